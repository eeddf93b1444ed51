"""Raw rows for tests, filled from the declared schemas: a test names only the columns it is about."""

from pyspark.sql.types import StructType

from tillroll import schemas

DAY = "2024-05-20"

# What the rules ask of a column that a test leaves open; all other columns are filled by type.
_SOUND = {
    "event_type": "sale",
    "loyalty_tier": "gold",
    "full_name": "  Uma Quist ",
    "email": " Uma.Quist@Shop.TEST",
    "home_store_id": "shop-1",
    "customer_id": "buyer-1",
    "product_id": "item-1",
    "store_id": "shop-1",
    "event_ts": f"{DAY}T09:15:00",
    "snapshot_ts": f"{DAY}T01:20:00",
    "ingest_ts": f"{DAY}T09:15:20",
}
_BY_TYPE = {"bigint": 4, "double": 40.0}


def _filled(schema: StructType, given: dict) -> dict:
    unknown = given.keys() - set(schema.names)
    assert not unknown, f"no such columns: {unknown}"
    sound = {f.name: _SOUND.get(f.name, _BY_TYPE.get(f.dataType.simpleString(), f.name)) for f in schema}
    return sound | given


def event(**given):
    return _filled(schemas.SALES_EVENTS_RAW, {"discount_amount": 0.0} | given)


def profile(**given):
    return _filled(schemas.PROFILES_RAW, {"ingest_ts": f"{DAY}T01:45:00"} | given)


def events(spark, *rows):
    return spark.createDataFrame(list(rows), schemas.SALES_EVENTS_RAW)


def profiles(spark, *rows):
    return spark.createDataFrame(list(rows), schemas.PROFILES_RAW)
