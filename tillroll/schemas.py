"""Declared schemas of every stored table, used on each read (streaming reads require them)."""

from pyspark.sql import types as T


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in columns.items()])


_S, _L, _D, _B = T.StringType(), T.LongType(), T.DoubleType(), T.BooleanType()
_TS, _DATE = T.TimestampType(), T.DateType()

# Raw layer. Timestamps land as ISO-8601 text.
SALES_EVENTS_RAW = _struct(
    event_id=_S,
    event_type=_S,
    customer_id=_S,
    product_id=_S,
    store_id=_S,
    quantity=_L,
    unit_price=_D,
    discount_amount=_D,
    event_ts=_S,
    ingest_ts=_S,
    source_partition=_S,
    schema_version=_S,
)
PROFILES_RAW = _struct(
    customer_id=_S,
    full_name=_S,
    email=_S,
    loyalty_tier=_S,
    home_store_id=_S,
    snapshot_ts=_S,
    ingest_ts=_S,
    schema_version=_S,
)

# Clean layer, without the partition column that the directory name carries.
SALES_EVENTS_CLEAN = _struct(
    event_id=_S,
    event_type=_S,
    customer_id=_S,
    product_id=_S,
    store_id=_S,
    quantity=_L,
    unit_price=_D,
    discount_amount=_D,
    line_amount=_D,
    event_ts=_TS,
    silver_loaded_at=_TS,
    is_late_arrival=_B,
)
PROFILES_CLEAN = _struct(
    customer_id=_S,
    full_name=_S,
    email=_S,
    loyalty_tier=_S,
    home_store_id=_S,
    snapshot_ts=_TS,
    silver_loaded_at=_TS,
)

# Reference data, CSV with a header.
PRODUCTS = _struct(
    product_id=_S, product_name=_S, category=_S, subcategory=_S, unit_cost=_D, list_price=_D
)
STORES = _struct(store_id=_S, store_name=_S, region=_S, store_type=_S)
CUSTOMER_IDS = _struct(customer_id=_S)

# Test-run document: {"results": [{"status": "pass"}, ...]}
RUN_RESULTS = T.StructType(
    [T.StructField("results", T.ArrayType(T.StructType([T.StructField("status", _S, True)])), True)]
)


def with_partition(schema: T.StructType, column: str) -> T.StructType:
    """A stored table's schema plus its date partition column."""
    return T.StructType([*schema.fields, T.StructField(column, _DATE, True)])
