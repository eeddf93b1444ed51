"""Retail domain tables derived from an order-management star schema in Parquet.

``lineitem`` and ``orders`` become point-of-sale events and customer snapshots, ``part`` and
``supplier`` become products and stores. The activity log ``events`` becomes broker deliveries for
the storage and streaming jobs. Broken, late and repeated events follow from the keys, so the same
tables always give the same events.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.operators.profiles import VALID_LOYALTY_TIERS

# Total order among the copies of an event that arrived at the same moment.
EVENT_TIE_BREAKERS = ["src_part", "src_supplier"]
PROFILE_TIE_BREAKERS = ["src_order"]
# The event id begins with the order, so all copies of an event share it.
EVENT_SHARED = ["src_order"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _prefixed(prefix: str, key: str) -> Column:
    return F.concat(F.lit(prefix), F.col(key).cast("string"))


def _every(key: str, n: int) -> Column:
    return F.col(key) % n == 0


def _later(ts: str, unit: str, amount: Column) -> Column:
    return F.timestamp_add(unit, amount.cast("int"), F.col(ts))


def sales_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw events of shipped order lines; ``src_*`` columns order copies that arrive together."""
    return sales_events_by_order(spark, sf_dir).drop(*EVENT_SHARED)


def sales_events_by_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with the order, by which large tables lie after the join."""
    owners = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    lines = table(spark, sf_dir, "lineitem")
    shipped = lines.join(owners, F.col("l_orderkey") == F.col("o_orderkey")).withColumn(
        "event_ts", F.col("l_shipdate").cast("timestamp")
    )
    event_type = (
        F.when(F.col("l_returnflag") == "R", "refund")
        .when((F.col("l_returnflag") == "N") & _every("l_suppkey", 5), "void")
        .when(_every("l_partkey", 211), "unknown")
        .otherwise("sale")
    )
    signed = F.when(F.col("l_returnflag") == "R", -F.col("l_quantity")).otherwise(F.col("l_quantity"))
    price = F.col("l_extendedprice")
    return shipped.select(
        F.concat_ws("-", F.col("l_orderkey"), F.col("l_linenumber")).alias("event_id"),
        event_type.alias("event_type"),
        F.when(~_every("l_orderkey", 12), _prefixed("CUST-", "o_custkey")).alias("customer_id"),
        F.when(_every("l_partkey", 97), "").otherwise(_prefixed("PROD-", "l_partkey")).alias("product_id"),
        _prefixed("STORE-", "l_suppkey").alias("store_id"),
        F.when(_every("l_partkey", 89), 0).otherwise(signed).cast("long").alias("quantity"),
        F.when(_every("l_partkey", 101), -price).otherwise(price).alias("unit_price"),
        F.when(F.col("l_discount") != 0, F.round(F.col("l_discount") * 100)).alias("discount_amount"),
        "event_ts",
        _later("event_ts", "MINUTE", F.col("l_partkey") % 7 * 20).alias("ingest_ts"),
        F.col("l_partkey").alias("src_part"),
        F.col("l_suppkey").alias("src_supplier"),
        F.col("l_orderkey").alias("src_order"),
    )


def _iso(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def _activity(spark: SparkSession, sf_dir: str, stream: bool) -> DataFrame:
    log = table(spark, sf_dir, "events")
    if stream:
        # The glob finds the table whether it is one file or a directory of files.
        log = spark.readStream.schema(log.schema).parquet(f"{sf_dir}/events.parquet*")
    return log.withColumn("happened", F.col("ts").cast("timestamp"))


def delivered_events(
    spark: SparkSession, sf_dir: str, stream: bool = False, second_copies_moved: bool = False
) -> DataFrame:
    """The activity log as a broker would deliver it: some events twice, late or malformed.

    Exactly the raw schema, timestamps as text. Copies of an event share its event time, unless the second ones
    are ``moved``: to the day after.
    """
    delivered = _activity(spark, sf_dir, stream).withColumn(
        "copy", F.explode(F.sequence(F.lit(0), F.when(_every("event_id", 67), 1).otherwise(0)))
    )
    n = F.col("event_id")
    event_type = (
        F.when(n % 199 == 0, "unknown")
        .when(F.col("event_type") == "error", "refund")
        .when(F.col("event_type") == "signup", "void")
        .otherwise("sale")
    )
    units = n % 5 + 1 + F.col("copy")
    signed = F.when(F.col("event_type") == "error", -units).otherwise(units)
    delay = F.when(n % 50 == 0, (n % 6 + 1) * 3600).otherwise(2) + F.col("copy") * 5
    return delivered.select(
        _prefixed("EVT-", "event_id").alias("event_id"),
        event_type.alias("event_type"),
        F.when(n % 12 != 0, _prefixed("CUST-", "user_id")).alias("customer_id"),
        F.when(n % 200 == 0, "")
        .otherwise(F.concat(F.lit("PROD-"), (n % 120).cast("string")))
        .alias("product_id"),
        F.concat(F.lit("STORE-"), (F.col("user_id") % 10).cast("string")).alias("store_id"),
        F.when(n % 400 == 1, 0).otherwise(signed).cast("long").alias("quantity"),
        F.when(n % 401 == 0, -F.col("value")).otherwise(F.col("value")).alias("unit_price"),
        F.when(n % 3 != 0, (n % 4).cast("double")).alias("discount_amount"),
        _iso(_later("happened", "DAY", F.col("copy") * int(second_copies_moved))).alias("event_ts"),
        _iso(_later("happened", "SECOND", delay)).alias("ingest_ts"),
        F.concat(F.lit("shard-"), (n % 4).cast("string")).alias("source_partition"),
        F.lit("v1").alias("schema_version"),
    )


def delivered_profiles(spark: SparkSession, sf_dir: str, stream: bool = False) -> DataFrame:
    """Customer snapshots from the sign-ups of the activity log, in the raw schema."""
    tiers = F.array(*map(F.lit, [*VALID_LOYALTY_TIERS, "not_a_real_tier"]))
    user = F.col("user_id").cast("string")
    n = F.col("event_id")
    return (
        _activity(spark, sf_dir, stream)
        .where("event_type = 'signup'")
        .select(
            F.concat(F.lit("CUST-"), user).alias("customer_id"),
            F.concat(F.lit("  Name "), user, F.lit(" ")).alias("full_name"),
            F.concat(F.lit(" User"), user, F.lit("@Example.COM ")).alias("email"),
            tiers[n % 5].alias("loyalty_tier"),
            F.when(n % 7 != 0, F.concat(F.lit("STORE-"), (n % 3).cast("string"))).alias("home_store_id"),
            _iso(F.col("happened")).alias("snapshot_ts"),
            _iso(_later("happened", "MINUTE", F.lit(5))).alias("ingest_ts"),
            F.lit("v1").alias("schema_version"),
        )
    )


def customer_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    tier = F.create_map(
        *map(
            F.lit,
            [
                "1-URGENT", "platinum",
                "2-HIGH", "gold",
                "3-MEDIUM", "silver",
                "4-NOT SPECIFIED", "bronze",
                "5-LOW", "not_a_real_tier",
            ],
        )
    )
    customer = F.col("o_custkey").cast("string")
    domain = (F.col("o_custkey") % 5).cast("string")
    taken = F.col("o_orderdate").cast("timestamp")
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("CUST-"), customer).alias("customer_id"),
        F.concat(F.lit("  Name "), customer, F.lit(" ")).alias("full_name"),
        F.concat(F.lit("  User"), customer, F.lit("@EXAMPLE"), domain, F.lit(".com ")).alias("email"),
        tier[F.col("o_orderpriority")].alias("loyalty_tier"),
        F.when(
            ~_every("o_orderkey", 17),
            F.concat(F.lit("STORE-"), (F.col("o_orderkey") % 3).cast("string")),
        ).alias("home_store_id"),
        taken.alias("snapshot_ts"),
        taken.alias("ingest_ts"),
        F.col("o_orderkey").alias("src_order"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        _prefixed("PROD-", "p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_brand").alias("category"),
        F.col("p_type").alias("subcategory"),
        F.col("p_size").cast("double").alias("unit_cost"),
        F.col("p_retailprice").alias("list_price"),
    )


def stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    places = nation.join(region, nation.n_regionkey == region.r_regionkey)
    kinds = F.array(*map(F.lit, ["hypermarket", "supermarket", "express"]))
    return (
        table(spark, sf_dir, "supplier")
        .join(places, F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            _prefixed("STORE-", "s_suppkey").alias("store_id"),
            F.col("s_name").alias("store_name"),
            F.col("r_name").alias("region"),
            kinds[F.col("s_nationkey") % 3].alias("store_type"),
        )
    )


def customer_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(_prefixed("CUST-", "c_custkey").alias("customer_id"))
