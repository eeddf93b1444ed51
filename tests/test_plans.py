"""Shape of the physical plans."""

import re

import pytest
from pyspark.sql import functions as F

from tillroll.operators.facts import asof_by_day
from tillroll.operators.marts import mart_daily_store_sales
from tillroll.plans.catalog import all_queries
from tillroll.sources import retail_tables as retail

SF = "/root/testdata/sf0.001"

BUILT_WITHOUT_STORING = [
    name
    for name in all_queries()
    if not name.startswith(("stream_", "daily_run", "silver_", "bronze_", "table_counts", "dq_su"))
]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BUILT_WITHOUT_STORING)
def test_no_python_and_no_cross_join(spark, name):
    plan = plan_of(all_queries()[name](spark, SF))
    for node in ("PythonUDF", "EvalPython", "InPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan


def test_dedupe_cuts_copies_before_the_shuffle(spark):
    plan = plan_of(all_queries()["dedupe_events"](spark, SF))
    partial, exchange = plan.index(", row_number(), 1, Partial"), plan.index("Exchange hashpartitioning(event_id")
    assert exchange < partial  # printed top-down: the exchange reads from the partial limit
    assert plan.count("Exchange hashpartitioning") == 1


def test_fact_is_shuffled_by_the_deduplication_only(spark):
    plan = plan_of(all_queries()["fct_sales"](spark, SF))
    on_rows = [line for line in plan.splitlines() if "Exchange hashpartitioning(event_id" in line]
    assert len(on_rows) == 1 and "SortMergeJoin" not in plan


def test_only_small_counts_meet_in_one_task(spark):
    """The history's numbers come from range partitions; one task sees one row per partition."""
    plan = plan_of(all_queries()["dim_customer_scd2"](spark, SF))
    single = [line for line in plan.splitlines() if "SinglePartition" in line]
    assert len(single) == 1
    below = plan.splitlines()[plan.splitlines().index(single[0]) + 1 :]
    assert "HashAggregate(keys=[" in below[0] or "HashAggregate(keys=[" in below[1]


def test_sales_by_day_join_on_customer_and_day(spark):
    sales = spark.createDataFrame([], "event_id string, customer_id string, event_ts timestamp")
    history = spark.createDataFrame(
        [], "customer_sk long, customer_id string, effective_start_date date, effective_end_date date"
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(asof_by_day(sales, history))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert re.search(r"SortMergeJoin \[customer_id#\d+, cast\(event_ts#\d+ as date\)\]", plan)
    assert "Exchange SinglePartition" not in plan


def test_hot_customer_day_is_split_at_run_time(spark):
    """A third of all sales on one customer and day: the join splits that partition."""
    i = F.col("id")
    hot = i % 3 == 0
    sales = spark.range(0, 300_000, 1, 8).select(
        i.cast("string").alias("event_id"),
        F.when(hot, "c0").otherwise(F.concat(F.lit("c"), i % 500)).alias("customer_id"),
        F.timestamp_seconds(F.when(hot, 0).otherwise(i * 60)).alias("event_ts"),
    )
    history = spark.range(500).select(
        i.alias("customer_sk"),
        F.concat(F.lit("c"), i).alias("customer_id"),
        F.to_date(F.lit("1970-01-01")).alias("effective_start_date"),
        F.lit(None).cast("date").alias("effective_end_date"),
    )
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200KB",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        joined = asof_by_day(sales, history)
        rows = joined.collect()
        assert "skew=true" in plan_of(joined)
    finally:
        for name in settings:
            spark.conf.unset(name)
    assert len(rows) == 300_000
    assert all(r.customer_id == f"c{r.customer_sk}" for r in rows)


def test_daily_mart_reads_four_fact_columns_and_reduces_first(spark, tmp_path):
    columns = "event_id string, store_sk long, date_sk int, quantity int, unit_price double, line_amount double"
    spark.createDataFrame([("e", 1, 20240101, 1, 1.0, 1.0)], columns).write.parquet(str(tmp_path / "f"))
    fact = spark.read.parquet(str(tmp_path / "f"))
    stores = spark.createDataFrame(
        [(1, "s", "n", "r")], "store_sk long, store_id string, store_name string, region string"
    )
    dates = spark.createDataFrame([(20240101, None, True)], "date_sk int, calendar_date date, is_weekend boolean")
    plan = plan_of(mart_daily_store_sales(fact, stores, dates, events_unique=True))
    scan = next(line for line in plan.splitlines() if "FileScan parquet" in line)
    assert "unit_price" not in scan
    lowest = [line for line in plan.splitlines() if "Exchange hashpartitioning(" in line][-1]
    assert "store_sk" in lowest and "date_sk" in lowest


def test_filters_and_columns_reach_the_scan(spark):
    sales = retail.table(spark, SF, "orders").where("o_orderkey > 10").select("o_custkey")
    plan = plan_of(sales.groupBy("o_custkey").agg(F.count(F.lit(1))))
    assert "GreaterThan(o_orderkey,10)" in plan and "o_totalprice" not in plan
