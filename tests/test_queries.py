"""Every named query against its SQL statement."""

from datetime import date

import pytest

import __spark_entry__ as entry
from oracle import ORACLE
from tests.compare import difference
from tillroll.plans.catalog import all_queries

SF = "/root/testdata/sf0.001"


def test_every_query_has_a_statement():
    assert set(all_queries()) == set(ORACLE)
    assert set(all_queries()) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, name):
    df = entry.queries()[name](spark, SF)
    assert difference(df, SF, entry.oracle_sql()[name]) is None


def test_entry(spark):
    assert entry.entry(spark).limit(1).count() == 1


@pytest.mark.parametrize("name", ["staged_sales", "quarantined_events"])
def test_large_tables_are_shuffled_by_order_once(spark, name):
    """The join by order serves the deduplication: lines and orders, one shuffle each."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        df = entry.queries()[name](spark, "/root/testdata/sf0.001")
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("Exchange hashpartitioning(") == 2
    assert "src_order" not in df.columns


def test_null_check_of_the_fact_joins_no_other_dimension(spark, tmp_path):
    day = date(2024, 5, 20)
    tables = {
        "orders": [dict(o_orderkey=k, o_custkey=1, o_orderdate=day, o_orderpriority="2-HIGH") for k in (1, 12)],
        "lineitem": [
            dict(
                l_orderkey=k, l_linenumber=1, l_partkey=3, l_suppkey=4, l_quantity=5.0, l_extendedprice=9.0,
                l_discount=0.0, l_returnflag="A", l_shipdate=day,
            )
            for k in (1, 12)
        ],
        "part": [dict(p_partkey=3, p_name="p", p_brand="b", p_type="t", p_size=1, p_retailprice=9.0)],
        "supplier": [dict(s_suppkey=4, s_name="s", s_nationkey=0)],
        "nation": [dict(n_nationkey=0, n_regionkey=0)],
        "region": [dict(r_regionkey=0, r_name="r")],
    }
    for name, rows in tables.items():
        spark.createDataFrame(rows).write.parquet(f"{tmp_path}/{name}.parquet")
    found = entry.queries()["dq_not_null"](spark, str(tmp_path))
    assert "_key" not in found._jdf.queryExecution().optimizedPlan().toString()
    # The order without a customer.
    assert [r.event_id for r in found.collect()] == ["12-1"]
