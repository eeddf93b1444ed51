import hashlib
import math
from datetime import date, datetime, timedelta
from random import Random

import pytest
from pyspark.sql import functions as F

from tillroll import schemas
from tillroll.functions.keys import NULL_PART, date_key, surrogate_key
from tillroll.functions.scalars import exact_sum, to_cents
from tillroll.operators.dimensions import date_dimension, dim_product, dim_store
from tillroll.operators.facts import (
    asof_by_day,
    asof_by_range,
    choose_strategy,
    fct_sales,
    with_customer_version,
)
from tillroll.operators.marts import mart_customer_ltv, mart_daily_store_sales, top_customers

HISTORY = "customer_sk long, customer_id string, effective_start_date date, effective_end_date date"
SALES = "event_id string, customer_id string, event_ts timestamp"


@pytest.fixture(scope="module")
def world():
    rng = Random(11)
    versions, sk = [], 0
    for c in range(40):
        starts = sorted(rng.sample(range(100), rng.randint(1, 8)))
        for i, s in enumerate(starts):
            sk += 1
            end = date(2026, 1, 1) + timedelta(days=starts[i + 1] - 1) if i + 1 < len(starts) else None
            versions.append((sk, f"c{c}", date(2026, 1, 1) + timedelta(days=s), end))
    sales = []
    for n in range(3000):
        # A third of all sales belong to one customer, some to none, some to an unknown one.
        owner = "c0" if n % 3 == 0 else rng.choice([None, "stranger", *(f"c{c}" for c in range(40))])
        sales.append((f"e{n}", owner, datetime(2026, 1, 1) + timedelta(minutes=rng.randint(0, 120 * 1440))))
    return versions, sales


def expected_versions(versions, sales):
    out = {}
    for event_id, owner, ts in sales:
        hits = [
            sk for sk, c, start, end in versions
            if c == owner and start <= ts.date() and (end is None or ts.date() <= end)
        ]
        assert len(hits) <= 1
        out[event_id] = hits[0] if hits else None
    return out


@pytest.mark.parametrize("strategy", ["broadcast", "range", "days", "auto", "auto large"])
def test_asof_equals_brute_force(spark, world, strategy, monkeypatch):
    versions, sales = world
    history = spark.createDataFrame(versions, HISTORY)
    frame = spark.createDataFrame(sales, SALES)
    if strategy == "auto large":
        monkeypatch.setattr("tillroll.operators.facts.BROADCAST_MAX_ROWS", 3)
        assert choose_strategy(history) == "days"
        strategy = "auto"
    joined = with_customer_version(frame, history, strategy)
    assert joined.columns == [*frame.columns, "customer_sk"]
    got = joined.collect()
    assert len(got) == len(sales)
    assert {r.event_id: r.customer_sk for r in got} == expected_versions(versions, sales)


@pytest.mark.parametrize("strategy", ["broadcast", "range", "days"])
def test_versions_that_start_on_one_day(spark, strategy):
    """The earlier of them ended before it began, whichever row comes first."""
    start, before = date(2026, 1, 5), date(2026, 1, 4)
    versions = [(2, "a", start, None), (1, "a", start, before), (3, "b", start, before), (4, "b", start, None)]
    sales = [("e1", "a", datetime(2026, 1, 5, 3)), ("e2", "b", datetime(2026, 1, 9)), ("e3", "a", datetime(2026, 1, 4))]
    for rows in (versions, versions[::-1]):
        joined = with_customer_version(
            spark.createDataFrame(sales, SALES), spark.createDataFrame(rows, HISTORY), strategy
        )
        assert {r.event_id: r.customer_sk for r in joined.collect()} == {"e1": 2, "e2": 4, "e3": None}


def test_gap_in_a_history_matches_nothing(spark):
    history = spark.createDataFrame(
        [(1, "a", date(2026, 1, 1), date(2026, 1, 5)), (2, "a", date(2026, 1, 10), None)], HISTORY
    )
    sales = spark.createDataFrame([("e", "a", datetime(2026, 1, 7))], SALES)
    for join in (asof_by_day, asof_by_range):
        assert join(sales, history).first().customer_sk is None


def test_changeover_day_belongs_to_the_new_version(spark):
    history = spark.createDataFrame(
        [(1, "a", date(2026, 1, 1), date(2026, 1, 5)), (2, "a", date(2026, 1, 6), None)], HISTORY
    )
    sales = spark.createDataFrame(
        [
            ("last", "a", datetime(2026, 1, 5, 23, 59)),
            ("first", "a", datetime(2026, 1, 6)),
            ("early", "a", datetime(2025, 12, 31)),
        ],
        SALES,
    )
    for join in (asof_by_day, asof_by_range):
        got = {r.event_id: r.customer_sk for r in join(sales, history).collect()}
        assert got == {"last": 1, "first": 2, "early": None}


def test_surrogate_key(spark):
    df = spark.createDataFrame([("a", 1, None)], "x string, y int, z string")
    row = df.select(
        surrogate_key(F.col("x")).alias("one"),
        surrogate_key(F.col("x"), F.col("y"), F.col("z")).alias("three"),
    ).first()
    assert row.one == hashlib.md5(b"a").hexdigest()
    assert row.three == hashlib.md5(f"a||1||{NULL_PART}".encode()).hexdigest()


def test_date_key(spark):
    df = spark.createDataFrame([(datetime(2026, 3, 9, 23, 59),)], "t timestamp")
    assert df.select(date_key(F.col("t"))).first()[0] == 20260309


def test_standard_calendar(spark):
    days = date_dimension(spark)
    rows = {r.date_sk: r for r in days.collect()}
    assert len(rows) == 1461 and min(rows) == 20240101 and max(rows) == 20271231
    sunday, monday = rows[20260719], rows[20260720]
    assert (sunday.day_of_week, sunday.is_weekend) == (0, True)
    assert (monday.day_of_week, monday.is_weekend, monday.quarter, monday.month) == (1, False, 3, 7)


@pytest.fixture(scope="module")
def star(spark):
    products = dim_product(
        spark.createDataFrame(
            [("p2", "b", "c", "s", 1.0, 2.0), ("p1", "a", "c", "s", 1.0, 2.0)],
            schemas.PRODUCTS,
        )
    )
    stores = dim_store(
        spark.createDataFrame(
            [("s2", "two", "N", "x"), ("s1", "one", "S", "x")],
            schemas.STORES,
        )
    )
    history = spark.createDataFrame(
        [
            (1, "a", "silver", date(2026, 1, 1), date(2026, 1, 9), False),
            (2, "a", "gold", date(2026, 1, 10), None, True),
            (3, "b", "platinum", date(2026, 1, 1), None, True),
            (4, "c", "bronze", date(2026, 1, 1), None, True),
        ],
        "customer_sk long, customer_id string, loyalty_tier string, effective_start_date date,"
        " effective_end_date date, is_current boolean",
    )
    now = datetime(2026, 2, 1)
    sales = spark.createDataFrame(
        [
            ("e1", "a", "p1", "s1", 1, 10.0, 0.0, 10.0, datetime(2026, 1, 5, 9), now),
            ("e2", "a", "p2", "s1", 2, 10.0, 0.5, 19.5, datetime(2026, 1, 10, 9), now),
            ("e3", "b", "p1", "s1", 3, 0.1, 0.0, 0.3, datetime(2026, 1, 10, 10), now),
            ("e4", None, "p1", "s1", 1, 7.0, 0.0, 7.0, datetime(2026, 1, 10, 11), now),
            ("e5", "b", "unknown", "nowhere", 1, 5.0, 0.0, 5.0, datetime(2026, 1, 10, 12), now),
            ("e6", "b", "p1", "s2", 1, 5.0, 0.0, 5.0, datetime(2023, 1, 1), now),
        ],
        "event_id string, customer_id string, product_id string, store_id string, quantity int, unit_price double,"
        " discount_amount double, line_amount double, event_ts timestamp, silver_loaded_at timestamp",
    )
    return fct_sales(sales, history, products, stores).cache(), history, stores


def test_fact(star):
    rows = {r.event_id: r for r in star[0].collect()}
    keys = {e: (r.customer_sk, r.product_sk, r.store_sk, r.date_sk) for e, r in rows.items()}
    assert keys == {
        "e1": (1, 1, 1, 20260105),
        "e2": (2, 2, 1, 20260110),
        "e3": (3, 1, 1, 20260110),
        "e4": (None, 1, 1, 20260110),
        "e5": (3, None, None, 20260110),
        "e6": (None, 1, 2, 20230101),
    }
    assert rows["e1"].sale_line_sk == hashlib.md5(b"e1").hexdigest()


@pytest.mark.parametrize("unique", [True, False])
def test_daily_mart(spark, star, unique):
    fact, _, stores = star
    rows = mart_daily_store_sales(fact, stores, date_dimension(spark), unique).orderBy("calendar_date").collect()
    # The unknown store and the day outside the calendar are left out.
    assert [tuple(r) for r in rows] == [
        ("s1", "one", "S", date(2026, 1, 5), False, 1, 1, 10.0, 10.0),
        ("s1", "one", "S", date(2026, 1, 10), True, 3, 6, 26.8, 8.93),
    ]


def test_repeated_events_count_once_without_the_uniqueness_claim(spark, star):
    fact, _, stores = star
    doubled = fact.unionByName(fact)
    rows = mart_daily_store_sales(doubled, stores, date_dimension(spark)).orderBy("calendar_date").collect()
    assert [(r.n_transactions, r.total_units_sold) for r in rows] == [(1, 2), (3, 12)]


def test_stores_sharing_all_labels_form_one_group(spark, star):
    fact, _, _ = star
    twins = spark.createDataFrame(
        [(1, "s", "same", "N"), (2, "s", "same", "N")],
        "store_sk long, store_id string, store_name string, region string",
    )
    both = fact.withColumn("date_sk", F.lit(20260110))
    results = [
        mart_daily_store_sales(both, twins, date_dimension(spark), unique).collect() for unique in (True, False)
    ]
    assert results[0] == results[1] and len(results[0]) == 1


@pytest.mark.parametrize("unique", [True, False])
def test_ltv(star, unique):
    fact, history, _ = star
    rows = {r.customer_id: r for r in mart_customer_ltv(fact, history, events_unique=unique).collect()}
    a, b, c = rows["a"], rows["b"], rows["c"]
    # Orders under an earlier version do not count.
    assert (a.total_orders, a.total_revenue, a.avg_order_value, a.estimated_ltv) == (1, 19.5, 19.5, 35.1)
    assert (b.total_orders, b.total_revenue, b.avg_order_value, b.estimated_ltv) == (2, 5.3, 2.65, 13.25)
    assert (c.total_orders, c.total_revenue, c.avg_order_value, c.estimated_ltv) == (0, 0.0, None, 0.0)
    assert (c.first_purchase_date, b.last_purchase_date) == (None, date(2026, 1, 10))


@pytest.mark.parametrize("unique", [True, False])
def test_ltv_over_all_versions(star, unique):
    fact, history, _ = star
    rows = {r.customer_id: r for r in mart_customer_ltv(fact, history, "customer", unique).collect()}
    a = rows["a"]
    assert (a.customer_sk, a.total_orders, a.total_revenue, a.first_purchase_date) == (2, 2, 29.5, date(2026, 1, 5))
    with pytest.raises(ValueError):
        mart_customer_ltv(fact, history, "other")


def test_top_customers(star):
    fact, history, _ = star
    assert [r.customer_id for r in top_customers(mart_customer_ltv(fact, history), 2).collect()] == ["a", "b"]


@pytest.mark.parametrize("unique", [True, False])
def test_amount_that_is_no_number_stays_in_its_own_group(spark, star, unique):
    fact, history, stores = star
    broken = fact.withColumn(
        "line_amount", F.when(F.col("event_id") == "e1", F.lit(float("nan"))).otherwise(F.col("line_amount"))
    )
    daily = mart_daily_store_sales(broken, stores, date_dimension(spark), unique).orderBy("calendar_date").collect()
    assert math.isnan(daily[0].total_revenue) and math.isnan(daily[0].avg_line_amount)
    assert daily[1].total_revenue == 26.8
    ltv = {r.customer_id: r for r in mart_customer_ltv(broken, history, "customer", unique).collect()}
    assert math.isnan(ltv["a"].estimated_ltv) and ltv["b"].total_revenue == 5.3


def test_sums_of_any_double(spark):
    df = spark.createDataFrame(
        [("inf", float("inf")), ("inf", 1.0), ("huge", 1e30), ("huge", 2.5), ("null", None), ("one", 1.25)],
        "k string, x double",
    )
    got = {r.k: r.s for r in df.groupBy("k").agg(exact_sum(F.col("x")).alias("s")).collect()}
    assert got == {"inf": float("inf"), "huge": 1e30, "null": None, "one": 1.25}


def test_cents(spark):
    df = spark.createDataFrame([(1.005,), (-1.005,), (2.675,), (None,), (1e40,)], "x double")
    assert [r[0] for r in df.select(to_cents(F.col("x"))).collect()] == [1.01, -1.01, 2.68, None, 1e40]


def test_sums_do_not_drift(spark):
    df = spark.range(1000).select(F.lit(0.1).alias("x"))
    assert df.agg(exact_sum(F.col("x"))).first()[0] == 100.0
