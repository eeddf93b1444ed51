from datetime import date, datetime, timedelta
from random import Random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.rows import profile, profiles
from tillroll.operators.dense_key import number_in_order, number_small_or_in_order
from tillroll.operators.dimensions import dim_store
from tillroll.operators.history import change_points, dim_customer_scd2, scd2_history
from tillroll.operators.marts import customers_with_changes
from tillroll.operators.profiles import clean_customer_profiles
from tillroll.operators.staging import stage_customer_profiles

SNAPSHOT = "customer_id string, loyalty_tier string, home_store_id string, email_domain string, snapshot_ts timestamp"


def day(n):
    return datetime(2026, 1, 1) + timedelta(days=n)


def history(spark, *rows):
    return dim_customer_scd2(spark.createDataFrame(rows, SNAPSHOT)).orderBy("customer_sk").collect()


def test_profiles_are_cleaned(spark):
    df = profiles(
        spark,
        profile(snapshot_ts="2024-05-20T08:00:00", home_store_id="shop-2"),
        profile(snapshot_ts="2024-05-20T09:00:00"),
        profile(customer_id="buyer-2", loyalty_tier="not_a_real_tier"),
        profile(customer_id="buyer-3", loyalty_tier=None),
        profile(customer_id="buyer-4", email="no-domain"),
    )
    rows = stage_customer_profiles(clean_customer_profiles(df)).orderBy("customer_id").collect()
    assert [r.customer_id for r in rows] == ["buyer-1", "buyer-4"]
    first, second = rows
    assert (first.email, first.full_name, first.home_store_id) == ("uma.quist@shop.test", "Uma Quist", "shop-1")
    assert (first.email_domain, second.email_domain) == ("shop.test", "")


def test_latest_profile_with_unknown_tier_hides_the_day(spark):
    df = profiles(spark, profile(), profile(snapshot_ts="2024-05-20T09:00:00", loyalty_tier="?"))
    assert clean_customer_profiles(df).count() == 0


def test_versions_and_ranges(spark):
    rows = history(
        spark,
        ("b", "gold", "s1", "x", day(0)),
        ("a", "gold", "s1", "x", day(0)),
        ("a", "gold", "s1", "x", day(1)),
        ("a", "silver", "s1", "y", day(2)),
        ("a", "silver", "s2", "y", day(5)),
    )
    got = [
        (r.customer_sk, r.customer_id, r.loyalty_tier, r.home_store_id, r.effective_start_date,
         r.effective_end_date, r.is_current)
        for r in rows
    ]
    assert got == [
        (1, "a", "gold", "s1", date(2026, 1, 1), date(2026, 1, 2), False),
        (2, "a", "silver", "s1", date(2026, 1, 3), date(2026, 1, 5), False),
        (3, "a", "silver", "s2", date(2026, 1, 6), None, True),
        (4, "b", "gold", "s1", date(2026, 1, 1), None, True),
    ]


def test_store_to_and_from_null_opens_versions(spark):
    rows = history(
        spark,
        ("a", "gold", None, "x", day(0)),
        ("a", "gold", "s1", "x", day(1)),
        ("a", "gold", None, "x", day(2)),
        ("a", "gold", None, "x", day(3)),
    )
    assert [r.home_store_id for r in rows] == [None, "s1", None]


def test_carried_column_opens_no_version(spark):
    rows = history(spark, ("a", "gold", "s", "old", day(0)), ("a", "gold", "s", "new", day(1)))
    assert [(r.email_domain, r.is_current) for r in rows] == [("old", True)]


def test_repeated_snapshots_count_once(spark):
    row = ("a", "gold", "s", "x", day(0))
    df = spark.createDataFrame([row, row], SNAPSHOT)
    points = change_points(df, "customer_id", ["loyalty_tier", "home_store_id"], ["email_domain"], "snapshot_ts")
    assert points.count() == 1


@pytest.fixture(scope="module")
def random_snapshots(spark):
    rng = Random(7)
    rows = []
    for c in range(120):
        for d in sorted(rng.sample(range(60), rng.randint(1, 25))):
            rows.append((f"c{c}", rng.choice(["gold", "silver"]), rng.choice(["s1", "s2", None]), "x", day(d)))
    # One customer with a snapshot on every day, as many as a customer can have.
    rows += [("hot", rng.choice(["gold", "silver"]), None, "x", day(d)) for d in range(1500)]
    return rows


def brute_force(rows):
    by_customer = {}
    for c, tier, store, _, ts in sorted(rows, key=lambda r: (r[0], r[4])):
        versions = by_customer.setdefault(c, [])
        if not versions or versions[-1][:2] != (tier, store):
            versions.append((tier, store, ts.date()))
    out, sk = [], 0
    for c in sorted(by_customer):
        versions = by_customer[c]
        for i, (tier, store, start) in enumerate(versions):
            sk += 1
            after = versions[i + 1][2] if i + 1 < len(versions) else None
            out.append((sk, c, tier, store, start, after and after - timedelta(days=1), after is None))
    return out


def test_history_equals_brute_force_and_tiles_time(spark, random_snapshots):
    df = spark.createDataFrame(random_snapshots, SNAPSHOT)
    for already_distinct in (False, True):
        rows = dim_customer_scd2(df, already_distinct).drop("email_domain", "dbt_loaded_at").collect()
        assert sorted(map(tuple, rows)) == brute_force(random_snapshots)


def test_generic_history(spark, random_snapshots):
    df = spark.createDataFrame(random_snapshots, SNAPSHOT)
    got = scd2_history(df, "customer_id", ["loyalty_tier"], "snapshot_ts", partitions=5)
    assert got.columns[:3] == ["version_sk", "customer_id", "loyalty_tier"]
    assert got.where("is_current").count() == 121


@pytest.mark.parametrize("partitions", [None, 1, 7])
def test_dense_numbers_equal_the_global_window(spark, partitions):
    df = spark.range(5000).select(
        # A third of the rows share one leading key.
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 97)).alias("k"),
        (F.col("id") * 7919 % 5003).alias("n"),
    )
    order = [F.col("k").asc_nulls_last(), F.col("n").asc_nulls_last()]
    expected = df.select(F.row_number().over(Window.orderBy(*order)).cast("long").alias("sk"), "*")
    got = number_in_order(df, "sk", order, partitions)
    assert got.count() == 5000
    assert got.exceptAll(expected.select(got.columns)).count() == 0


def test_dense_numbers_of_nothing(spark):
    df = spark.createDataFrame([], "k string")
    assert number_in_order(df, "sk", [F.col("k").asc_nulls_last()]).count() == 0


def test_large_dimension_leaves_the_single_task(spark, monkeypatch):
    df = spark.range(50).select(F.format_string("p%03d", 49 - F.col("id")).alias("product_id"))
    small = number_small_or_in_order(df, "sk", [F.col("product_id").asc_nulls_last()])
    monkeypatch.setattr("tillroll.operators.dense_key.ONE_TASK_MAX_ROWS", 10)
    large = number_small_or_in_order(df, "sk", [F.col("product_id").asc_nulls_last()])
    assert sorted(small.collect()) == sorted(large.collect())


def test_repeated_keys_of_a_dimension_get_the_same_numbers_on_both_ways(spark, monkeypatch):
    rows = [("s1", "n2", "r", "t"), ("s1", "n1", "r", "t"), ("s0", None, "r", "t"), ("s0", "n0", "r", "t")]
    names = ["store_id", "store_name", "region", "store_type"]

    def numbers(given):
        return {r.store_sk: (r.store_id, r.store_name) for r in dim_store(spark.createDataFrame(given, names)).collect()}

    small = numbers(rows)
    assert small == numbers(rows[::-1]) == {1: ("s0", "n0"), 2: ("s0", None), 3: ("s1", "n1"), 4: ("s1", "n2")}
    monkeypatch.setattr("tillroll.operators.dense_key.ONE_TASK_MAX_ROWS", 1)
    assert numbers(rows) == small


def test_customers_with_changes(spark):
    df = spark.createDataFrame(
        [
            ("a", "gold", "s", "x", day(0)), ("a", "silver", "s", "x", day(1)),
            ("b", "gold", "s", "x", day(0)),
            ("c", "gold", "s", "x", day(0)), ("c", "gold", "t", "x", day(1)), ("c", "gold", "s", "x", day(2)),
        ],
        SNAPSHOT,
    )
    assert [tuple(r) for r in customers_with_changes(dim_customer_scd2(df)).collect()] == [("c", 3), ("a", 2)]
