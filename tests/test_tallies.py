import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tillroll.operators.tallies import EVENT_NO, number_events, sales_by, store_day_tallies

SALES = "event_id string, store_id string, event_ts timestamp"
FACT = "event_no long, store_sk long, date_sk int, quantity int, line_amount double"


@pytest.fixture(scope="module")
def dims(spark):
    stores = spark.createDataFrame(
        [(1, "s1", "N"), (2, "s2", "N"), (3, "s3", "S")], "store_sk long, store_id string, region string"
    )
    dates = spark.createDataFrame(
        [(20240101 + i, date(2024, 1, 1) + timedelta(i), i // 5) for i in range(10)],
        "date_sk int, calendar_date date, week int",
    )
    return stores, dates


def plain(rows, label):
    groups = {}
    for number, store, day, quantity, amount in rows:
        group = groups.setdefault(label(store, day), [set(), 0, 0.0])
        group[0].update([] if number is None else [number])
        group[1] += quantity
        group[2] += amount
    return {key: (len(ids), units, round(revenue, 2)) for key, (ids, units, revenue) in groups.items()}


def found(df, *grain):
    return {
        tuple(r[c] for c in grain): (r.n_transactions, r.total_units_sold, round(r.total_revenue, 2))
        for r in df.collect()
    }


def test_counts_equal_sets_at_every_grain(spark, dims):
    """Numbers over many buckets, lines that repeat, one store and day with a third of all, events without id."""
    pick = random.Random(5)
    rows = []
    for i in range(6000):
        number = None if i % 50 == 0 else pick.choice([i, i * 40_000, (3 << 33) + i, 32_768, 32_769])
        hot = i % 3 == 0
        rows.append((number, 1 if hot else pick.randint(1, 3), 20240101 if hot else 20240101 + pick.randint(0, 9), 1 + i % 4, 0.25 * (i % 7)))
    rows += rows[:500]
    tallies = store_day_tallies(spark.createDataFrame(rows, FACT).repartition(7))
    assert found(sales_by(tallies, *dims, ["store_id", "calendar_date"]), "store_id", "calendar_date") == plain(
        rows, lambda s, d: (f"s{s}", date(2024, 1, 1) + timedelta(d - 20240101))
    )
    assert found(sales_by(tallies, *dims, ["region", "week"]), "region", "week") == plain(
        rows, lambda s, d: ("S" if s == 3 else "N", (d - 20240101) // 5)
    )


def test_runs_with_equal_numbers_stay_apart(spark, dims):
    runs = [store_day_tallies(spark.createDataFrame([(7, 1, 20240101, 1, 2.0)] * 2, FACT), run) for run in (0, 1)]
    (row,) = sales_by(runs[0].unionByName(runs[1]), *dims, ["region"]).collect()
    assert (row.n_transactions, row.total_units_sold, row.total_revenue, row.avg_line_amount) == (2, 4, 8.0, 2.0)


def test_unknown_store_or_day_and_nothing_at_all(spark, dims):
    odd = [(1, 9, 20240101, 1, 1.0), (2, None, 20240101, 1, 1.0), (3, 1, 20300101, 1, 1.0), (4, 1, None, 1, 1.0)]
    assert sales_by(store_day_tallies(spark.createDataFrame(odd, FACT)), *dims, ["region"]).count() == 0
    assert sales_by(store_day_tallies(spark.createDataFrame([], FACT)), *dims, ["region"]).count() == 0


def test_nulls_in_amount_and_quantity(spark, dims):
    rows = [(1, 1, 20240101, None, None), (2, 1, 20240101, None, None)]
    (row,) = sales_by(store_day_tallies(spark.createDataFrame(rows, FACT)), *dims, ["region"]).collect()
    assert (row.n_transactions, row.total_units_sold, row.total_revenue, row.avg_line_amount) == (2, None, None, None)


def test_numbers_are_unique_and_days_of_a_store_lie_together(spark):
    noon = datetime(2024, 1, 1, 12)
    rows = [(f"e{i}", f"s{i % 4}", noon + timedelta(days=i % 5)) for i in range(4000)]
    rows += [(None, "s0", noon), ("undated", None, None)]
    sales = spark.createDataFrame(rows, SALES).repartition(9)
    numbered = number_events(sales)
    assert sorted(map(repr, numbered.select(*sales.columns).collect())) == sorted(map(repr, sales.collect()))
    one = numbered.agg(
        F.count(EVENT_NO).alias("n"), F.count_distinct(EVENT_NO).alias("d"), F.min(EVENT_NO).alias("least")
    ).first()
    assert (one.n, one.d) == (4001, 4001) and one.least >= 1
    buckets = numbered.where("event_id like 'e%'").select(
        "store_id", F.to_date("event_ts").alias("day"), F.bitmap_bucket_number(EVENT_NO).alias("b")
    )
    # 20 groups over 8 ranges: each range boundary splits at most one group.
    assert buckets.distinct().count() <= 28
    again = numbered.select("event_id", EVENT_NO).where("event_id = 'e17'").collect()
    assert again == numbered.select("event_id", EVENT_NO).where("event_id = 'e17'").collect()


def test_no_shuffle_carries_event_ids(spark, dims, tmp_path):
    spark.createDataFrame([(1, 1, 20240101, 1, 1.0)], FACT).withColumn("event_id", F.lit("e")).write.parquet(
        str(tmp_path / "f")
    )
    result = sales_by(store_day_tallies(spark.read.parquet(str(tmp_path / "f"))), *dims, ["region"])
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "event_id" not in plan
    lowest = [line for line in plan.splitlines() if "Exchange hashpartitioning(" in line][-1]
    assert "store_sk" in lowest and "bitmap" not in lowest
    assert "partial_bitmap_construct_agg" in plan


def test_sparse_days_stay_one_word_per_event_and_equal_the_bitmaps(spark, dims):
    """A fact of few events per store and day makes no 4 KB bitmap, and both forms merge in one result."""
    days = 3000
    rows = [(i if i % 40 else None, 1 + i % 3, 20240101 + i % days, 1 + i % 4, 0.25 * (i % 7)) for i in range(2 * days)]
    rows += [(-70, 1, 20240101, 1, 1.0), (-7, 1, 20240101, 1, 1.0), *rows[:100]]
    fact = spark.createDataFrame(rows, FACT)
    sparse = store_day_tallies(fact)
    assert "bitmap_construct_agg" not in sparse._jdf.queryExecution().executedPlan().toString()
    assert sparse.where("events is not null").count() == 0 and sparse.count() <= len(rows)
    stores = dims[0]
    dates = spark.createDataFrame([(20240101 + i, i // 1000) for i in range(days)], "date_sk int, week int")
    truth = plain(rows, lambda s, d: ("S" if s == 3 else "N", (d - 20240101) // 1000))
    for mode in (False, True):
        tallies = store_day_tallies(fact, bitmaps=mode)
        assert found(sales_by(tallies, stores, dates, ["region", "week"]), "region", "week") == truth
    both = store_day_tallies(fact, 0, bitmaps=False).unionByName(store_day_tallies(fact, 1, bitmaps=True))
    (row,) = sales_by(both, stores, dates, []).collect()
    # -70, -7 and the distinct numbers of 0 .. 5999 that are no multiple of 40, in each run.
    assert row.n_transactions == 2 * (2 + 6000 - 150)
