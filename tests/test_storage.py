import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from tests.rows import event, events, profile, profiles
from tillroll import schemas
from tillroll.operators.quality import quarantine_count, status_histogram
from tillroll.plans.silver import clean_events_job, clean_profiles_job
from tillroll.scratch import fresh_path, pin, scratch_scope
from tillroll.sources import sinks
from tillroll.sources.files import exists, partition_dirs
from tillroll.sources.lake import (
    Lake,
    read_clean_events,
    read_clean_profiles,
    read_quarantine,
    read_raw_events,
    read_seed,
    read_seed_column,
    read_test_statuses,
)
from tillroll.streaming.landing import with_ingest_date


@pytest.fixture
def lake(tmp_path):
    return Lake(str(tmp_path / "lake"))


def land(spark, lake, *rows):
    sinks.land_batch(with_ingest_date(events(spark, *rows)), lake.raw_events)


def clean_ids(spark, lake):
    rows = read_clean_events(spark, lake.clean_events).select("event_id", "event_date").collect()
    return sorted((r.event_id, r.event_date.isoformat()) for r in rows)


def test_each_root_moves_on_its_own():
    lake = Lake("/lake", silver_root="s3a://other/silver/")
    assert lake.raw_events == "/lake/bronze/sales_events"
    assert lake.clean_events == "s3a://other/silver/sales_events_clean"
    assert lake.quarantine == "s3a://other/silver/_quarantine/sales_events"
    assert lake.gold == "/lake/gold"


def test_landing_appends_and_replays(spark, lake):
    land(spark, lake, event(event_id="a"))
    land(spark, lake, event(event_id="b"), event(event_id="c", ingest_ts="2024-05-21T00:00:00"))
    raw = read_raw_events(spark, lake.raw_events)
    assert raw.count() == 3 and dict(raw.dtypes)["ingest_date"] == "date"
    again = with_ingest_date(events(spark, event(event_id="d")))
    sinks.land_batch(again, lake.raw_events, replay_dates=True)
    assert sorted(r.event_id for r in read_raw_events(spark, lake.raw_events).collect()) == ["c", "d"]
    assert raw.sparkSession.read.parquet(lake.raw_events).columns == raw.columns


def test_events_job(spark, lake):
    land(
        spark,
        lake,
        event(event_id="a"),
        event(event_id="a", ingest_ts="2024-05-20T11:30:00", quantity=5),
        event(event_id="b", event_ts="2024-05-19T23:00:00"),
        event(event_id="c", product_id=""),
    )
    assert clean_events_job(spark, lake) == (4, 2, 1)
    assert clean_ids(spark, lake) == [("a", "2024-05-20"), ("b", "2024-05-19")]
    row = read_clean_events(spark, lake.clean_events).where("event_id = 'a'").first()
    assert (row.quantity, row.line_amount, row.is_late_arrival) == (5, 200.0, True)
    assert [r.event_id for r in read_quarantine(spark, lake.quarantine).collect()] == ["c"]
    # A second run changes nothing.
    assert clean_events_job(spark, lake) == (4, 2, 1)
    assert clean_ids(spark, lake) == [("a", "2024-05-20"), ("b", "2024-05-19")]


def test_rerun_clears_old_rejects_and_emptied_days(spark, lake):
    land(spark, lake, event(event_id="bad", quantity=0), event(event_id="b", event_ts="2024-05-19T23:00:00"))
    clean_events_job(spark, lake)
    assert quarantine_count(read_quarantine(spark, lake.quarantine)) == 1
    # Better copies arrive: the reject is repaired, the other event is moved to another day.
    land(
        spark,
        lake,
        event(event_id="bad", ingest_ts="2024-05-20T12:00:00"),
        event(event_id="b", event_ts="2024-05-20T01:00:00", ingest_ts="2024-05-20T12:00:00"),
    )
    clean_events_job(spark, lake)
    assert quarantine_count(read_quarantine(spark, lake.quarantine)) == 0
    assert clean_ids(spark, lake) == [("b", "2024-05-20"), ("bad", "2024-05-20")]
    assert partition_dirs(spark, lake.clean_events, "event_date") == {"event_date=2024-05-20"}


def test_only_the_scope_is_replaced(spark, tmp_path):
    path = str(tmp_path / "t")
    d1, d2, d3 = (date(2026, 1, n) for n in (1, 2, 3))
    frame = lambda *rows: spark.createDataFrame(rows, "x int, d date")
    assert sinks.overwrite_partitions(frame((1, d1), (2, d2), (3, d3), (4, None)), path, "d") == 4
    # Day 1 gets a new row, day 2 none, day 3 is not in scope.
    assert sinks.overwrite_partitions(frame((9, d1)), path, "d", [d1, d2]) == 1
    assert sorted(r.x for r in spark.read.parquet(path).collect()) == [3, 4, 9]
    # Nothing at all for a day and for the rows without a day.
    assert sinks.overwrite_partitions(frame(), path, "d", [d1, None]) == 0
    assert sorted(r.x for r in spark.read.schema("x int, d date").parquet(path).collect()) == [3]


def test_hot_day_is_split_among_tasks(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    try:
        days = spark.range(0, 400_000, 1, 8).select(
            F.col("id"),
            F.when(F.col("id") % 3 == 0, F.lit("2026-01-01")).otherwise(F.lit("2026-01-02")).cast("date").alias("d"),
        )
        sinks.overwrite_partitions(days, path, "d")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = spark.read.parquet(path).where("d = date'2026-01-02'").inputFiles()
    assert len([f for f in files if "2026-01-02" in f]) > 1
    assert spark.read.parquet(path).count() == 400_000


def test_profiles_job(spark, lake):
    rows = [
        profile(),
        profile(snapshot_ts="2024-05-20T05:00:00", loyalty_tier="silver"),
        profile(snapshot_ts="2024-05-21T00:00:00"),
        profile(customer_id="x", loyalty_tier="?"),
    ]
    sinks.land_batch(with_ingest_date(profiles(spark, *rows)), lake.raw_profiles)
    assert clean_profiles_job(spark, lake)[:2] == (4, 2)
    got = read_clean_profiles(spark, lake.clean_profiles).orderBy("snapshot_date").collect()
    assert [(r.loyalty_tier, r.snapshot_date.day) for r in got] == [("silver", 20), ("gold", 21)]


def test_missing_quarantine_counts_zero(spark, lake):
    assert read_quarantine(spark, lake.quarantine) is None
    assert quarantine_count(None) == 0


def test_seed_files(spark, tmp_path):
    path = tmp_path / "ref_products.csv"
    path.write_text(
        "product_id,product_name,category,subcategory,unit_cost,list_price\n"
        'P1,"Lamp, large",Home,Light,12.5,20\nP2,Cup,Home,,3,\n'
    )
    rows = read_seed(spark, str(path), schemas.PRODUCTS).orderBy("product_id").collect()
    assert (rows[0].product_name, rows[0].list_price) == ("Lamp, large", 20.0)
    assert (rows[1].subcategory, rows[1].list_price) == (None, None)
    ids = read_seed_column(spark, str(path), schemas.PRODUCTS, "product_id")
    assert ids.columns == ["product_id"] and ids.count() == 2


def test_csv_export_of_a_report(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.createDataFrame([("a", 1.5, date(2026, 1, 1), None)], "k string, x double, d date, n int")
    sinks.export_csv(df, path, single_file=True)
    assert len(list((tmp_path / "out").glob("*.csv"))) == 1
    assert read_seed(spark, path, df.schema).collect() == df.collect()


def test_run_result_documents(spark, tmp_path):
    doc = tmp_path / "run_results.json"
    doc.write_text(json.dumps({"results": [{"status": "pass"}, {"status": "pass"}, {"status": "fail"}, {}]}, indent=2))
    got = {r.status: r.n for r in status_histogram(read_test_statuses(spark, str(doc))).collect()}
    assert got == {"pass": 2, "fail": 1, "unknown": 1}


def test_tables_and_views(spark, tmp_path):
    df = spark.range(3).toDF("x")
    assert sinks.save_table(df, str(tmp_path / "t")).count() == 3
    assert sinks.save_catalog_table(df, "saved_numbers", str(tmp_path / "c")).count() == 3
    spark.sql("drop table saved_numbers")
    sinks.register_view(df, "viewed_numbers")
    assert spark.sql("select sum(x) from viewed_numbers").first()[0] == 3


def test_scratch_is_cleaned_after_its_scope(spark):
    with scratch_scope(spark):
        path = fresh_path(spark, "x")
        spark.range(2).write.parquet(path)
        pinned = pin(spark.range(5).toDF("x"), "numbers")
        assert pinned.count() == 5 and exists(spark, path)
        (stored,) = {f.rsplit("/", 1)[0] for f in pinned.inputFiles()}
    assert not exists(spark, path) and not exists(spark, stored)
