from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tillroll.operators.dimensions import date_dimension_covering
from tillroll.plans.daily import read_seeds, run_daily
from tillroll.plans.gold import GOLD_TABLES
from tillroll.plans.report import health_metrics
from tillroll.sources import retail_tables as retail
from tillroll.sources.files import partition_dirs
from tillroll.sources.lake import Lake
from tillroll.sources.published import Layer
from tillroll.sources.sinks import export_csv, land_batch
from tillroll.streaming.landing import with_ingest_date

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("daily")
    lake = Lake(str(root / "lake"))
    land_batch(with_ingest_date(retail.delivered_events(spark, SF)).coalesce(1), lake.raw_events)
    land_batch(with_ingest_date(retail.delivered_profiles(spark, SF)).coalesce(1), lake.raw_profiles)
    for name in ("products", "stores", "customer_ids"):
        export_csv(getattr(retail, name)(spark, SF), str(root / f"ref_{name}.csv"))
    return lake, read_seeds(spark, str(root))


def contents(spark, lake):
    stamps = ("silver_loaded_at", "dbt_loaded_at")
    return {
        t: sorted(map(repr, Layer(lake.gold).read(spark, t).drop(*stamps).collect())) for t in GOLD_TABLES
    }


def test_daily_run(spark, landed):
    lake, seeds = landed
    dates = date_dimension_covering(retail.table(spark, SF, "events"), "ts")
    first = run_daily(spark, lake, seeds, dates)
    assert first.error is None
    raw, clean, quarantined = first.events
    assert clean + quarantined == 1000 and raw > 1000
    assert first.checks.count() == 51
    figures = dict(line.rsplit(maxsplit=1) for line in first.report.splitlines() if line.startswith("  "))
    assert figures["  sales events"] == f"{quarantined:,}"
    assert figures["  dim_date"] == "366"
    before = contents(spark, lake)
    assert before["fct_sales"]

    second = run_daily(spark, lake, seeds, dates, strategy="days")
    assert second.events == first.events
    assert contents(spark, lake) == before


def test_history_tiles_time(spark, landed):
    lake, _ = landed
    versions = Layer(lake.gold).read(spark, "dim_customer_scd2")
    by_customer = {}
    for v in versions.orderBy("customer_id", "effective_start_date").collect():
        by_customer.setdefault(v.customer_id, []).append(v)
    for chain in by_customer.values():
        for left, right in zip(chain, chain[1:]):
            assert (right.effective_start_date - left.effective_end_date).days == 1
        assert [v.is_current for v in chain] == [False] * (len(chain) - 1) + [True]


def test_partitions_follow_the_event_days(spark, landed):
    lake, _ = landed
    days = spark.read.parquet(lake.clean_events).select(F.to_date("event_ts").alias("d")).distinct().collect()
    assert partition_dirs(spark, lake.clean_events, "event_date") == {f"event_date={r.d}" for r in days}


def test_failed_run_still_reports(spark, tmp_path):
    run = run_daily(spark, Lake(str(tmp_path / "empty")), seeds=None)
    assert run.error is not None and run.checks is None
    assert "fct_sales                       error: " in run.report
    assert "sales events                    0" in run.report and "none were run" in run.report


def test_report_with_a_quarantine_that_holds_nothing_or_cannot_be_read(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    folder = Path(lake.quarantine)
    folder.mkdir(parents=True)
    (found,) = health_metrics(spark, lake, [], None).collect()
    assert (found.area, found.n, found.problem) == ("rejected", 0, None)
    (folder / "part-0.parquet").write_bytes(b"no parquet")
    (found,) = health_metrics(spark, lake, [], None).collect()
    assert found.n is None and found.problem
