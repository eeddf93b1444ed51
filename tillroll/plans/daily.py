"""The daily run: clean layer, business layer, checks, report."""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tillroll import schemas
from tillroll.operators.facts import AsofStrategy
from tillroll.operators.quality import retail_checks, run_checks
from tillroll.plans.gold import GOLD_TABLES, Seeds, gold_job
from tillroll.plans.report import health_report
from tillroll.plans.silver import SilverCounts, clean_events_job, clean_profiles_job
from tillroll.sources.lake import Lake, read_seed
from tillroll.sources.published import Layer


class DailyRun(NamedTuple):
    events: SilverCounts | None
    profiles: SilverCounts | None
    checks: DataFrame | None
    report: str
    error: Exception | None


def read_seeds(spark: SparkSession, root: str) -> Seeds:
    root = root.rstrip("/")
    return Seeds(
        read_seed(spark, f"{root}/ref_products.csv", schemas.PRODUCTS),
        read_seed(spark, f"{root}/ref_stores.csv", schemas.STORES),
        read_seed(spark, f"{root}/ref_customer_ids.csv", schemas.CUSTOMER_IDS),
    )


def run_daily(
    spark: SparkSession,
    lake: Lake,
    seeds: Seeds,
    dates: DataFrame | None = None,
    strategy: AsofStrategy = "auto",
    event_tie_breakers: Iterable[str] | None = None,
    profile_tie_breakers: Iterable[str] | None = None,
    event_schema: T.StructType | None = schemas.SALES_EVENTS_RAW,
    profile_schema: T.StructType | None = schemas.PROFILES_RAW,
    keep_versions: int = 2,
) -> DailyRun:
    """Raw layer to report, in sequence. The report is made whatever failed before it.

    The business layer and its check results are published together, after the checks ran: a run that fails
    before leaves what the last one published. ``keep_versions`` published states stay readable.
    """
    layer = Layer(lake.gold)
    events = profiles = checks = error = None
    try:
        events = clean_events_job(spark, lake, event_tie_breakers, schema=event_schema)
        profiles = clean_profiles_job(spark, lake, profile_tie_breakers, schema=profile_schema)
        with layer.next(spark) as draft:
            tables = gold_job(spark, lake, seeds, dates, strategy, draft=draft)
            results = draft.store("check_results", run_checks(retail_checks(), tables))
        checks = results
        layer.vacuum(spark, keep_versions)
    except Exception as failure:  # noqa: BLE001 - returned, after the report
        error = failure
    statuses = None if checks is None else checks.select("status")
    report = health_report(spark, lake, GOLD_TABLES, statuses)
    return DailyRun(events, profiles, checks, report, error)
