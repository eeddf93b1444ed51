"""Batch jobs of the clean layer: read the raw tables, write the clean ones."""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll import schemas
from tillroll.functions.scalars import parse_ts
from tillroll.operators.events import NullPolicy, Split, clean_side, dedupe_sales_events, verdict
from tillroll.operators.profiles import clean_customer_profiles
from tillroll.operators.sizes import BROADCAST_MAX_BYTES, BROADCAST_MAX_ROWS, fits
from tillroll.scratch import pin, scratch_scope
from tillroll.sources.lake import Lake, read_raw_events, read_raw_profiles
from tillroll.sources.sinks import overwrite_partitions


class SilverCounts(NamedTuple):
    raw: int
    clean: int
    quarantined: int = 0


def judged_events(
    raw: DataFrame,
    tie_breakers: Iterable[str] | None = None,
    null_policy: NullPolicy = "quarantine",
) -> DataFrame:
    """Deduplicated raw events with their verdict as column ``_ok``."""
    return dedupe_sales_events(raw, tie_breakers).withColumn("_ok", verdict(null_policy))


def split_judged(judged: DataFrame) -> Split:
    accepted, rejected = judged.where("_ok"), judged.where("not _ok")
    dated = clean_side(accepted).withColumn("event_date", F.to_date("event_ts"))
    return Split(dated, rejected.drop("_ok"))


def without_unknown_references(events: DataFrame, parents: dict[str, DataFrame]) -> Split:
    """Optional reference check: rows whose id in a column has no parent go to the quarantine.

    ``parents`` maps a column of the events to a frame with a column of that name. A null id passes,
    and stays out of a join that shuffles: null ids would all meet in one task.
    """
    marked = events
    for column, parent in parents.items():
        known = parent.select(F.col(column).alias("_id")).where("_id is not null").distinct()
        small = fits(known, BROADCAST_MAX_ROWS, BROADCAST_MAX_BYTES)
        side = (F.broadcast(known) if small else known).withColumn("_known", F.lit(True))
        asked = marked if small else marked.where(F.col(column).isNotNull())
        found = F.col(column).isNull() | F.coalesce("_known", F.lit(False))
        flagged = (
            asked.join(side, F.col(column) == F.col("_id"), "left")
            .withColumn(f"_ok_{column}", found)
            .drop("_id", "_known")
        )
        if not small:
            without_id = marked.where(F.col(column).isNull())
            flagged = flagged.unionByName(without_id.withColumn(f"_ok_{column}", F.lit(True)))
        marked = flagged
    flags = [f"_ok_{column}" for column in parents]
    all_known = " and ".join(flags) or "true"
    return Split(
        marked.where(all_known).drop(*flags), marked.where(f"not ({all_known})").drop(*flags)
    )


def clean_events_job(
    spark: SparkSession,
    lake: Lake,
    tie_breakers: Iterable[str] | None = None,
    null_policy: NullPolicy = "quarantine",
    schema: T.StructType | None = schemas.SALES_EVENTS_RAW,
) -> SilverCounts:
    """All raw events to clean events by ``event_date`` and quarantine.

    Both outputs come from one deduplication, stored once in the shared folder while they are written.
    Both are laid out by ``event_date``, as the incremental job writes them, and dates without rows any
    more are removed from both.
    """
    raw = read_raw_events(spark, lake.raw_events, schema)
    with scratch_scope(spark):
        split = split_judged(pin(judged_events(raw, tie_breakers, null_policy), "judged"))
        clean = overwrite_partitions(split.clean, lake.clean_events, "event_date")
        by_day = split.quarantine.withColumn("event_date", F.to_date(parse_ts(F.col("event_ts"))))
        quarantined = overwrite_partitions(by_day, lake.quarantine, "event_date")
    return SilverCounts(raw.count(), clean, quarantined)


def clean_profiles_job(
    spark: SparkSession,
    lake: Lake,
    tie_breakers: Iterable[str] | None = None,
    schema: T.StructType | None = schemas.PROFILES_RAW,
) -> SilverCounts:
    """All raw snapshots to clean snapshots by ``snapshot_date``."""
    raw = read_raw_profiles(spark, lake.raw_profiles, schema)
    clean = clean_customer_profiles(raw, tie_breakers).withColumn(
        "snapshot_date", F.to_date("snapshot_ts")
    )
    return SilverCounts(raw.count(), overwrite_partitions(clean, lake.clean_profiles, "snapshot_date"))
