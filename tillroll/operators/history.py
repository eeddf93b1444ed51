"""Type 2 history: one row per key and validity range."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.operators.dense_key import number_in_order

CUSTOMER_TRACKED = ["loyalty_tier", "home_store_id"]
CUSTOMER_CARRIED = ["email_domain"]


def change_points(
    snapshots: DataFrame,
    key: str,
    tracked: list[str],
    carried: list[str],
    ts: str,
    already_distinct: bool = False,
) -> DataFrame:
    """Snapshots that open a version: the first of a key, and each that differs from the one before.

    Only ``tracked`` columns open versions; ``carried`` ones keep the value of their change point.
    A null first tracked value before a snapshot counts as "no snapshot before".

    Needs at most one row per key and day, which bounds a key's rows by the number of days and so
    bounds what one window task holds. ``already_distinct`` skips the distinct, a shuffle, where
    that holds by construction.
    """
    rows = snapshots.select(key, *tracked, *carried, ts)
    if not already_distinct:
        rows = rows.distinct()
    timeline = Window.partitionBy(key).orderBy(F.col(ts).asc_nulls_last())
    before = {c: F.lag(c).over(timeline) for c in tracked}
    opens = [before[tracked[0]].isNull(), *(~F.col(c).eqNullSafe(before[c]) for c in tracked)]
    marked = rows.withColumn("_opens", reduce(or_, opens))
    return marked.where("_opens").drop("_opens")


def validity_ranges(points: DataFrame, key: str, ts: str) -> DataFrame:
    """Each change point holds until the day before the next one; the last one is current."""
    timeline = Window.partitionBy(key).orderBy(F.col(ts).asc_nulls_last())
    following = F.to_date(F.lead(ts).over(timeline))
    return points.select(
        "*",
        F.to_date(ts).alias("effective_start_date"),
        F.date_sub(following, 1).alias("effective_end_date"),
        following.isNull().alias("is_current"),
    ).drop(ts)


def scd2_history(
    snapshots: DataFrame,
    key: str,
    tracked: list[str],
    ts: str,
    carried: list[str] | None = None,
    surrogate: str = "version_sk",
    already_distinct: bool = False,
    partitions: int | None = None,
) -> DataFrame:
    """Full recompute of the history, hence the same result on every run over the same snapshots."""
    points = change_points(snapshots, key, tracked, carried or [], ts, already_distinct)
    versions = validity_ranges(points, key, ts)
    order = [F.col(key).asc_nulls_last(), F.col("effective_start_date").asc_nulls_last()]
    return number_in_order(versions, surrogate, order, partitions)


def dim_customer_scd2(profiles: DataFrame, already_distinct: bool = False) -> DataFrame:
    history = scd2_history(
        profiles,
        key="customer_id",
        tracked=CUSTOMER_TRACKED,
        carried=CUSTOMER_CARRIED,
        ts="snapshot_ts",
        surrogate="customer_sk",
        already_distinct=already_distinct,
    )
    return history.withColumn("dbt_loaded_at", F.current_timestamp())
