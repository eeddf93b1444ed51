"""Raw customer snapshots to clean snapshots."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.scalars import parse_ts
from tillroll.operators.latest import keep_latest, newest_first

# Fixed values.
VALID_LOYALTY_TIERS = ["bronze", "silver", "gold", "platinum"]


def dedupe_customer_profiles(df: DataFrame, tie_breakers: Iterable[str] | None = None) -> DataFrame:
    """The latest snapshot of each customer and day."""
    taken = parse_ts(F.col("snapshot_ts"))
    return keep_latest(
        df, [F.col("customer_id"), F.to_date(taken)], newest_first(df, taken, tie_breakers)
    )


def clean_customer_profiles(df: DataFrame, tie_breakers: Iterable[str] | None = None) -> DataFrame:
    """Deduplicate, then drop unknown tiers and normalise the text.

    A day whose latest snapshot has an unknown tier is left out, even when an earlier snapshot of
    that day was good.
    """
    latest = dedupe_customer_profiles(df, tie_breakers)
    return latest.where(F.col("loyalty_tier").isin(VALID_LOYALTY_TIERS)).select(
        "customer_id",
        F.trim("full_name").alias("full_name"),
        F.lower(F.trim("email")).alias("email"),
        "loyalty_tier",
        "home_store_id",
        parse_ts(F.col("snapshot_ts")).alias("snapshot_ts"),
        F.current_timestamp().alias("silver_loaded_at"),
    )
