"""Raw sales events to clean sales events and quarantine."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import and_
from typing import Literal, NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.scalars import is_late, line_amount, parse_ts, ts_of
from tillroll.operators.latest import keep_latest, newest_first

# Fixed values.
VALID_EVENT_TYPES = ["sale", "refund", "void"]

NullPolicy = Literal["quarantine", "reference"]

CLEAN_COLUMNS = [
    "event_id",
    "event_type",
    "customer_id",
    "product_id",
    "store_id",
    "quantity",
    "unit_price",
    "discount_amount",
    "line_amount",
    "event_ts",
    "silver_loaded_at",
    "is_late_arrival",
]


class Split(NamedTuple):
    """Accepted rows and rejected rows of one input."""

    clean: DataFrame
    quarantine: DataFrame


def dedupe_sales_events(
    df: DataFrame, tie_breakers: Iterable[str] | None = None, shared: Iterable[str] = ()
) -> DataFrame:
    """One row per ``event_id``: the copy that arrived last.

    ``shared`` names columns in which all copies of an event agree. Where the rows already lie by such a column,
    say after a join by it, they are not shuffled again.
    """
    order = newest_first(df, parse_ts(F.col("ingest_ts")), tie_breakers)
    return keep_latest(df, [*map(F.col, shared), F.col("event_id")], order)


def passes_validation() -> Column:
    """Three-valued: null when a field is null and none is wrong."""
    rules = [
        F.col("product_id") != "",
        F.col("store_id") != "",
        F.col("quantity") != 0,
        F.col("unit_price") >= 0,
        F.col("event_type").isin(VALID_EVENT_TYPES),
    ]
    return reduce(and_, rules)


def has_timestamps() -> Column:
    return parse_ts(F.col("event_ts")).isNotNull() & parse_ts(F.col("ingest_ts")).isNotNull()


def verdict(null_policy: NullPolicy = "quarantine") -> Column:
    """True for the clean side, false for the quarantine.

    ``reference`` leaves an undecided row null, on neither side, and lets unreadable timestamps
    pass as null. ``quarantine`` rejects both, so that the two sides always add up to the input.
    """
    if null_policy == "reference":
        return passes_validation()
    if null_policy == "quarantine":
        return F.coalesce(passes_validation() & has_timestamps(), F.lit(False))
    raise ValueError(f"unknown null policy: {null_policy}")


def quarantine_malformed_sales_events(
    df: DataFrame, null_policy: NullPolicy = "quarantine"
) -> Split:
    ok = verdict(null_policy)
    return Split(df.where(ok), df.where(~ok))


def enrich_sales_events(df: DataFrame) -> DataFrame:
    """Discount without nulls, line amount, real timestamps, late flag and load stamp."""
    discount = F.coalesce(F.col("discount_amount"), F.lit(0.0))
    happened, arrived = ts_of(df, "event_ts"), ts_of(df, "ingest_ts")
    return df.withColumns(
        {
            "discount_amount": discount,
            "line_amount": line_amount(F.col("quantity"), F.col("unit_price"), discount),
            "event_ts": happened,
            "ingest_ts": arrived,
            "is_late_arrival": is_late(happened, arrived),
            "silver_loaded_at": F.current_timestamp(),
        }
    )


def clean_side(valid: DataFrame) -> DataFrame:
    return enrich_sales_events(valid).select(*CLEAN_COLUMNS)


def clean_sales_events(
    df: DataFrame,
    tie_breakers: Iterable[str] | None = None,
    null_policy: NullPolicy = "quarantine",
    shared: Iterable[str] = (),
) -> Split:
    """Deduplicate, split, enrich.

    Deduplication comes first: a malformed later copy displaces a good earlier one and sends the
    event to the quarantine. The quarantine keeps every raw column.
    """
    split = quarantine_malformed_sales_events(dedupe_sales_events(df, tie_breakers, shared), null_policy)
    return Split(clean_side(split.clean), split.quarantine)
