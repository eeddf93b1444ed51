"""Distinct events as sets of bits: exact, whatever repeats in the fact, and mergeable to any grain.

Events are numbered while they are stored, near each other by day and store, so that a store's day fills few
words of 64 numbers or few bitmaps of 32 768 (4 KB). No event id is shuffled, and tallies of days merge to
quarters or regions without the fact. A word is one long, so tallies in words never have more rows than the
fact, however few events a store has a day. Bitmaps are made only where the fact was measured to fill them, or
to need few of them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.scalars import exact_sum_parts, per_unit, sum_of_parts
from tillroll.operators.sizes import broadcast_if_small
from tillroll.scratch import pin

EVENT_NO = "event_no"

# Lines per bitmap from which bitmaps move less than words, and a number of bitmaps that is small anyway.
BITMAP_MIN_LINES = 4096
FEW_BITMAPS = 1024

_WORD_BITS = 64
_SUMS = ["total_units_sold", "_priced", "_exact", "_rest"]


def number_events(sales: DataFrame) -> DataFrame:
    """The sales, stored with a number per event; events without id get none.

    Takes each event in one row, as the clean layer holds them, before any join that may repeat them. A busy
    store's day is spread by event id. The numbers hold for the stored copy, so task retries cannot change them.
    """
    near = [F.to_date("event_ts"), F.col("store_id"), F.col("event_id")]
    place = F.monotonically_increasing_id() + 1
    ordered = sales.repartitionByRange(*near).sortWithinPartitions(*near)
    numbered = ordered.withColumn(EVENT_NO, F.when(F.col("event_id").isNotNull(), place))
    return pin(numbered, "numbered_sales", codec="zstd")


def _fills_bitmaps(fact: DataFrame) -> bool:
    """Whether the fact was measured to fill its bitmaps, or to need few. Only the form depends on it."""
    cell = F.struct("store_sk", "date_sk", F.bitmap_bucket_number(EVENT_NO))
    lines, bitmaps = fact.agg(F.count(F.lit(1)), F.approx_count_distinct(F.xxhash64(cell))).first()
    return bitmaps <= FEW_BITMAPS or lines >= BITMAP_MIN_LINES * bitmaps


def store_day_tallies(fact: DataFrame, run: int = 0, bitmaps: bool | None = None) -> DataFrame:
    """One row per store key, day key and bucket: the events as bits, and the sums of their lines.

    A bucket is a word of 64 numbers (``word``) or a bitmap of 32 768 (``events``), for the whole fact; which
    one is measured unless ``bitmaps`` says so. ``run`` keeps the numbers of separately numbered facts apart;
    an event belongs to one run.
    """
    number = F.col(EVENT_NO)
    exact, rest = exact_sum_parts(F.col("line_amount"))
    bit = F.expr(f"shiftleft(1L, int({EVENT_NO} & {_WORD_BITS - 1}))")
    no_word, no_events = F.lit(None).cast("long"), F.lit(None).cast("binary")
    if _fills_bitmaps(fact) if bitmaps is None else bitmaps:
        bucket = F.bitmap_bucket_number(number)
        word, events = no_word, F.bitmap_construct_agg(F.bitmap_bit_position(number))
    else:
        bucket = F.shiftright(number, _WORD_BITS.bit_length() - 1)
        word, events = F.coalesce(F.bit_or(bit), F.lit(0).cast("long")), no_events
    return (
        fact.groupBy("store_sk", "date_sk", bucket.alias("bucket"))
        .agg(
            events.alias("events"),
            word.alias("word"),
            F.sum(F.col("quantity").cast("long")).alias("total_units_sold"),
            F.count("line_amount").alias("_priced"),
            exact.alias("_exact"),
            rest.alias("_rest"),
        )
        .withColumn("run", F.lit(run))
    )


def _groups(dim: DataFrame, key: str, group: str, labels: list[str]) -> tuple[DataFrame, DataFrame]:
    """``key, group`` and ``group, labels``: keys that share all labels make one group, named by the least of them."""
    known = dim.where(F.col(key).isNotNull()).select(key, *labels)
    if not labels:
        everything = known.select(key, F.lit(0).alias(group))
        return everything, everything.select(group).distinct()
    named = known.groupBy(*labels).agg(F.min(key).alias(group))
    same = reduce(Column.__and__, (F.col(f"_to.{c}").eqNullSafe(F.col(f"_of.{c}")) for c in labels))
    pairs = named.alias("_to").join(known.alias("_of"), same)
    return pairs.select(f"_of.{key}", f"_to.{group}"), named


def _sums() -> list[Column]:
    return [F.sum(name).alias(name) for name in _SUMS]


def sales_by(tallies: DataFrame, stores: DataFrame, dates: DataFrame, grain: list[str]) -> DataFrame:
    """Distinct events, units and revenue by any labels of stores and dates.

    Tallies without a known store or day are left out. An event in two groups counts in both. The tallies are
    merged by short group keys; the labels join the result only.
    """
    store_group, store_labels = _groups(stores, "store_sk", "_store", [c for c in grain if c in stores.columns])
    date_group, date_labels = _groups(
        dates, "date_sk", "_date", [c for c in grain if c in dates.columns and c not in stores.columns]
    )
    groups = ["_store", "_date"]
    labelled = broadcast_if_small(date_group).join(
        broadcast_if_small(store_group).join(tallies, "store_sk"), "date_sk"
    )
    by = [*groups, "run", "bucket"]
    # Words and bitmaps apart: no word is ever widened to a bitmap.
    words = labelled.where("word is not null").groupBy(*by).agg(F.bit_or("word").alias("word"), *_sums())
    maps = labelled.where("events is not null").groupBy(*by).agg(F.bitmap_or_agg("events").alias("events"), *_sums())
    per_bucket = words.select(*groups, F.bit_count("word").cast("long").alias("n"), *_SUMS).unionByName(
        maps.select(*groups, F.bitmap_count("events").alias("n"), *_SUMS)
    )
    totals = per_bucket.groupBy(*groups).agg(F.sum("n").alias("n_transactions"), *_sums())
    revenue = sum_of_parts(F.col("_exact"), F.col("_rest"))
    return (
        broadcast_if_small(date_labels)
        .join(broadcast_if_small(store_labels).join(totals, "_store"), "_date")
        .select(
            *grain,
            "n_transactions",
            "total_units_sold",
            revenue.alias("total_revenue"),
            per_unit(revenue, F.col("_priced")).alias("avg_line_amount"),
        )
    )
