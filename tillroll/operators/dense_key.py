"""Consecutive integer keys over an ordered set."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.operators.sizes import ONE_TASK_MAX_ROWS, fits
from tillroll.scratch import pin

# monotonically_increasing_id: partition number above these bits, row position below.
_POSITION_BITS = 33


def number_in_order(
    df: DataFrame, name: str, order: list[Column], partitions: int | None = None
) -> DataFrame:
    """``row_number() over (order by ...)`` starting at 1, without one task sorting everything.

    Rows are range-partitioned and sorted, and their place (partition, position) is written down
    once, because a second evaluation could place them elsewhere. A row's number is then the size
    of the partitions before its own plus its position. ``order`` should be total.
    """
    by = [*([partitions] if partitions else []), *order]
    place = F.monotonically_increasing_id()
    placed = pin(
        df.repartitionByRange(*by).sortWithinPartitions(*order).select("*", place.alias("_place")),
        name,
    )
    block = F.shiftright("_place", _POSITION_BITS)
    position = F.col("_place") - F.shiftleft(block, _POSITION_BITS)

    # One row per range partition, however large the data.
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(block.alias("_block"))
        .count()
        .select("_block", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_offset"))
    )
    return placed.join(F.broadcast(offsets), block == F.col("_block")).select(
        (F.col("_offset") + position + 1).alias(name), *df.columns
    )


def number_small_or_in_order(df: DataFrame, name: str, order: list[Column]) -> DataFrame:
    """The same numbers: in one task when the frame is measured small, else as above."""
    if not fits(df, ONE_TASK_MAX_ROWS):
        return number_in_order(df, name, order)
    return df.select(F.row_number().over(Window.orderBy(*order)).cast("long").alias(name), "*")
