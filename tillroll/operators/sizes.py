"""Size checks: a side is broadcast, or numbered in one task, only after it was measured."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_MAX_ROWS = 1_000_000
BROADCAST_MAX_BYTES = 64 * 1024 * 1024
ONE_TASK_MAX_ROWS = 100_000

_FIXED_WIDTH_BYTES = 8


def fits(df: DataFrame, max_rows: int, max_bytes: int | None = None) -> bool:
    """Whether the frame stays within both bounds, by one distributed count of rows and text bytes."""
    if max_bytes is None:
        return df.count() <= max_rows
    size = F.lit(_FIXED_WIDTH_BYTES * len(df.columns))
    for column, dtype in df.dtypes:
        if dtype in ("string", "binary"):
            size = size + F.coalesce(F.octet_length(column), F.lit(0))
    rows, total = df.agg(F.count(F.lit(1)), F.sum(size.cast("long"))).first()
    return rows <= max_rows and (total or 0) <= max_bytes


def broadcast_if_small(
    df: DataFrame,
    max_rows: int = BROADCAST_MAX_ROWS,
    max_bytes: int = BROADCAST_MAX_BYTES,
) -> DataFrame:
    """``broadcast(df)`` when measured small, else ``df`` as it is.

    Beyond the bound the join shuffles on its keys and adaptive execution splits skewed
    partitions of the larger side.
    """
    return F.broadcast(df) if fits(df, max_rows, max_bytes) else df
