"""Keep the newest row of each key."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def newest_first(df: DataFrame, ts: Column, tie_breakers: Iterable[str] | None) -> list[Column]:
    """Descending order by ``ts`` made total.

    Without named tie-breakers every column takes part, so only identical rows stay tied and the
    outcome does not depend on task order or on a retry.
    """
    rest = df.columns if tie_breakers is None else tie_breakers
    return [ts.desc_nulls_last(), *(F.col(c).desc_nulls_last() for c in rest)]


def keep_latest(df: DataFrame, keys: list[Column], order: list[Column]) -> DataFrame:
    """First row of each key under ``order``.

    The rank filter lets the planner cut each key to one row per map task before the shuffle, so
    a key that is repeated across the whole input still arrives as a handful of rows.
    """
    ranked = df.select("*", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).alias("_nth"))
    return ranked.where("_nth = 1").drop("_nth")
