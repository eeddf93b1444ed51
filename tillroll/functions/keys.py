"""Keys computed from a row alone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A stored key must stay equal for equal inputs.
NULL_PART = "_dbt_surrogate_key_null_"
PART_SEPARATOR = "||"


def surrogate_key(*parts: Column) -> Column:
    """md5 over the parts as text. A null part counts as a sentinel instead of nulling the key.

    Feed it text, integers, dates or decimals: the text form of a double is engine-specific.
    """
    texts = [F.coalesce(p.cast("string"), F.lit(NULL_PART)) for p in parts]
    return F.md5(F.concat_ws(PART_SEPARATOR, *texts))


def date_key(day: Column) -> Column:
    """``yyyymmdd`` as integer, by arithmetic: no formatter call per row."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)
