"""Shared pieces: what a word is, reading tables, and names that cannot clash."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Words are runs of anything but space, tab, line feed, vertical tab, form feed, carriage return.
SPACES = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
WORD_RE = re.compile(WORD)

# Only these letters are lower-cased; others keep their case.
LOWER_ASCII = {upper: upper + 32 for upper in range(ord("A"), ord("Z") + 1)}


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def whole(text: Column | str) -> Column:
    """The text, a missing one as empty."""
    return F.coalesce(text if isinstance(text, Column) else F.col(text), F.lit(""))


def words_of(text: Column | str) -> Column:
    """The words of a text in order, evaluated inside the JVM."""
    return F.filter(F.split(whole(text), SPACES + "+", -1), lambda w: w != "")


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often the body refers to it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def own(name: str) -> str:
    """A column name that no input column has."""
    return f"_{name}_{uuid.uuid4().hex[:10]}"
