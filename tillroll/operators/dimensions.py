"""Dimensions without history: products, stores, calendar."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions.keys import date_key
from tillroll.operators.dense_key import number_small_or_in_order

# The calendar of the standard deployment.
CALENDAR_START = date(2024, 1, 1)
CALENDAR_END = date(2027, 12, 31)


def dim_type1(df: DataFrame, key: str, surrogate: str, attributes: list[str]) -> DataFrame:
    """Current state per natural key, numbered in key order; rows that repeat a key, by their attributes."""
    order = [F.col(c).asc_nulls_last() for c in (key, *attributes)]
    return number_small_or_in_order(df.select(key, *attributes), surrogate, order)


def dim_product(products: DataFrame) -> DataFrame:
    attributes = ["product_name", "category", "subcategory", "unit_cost", "list_price"]
    return dim_type1(products, "product_id", "product_sk", attributes)


def dim_store(stores: DataFrame) -> DataFrame:
    return dim_type1(stores, "store_id", "store_sk", ["store_name", "region", "store_type"])


def _calendar(bounds: DataFrame, first: Column, last: Column) -> DataFrame:
    days = bounds.select(
        F.explode(F.sequence(first, last, F.expr("interval 1 day"))).alias("calendar_date")
    )
    day = F.col("calendar_date")
    sunday_based = F.dayofweek(day) - 1
    return days.select(
        date_key(day).alias("date_sk"),
        day,
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        sunday_based.alias("day_of_week"),
        sunday_based.isin(0, 6).alias("is_weekend"),
    )


def date_dimension(
    spark: SparkSession, start: date = CALENDAR_START, end: date = CALENDAR_END
) -> DataFrame:
    """One row per day, both ends included."""
    return _calendar(spark.range(1), F.lit(start), F.lit(end))


def date_dimension_covering(df: DataFrame, ts: str) -> DataFrame:
    """The whole calendar years that the timestamps of ``df`` touch."""
    bounds = df.agg(F.min(ts).alias("lo"), F.max(ts).alias("hi"))
    first = F.make_date(F.year("lo"), F.lit(1), F.lit(1))
    last = F.make_date(F.year("hi"), F.lit(12), F.lit(31))
    return _calendar(bounds, first, last)
