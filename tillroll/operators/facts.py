"""Sale lines with the keys of the dimension rows that apply to them."""

from __future__ import annotations

from collections.abc import Iterable
from typing import Literal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.functions.keys import date_key, surrogate_key
from tillroll.operators.sizes import (
    BROADCAST_MAX_BYTES,
    BROADCAST_MAX_ROWS,
    broadcast_if_small,
    fits,
)
from tillroll.operators.tallies import EVENT_NO

AsofStrategy = Literal["auto", "broadcast", "range", "days"]

FACT_COLUMNS = (
    "sale_line_sk",
    "event_id",
    "customer_sk",
    "product_sk",
    "store_sk",
    "date_sk",
    "quantity",
    "unit_price",
    "discount_amount",
    "line_amount",
    "event_ts",
    "silver_loaded_at",
)

_VERSION = ["customer_id", "customer_sk", "effective_start_date", "effective_end_date"]


def _sale_day():
    return F.to_date("event_ts")


def asof_by_range(sales: DataFrame, history: DataFrame, broadcast: bool = False) -> DataFrame:
    """Equality on the customer, the sale's day within the version's range.

    With the history broadcast, sales are not shuffled at all. Without, anonymous sales stay out
    of the join, since their null key would send them all to one task.
    """
    versions = history.select(*_VERSION).withColumnRenamed("customer_id", "_owner")
    in_range = (_sale_day() >= F.col("effective_start_date")) & (
        F.col("effective_end_date").isNull() | (_sale_day() <= F.col("effective_end_date"))
    )
    condition = (F.col("customer_id") == F.col("_owner")) & in_range
    columns = [*sales.columns, "customer_sk"]
    if broadcast:
        return sales.join(F.broadcast(versions), condition, "left").select(*columns)
    known = sales.where("customer_id is not null").join(versions, condition, "left")
    unknown = sales.where("customer_id is null").withColumn("customer_sk", F.lit(None).cast("long"))
    return known.select(*columns).unionByName(unknown)


def customer_version_by_day(sales: DataFrame, history: DataFrame) -> DataFrame:
    """The version in force for each customer and day that has sales.

    Sales shrink to distinct (customer, day) pairs before any shuffle; those and the version starts
    form one timeline per customer. A customer has at most one pair and one start per day, so no
    timeline outgrows twice the number of days, however many sales it stands for. Of versions that start
    on one day, the one that holds longest is in force; the others end before they start.
    """
    nothing = F.lit(None).cast("struct<sk:bigint,until:date>")
    starts = history.select(
        "customer_id",
        F.col("effective_start_date").alias("_day"),
        F.struct(
            F.col("customer_sk").cast("long").alias("sk"),
            F.col("effective_end_date").alias("until"),
        ).alias("_version"),
        F.lit(False).alias("_asks"),
    )
    asked = (
        sales.where("customer_id is not null")
        .select("customer_id", _sale_day().alias("_day"))
        .distinct()
        .select("*", nothing.alias("_version"), F.lit(True).alias("_asks"))
    )
    timeline = (
        Window.partitionBy("customer_id")
        .orderBy("_day", "_asks", F.col("_version.until").asc_nulls_last(), "_version.sk")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    in_force = F.last("_version", ignorenulls=True).over(timeline)
    answered = (
        starts.unionByName(asked)
        .select("customer_id", "_day", "_asks", in_force.alias("_version"))
        .where("_asks")
    )
    still_valid = F.col("_version.until").isNull() | (F.col("_day") <= F.col("_version.until"))
    return answered.select(
        "customer_id", "_day", F.when(still_valid, F.col("_version.sk")).alias("customer_sk")
    )


def asof_by_day(sales: DataFrame, history: DataFrame) -> DataFrame:
    """The same result by plain equality on (customer, day).

    The day in the key spreads a busy customer, and the anonymous sales, over many tasks. ``sales``
    is read twice, once for two columns only; hand in a stored table.
    """
    by_day = customer_version_by_day(sales, history).withColumnRenamed("customer_id", "_owner")
    condition = (F.col("customer_id") == F.col("_owner")) & (_sale_day() == F.col("_day"))
    return sales.join(by_day, condition, "left").select(*sales.columns, "customer_sk")


def choose_strategy(history: DataFrame) -> AsofStrategy:
    """``broadcast`` for a history that is measured small, ``days`` beyond that."""
    small = fits(history.select(*_VERSION), BROADCAST_MAX_ROWS, BROADCAST_MAX_BYTES)
    return "broadcast" if small else "days"


def with_customer_version(
    sales: DataFrame, history: DataFrame, strategy: AsofStrategy = "auto"
) -> DataFrame:
    """Adds ``customer_sk`` of the version valid on the sale's day; null if there is none.

    All strategies give the same rows. ``broadcast`` is for a history that ``choose_strategy``
    measured; ``auto`` measures it here.
    """
    if strategy == "auto":
        strategy = choose_strategy(history)
    if strategy == "days":
        return asof_by_day(sales, history)
    return asof_by_range(sales, history, broadcast=strategy == "broadcast")


def with_lookup(df: DataFrame, dim: DataFrame, key: str, surrogate: str) -> DataFrame:
    """Adds the dimension's surrogate for a natural key; null if it is unknown."""
    pairs = dim.select(F.col(key).alias("_key"), F.col(surrogate))
    joined = df.join(broadcast_if_small(pairs), F.col(key) == F.col("_key"), "left")
    return joined.drop("_key")


def repeats(dim: DataFrame, key: str) -> bool:
    """Whether a natural key stands in several rows, so that a lookup of it repeats the sales."""
    known, different = dim.agg(F.count(key), F.count_distinct(key)).first()
    return known > different


def sales_columns(columns: Iterable[str] = FACT_COLUMNS) -> list[str]:
    """The staged columns that these columns of the fact, and the lookups, are made from."""
    made_from = {c: [c] for c in FACT_COLUMNS} | {
        "sale_line_sk": ["event_id"],
        "customer_sk": ["customer_id", "event_ts"],
        "product_sk": [],
        "store_sk": [],
        "date_sk": ["event_ts"],
    }
    return sorted({"product_id", "store_id", *(source for c in columns for source in made_from[c])})


def fct_sales(
    sales: DataFrame,
    history: DataFrame | None,
    products: DataFrame,
    stores: DataFrame,
    strategy: AsofStrategy = "auto",
    columns: Iterable[str] = FACT_COLUMNS,
) -> DataFrame:
    """One row per staged sale; the number of a numbered event goes along.

    ``columns`` names what the caller reads. The customer's version gives each sale one key, so without that key
    the history is not needed. A product or store without its key is joined only if it was found to repeat, which
    repeats the rows; then its natural key is enough.
    """
    columns = list(columns)
    number = [EVENT_NO] if EVENT_NO in sales.columns else []
    keyed = with_customer_version(sales, history, strategy) if "customer_sk" in columns else sales
    for dim, key, surrogate in ((products, "product_id", "product_sk"), (stores, "store_id", "store_sk")):
        if surrogate in columns:
            keyed = with_lookup(keyed, dim, key, surrogate)
        elif repeats(dim, key):
            keyed = with_lookup(keyed, dim.select(key, F.lit(None).alias(surrogate)), key, surrogate)
    computed = {
        "sale_line_sk": surrogate_key(F.col("event_id")).alias("sale_line_sk"),
        "date_sk": date_key(F.col("event_ts")).alias("date_sk"),
    }
    return keyed.select(*(computed.get(c, F.col(c)) for c in columns), *number)
