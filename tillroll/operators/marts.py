"""Business aggregates over the star schema."""

from __future__ import annotations

from typing import Literal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.scalars import (
    exact_sum_parts,
    ltv_multiplier,
    per_unit,
    sum_of_parts,
    to_cents,
)
from tillroll.operators.sizes import broadcast_if_small

LtvScope = Literal["current_version", "customer"]

_PARTS = ("_exact", "_rest")


def _event_count(events_unique: bool) -> Column:
    """Distinct events. Where each event is one fact row, counting them needs no shuffle of rows."""
    return F.count("event_id") if events_unique else F.count_distinct("event_id")


def _revenue_parts(amount: str = "line_amount") -> dict[str, Column]:
    return dict(zip(_PARTS, exact_sum_parts(F.col(amount)), strict=True))


def _revenue() -> Column:
    return sum_of_parts(*map(F.col, _PARTS))


def _named(aggregates: dict[str, Column]) -> list[Column]:
    return [aggregate.alias(name) for name, aggregate in aggregates.items()]


def mart_daily_store_sales(
    fact: DataFrame, stores: DataFrame, dates: DataFrame, events_unique: bool = False
) -> DataFrame:
    """One row per store and day; facts without a known store or day are left out.

    ``events_unique`` states that no ``event_id`` occurs twice in the fact. The fact is then reduced
    to one row per store key and day key before the first shuffle, and only those rows meet the
    dimensions.
    """
    store = stores.select("store_sk", "store_id", "store_name", "region")
    day = dates.select("date_sk", "calendar_date", "is_weekend")
    grain = ["store_id", "store_name", "region", "calendar_date", "is_weekend"]

    def with_dimensions(df: DataFrame) -> DataFrame:
        return df.join(broadcast_if_small(store), "store_sk").join(
            broadcast_if_small(day), "date_sk"
        )

    totals = {
        "n_transactions": _event_count(events_unique),
        "total_units_sold": F.sum(F.col("quantity").cast("long")),
        "_priced": F.count("line_amount"),
        **_revenue_parts(),
    }
    if events_unique:
        per_key = fact.groupBy("store_sk", "date_sk").agg(*_named(totals))
        # Merges keys that share all five labels; normally each group is one row.
        merged = {name: F.sum(name) for name in totals}
        result = with_dimensions(per_key).groupBy(*grain).agg(*_named(merged))
    else:
        result = with_dimensions(fact).groupBy(*grain).agg(*_named(totals))
    return result.select(
        *grain,
        "n_transactions",
        "total_units_sold",
        _revenue().alias("total_revenue"),
        per_unit(_revenue(), F.col("_priced")).alias("avg_line_amount"),
    )


def _order_figures(events_unique: bool) -> dict[str, Column]:
    day = F.to_date("event_ts")
    return {
        "total_orders": _event_count(events_unique),
        "first_purchase_date": F.min(day),
        "last_purchase_date": F.max(day),
        **_revenue_parts(),
    }


def customer_orders(fact: DataFrame, events_unique: bool = False) -> DataFrame:
    """Order figures per customer version; revenue stays in parts for further merging."""
    known = fact.where("customer_sk is not null")
    return known.groupBy("customer_sk").agg(*_named(_order_figures(events_unique)))


def _orders_of_whole_customer(
    fact: DataFrame, history: DataFrame, events_unique: bool
) -> DataFrame:
    owners = history.select("customer_sk", "customer_id")
    if not events_unique:
        known = fact.where("customer_sk is not null").join(owners, "customer_sk")
        return known.groupBy("customer_id").agg(*_named(_order_figures(events_unique)))
    merged = {
        "total_orders": F.sum("total_orders"),
        "first_purchase_date": F.min("first_purchase_date"),
        "last_purchase_date": F.max("last_purchase_date"),
        **{part: F.sum(part) for part in _PARTS},
    }
    per_version = customer_orders(fact, events_unique).join(owners, "customer_sk")
    return per_version.groupBy("customer_id").agg(*_named(merged))


def mart_customer_ltv(
    fact: DataFrame,
    history: DataFrame,
    scope: LtvScope = "current_version",
    events_unique: bool = False,
) -> DataFrame:
    """One row per current customer, with or without orders.

    ``current_version`` counts the orders placed under the current version only; ``customer``
    counts those of all versions.
    """
    current = history.where("is_current").select("customer_sk", "customer_id", "loyalty_tier")
    if scope == "current_version":
        orders, on = customer_orders(fact, events_unique), "customer_sk"
    elif scope == "customer":
        orders, on = _orders_of_whole_customer(fact, history, events_unique), "customer_id"
    else:
        raise ValueError(f"unknown scope: {scope}")
    revenue = F.coalesce(_revenue(), F.lit(0.0))
    count = F.coalesce(F.col("total_orders"), F.lit(0))
    return current.join(orders, on, "left").select(
        "customer_sk",
        "customer_id",
        "loyalty_tier",
        count.alias("total_orders"),
        revenue.alias("total_revenue"),
        per_unit(revenue, count).alias("avg_order_value"),
        "first_purchase_date",
        "last_purchase_date",
        to_cents(revenue * ltv_multiplier(F.col("loyalty_tier"))).alias("estimated_ltv"),
    )


def top_customers(ltv: DataFrame, n: int = 200) -> DataFrame:
    """The report's top list: highest estimated value first."""
    return ltv.orderBy(F.desc("estimated_ltv"), F.asc("customer_sk")).limit(n)


def customers_with_changes(history: DataFrame) -> DataFrame:
    """Customers with more than one version."""
    return (
        history.groupBy("customer_id")
        .agg(F.count(F.lit(1)).alias("n_versions"))
        .where("n_versions > 1")
        .orderBy(F.desc("n_versions"), F.asc("customer_id"))
    )
