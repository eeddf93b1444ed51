"""Star schema and marts from the clean layer."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from tillroll.operators.dimensions import date_dimension, dim_product, dim_store
from tillroll.operators.facts import AsofStrategy, choose_strategy, fct_sales
from tillroll.operators.history import dim_customer_scd2
from tillroll.operators.marts import mart_customer_ltv, mart_daily_store_sales
from tillroll.operators.staging import stage_customer_profiles, stage_sales_events
from tillroll.scratch import scratch_scope
from tillroll.sources.lake import Lake, read_clean_events, read_clean_profiles
from tillroll.sources.published import Draft, Layer

GOLD_TABLES = [
    "dim_customer_scd2",
    "dim_product",
    "dim_store",
    "dim_date",
    "fct_sales",
    "mart_daily_store_sales",
    "mart_customer_ltv",
]

# Tables that lie by day; the others are small or have no day.
_DAY_COLUMNS = {"fct_sales": "date_sk", "mart_daily_store_sales": "calendar_date"}

Store = Callable[[str, DataFrame], DataFrame]


class Seeds(NamedTuple):
    products: DataFrame
    stores: DataFrame
    customer_ids: DataFrame


def _as_is(name: str, df: DataFrame) -> DataFrame:
    return df


def build_gold(
    clean_events: DataFrame,
    clean_profiles: DataFrame,
    seeds: Seeds,
    dates: DataFrame | None = None,
    strategy: AsofStrategy = "auto",
    store: Store = _as_is,
    events_unique: bool = True,
) -> dict[str, DataFrame]:
    """All tables of the layer, with staging and seeds, by name.

    ``store`` is called on each table in dependency order; what it returns is what later tables
    read. The clean layer holds each event once and each customer at most once a day, so the marts
    need no distinct count and the history no distinct. ``events_unique=False`` restores the distinct
    count for a fact that may repeat events, say because a product id occurs twice in its seed; the
    uniqueness checks report such cases. A history is broadcast only where it was measured small, also with
    ``strategy="broadcast"``.
    """
    sales, profiles = stage_sales_events(clean_events), stage_customer_profiles(clean_profiles)
    history = store("dim_customer_scd2", dim_customer_scd2(profiles, already_distinct=True))
    if strategy in ("auto", "broadcast"):
        strategy = choose_strategy(history)
    product = store("dim_product", dim_product(seeds.products))
    shop = store("dim_store", dim_store(seeds.stores))
    calendar = store("dim_date", date_dimension(sales.sparkSession) if dates is None else dates)
    fact = store("fct_sales", fct_sales(sales, history, product, shop, strategy))
    daily = mart_daily_store_sales(fact, shop, calendar, events_unique)
    ltv = mart_customer_ltv(fact, history, events_unique=events_unique)
    return {
        "stg_sales_events": sales,
        "stg_customer_profiles": profiles,
        "ref_products": seeds.products,
        "ref_stores": seeds.stores,
        "ref_customer_ids": seeds.customer_ids,
        "dim_customer_scd2": history,
        "dim_product": product,
        "dim_store": shop,
        "dim_date": calendar,
        "fct_sales": fact,
        "mart_daily_store_sales": store("mart_daily_store_sales", daily),
        "mart_customer_ltv": store("mart_customer_ltv", ltv),
    }


def gold_job(
    spark: SparkSession,
    lake: Lake,
    seeds: Seeds,
    dates: DataFrame | None = None,
    strategy: AsofStrategy = "auto",
    events_unique: bool = True,
    draft: Draft | None = None,
) -> dict[str, DataFrame]:
    """Build the layer from the stored clean layer and publish it, or leave that to the owner of ``draft``."""
    if draft is None:
        with Layer(lake.gold).next(spark) as own:
            return gold_job(spark, lake, seeds, dates, strategy, events_unique, own)
    with scratch_scope(spark):
        return build_gold(
            read_clean_events(spark, lake.clean_events),
            read_clean_profiles(spark, lake.clean_profiles),
            seeds,
            dates,
            strategy,
            store=lambda name, df: draft.store(name, df, _DAY_COLUMNS.get(name)),
            events_unique=events_unique,
        )
