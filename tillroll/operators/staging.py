"""Typed staging frames over the clean layer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.scalars import email_domain


def stage_sales_events(clean: DataFrame) -> DataFrame:
    """Completed sales only; ``event_date`` is taken from the partition or derived."""
    day = F.col("event_date") if "event_date" in clean.columns else F.to_date("event_ts")
    return clean.where(F.col("event_type") == "sale").select(
        "event_id",
        "event_type",
        "customer_id",
        "product_id",
        "store_id",
        F.col("quantity").cast("int").alias("quantity"),
        F.col("unit_price").cast("double").alias("unit_price"),
        F.col("discount_amount").cast("double").alias("discount_amount"),
        F.col("line_amount").cast("double").alias("line_amount"),
        F.col("event_ts").cast("timestamp").alias("event_ts"),
        F.col("silver_loaded_at").cast("timestamp").alias("silver_loaded_at"),
        "is_late_arrival",
        day.alias("event_date"),
    )


def stage_customer_profiles(clean: DataFrame) -> DataFrame:
    return clean.select(
        "customer_id",
        "full_name",
        "email",
        email_domain(F.col("email")).alias("email_domain"),
        "loyalty_tier",
        "home_store_id",
        F.col("snapshot_ts").cast("timestamp").alias("snapshot_ts"),
        F.col("silver_loaded_at").cast("timestamp").alias("silver_loaded_at"),
    )
