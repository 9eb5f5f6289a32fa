"""Analytics columns of valid events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.functions.columns import funnel_stage, is_type, lag_ms, revenue


def enrich(events: DataFrame) -> DataFrame:
    """Add date parts, purchase and cart flags, revenue, funnel stage and lag.

    One projection over built-in functions, so it stays inside the generated
    code of the stage that reads the events.
    """
    ts = F.col("event_ts")
    purchase = is_type("checkout_complete")
    return events.select(
        "*",
        F.to_date(ts).alias("event_date"),
        F.hour(ts).alias("event_hour"),
        F.minute(ts).alias("event_minute"),
        purchase.alias("is_purchase"),
        is_type("add_to_cart").alias("is_add_to_cart"),
        revenue(purchase, F.col("cart_value")).alias("revenue"),
        funnel_stage(F.col("event_type")).alias("funnel_stage"),
        lag_ms(F.col("_ingested_at"), ts).alias("processing_lag_ms"),
    )
