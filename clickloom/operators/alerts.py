"""High-value purchase alerts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.functions.columns import alert_text, is_type


def purchases(events: DataFrame) -> DataFrame:
    return events.filter(is_type("checkout_complete"))


def high_value_purchases(events: DataFrame, threshold: float = 500.0) -> DataFrame:
    """Purchases of at least ``threshold`` (inclusive), with the alert line.

    The test runs before any Python writer, which then sees only real alerts.
    """
    amount = F.coalesce(F.col("cart_value"), F.lit(0.0))
    return (
        purchases(events)
        .filter(F.nanvl(amount, F.lit(0.0)) >= F.lit(float(threshold)))
        .select(
            "event_id",
            "event_ts",
            "order_id",
            "user_id",
            amount.alias("amount"),
            "payment_method",
            alert_text().alias("alert_text"),
        )
    )
