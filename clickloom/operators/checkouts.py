"""Checkouts on a stream: each start with the completion it led to, or none."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.functions.columns import is_type


def stream_checkouts(
    events: DataFrame, within: str = "30 minutes", watermark: str = "5 minutes"
) -> DataFrame:
    """Every ``checkout_start`` with each ``checkout_complete`` of its session ``within`` a time.

    Both sides are kept as state until the watermark rules a partner out: a start
    for ``within``, a completion until no start before it can come. A pair comes
    out at once, a start without a completion (``abandoned``) when the watermark
    has passed its time. Events without a readable time take no part.
    """
    timed = events.filter(F.col("event_ts").isNotNull()).withWatermark("event_ts", watermark)
    started = timed.filter(is_type("checkout_start")).select(
        F.col("session_id").alias("session_id"),
        F.col("event_id").alias("start_id"),
        F.col("event_ts").alias("started_at"),
    )
    completed = timed.filter(is_type("checkout_complete")).select(
        F.col("session_id").alias("_session"),
        F.col("event_id").alias("complete_id"),
        F.col("event_ts").alias("completed_at"),
        F.col("cart_value"),
    )
    led_to = (
        (F.col("session_id") == F.col("_session"))
        & (F.col("completed_at") >= F.col("started_at"))
        & (F.col("completed_at") <= F.col("started_at") + F.expr(f"interval {within}"))
    )
    return started.join(completed, led_to, "left_outer").select(
        "session_id", "start_id", "started_at", "complete_id", "completed_at", "cart_value",
        F.col("complete_id").isNull().alias("abandoned"),
    )
