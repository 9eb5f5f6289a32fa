"""Sessions by inactivity gap."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickloom.functions.columns import exact_amount, money, money_sum, odd_amount
from clickloom.functions.intervals import floor_micros, interval_micros

SESSION_COLUMNS = (
    "user_id",
    "session_start",
    "session_end",
    "event_count",
    "purchase_count",
    "total_revenue",
)


def batch_sessions(events: DataFrame, gap: str = "30 minutes") -> DataFrame:
    """Sessions of a table: a new one starts after more than ``gap`` of silence.

    Events are first combined into buckets one gap wide. Two events of a bucket
    are always less than a gap apart, so a bucket never spans a session border
    and its first and last event time are all the border test needs. The
    combine runs map-side, and the window after it sees at most one row per
    user and gap of calendar time, however many events a single user has.
    """
    gap_micros = interval_micros(gap)
    micros = F.unix_micros(F.col("event_ts"))
    bucket = floor_micros(F.col("event_ts"), gap_micros)
    buckets = (
        events.filter(F.col("event_ts").isNotNull())
        .groupBy("user_id", bucket.alias("bucket"))
        .agg(
            F.min(micros).alias("first_at"),
            F.max(micros).alias("last_at"),
            F.count("*").alias("event_count"),
            F.sum(F.col("is_purchase").cast("int")).alias("purchase_count"),
            F.sum(exact_amount(F.col("revenue"))).alias("exact"),
            F.sum(odd_amount(F.col("revenue"))).alias("odd"),
        )
    )
    by_time = Window.partitionBy("user_id").orderBy("bucket")
    silence = F.col("first_at") - F.lag("last_at").over(by_time)
    starts = buckets.withColumn("starts", F.when(silence <= gap_micros, 0).otherwise(1))
    numbered = starts.withColumn("number", F.sum("starts").over(by_time))
    return (
        numbered.groupBy("user_id", "number")
        .agg(
            F.timestamp_micros(F.min("first_at")).alias("session_start"),
            F.timestamp_micros(F.max("last_at") + gap_micros).alias("session_end"),
            F.sum("event_count").alias("event_count"),
            F.sum("purchase_count").alias("purchase_count"),
            money(F.sum("exact"), F.sum("odd")).alias("total_revenue"),
        )
        .select(*SESSION_COLUMNS)
    )


def stream_sessions(
    events: DataFrame, gap: str = "30 minutes", watermark: str = "5 minutes"
) -> DataFrame:
    """The same sessions on a stream, each written once it has closed."""
    return (
        events.withWatermark("event_ts", watermark)
        .groupBy(F.session_window("event_ts", gap).alias("window"), "user_id")
        .agg(
            F.count("*").alias("event_count"),
            F.sum(F.col("is_purchase").cast("int")).alias("purchase_count"),
            money_sum(F.col("revenue")).alias("total_revenue"),
        )
        .select(
            "user_id",
            F.col("window.start").alias("session_start"),
            F.col("window.end").alias("session_end"),
            "event_count",
            "purchase_count",
            "total_revenue",
        )
    )

