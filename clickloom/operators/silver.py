"""Event-time window aggregates ("silver" cells).

A cell is one window of one event type, date, device and funnel stage. The
distinct counts are what makes cells hard at scale, so there are three plans:

``batch_cells``   ``countDistinct``. Spark expands each event once per distinct
                  column, combines map-side, and shuffles on cell *and* value,
                  so a cell holding a third of all events still spreads over
                  all tasks; the second shuffle carries partial counts only.
``sliding_cells`` The same counts for overlapping windows. Events are first
                  reduced to panes, the spans between which no window starts or
                  ends; only what a pane adds is copied into the windows that
                  cover it, never the values.
``stream_cells``  Streams refuse ``countDistinct``. Two chained window
                  aggregates count exactly without ever holding a set: the
                  first keeps one row per cell and distinct value, the second
                  counts those rows. Sliding windows would need such rows in
                  every window; there the panes a value was met in are kept,
                  and one aggregate adds up what each pane is new to.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.functions.columns import exact_amount, money, odd_amount
from clickloom.functions.intervals import floor_micros, interval_length, interval_micros
from clickloom.operators.new_values import new_in_windows

CELL_KEYS = ("event_type", "event_date", "device_type", "funnel_stage")

DISTINCT_COUNTS = {
    "unique_users": "user_id",
    "unique_sessions": "session_id",
    "unique_products_viewed": "product_id",
}

# Additive measures of a single event; each merges with the function next to it.
_MEASURES = {
    "event_count": (F.sum, lambda: F.lit(1)),
    "money_exact": (F.sum, lambda: exact_amount(F.col("revenue"))),
    "money_odd": (F.sum, lambda: odd_amount(F.col("revenue"))),
    "money_rows": (F.sum, lambda: F.col("revenue").isNotNull().cast("int")),
    "purchase_count": (F.sum, lambda: F.col("is_purchase").cast("int")),
    "add_to_cart_count": (F.sum, lambda: F.col("is_add_to_cart").cast("int")),
    "lag_sum": (F.sum, lambda: F.col("processing_lag_ms")),
    "lag_rows": (F.sum, lambda: F.col("processing_lag_ms").isNotNull().cast("int")),
    "max_processing_lag_ms": (F.max, lambda: F.col("processing_lag_ms")),
    "authenticated_events": (
        F.sum,
        lambda: F.coalesce(F.col("is_authenticated"), F.lit(False)).cast("int"),
    ),
}

CELL_COLUMNS = (
    *CELL_KEYS,
    "event_count",
    "unique_users",
    "unique_sessions",
    "total_revenue",
    "avg_revenue",
    "purchase_count",
    "add_to_cart_count",
    "avg_processing_lag_ms",
    "max_processing_lag_ms",
    "unique_products_viewed",
    "authenticated_events",
    "window_start",
    "window_end",
)


def batch_cells(
    events: DataFrame, width: str = "1 minute", error: float | None = None
) -> DataFrame:
    """Tumbling windows over a table of enriched events.

    With ``error`` the distinct counts are sketches of that relative standard
    error: one shuffle instead of two, and no expansion of the events.
    """
    return _one_aggregate(events, F.window("event_ts", width), _distinct(error))


def sliding_cells(
    events: DataFrame, width: str = "5 minutes", step: str = "1 minute"
) -> DataFrame:
    """Overlapping windows over a table of enriched events, of any width and step.

    Windows start at the multiples of ``step``. The measures of a pane count in
    all windows that cover it. A distinct value counts only in those that its
    previous pane does not lie in, so no window counts it twice. Events are read
    once and grouped once by pane, cell and value.
    """
    wide, apart = interval_length(width), interval_length(step)
    pane = floor_micros(F.col("event_ts"), F.lit(math.gcd(wide, apart)))
    timed = events.filter(F.col("event_ts").isNotNull())
    facts = _merge_facts(_facts(timed).groupBy(pane.alias("pane"), *CELL_KEYS, "kind", "item"))
    earlier = F.lag("pane").over(
        Window.partitionBy(*CELL_KEYS, "kind", "item").orderBy("pane")
    )
    # Windows that start later than this, up to the pane, take the row.
    after = F.greatest(F.col("pane") - wide, F.when(F.col("kind").isNotNull(), F.col("earlier")))
    first = F.col("after") - F.pmod(F.col("after"), F.lit(apart)) + apart
    last = F.col("pane") - F.pmod(F.col("pane"), F.lit(apart))
    cells = _count_facts(
        facts.withColumn("earlier", earlier)
        .withColumn("after", after)
        .withColumn("first", first)
        .withColumn("last", last)
        .filter("first <= last")
        .withColumn("start", F.explode(F.sequence("first", "last", F.lit(apart))))
        .groupBy("start", *CELL_KEYS)
    )
    window = F.struct(
        F.timestamp_micros("start").alias("start"),
        F.timestamp_micros(F.col("start") + wide).alias("end"),
    )
    return finished(cells.withColumn("window", window))


def stream_cells(
    events: DataFrame,
    width: str = "1 minute",
    step: str | None = None,
    watermark: str = "5 minutes",
) -> DataFrame:
    """Tumbling (or, with ``step``, sliding) windows over a stream, append mode."""
    marked = events.withWatermark("event_ts", watermark)
    if step:
        return _stream_sliding_cells(marked, width, step, watermark)
    window = F.window("event_ts", width)
    values = _merge_facts(_facts(marked).groupBy(window, *CELL_KEYS, "kind", "item"))
    return finished(_count_facts(values.groupBy("window", *CELL_KEYS)))


def _stream_sliding_cells(marked: DataFrame, width: str, step: str, watermark: str) -> DataFrame:
    """Measures from the events, distinct counts from the windows a value is new in.

    The time of both has the watermark of the events: a union takes it from its first part.
    """
    values = _values(marked.filter(F.col("event_ts").isNotNull()))
    lengths = [interval_micros(text) for text in (width, step, watermark)]
    wide, apart, delay = marked.sparkSession.sql("SELECT 1").select(*lengths).first()
    new = new_in_windows(values, CELL_KEYS, wide, apart, delay)
    single = marked.select(
        "event_ts", *CELL_KEYS, *(value().alias(name) for name, (_, value) in _MEASURES.items())
    )
    rows = single.unionByName(new, allowMissingColumns=True)
    start = F.unix_micros("window.start")
    told = rows.withColumn("window", F.window("event_ts", width, step)).filter(
        F.col("kind").isNull() | start.between(F.col("first"), F.col("last"))
    )
    counts = [
        F.coalesce(F.sum(F.when(F.col("kind") == name, F.col("n"))), F.lit(0)).alias(name)
        for name in DISTINCT_COUNTS
    ]
    return finished(told.groupBy("window", *CELL_KEYS).agg(*merged_measures(), *counts))


def stream_cells_approx(
    events: DataFrame,
    width: str = "1 minute",
    step: str | None = None,
    watermark: str = "5 minutes",
    error: float = 0.05,
) -> DataFrame:
    """The stream cells in a single aggregate, with approximate distinct counts.

    Chained aggregates run in append mode only; this one also runs in update and
    complete mode. Each distinct count is a sketch of fixed size in the state
    row of its cell, with relative standard error ``error``. All other columns
    are exact.
    """
    marked = events.withWatermark("event_ts", watermark)
    return _one_aggregate(marked, F.window("event_ts", width, step or width), _distinct(error))


def with_written_at(cells: DataFrame, clock: Column | None = None) -> DataFrame:
    """Stamp rows with the time they are written."""
    return cells.withColumn("_written_at", F.current_timestamp() if clock is None else clock)


def _distinct(error: float | None) -> Callable[[str], Column]:
    return F.countDistinct if error is None else lambda c: F.approx_count_distinct(c, error)


def _one_aggregate(
    events: DataFrame, window: Column, distinct: Callable[[str], Column]
) -> DataFrame:
    return finished(
        events.groupBy(window.alias("window"), *CELL_KEYS).agg(
            *measures(),
            *(distinct(c).alias(name) for name, c in DISTINCT_COUNTS.items()),
        )
    )


def _facts(events: DataFrame) -> DataFrame:
    """Each event as one row of measures and one row per distinct-counted value.

    ``kind`` names the counted column and ``item`` holds the value; the measures
    are null there, and both are null on the row that carries the measures.
    """
    measures = {name: value() for name, (_, value) in _MEASURES.items()}
    kinds = [
        F.struct(F.lit(name).alias("kind"), F.col(c).alias("item"))
        for name, c in DISTINCT_COUNTS.items()
    ]
    carrier = F.struct(
        F.lit(None).cast("string").alias("kind"), F.lit(None).cast("string").alias("item")
    )
    rows = events.select(
        "event_ts",
        *CELL_KEYS,
        *(value.alias(name) for name, value in measures.items()),
        F.inline(F.array(carrier, *kinds)),
    )
    counted = F.col("kind").isNotNull()
    return rows.filter(~counted | F.col("item").isNotNull()).withColumns(
        {name: F.when(~counted, F.col(name)) for name in measures}
    )


def _values(events: DataFrame) -> DataFrame:
    """The distinct-counted values of each event alone, as ``kind`` and ``item``."""
    kinds = [
        F.struct(F.lit(name).alias("kind"), F.col(c).alias("item"))
        for name, c in DISTINCT_COUNTS.items()
    ]
    rows = events.select("event_ts", *CELL_KEYS, F.inline(F.array(*kinds)))
    return rows.filter("item is not null")


def measures() -> list[Column]:
    """Aggregates of events into the mergeable measures."""
    return [merge(value()).alias(name) for name, (merge, value) in _MEASURES.items()]


def merged_measures() -> list[Column]:
    """Aggregates of measures into the same measures."""
    return [merge(name).alias(name) for name, (merge, _) in _MEASURES.items()]


def _merge_facts(grouped) -> DataFrame:
    return grouped.agg(*merged_measures())


def _count_facts(grouped) -> DataFrame:
    return grouped.agg(
        *merged_measures(),
        *(F.count_if(F.col("kind") == name).alias(name) for name in DISTINCT_COUNTS),
    )


def finished(cells: DataFrame) -> DataFrame:
    """Turn merged measures into the published columns.

    The averages run over the events that have a value.
    """
    total = money(F.col("money_exact"), F.col("money_odd"))
    return cells.withColumns(
        {
            "total_revenue": total,
            "avg_revenue": total / F.nullif(F.col("money_rows"), F.lit(0)),
            "avg_processing_lag_ms": F.col("lag_sum") / F.nullif(F.col("lag_rows"), F.lit(0)),
            "window_start": F.col("window.start"),
            "window_end": F.col("window.end"),
        }
    ).select(*CELL_COLUMNS)
