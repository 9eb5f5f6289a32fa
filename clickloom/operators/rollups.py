"""Roll-ups of silver cells to longer windows and to coarser groups, without the events.

Cells keep what can be merged: sums, maxima and, for each distinct count, a theta
sketch. Longer windows are unions of shorter ones, so hours come from minutes and
days from hours. Sums and averages are those of the events, to the cent; a
distinct count is exact below the sketch's nominal entries and has a relative
standard error of 1 / sqrt(entries) beyond.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.operators.silver import CELL_KEYS, DISTINCT_COUNTS, finished, measures, merged_measures

# Nominal entries of a sketch as a power of two: 4,096, an error of 1.6 %.
SKETCH_POWER = 12

CUBE_KEYS = ("event_type", "event_date", "device_type")
CUBE = (("event_type", "event_date"), ("event_type",), ("event_date",), ("device_type",), ())


def sketched_cells(
    events: DataFrame, width: str = "1 minute", power: int = SKETCH_POWER
) -> DataFrame:
    """Cells of enriched events with mergeable measures and a sketch per distinct count.

    One aggregate, combined map-side: a shuffle of cells, never of values.
    """
    timed = events.filter(F.col("event_ts").isNotNull())
    return timed.groupBy(F.window("event_ts", width).alias("window"), *CELL_KEYS).agg(
        *measures(), *(F.theta_sketch_agg(c, power).alias(n) for n, c in DISTINCT_COUNTS.items())
    )


def merged_cells(
    cells: DataFrame, width: str = "1 hour", power: int = SKETCH_POWER
) -> DataFrame:
    """Sketched cells of a longer window, from sketched cells of shorter ones.

    ``width`` is a multiple of the cells' own width. The result can be merged on.
    """
    longer = F.window(F.col("window.start"), width).alias("window")
    return cells.withColumn("_window", longer).groupBy(
        F.col("_window").alias("window"), *CELL_KEYS
    ).agg(
        *merged_measures(), *(F.theta_union_agg(n, power).alias(n) for n in DISTINCT_COUNTS)
    )


def estimated_cells(cells: DataFrame) -> DataFrame:
    """The published columns of sketched cells."""
    return finished(
        cells.withColumns({n: F.theta_sketch_estimate(n) for n in DISTINCT_COUNTS})
    )


def event_cube(events: DataFrame, sets: Sequence[Sequence[str]] = CUBE) -> DataFrame:
    """Measures of several groupings of enriched events, by one scan.

    Events are first merged into cells of all keys; only these are copied, once
    per grouping. Keys that a grouping does not have are null; ``grouping`` names
    it, bit by bit from the last key, as SQL's ``grouping_id`` does, so a null
    value of a key can be told from a key left out.
    """
    cells = events.groupBy(*CUBE_KEYS).agg(*measures())
    together = cells.groupingSets([[F.col(c) for c in one] for one in sets], *CUBE_KEYS).agg(
        F.grouping_id().alias("grouping"), *merged_measures()
    )
    total = F.coalesce(F.col("money_exact").cast("double"), F.lit(0.0)) + F.coalesce(
        "money_odd", F.lit(0.0)
    )
    has_money = F.col("money_exact").isNotNull() | F.col("money_odd").isNotNull()
    return together.select(
        "grouping", *CUBE_KEYS, "event_count", "purchase_count", "add_to_cart_count",
        "authenticated_events", F.when(has_money, total).alias("total_revenue"),
        "max_processing_lag_ms",
    )
