"""The most frequent values of a column with very many of them.

Each task keeps a summary of a fixed number of counters (Misra-Gries): values
that find no counter take one off each. A counter is too low by no more than what
its task took off, so the merged counters bound every value's count from both
sides. The few values that can be among the first are counted exactly in a
second pass. No task holds all values, and what is shuffled does not grow with
their number.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.operators.bounds import fits_broadcast

COUNTERS = 2_000


def reduced(counts: pd.Series, counters: int) -> tuple[pd.Series, int]:
    """At most ``counters`` of the counts, and what was taken off each of them."""
    if len(counts) <= counters:
        return counts, 0
    off = int(np.partition(counts.to_numpy(), -counters - 1)[-counters - 1])
    return (counts - off)[counts > off], off


def summaries(rows: DataFrame, column: str, counters: int) -> DataFrame:
    """(value, n, off) of the counters of each task; ``off`` is on its first row only."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, off = pd.Series(dtype=np.int64), 0
        for batch in batches:
            seen = batch.column(0).value_counts()
            new = pd.Series(seen.field("counts").to_numpy(), seen.field("values").to_pandas())
            held, less = reduced(held.add(new, fill_value=0).astype(np.int64), counters)
            off += less
        if len(held) or off:
            values = pa.array([*held.index, None], pa.string())
            n = pa.array([*held.to_numpy(), 0], pa.int64())
            offs = pa.array([0] * len(held) + [off], pa.int64())
            yield pa.RecordBatch.from_arrays([values, n, offs], ["value", "n", "off"])

    present = rows.select(F.col(column).cast("string").alias("value")).filter("value is not null")
    return present.mapInArrow(run, "value string, n long, off long")


def most_frequent(
    rows: DataFrame, column: str, k: int = 20, counters: int = COUNTERS
) -> DataFrame:
    """(value, n, rank): the ``k`` most frequent values and how often they occur.

    Exact; the value breaks ties, nulls are not counted. The driver gets two
    numbers. Where values are so even that the summaries cannot rule any out, all
    are counted by a plain aggregate.
    """
    held = summaries(rows, column, counters)
    merged = held.groupBy("value").agg(F.sum("n").alias("n"), F.sum("off").alias("off"))
    known = merged.filter("value is not null")
    off = merged.agg(F.sum("off")).first()[0] or 0
    first = known.orderBy(F.desc("n"), "value").limit(k).agg(F.min("n"), F.count("*")).first()
    least = first[0] or 0
    counted = rows.select(F.col(column).cast("string").alias("value")).filter("value is not null")
    if off < least and first[1] == k:
        # The k-th value occurs ``least`` times at least, a value without a counter ``off`` at most.
        able = known.filter(F.col("n") + off >= least).select("value")
        counted = counted.join(F.broadcast(able) if fits_broadcast(able) else able, "value", "left_semi")
    return (
        counted.groupBy("value")
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), "value")
        .limit(k)
        .selectExpr("value", "n", "row_number() over (order by n desc, value) as rank")
    )
