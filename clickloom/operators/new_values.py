"""Distinct values of sliding windows on a stream, each told to a window once.

A value that lies in overlapping windows would need a state row in each of them. Here
the state of a value is the panes it was met in, the spans between which no window
starts or ends. A pane met for the first time is new to the windows that hold it and
no pane met before; these follow each other, so one row with the first and the last of
them says it all. Counts of such rows add up to distinct counts.

Nothing waits for the watermark, and no row is dropped: the aggregate after it drops
what came too late, window by window. A pane is forgotten when the watermark must have
passed its last window; what could still ask for it is dropped there. The watermark
is at least that of the rows a bucket got before this trigger: Spark drops by that of
the trigger before. So a query must not hold this watermark back by another stream's.

Values are dealt to ``BUCKETS`` by a hash, and the state of Spark is that of a bucket.
The values of a cell lie in up to ``SPREAD`` buckets, few enough for equal rows to be
counted before they leave, and enough that no task holds a large cell. Values are told
apart by 16 bytes of a SHA-256. A trigger rewrites the buckets it touches; others keep
the panes of their last one.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from clickloom.functions.intervals import floor_micros

BUCKETS = 256
SPREAD = 8
_OUT = ("_pane long", "first long", "last long", "n long", "kind string")


def new_in_windows(
    facts: DataFrame,
    keys: tuple[str, ...],
    wide: int,
    apart: int,
    delay: int,
    buckets: int = BUCKETS,
) -> DataFrame:
    """(event_ts, keys, kind, first, last, n): ``n`` values are new in these windows.

    ``facts`` has ``event_ts``, whose watermark is ``delay`` microseconds behind, the keys,
    and ``kind`` and ``item``, a value. Windows are ``wide`` and start at the multiples of
    ``apart``; ``first`` and ``last`` are starts. The ``event_ts`` that leaves is that of
    the pane and lies in all of them.
    """
    columns = [*(field.split()[0] for field in _OUT), *keys]
    seen = np.dtype([("high", "u8"), ("low", "u8"), ("pane", "i8")])

    def advance(
        bucket: tuple, frames: Iterator[pd.DataFrame], state: GroupState
    ) -> Iterable[pd.DataFrame]:
        clock, kept = state.get if state.exists else (None, b"")
        known = np.frombuffer(kept, seen)
        cells, rows, codes = {}, [known], [np.full(len(known), -1)]
        for frame in frames:
            frame = frame.drop_duplicates(["_value", "_pane"])
            halves = np.frombuffer(b"".join(frame["_value"]), ">u8").reshape(-1, 2)
            row = np.empty(len(frame), seen)
            row["high"], row["low"], row["pane"] = halves[:, 0], halves[:, 1], frame["_pane"]
            at, names = pd.factorize(frame["_cell"])
            numbers = np.array([cells.setdefault(name, len(cells)) for name in names])
            rows.append(row)
            codes.append(numbers[at])
        row, code = np.concatenate(rows), np.concatenate(codes)
        # By value and pane, a known one first; of equal ones the first stays.
        order = np.lexsort((code >= 0, row["pane"], row["low"], row["high"]))
        row, code = row[order], code[order]
        same = (row["high"][1:] == row["high"][:-1]) & (row["low"][1:] == row["low"][:-1])
        stays = np.append(True, ~(same & (row["pane"][1:] == row["pane"][:-1])))
        value = np.cumsum(np.append(False, ~same))[stays]
        row, code = row[stays], code[stays]
        pane, old, place = row["pane"], code < 0, np.arange(len(row))
        # A window that holds several new panes goes to the first of them; one that
        # holds a known pane, the pane before or the next known, is not new.
        after, upto = pane - wide, pane.copy()
        follows = np.append(False, value[1:] == value[:-1])
        after[follows] = np.maximum(after[follows], pane[place[follows] - 1])
        known_at = np.where(old, place, len(row) - 1)
        known_at = np.minimum.accumulate(known_at[::-1])[::-1]
        bounded = old[known_at] & (value[known_at] == value)
        upto[bounded] = np.minimum(upto, pane[known_at] - wide)[bounded]
        first, last = (after // apart + 1) * apart, upto // apart * apart
        new = ~old & (first <= last)
        newest = int(pane.max()) // 1000 * 1000
        if clock is not None:
            row, newest = row[pane + wide > clock - delay], max(newest, clock)
        state.update((newest, row.tobytes()))
        if new.any():
            told = np.stack([code[new], pane[new], first[new], last[new]])
            told = told[:, np.lexsort(told)]
            starts = np.flatnonzero(np.append(True, (told[:, 1:] != told[:, :-1]).any(axis=0)))
            number, *spans = told[:, starts]
            named = [(kind, json.loads(text)) for kind, text in (c.split("\n") for c in cells)]
            out = {"_pane": spans[0], "first": spans[1], "last": spans[2]}
            out["n"] = np.diff(np.append(starts, told.shape[1]))
            out["kind"] = np.array([kind for kind, _ in named], object)[number]
            for c in keys:
                out[c] = np.array([read.get(c) for _, read in named], object)[number]
            yield pd.DataFrame(out)[columns]

    # The keys as one text for each row; JSON has no line end inside.
    text = F.to_json(F.struct(*(F.col(c).cast("string").alias(c) for c in keys)))
    cell = F.concat("kind", F.lit("\n"), F.col("_keys"))
    share = F.pmod(F.xxhash64("item"), F.lit(SPREAD))
    value = F.unhex(F.substring(F.sha2(F.concat("_cell", F.lit("\n"), "item"), 256), 1, 32))
    panes = (
        facts.withColumn("_keys", text)
        .withColumn("_cell", cell)
        .select(
            F.pmod(F.xxhash64("_cell", share), F.lit(buckets)).alias("_bucket"),
            "_cell",
            value.alias("_value"),
            floor_micros(F.col("event_ts"), F.lit(math.gcd(wide, apart))).alias("_pane"),
        )
    )
    told = panes.groupBy("_bucket").applyInPandasWithState(
        advance,
        ", ".join([*_OUT, *(f"{c} string" for c in keys)]),
        "clock long, panes binary",
        "append",
        GroupStateTimeout.NoTimeout,
    )
    types = {c: facts.schema[c].dataType for c in keys}
    return told.select(
        F.timestamp_micros("_pane").alias("event_ts"),
        *(F.col(c).cast(form).alias(c) for c, form in types.items()),
        "kind",
        "first",
        "last",
        "n",
    )
