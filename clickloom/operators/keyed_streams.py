"""Running cart and login state on a stream: keyed state that works in event order.

Events of a key can come in any order within the watermark. Each key keeps those
that may still be overtaken, and its value; when the watermark passes, they are
taken out in the order of the batch operators (time, then id) and each leaves
with the value it shows. So the rows are those of ``state.py`` for all time the
watermark has passed, whatever the order of arrival.

An event older than the watermark is dropped, as everywhere on a stream; one
without a readable time has no place in the order and is left out. A key starts
anew after ``keep`` of event time without events, wherever micro-batches begin and
end, so its state can be dropped when the watermark has passed that time.

Keys are dealt to ``buckets`` by a hash, and the state of Spark is that of a
bucket: the values and waiting events of all its keys, which lie in one task
anyway. A call per key would cost many times what its few events do. Each trigger
reads and writes the buckets its events or timeouts touch; the more keys are
remembered, the more buckets a stream should have, and it keeps their number for
the life of its checkpoint. What a bucket holds is bounded by the keys of ``keep``
and the events within the watermark. Arrow carries the buckets, many per batch.
"""

from __future__ import annotations

import bisect
import json
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from clickloom.functions.intervals import interval_length
from clickloom.operators.state import added_units, shown_cart, units

# A step takes (value, event type, added, price) and gives (next value, shown value).
Step = Callable[[int, str, int, int], tuple[int, int]]

BUCKETS = 256
_FIELDS = ("event_id", "event_type", "_micros", "_added", "_price")
_OUT = "{key} string, event_id string, event_type string, _micros long, _price decimal(30,0), _shown decimal(38,0)"


def cart_step(value: int, kind: str, added: int, price: int) -> tuple[int, int]:
    """An event shows the cart with what it adds; a complete checkout empties it after."""
    value += added
    return (0 if kind == "checkout_complete" else value), value


def login_step(value: int, kind: str, added: int, price: int) -> tuple[int, int]:
    value = {"user_login": 1, "user_logout": 0}.get(kind, value)
    return value, value


def in_event_order(
    events: DataFrame, key: str, step: Step, watermark: str, keep: str, buckets: int = BUCKETS
) -> DataFrame:
    """(key, event_id, event_type, event_ts, _price, _shown) of all events the watermark has passed."""
    keep_micros = interval_length(keep)
    columns = [key, "event_id", "event_type", "_micros", "_price", "_shown"]

    def advance(
        bucket: tuple, frames: Iterator[pd.DataFrame], state: GroupState
    ) -> Iterable[pd.DataFrame]:
        keys, waiting = {}, []
        if state.exists:
            kept, waiting = json.loads(state.get[0])
            keys = {k: (value, last) for k, value, last in kept}
        if not state.hasTimedOut:
            for frame in frames:
                rows = zip(*(frame[c].tolist() for c in (key, *_FIELDS)), strict=True)
                waiting += [[m, i, t, int(a), int(p), k] for k, i, t, m, a, p in rows]
        passed = state.getCurrentWatermarkMs() * 1000
        waiting.sort(key=lambda row: (row[0], row[1] is not None, row[1] or ""))
        n_ready = bisect.bisect_left(waiting, passed, key=lambda row: row[0])
        out = []
        for micros, event_id, kind, added, price, k in waiting[:n_ready]:
            value, last = keys.get(k, (0, micros))
            if micros - last > keep_micros:
                value = 0
            value, shown = step(value, kind, added, price)
            keys[k] = value, micros
            out.append((k, event_id, kind, micros, price, shown))
        still = waiting[n_ready:]
        busy = {row[5] for row in still}
        kept = [
            (k, value, last)
            for k, (value, last) in keys.items()
            if k in busy or passed - last <= keep_micros
        ]
        if not still and not kept:
            state.remove()
        else:
            state.update((json.dumps((kept, still)),))
            wake = [last + keep_micros for k, _, last in kept if k not in busy]
            wake += [row[0] for row in still[:1]]
            state.setTimeoutTimestamp(max(min(wake), passed) // 1000 + 1)
        if out:
            yield pd.DataFrame(out, columns=columns)

    picked = events.filter(F.col("event_ts").isNotNull()).select(
        F.pmod(F.xxhash64(key), F.lit(buckets)).alias("_bucket"),
        F.col(key).alias(key),
        "event_id",
        "event_type",
        "event_ts",
        F.unix_micros("event_ts").alias("_micros"),
        added_units().alias("_added"),
        units(F.col("price")).alias("_price"),
    )
    done = (
        picked.withWatermark("event_ts", watermark)
        .groupBy("_bucket")
        .applyInPandasWithState(
            advance,
            _OUT.format(key=key),
            "state string",
            "append",
            GroupStateTimeout.EventTimeTimeout,
        )
    )
    return done.withColumn("event_ts", F.timestamp_micros("_micros"))


def stream_cart(events: DataFrame, watermark: str = "5 minutes", keep: str = "1 day") -> DataFrame:
    """``running_cart`` of every event the watermark has passed; see ``cart_state``."""
    done = in_event_order(events, "session_id", cart_step, watermark, keep)
    cart = F.col("_shown")
    return done.select(
        "event_id", "session_id", "event_type", "event_ts",
        shown_cart(cart, F.col("_price")).alias("running_cart"),
    )


def stream_login(
    events: DataFrame, watermark: str = "5 minutes", keep: str = "90 days"
) -> DataFrame:
    """``logged_in`` of every event the watermark has passed; see ``login_state``."""
    done = in_event_order(events, "user_id", login_step, watermark, keep)
    return done.select(
        "event_id", "user_id", "event_type", "event_ts", (F.col("_shown") > 0).alias("logged_in")
    )
