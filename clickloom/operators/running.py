"""Running sums per key by a prefix scan over ranges of rows.

The rows are dealt to ranges of (key, time, id) of about equal size: a hot key,
a burst within one second and rows without a time are cut like any others, by
rows. Each range is scanned once in order, batch by batch, so no key has to fit
in memory. A range ends with one summary row: the sums its last key stands at.
The summaries, one per range, are scanned in a window, and the rows of a range's
first key get what the ranges before it had added up.

The rows and the summaries come from one exchange, which Spark runs once. They
must agree on where the ranges begin: every row knows the first row of its range
and is held against the summary, so a plan that ran the exchange twice, with
other borders, would fail rather than give wrong sums.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

# What a row does to its key's sums, beside adding to them.
KEEP, RESET_BEFORE, RESET_AFTER = 0, 1, 2

RANGES = "spark.sql.shuffle.partitions"


class _Scan:
    """The running sums of one range, over batches in the order of the range."""

    def __init__(self, key: str, sums: Sequence[str], reset: str) -> None:
        self.key, self.sums, self.reset = key, sums, reset
        self.first: pa.Scalar | None = None
        self.last: pa.Scalar | None = None
        self.open = True  # still the first key, and not reset yet
        self.single = True  # still the first key
        self.pending_reset = False
        self.carried = np.zeros(len(sums), np.int64)

    def step(self, batch: pa.RecordBatch) -> tuple[list[np.ndarray], np.ndarray]:
        """The sums at each row of a batch, and whether earlier ranges add to them."""
        n = batch.num_rows
        keys = batch.column(self.key)
        mode = batch.column(self.reset).to_numpy(zero_copy_only=False)
        new_key = np.zeros(n, bool)
        new_key[1:] = ~_same(keys.slice(1), keys.slice(0, n - 1))
        if self.first is None:
            self.first = keys[0]
        else:
            new_key[0] = not _same(keys.slice(0, 1), pa.array([self.last.as_py()], keys.type))[0]
        starts = new_key | (mode == RESET_BEFORE)
        starts[1:] |= mode[:-1] == RESET_AFTER
        starts[0] |= self.pending_reset
        begun = np.maximum.accumulate(np.where(starts, np.arange(n), -1))
        out = []
        for i, name in enumerate(self.sums):
            total = np.concatenate([[0], np.cumsum(batch.column(name).to_numpy(zero_copy_only=False))])
            before = np.where(begun >= 0, total[np.maximum(begun, 0)], -self.carried[i])
            out.append(total[1:] - before)
        is_open = (begun < 0) & self.open
        self.open = bool(is_open[-1])
        self.single = self.single and not new_key.any()
        self.pending_reset = bool(mode[-1] == RESET_AFTER)
        self.carried = np.array([0 if self.pending_reset else sums[-1] for sums in out], np.int64)
        self.last = keys[n - 1]
        return out, is_open


def _same(a: pa.Array, b: pa.Array) -> np.ndarray:
    equal = pc.fill_null(pc.equal(a, b), False)
    return pc.or_(equal, pc.and_(pc.is_null(a), pc.is_null(b))).to_numpy(zero_copy_only=False)


def running_sums(
    rows: DataFrame, key: str, order: Sequence[str], added: dict[str, Column], reset: Column
) -> DataFrame:
    """``rows`` with a running sum per name in ``added``, as long.

    ``added`` are whole numbers; a null adds nothing. ``reset`` is ``KEEP``,
    ``RESET_BEFORE`` (the sums start anew with the row) or ``RESET_AFTER`` (with
    the row behind it). Nulls of the key are a key, nulls of the order come first.
    Nothing runs while the query is built. There are as many ranges as the session
    has shuffle partitions; the only broadcast is of one summary row per range.
    """
    names = list(added)
    taken = {"_range", "_reset", "_mark", "_open", *(f"_run_{c}" for c in names)}
    if clash := taken & set(rows.columns):
        raise ValueError(f"columns {sorted(clash)} are used inside")
    n_ranges = int(rows.sparkSession.conf.get(RANGES))
    steps = {f"_run_{c}": F.coalesce(value.cast("long"), F.lit(0)) for c, value in added.items()}
    place = [key, *order]
    ranged = (
        rows.withColumns({**steps, "_reset": reset.cast("int"), "_mark": F.xxhash64(*place)})
        .repartitionByRange(n_ranges, *place)
        .sortWithinPartitions(*place)
        .withColumn("_range", F.spark_partition_id())
    )
    runs = list(steps)

    def scanned(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan, mark = _Scan(key, runs, "_reset"), None
        for batch in batches:
            if not batch.num_rows:
                continue
            sums, is_open = scan.step(batch)
            mark = batch.column("_mark")[0] if mark is None else mark
            changed = {
                **dict(zip(runs, map(pa.array, sums), strict=True)),
                "_mark": pa.repeat(mark, batch.num_rows),
            }
            columns = [changed.get(f.name, batch.column(f.name)) for f in batch.schema]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(is_open)], [*batch.schema.names, "_open"]
            )

    def summed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan, place_of = _Scan(key, runs, "_reset"), None
        for batch in batches:
            if not batch.num_rows:
                continue
            scan.step(batch)
            if place_of is None:
                place_of = batch.column("_range")[0], batch.column("_mark")[0]
        if place_of is None:
            return
        # The key is one type in all batches, also where it is null.
        kind = scan.last.type
        columns = [
            pa.array([place_of[0].as_py()], pa.int32()), pa.array([place_of[1].as_py()], pa.int64()),
            pa.array([scan.first.as_py()], kind), pa.array([scan.last.as_py()], kind),
            pa.array([scan.single and scan.open and not scan.pending_reset]),
            *(pa.array([int(s)], pa.int64()) for s in scan.carried),
        ]
        yield pa.RecordBatch.from_arrays(
            columns, ["_range", "_mark", "_first", "_last", "_through", *runs]
        )

    kind = rows.schema[key].dataType
    ends = ranged.mapInArrow(
        summed,
        StructType(
            [
                ranged.schema["_range"], ranged.schema["_mark"], StructField("_first", kind),
                StructField("_last", kind), StructField("_through", BooleanType()),
                *(StructField(c, LongType()) for c in runs),
            ]
        ),
    )
    # One row per range: what the last key of the range before stands at.
    ahead = Window.orderBy("_range")
    earlier = F.lag("_last").over(ahead)
    follows = F.lag("_range").over(ahead).isNotNull() & earlier.eqNullSafe(F.col("_first"))
    grouped = ends.withColumn("_follows", follows).withColumn(
        "_group", F.sum((~(F.col("_through") & F.col("_follows"))).cast("int")).over(ahead)
    )
    in_group = Window.partitionBy("_group").orderBy("_range")
    totals = grouped.withColumns({c: F.sum(c).over(in_group) for c in runs})
    carried = totals.select(
        "_range",
        F.col("_mark").alias("_summary_mark"),
        *(F.when(F.col("_follows"), F.lag(c).over(ahead)).alias(f"{c}_carried") for c in runs),
    )
    scans = ranged.mapInArrow(
        scanned, StructType([*ranged.schema.fields, StructField("_open", BooleanType())])
    )
    joined = scans.join(F.broadcast(carried), "_range", "left")
    agree = F.col("_mark").eqNullSafe(F.col("_summary_mark"))
    differ = F.raise_error(F.lit("rows and summaries were dealt to different ranges"))

    def total(c: str) -> Column:
        carry = F.when(F.col("_open"), F.coalesce(f"{c}_carried", F.lit(0))).otherwise(0)
        return F.when(agree, F.col(c) + carry).otherwise(differ.cast("long"))

    return joined.select(*rows.columns, *(total(f"_run_{c}").alias(c) for c in names))
