"""Sorted runs of index lines in files, merged by loser trees with one batch of each run in memory.

A run is an Arrow IPC file of sorted batches. As long as there are more than
``FAN_IN`` runs, tasks merge groups of so many into longer ones. The last runs are
cut at the same keys, and each task merges its slice of all of them: it finds the
first batch of the slice in every file and reads on from there. So a task holds
``FAN_IN`` batches whatever the number of lines, and a key with very many lines is
spread, as cuts lie between lines and not between keys.

A file appears under its name only when it is complete, and a repeated task writes
the same lines, so lost executors do no harm.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyarrow import fs, ipc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm.common import cut
from clickloom.llm.token_files import locate

FAN_IN = 64
BATCH_LINES = 2_048
RANGE_LINES = 20_000  # lines a task of the last merge aims at
MOST_RANGES = 4_096
FENCES = 64  # places of a run that say how its lines spread

Order = Callable[[tuple], tuple]


def publish(folder: str, name: str, write: Callable[[pa.NativeFile], None]) -> None:
    """Write a file below ``folder`` that shows under its name only when whole."""
    files, path = locate(folder)
    files.create_dir(path, recursive=True)
    task = TaskContext.get()
    hidden = f"{path}/.{name}-{task.taskAttemptId() if task else 0}"
    with files.open_output_stream(hidden) as out:
        write(out)
    files.move(hidden, f"{path}/{name}")


def batches_of(lines: Iterable[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    waiting: list[tuple] = []
    for line in lines:
        waiting.append(line)
        if len(waiting) == BATCH_LINES:
            yield as_batch(waiting, schema)
            waiting = []
    if waiting:
        yield as_batch(waiting, schema)


def as_batch(lines: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*lines, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )


def write_run(folder: str, name: str, lines: Iterable[tuple], schema: pa.Schema) -> None:
    def write(out: pa.NativeFile) -> None:
        with ipc.new_file(out, schema) as run:
            for batch in batches_of(lines, schema):
                run.write(batch)

    publish(folder, name, write)


class RunFile:
    """A sorted run, read batch by batch."""

    def __init__(self, files: fs.FileSystem, path: str, order: Order) -> None:
        self.file = ipc.open_file(files.open_input_file(path))
        self.order = order

    def first_of(self, i: int) -> tuple:
        return self._lines(self.file.get_batch(i).slice(0, 1))[0]

    @staticmethod
    def _lines(batch: pa.RecordBatch) -> list[tuple]:
        return list(zip(*(c.to_pylist() for c in batch.columns), strict=True))

    def lines(self, low: tuple | None = None, high: tuple | None = None) -> Iterator[tuple]:
        """The lines with keys from ``low`` up to, not including, ``high``."""
        n = self.file.num_record_batches
        start = 0
        if low is not None:
            after = bisect_left(range(n), low, key=lambda i: self.order(self.first_of(i)))
            start = max(0, after - 1)
        for i in range(start, n):
            for line in self._lines(self.file.get_batch(i)):
                key = self.order(line)
                if high is not None and key >= high:
                    return
                if low is None or key >= low:
                    yield line

    def fences(self) -> list[tuple[tuple, int]]:
        """At most ``FENCES`` lines of the run, each with the number of lines from it to the next."""
        n = self.file.num_record_batches
        if not n:
            return []
        # All batches but the last are equally long.
        full, rest = self.file.get_batch(0).num_rows, self.file.get_batch(n - 1).num_rows
        step = -(-n // FENCES)
        inside = max(1, FENCES // n)  # a run of few batches is cut inside them too
        found = []
        for i in range(0, n, step):
            upto = min(i + step, n)
            size = (upto - i) * full - (full - rest if upto == n else 0)
            if step > 1:
                found.append((self.first_of(i), size))
                continue
            lines = self._lines(self.file.get_batch(i))
            stride = -(-size // inside)
            found += [(lines[k], min(stride, size - k)) for k in range(0, size, stride)]
        return found


class LoserTree:
    """Merges sorted runs; an inner node keeps the run that lost there."""

    def __init__(self, runs: Iterable[Iterable[tuple]], order: Order) -> None:
        self.order = order
        self.runs = [iter(run) for run in runs]
        self.width = 1 << max(0, len(self.runs) - 1).bit_length()
        self.heads: list[tuple | None] = [next(run, None) for run in self.runs]
        self.heads += [None] * (self.width - len(self.heads))
        self.keys = [None if x is None else order(x) for x in self.heads]
        self.losers = [0] * self.width
        winners = list(range(self.width))
        node = self.width
        while node > 1:  # play the first tournament level by level
            half = node // 2
            for i in range(half):
                a, b = winners[2 * i], winners[2 * i + 1]
                won, lost = (a, b) if self._before(a, b) else (b, a)
                winners[i], self.losers[half + i] = won, lost
            node = half
        self.winner = winners[0]

    def _before(self, a: int, b: int) -> bool:
        x, y = self.keys[a], self.keys[b]
        return x is not None and (y is None or x <= y)

    def __iter__(self) -> Iterator[tuple]:
        while (line := self.heads[self.winner]) is not None:
            yield line
            at = self.winner
            self.heads[at] = head = next(self.runs[at], None)
            self.keys[at] = None if head is None else self.order(head)
            node = (self.width + at) // 2
            while node:
                other = self.losers[node]
                if not self._before(at, other):
                    self.losers[node], at = at, other
                node //= 2
            self.winner = at


def merged_lines(
    folder: str, names: Iterable[str], order: Order, low: tuple | None = None, high: tuple | None = None
) -> Iterator[tuple]:
    files, path = locate(folder)
    runs = [RunFile(files, f"{path}/{name}", order).lines(low, high) for name in names]
    return iter(LoserTree(runs, order))


def run_name(level: int, number: int) -> str:
    return f"run-{level}-{number:08d}.arrow"


def merge_groups(
    spark: SparkSession, folder: str, level: int, runs: int, order: Order, schema: pa.Schema
) -> int:
    """Merge the runs of ``level`` into those of the next, ``FAN_IN`` into one: how many there are."""
    fan_in = FAN_IN
    groups = -(-runs // fan_in)

    def merge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for group in batch.column(0).to_pylist():
                members = range(group * fan_in, min(runs, (group + 1) * fan_in))
                lines = merged_lines(folder, [run_name(level, i) for i in members], order)
                write_run(folder, run_name(level + 1, group), lines, schema)
                yield pa.RecordBatch.from_pydict({"run": pa.array([group], pa.int64())})

    # A range has one row per group and as many partitions: a task merges one group.
    done = spark.range(0, groups, 1, groups).mapInArrow(merge, "run long").agg(F.count("*"))
    if done.first()[0] != groups:
        raise RuntimeError(f"not all groups of level {level} were merged")
    return groups


def cuts(fences: list[tuple[tuple, int]], order: Order, ranges: int) -> list[tuple]:
    """At most ``ranges`` - 1 keys that part the lines about evenly."""
    keyed = sorted(((order(line), n) for line, n in fences), key=lambda x: x[0])
    total, seen, last, found = sum(n for _, n in keyed), 0, 0, []
    for key, n in keyed:
        if (share := seen * ranges // total) > last:
            found.append(key)
            last = share
        seen += n
    return found


def merge_runs(
    spark: SparkSession, folder: str, runs: int, order: Order, schema: pa.Schema, ddl: str
) -> DataFrame:
    """All lines of the ``runs`` sorted runs of level 0 in order, range after range.

    The driver gets at most ``FENCES`` lines from each of at most ``FAN_IN`` runs.
    """
    level = 0
    while runs > FAN_IN:
        runs = merge_groups(spark, folder, level, runs, order, schema)
        level += 1
    names = [run_name(level, i) for i in range(runs)]
    at_level = level

    def fence(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = locate(folder)
        for batch in batches:
            for number in batch.column(0).to_pylist():
                found = RunFile(files, f"{path}/{run_name(at_level, number)}", order).fences()
                if found:
                    lines = as_batch([line for line, _ in found], schema)
                    sizes = pa.array([n for _, n in found], pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [*lines.columns, sizes], names=[*schema.names, "lines_from_here"]
                    )

    sampled = spark.range(0, runs, 1, max(1, runs)).mapInArrow(fence, f"{ddl}, lines_from_here long")
    fences = [(tuple(row)[:-1], row[-1]) for row in sampled.collect()]
    total = sum(n for _, n in fences)
    ranges = min(MOST_RANGES, max(1, -(-total // RANGE_LINES)))
    bounds: list[tuple | None] = [None, *cuts(fences, order, ranges), None]

    def merge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number in batch.column(0).to_pylist():
                lines = merged_lines(folder, names, order, bounds[number], bounds[number + 1])
                yield from batches_of(lines, schema)

    pieces = len(bounds) - 1
    return spark.range(0, pieces, 1, pieces).mapInArrow(merge, ddl)


def settle_count(parts: DataFrame) -> int:
    """Run the job that writes one file per row of ``parts`` once, and count them."""
    return cut(parts).count()
