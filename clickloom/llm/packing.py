"""Pack tokenised documents into few sequences of fixed length by bin completion.

Documents longer than a sequence are cut so that all pieces but the first are
full. Full pieces are sequences; what is left and the short documents are dealt
to shards of bounded size, and each shard is packed by itself: best-fit
decreasing gives the first solution, then bins are completed around the largest
remaining piece with fillings of any number of pieces, least waste first, and a
branch is left as soon as its waste rules out a better solution. The search for
one sequence less ends after ``NODES_PER_PIECE`` steps per piece. Documents go to
shards by a hash of their row number, so that every shard has about the sizes of
the whole table, whatever the order of the rows.

Defined cases: a null or empty text is the end id alone; null ids and repeated
rows are documents of their own; an empty table gives an empty result; further
columns are not read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import cut, map_batches
from clickloom.llm.tokenizing import END_ID, default_tokenizer, encoder

LENGTH = 1024
SHARD_DOCS = 8192
NODES_PER_PIECE = 4
QUICK_TRIES = 64  # steps before an exact filling is read off the totals instead

SCHEMA = (
    "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, "
    "offset long"
)


def best_fit(sizes: np.ndarray, capacity: int) -> list[list[int]]:
    """Best-fit decreasing; bins as lists of sizes."""
    bins: list[list[int]] = []
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r: some bin has room r
    for size in sorted(sizes.tolist(), reverse=True):
        fitting = rooms >> size
        if fitting:
            room = (fitting & -fitting).bit_length() - 1 + size
            at = open_bins[room].pop()
            if not open_bins[room]:
                rooms &= ~(1 << room)
        else:
            room, at = capacity, len(bins)
            bins.append([])
        bins[at].append(size)
        if room > size:
            open_bins[room - size].append(at)
            rooms |= 1 << (room - size)
    return bins


class Pieces:
    """How many pieces of each size are left."""

    def __init__(self, sizes: np.ndarray, capacity: int) -> None:
        self.count = np.bincount(sizes, minlength=capacity + 1).tolist()
        self.left = len(sizes)
        self.capacity = capacity
        self.sizes = sum(1 << s for s, n in enumerate(self.count) if n)
        self.mirror = sum(1 << (capacity - s) for s, n in enumerate(self.count) if n)

    def largest(self, most: int) -> int:
        """The largest size left up to ``most``; 0 if none."""
        if most <= 0:
            return 0
        return max((self.sizes & ((1 << (most + 1)) - 1)).bit_length() - 1, 0)

    def least(self) -> int:
        return (self.sizes & -self.sizes).bit_length() - 1

    def take(self, size: int) -> None:
        self.count[size] -= 1
        self.left -= 1
        if not self.count[size]:
            self.sizes ^= 1 << size
            self.mirror ^= 1 << (self.capacity - size)

    def give(self, size: int) -> None:
        if not self.count[size]:
            self.sizes ^= 1 << size
            self.mirror ^= 1 << (self.capacity - size)
        self.count[size] += 1
        self.left += 1

    def pair(self, gap: int, most: int) -> tuple[int, int] | None:
        """Two pieces up to ``most`` that fill ``gap``, the first as large as can be."""
        both = self.sizes & (self.mirror >> (self.capacity - gap)) & ((1 << (most + 1)) - 1)
        if not gap % 2 and self.count[gap // 2] < 2:
            both &= ~(1 << (gap // 2))
        a = both.bit_length() - 1
        return (a, gap - a) if 2 * a >= gap > a > 0 else None

    def exact(self, gap: int, most: int, tries: list[int]) -> tuple[int, ...] | None:
        """Pieces up to ``most`` that fill ``gap``, of many the large ones; None if not soon met."""
        if gap <= most and self.count[gap]:
            return (gap,)
        found = self.pair(gap, most)
        a = self.largest(min(gap - 2 * self.least(), most))
        while found is None and a and tries[0] > 0:
            tries[0] -= 1
            self.take(a)
            rest = self.exact(gap - a, a, tries)
            self.give(a)
            found = (a, *rest) if rest else None
            a = self.largest(a - 1)
        return found

    def fillings(self, gap: int, loss: int) -> Iterator[tuple[int, ...]]:
        """Fillings of ``gap`` by any number of pieces that leave at most ``loss``, best first.

        The largest single piece dominates all smaller ones and every set that
        fits into its place, so sets must fill more than it does. The first
        filling is mostly found by trying; bit sets of the totals that the sizes
        make then give all others, without ways that lead nowhere.
        """
        one = self.largest(gap)
        if one in (0, gap):
            yield (one,) if one else ()
            return
        together = gap - self.least()  # the largest size that fits with another piece
        quick = self.exact(gap, gap, [QUICK_TRIES])
        if quick:
            yield quick
        everything = (1 << (gap + 1)) - 1
        sizes, most, made = [], [], [1]
        bits = self.sizes & ((1 << (together + 1)) - 1)
        while bits:
            low = bits & -bits
            bits ^= low
            size, now = low.bit_length() - 1, made[-1]
            left = min(self.count[size], gap // size)
            sizes.append(size)
            most.append(left)
            some = 1
            while left:
                some = min(some, left)
                now |= (now << (size * some)) & everything
                left -= some
                some *= 2
            made.append(now)

        def ways(total: int, at: int) -> Iterator[tuple[int, ...]]:
            if not total:
                yield ()
                return
            while made[at] >> total & 1:
                at -= 1
                size = sizes[at]
                for n in range(min(most[at], total // size), 0, -1):
                    if made[at] >> (total - n * size) & 1:
                        for rest in ways(total - n * size, at):
                            yield (size,) * n + rest

        for total in range(gap, max(one, gap - loss - 1), -1):
            if made[-1] >> total & 1:
                for filling in ways(total, len(sizes)):
                    if filling != quick:
                        yield filling
        if gap - one <= loss:
            yield (one,)


def complete_bins(
    sizes: np.ndarray, capacity: int, target: int, nodes: int
) -> list[list[int]] | None:
    """A packing into ``target`` bins by depth-first bin completion, or None if none was met."""
    spare = target * capacity - int(sizes.sum())
    if spare < 0:
        return None
    left = Pieces(sizes, capacity)
    bins: list[list[int]] = []
    choices: list[Iterator[tuple[int, ...]]] = []
    waste = [0]
    forward = True
    while True:
        if forward:
            if not left.left:
                return bins
            if len(bins) == target:
                forward = False
                continue
            first = left.largest(capacity)
            left.take(first)
            bins.append([first])
            choices.append(left.fillings(capacity - first, spare - waste[-1]))
            waste.append(waste[-1])
        elif not bins:
            return None
        for size in bins[-1][1:]:
            left.give(size)
        del bins[-1][1:]
        nodes -= 1
        filling = next(choices[-1], None) if nodes > 0 else None
        if nodes <= 0:
            return None
        loss = capacity - bins[-1][0] - sum(filling or ())
        if filling is None or waste[-2] + loss > spare:
            left.give(bins.pop()[0])
            choices.pop()
            waste.pop()
            forward = False
            continue
        for size in filling:
            left.take(size)
        bins[-1] += filling
        waste[-1] = waste[-2] + loss
        forward = True


def least_bins(sizes: np.ndarray, capacity: int) -> int:
    """A lower bound: pieces over half a bin stand apart, and small ones fill what they leave."""
    big = np.sort(sizes[2 * sizes > capacity])
    small = np.sort(sizes[2 * sizes <= capacity])
    bound = 0
    for least in range(capacity // 2 + 1):
        at = int(np.searchsorted(big, capacity - least, "right"))
        room = at * capacity - int(big[:at].sum())
        filling = int(small[np.searchsorted(small, least) :].sum())
        bound = max(bound, len(big) + max(0, math.ceil((filling - room) / capacity)))
    return bound


def pack(sizes: np.ndarray, capacity: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each piece."""
    if not len(sizes):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    best = best_fit(sizes, capacity)
    bound = least_bins(sizes, capacity)
    while len(best) > bound:
        better = complete_bins(sizes, capacity, len(best) - 1, NODES_PER_PIECE * len(sizes))
        if better is None:
            break
        best = better
    flat = [(size, at, sum(row[:i])) for at, row in enumerate(best) for i, size in enumerate(row)]
    placed = np.array(sorted(flat, key=lambda x: x[0]), np.int64)
    order = np.argsort(sizes, kind="stable")
    where, offset = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
    where[order], offset[order] = placed[:, 1], placed[:, 2]
    return where, offset


def tokenised(docs: DataFrame, tokenizer: str, length: int) -> DataFrame:
    """(doc_id, n_tokens, crcs): the size of each document and the crc32 of each piece."""
    end = np.array([END_ID], "<u4").tobytes()

    def measure(batch: pa.RecordBatch) -> dict[str, list]:
        n_tokens, crcs = [], []
        for ids in encoder(tokenizer).encode(batch.column("text").to_pylist()):
            data = memoryview(ids + end)
            n = len(data) // 4
            first = n % length or length
            edges = [0, *range(4 * first, len(data) + 1, 4 * length)]
            if n <= length:
                edges = [0, len(data)]
            crcs.append([zlib.crc32(data[a:b]) for a, b in zip(edges, edges[1:], strict=False)])
            n_tokens.append(n)
        return {"doc_id": batch.column("doc_id"), "n_tokens": n_tokens, "crcs": crcs}

    schema = "doc_id long, n_tokens long, crcs array<long>"
    return map_batches(docs.select("doc_id", "text"), measure, schema)


def pack_shard(shard: int, rows: pd.DataFrame, length: int) -> pd.DataFrame:
    """The pieces of the documents of one shard with their places."""
    rows = rows.sort_values(["n_tokens", "doc_id"], kind="stable")
    n_tokens = rows["n_tokens"].to_numpy(np.int64)
    n_pieces = rows["crcs"].map(len).to_numpy(np.int64)
    first = n_tokens - (n_pieces - 1) * length
    part = first < length
    bins, places = pack(first[part], length)
    document = np.repeat(np.arange(len(rows)), n_pieces)
    piece = np.arange(len(document)) - np.repeat(n_pieces.cumsum() - n_pieces, n_pieces)
    sequence = np.zeros(len(document), np.int64)
    offset = np.zeros(len(document), np.int64)
    partial = (piece == 0) & part[document]
    sequence[partial], offset[partial] = bins, places
    full = int(bins.max(initial=-1)) + 1
    sequence[~partial] = full + np.arange(len(document) - partial.sum())
    return pd.DataFrame(
        {
            "doc_id": rows["doc_id"].array.take(document),
            "piece": piece.astype(np.int32),
            "start": np.where(piece == 0, 0, first[document] + (piece - 1) * length),
            "length": np.where(piece == 0, first[document], length),
            "ids_crc32": np.concatenate([np.asarray(c, np.int64) for c in rows["crcs"]]),
            "sequence_id": (shard << 32) + sequence,
            "offset": offset,
        }
    )


def pack_documents(
    docs: DataFrame, tokenizer: str | None = None, length: int = LENGTH,
    shard_docs: int = SHARD_DOCS,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Tokenising is written out once; only sizes and checksums are dealt to the
    shards, by a hash of the row number: no key can crowd a shard, whose size
    stays near ``shard_docs``, and no period in the sizes can sort it.
    """
    sizes = cut(tokenised(docs, tokenizer or default_tokenizer(), length))
    shards = max(1, round(sizes.count() / shard_docs))
    dealt = sizes.withColumn("shard", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(shards)))

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        return pack_shard(int(key[0]), rows, length)

    return dealt.groupBy("shard").applyInPandas(run, SCHEMA)
