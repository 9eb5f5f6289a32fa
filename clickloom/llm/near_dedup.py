"""Near-duplicate groups by SetSketch registers, banded, estimated and verified.

A document is the set of its word shingles. Its sketch has one register per
position: every shingle throws a point into each of as many intervals, spaced so
that the points are exponential, and each interval's point falls on a register
of its own; a register keeps the smallest point, on a logarithmic scale.
Sketches of unions are register-wise maxima, and registers of two sets agree
with about their Jaccard similarity, so bands of registers find candidates. The
joint likelihood of larger, smaller and equal registers, with the set sizes
known, drops candidates that cannot reach the threshold; the rest are confirmed
on their full sets.

Equal sets are one node. First the members of each bucket of a few bands are
compared with one leader of the bucket, which joins most of what belongs
together. Nodes that have not enough shingles in common with other components,
and buckets of one component, are done then. What is left is clustered by common
buckets, and no pairs of all members are formed there either: each cluster has a
core, the shingles of more than half of its members, and a set is told by how it
differs from the core. Two sets differ in what only one of them differs in, so

- with few differences each they are linked whatever these are, and then both
  are linked with the member closest to the core as well: one comparison each;
- otherwise they must have some differences in common, by their numbers at least
  a known number of them, and so one among the rarest of each. Only such pairs
  of different components are made.

So no link inside a bucket is lost, no pair is dropped by a limit, and the work
on a group of near copies of one text grows with its rows, not their square, also
where hardly any two of them reach the threshold. With the defaults a link at the
threshold shares no bucket with a chance of 5e-7.

Defined cases: texts without a word, and null texts, have an empty set, are
linked with nothing and are kept. A row without an id takes no part in linking:
its component is null and it is kept. Repeated rows share a component, and each
is kept if its id is the component; rows of one id with different texts are one
node with several sets. An empty table gives an empty result.
Further columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickloom.llm.common import WORD, cut, map_batches, release
from clickloom.llm.components import components

SHINGLE_WORDS = 5
PERCENT = 80

REGISTERS = 293  # a prime, so that strides reach every register once
BAND_ROWS, BANDS = 6, 48
BASE = 1.001
RATE = 20.0
HIGHEST = 65_535
# Candidates whose best likelihood at or above the threshold falls short of the
# overall best by more than this (in nats) are dropped: odds of 6e-7 at most.
LEAST_LIKELIHOOD = 14.0
# The first round looks at these bands only: it joins most of what belongs together.
FIRST_BANDS = 12

_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, width: int = SHINGLE_WORDS) -> np.ndarray:
    """The sorted distinct 64-bit hashes of the word shingles, A-Z lower-cased."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)
    width = min(width, n)
    code = np.full(n - width + 1, width, np.uint64)
    for i in range(width):
        code = mixed(code * _STEP + hashed[i : n - width + 1 + i])
    return np.unique(code)


def sketch(elements: np.ndarray) -> np.ndarray:
    """The registers of a non-empty set of 64-bit hashes, as 16-bit values.

    The j-th point of an element is uniform in [j, j + 1) before the transform
    to exponential values, and falls on register (start + j * stride): points of
    lower intervals are smaller, so intervals are thrown until every register
    has a point.
    """
    m = REGISTERS
    lowest = np.full(m, float(m))
    spread = mixed(elements)
    start = spread % np.uint64(m)
    stride = np.uint64(1) + (spread >> np.uint64(20)) % np.uint64(m - 1)
    done = 0
    layers = math.ceil(m * (math.log(m) + 3) / len(elements))
    while True:
        todo = min(done + layers, m)
        j = np.arange(done, todo, dtype=np.uint64)[:, None]
        register = ((start + j * stride) % np.uint64(m)).astype(np.int64)
        chance = mixed(elements + (j + np.uint64(1)) * _STEP) >> np.uint64(11)
        np.minimum.at(lowest, register.ravel(), (j + chance * 2.0**-53).ravel())
        done = todo
        if done == m or lowest.max() < done:
            break
    point = -np.log1p(-np.minimum(lowest / m, 1 - 2.0**-53)) / RATE
    value = np.floor(1 - np.log(point) / math.log(BASE))
    return np.clip(value, 0, HIGHEST).astype("<u2")


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sketch of the union of two sets."""
    return np.maximum(a, b)


def band_keys(sketches: np.ndarray) -> np.ndarray:
    """One 64-bit key per sketch and band."""
    used = sketches[:, : BAND_ROWS * BANDS].reshape(len(sketches), BANDS, BAND_ROWS)
    key = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), used.shape[:2])
    for i in range(BAND_ROWS):
        key = mixed(key * _STEP + used[:, :, i].astype(np.uint64) + np.uint64(1))
    return key.view(np.int64)


def likely(
    a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, percent: int = PERCENT
) -> np.ndarray:
    """Whether the registers of the pairs leave a similarity of ``percent`` or more likely."""
    larger, smaller = (a > b).sum(1)[:, None], (a < b).sum(1)[:, None]
    equal = a.shape[1] - larger - smaller
    u = (n_a / (n_a + n_b))[:, None]
    v = 1 - u
    most = np.minimum(u / v, v / u)
    chance = lambda x: -np.log1p(-x * (BASE - 1) / BASE) / math.log(BASE)

    def fit(similarity: np.ndarray) -> np.ndarray:
        up, down = chance(u - v * similarity), chance(v - u * similarity)
        up, down = np.maximum(up, 1e-9), np.maximum(down, 1e-9)
        same = np.maximum(1 - up - down, 1e-9)
        return (larger * np.log(up) + smaller * np.log(down) + equal * np.log(same)).max(1)

    grid = np.linspace(0, 1, 101)
    threshold = percent / 100
    anywhere = fit(most * grid)
    above = fit(threshold + np.maximum(most - threshold, 0) * np.linspace(0, 1, 21))
    possible = 100 * np.minimum(n_a, n_b) >= percent * np.maximum(n_a, n_b)
    return possible & (above >= anywhere - LEAST_LIKELIHOOD)


def sketched(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, n_shingles, set_id, sketch); set_id names the set, null for an empty one."""

    def run(batch: pa.RecordBatch) -> dict[str, list]:
        sizes, names, registers = [], [], []
        for text in batch.column("text").to_pylist():
            found = shingles(text, width)
            sizes.append(len(found))
            names.append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
            registers.append(sketch(found).tobytes() if len(found) else None)
        return {"doc_id": batch.column("doc_id"), "n_shingles": sizes, "set_id": names,
                "sketch": registers}

    schema = "doc_id long, n_shingles long, set_id binary, sketch binary"
    return map_batches(docs.select("doc_id", "text"), run, schema)


def matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u2").reshape(-1, REGISTERS)


def bucket_rows(nodes: DataFrame) -> DataFrame:
    """(key, id, band, degree) of all buckets of two nodes or more.

    The degree of a node adds up the sizes of its buckets.
    """

    def run(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
        keys = band_keys(matrix(batch.column("sketch")))
        return {
            "key": keys.ravel(),
            "id": np.repeat(batch.column("id").to_numpy(), BANDS),
            "band": np.tile(np.arange(BANDS, dtype=np.int32), batch.num_rows),
        }

    rows = map_batches(nodes.select("id", "sketch"), run, "key long, id long, band int")
    crowded = rows.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    shared = cut(rows.join(crowded, "key"))
    degrees = shared.groupBy("id").agg(F.sum("n").alias("degree"))
    return shared.select("key", "id", "band").join(degrees, "id")


def full_sets(docs: DataFrame, ids: DataFrame, width: int) -> DataFrame:
    """(id, n, sketch, elements) of the given ids' texts, one row per id and text."""

    def run(batch: pa.RecordBatch) -> dict[str, list]:
        sets = [shingles(text, width) for text in batch.column("text").to_pylist()]
        return {
            "id": batch.column("id"),
            "n": list(map(len, sets)),
            "sketch": [sketch(found).tobytes() for found in sets],
            "elements": [found.view(np.int64) for found in sets],
        }

    texts = (
        docs.select(F.col("doc_id").alias("id"), "text")
        .filter(F.col("text").rlike(WORD))
        .join(ids, "id", "left_semi")
        .dropDuplicates(["id", "text"])
    )
    return map_batches(texts, run, "id long, n long, sketch binary, elements array<long>")


def both_sides(pairs: DataFrame, held: DataFrame, *names: str) -> DataFrame:
    """``pairs`` with the columns ``names`` of a and b."""
    for c in "ba":
        side = held.select(F.col("id").alias(c), *[F.col(x).alias(f"{x}_{c}") for x in names])
        pairs = pairs.join(side, c)
    return pairs


def likely_pairs(pairs: DataFrame, held: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sketches leave the link likely."""

    def run(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        keep = likely(
            *(matrix(batch.column(f"sketch_{c}")) for c in "ab"),
            *(batch.column(f"n_{c}").to_numpy() for c in "ab"),
            percent,
        )
        return {c: batch.column(c).filter(pa.array(keep)) for c in "ab"}

    return map_batches(both_sides(pairs, held, "n", "sketch"), run, "a long, b long")


def confirmed(pairs: DataFrame, held: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""

    def sets(column: pa.ListArray) -> list[np.ndarray]:
        values, at = column.values.to_numpy(), column.offsets.to_numpy()
        return [values[low:high] for low, high in zip(at, at[1:], strict=False)]

    def run(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        keep = []
        for a, b in zip(*(sets(batch.column(f"elements_{c}")) for c in "ab"), strict=True):
            both = len(np.intersect1d(a, b, assume_unique=True))
            keep.append(100 * both >= percent * (len(a) + len(b) - both))
        return {c: batch.column(c).filter(pa.array(keep, pa.bool_())) for c in "ab"}

    return map_batches(both_sides(pairs, held, "elements"), run, "a long, b long")


def able_outside(placed: DataFrame, held: DataFrame, percent: int) -> DataFrame:
    """The ids in ``placed`` (id, component) that can be linked with another component.

    At least ``percent`` of a linked node's shingles occur in the other component.
    """
    rows = held.join(placed, "id").select("id", "component", F.explode("elements").alias("e"))
    spread = (
        rows.groupBy("e")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"))
        .filter("low < high")
        .select("e")
    )
    common = rows.join(spread, "e").groupBy("id").agg(F.count("*").alias("c"))
    # An id with several texts is measured by the shortest of them.
    sizes = held.groupBy("id").agg(F.min("n").alias("n"))
    return common.join(sizes, "id").filter(100 * F.col("c") >= percent * F.col("n")).select("id")


def clustered(active: DataFrame) -> DataFrame:
    """(id, cluster) of the nodes in ``active`` (key, id): those joined by common keys."""
    first = active.groupBy("key").agg(F.min("id").alias("b"))
    links = active.join(first, "key").select(F.col("id").alias("a"), "b")
    return components(links).withColumnRenamed("component", "cluster")


def differences(members: DataFrame, percent: int) -> DataFrame:
    """``members`` (id, component, cluster, n, elements) by what sets them off their core.

    Gives (id, component, cluster, set, differs, weight). Two sets are linked if
    their weights together are at most 2 * (100 + percent) times the number of
    differences that they have in common.
    """
    sizes = members.groupBy("cluster").agg(F.count("*").alias("members"))
    counts = (
        members.select("cluster", F.explode("elements").alias("e"))
        .groupBy("cluster", "e")
        .agg(F.count("*").alias("times"))
    )
    core = (
        counts.join(sizes, "cluster")
        .filter(2 * F.col("times") > F.col("members"))
        .groupBy("cluster")
        .agg(F.collect_list("e").alias("core"))
    )
    core_or_none = F.coalesce("core", F.array().cast("array<long>"))
    differs = F.concat(
        F.array_except("elements", core_or_none), F.array_except(core_or_none, "elements")
    )
    weight = (100 + percent) * F.size("differs") - (100 - percent) * F.col("n")
    return (
        members.join(core, "cluster", "left")
        .withColumn("differs", differs)
        .select(
            "id", "component", "cluster", F.xxhash64("elements").alias("set"), "differs",
            weight.cast("long").alias("weight"),
        )
    )


def cluster_pairs(told: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of different components that the differences leave possible.

    With the pairs of each member and its cluster's closest one, they decide the
    components of every cluster.
    """
    unit = 2 * (100 + percent)
    closest = told.groupBy("cluster").agg(
        F.min(F.struct("weight", "id", "component")).alias("best")
    )
    told = told.join(closest, "cluster")
    w, best = F.col("weight"), F.col("best.weight")
    direct = told.filter((w + best <= 0) & (F.col("component") != F.col("best.component")))
    direct = direct.select(F.col("id").alias("a"), F.col("best.id").alias("b"))

    # Of a pair of different components, one at least is not linked with the closest
    # member directly: its weight is above that of all that are, taken negatively.
    partner = F.when(w + best <= 0, 1 - best).otherwise(best)
    needed = lambda sum_: F.greatest(F.ceil(sum_ / F.lit(unit)), F.lit(1))
    member = ["cluster", "id", "set"]
    tokens = told.select(
        *member, "component", "weight", F.size("differs").alias("n_differs"),
        needed(w + partner).alias("least"), F.explode("differs").alias("e"),
    )
    times = tokens.groupBy("cluster", "e").agg(F.count("*").alias("times")).filter("times > 1")
    # The place of a difference among all of its set, those of no other set first.
    order = Window.partitionBy(*member).orderBy("times", "e")
    known = tokens.join(times, ["cluster", "e"])
    alone = F.col("n_differs") - F.count("*").over(Window.partitionBy(*member))
    first = (
        known.withColumn("place", alone + F.row_number().over(order) - 1)
        .filter(F.col("place") <= F.col("n_differs") - F.col("least"))
        .drop("set", "times", "least")
    )
    a, b = first.alias("a"), first.alias("b")
    in_common = needed(F.col("a.weight") + F.col("b.weight"))
    meet = (
        (F.col("a.cluster") == F.col("b.cluster"))
        & (F.col("a.e") == F.col("b.e"))
        & (F.col("a.id") < F.col("b.id"))
        & (F.col("a.component") != F.col("b.component"))
        & (F.col("a.place") <= F.col("a.n_differs") - in_common)
        & (F.col("b.place") <= F.col("b.n_differs") - in_common)
    )
    pairs = a.join(b, meet).select(F.col("a.id").alias("a"), F.col("b.id").alias("b"))
    return (
        pairs.unionByName(direct)
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
    )


def linked_nodes(docs: DataFrame, nodes: DataFrame, width: int, percent: int) -> DataFrame:
    """(id, component) of every node that is linked with another."""
    members = cut(bucket_rows(nodes))
    held = cut(full_sets(docs, members.select("id").distinct(), width))

    def joined(pairs: DataFrame, found: DataFrame) -> DataFrame:
        links = cut(confirmed(likely_pairs(pairs, held, percent), held, percent))
        if links.isEmpty():
            return found
        # Earlier components are links between their members and their smallest id.
        earlier = found.select(F.col("id").alias("a"), F.col("component").alias("b"))
        return cut(components(links.unionByName(earlier)))

    def in_open_buckets(placed: DataFrame) -> DataFrame:
        ends = placed.groupBy("key").agg(
            F.min("component").alias("low"), F.max("component").alias("high")
        )
        return placed.join(ends.filter("low < high").select("key"), "key")

    early = members.filter(F.col("band") < FIRST_BANDS)
    leaders = early.groupBy("key").agg(F.min(F.struct(-F.col("degree"), "id")).alias("leader"))
    found = joined(
        early.join(leaders.select("key", F.col("leader.id").alias("leader")), "key")
        .filter("id <> leader")
        .select(F.least("leader", "id").alias("a"), F.greatest("leader", "id").alias("b"))
        .distinct(),
        docs.sparkSession.createDataFrame([], "id long, component long"),
    )
    release(docs.sparkSession)
    placed = members.join(found, "id", "left").select(
        "key", "id", F.coalesce("component", "id").alias("component")
    )
    active = cut(in_open_buckets(placed))
    able = able_outside(active.select("id", "component").distinct(), held, percent)
    active = cut(in_open_buckets(active.join(able, "id", "left_semi")))
    if active.isEmpty():
        return found
    nodes_left = active.select("id", "component").distinct().join(clustered(active), "id")
    told = cut(differences(held.join(nodes_left, "id"), percent))
    release(docs.sparkSession)
    return joined(cut(cluster_pairs(told, percent)), found)


def near_duplicates(
    docs: DataFrame, width: int = SHINGLE_WORDS, percent: int = PERCENT
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per row of ``docs``."""
    rows = cut(sketched(docs, width))
    nodes = cut(
        rows.filter("set_id is not null and doc_id is not null")
        .groupBy("set_id")
        .agg(F.min("doc_id").alias("id"), F.first("n_shingles").alias("n"),
             F.first("sketch").alias("sketch"), F.count("*").alias("copies"))
    )
    found = linked_nodes(docs, nodes.select("id", "n", "sketch"), width, percent)
    groups = (
        nodes.select("set_id", "id", "copies")
        .join(found, "id", "left")
        .filter("copies > 1 or component is not null")
        .select("set_id", F.coalesce("component", "id").alias("component"))
    )
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return (
        rows.select("doc_id", "n_shingles", "set_id")
        .join(groups, "set_id", "left")
        .select(
            "doc_id",
            "n_shingles",
            component.alias("component_id"),
            F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
        )
    )


def drop_near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one row of each group, all its columns kept; rows without id stay."""
    kept = near_duplicates(docs, **options).filter("kept").select(F.col("doc_id").alias("kept_id"))
    names = docs.columns
    chosen = docs.join(kept.distinct(), docs["doc_id"] == kept["kept_id"], "left_semi")
    nameless = docs.filter(docs["doc_id"].isNull())
    return chosen.dropDuplicates(["doc_id"]).select(*names).unionByName(nameless)
