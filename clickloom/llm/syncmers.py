"""Document fingerprints from closed syncmers. DataFrame operations only.

A run of K bytes of a text is an anchor if, of the hashes of its runs of S
bytes, the least is the first or the last. Whether it is depends on the run
alone, not on what stands around it, so texts that share a passage share its
anchors, and the anchors of a spliced text are those of its parts besides the
few runs across the joint. A fingerprint is the list of the lowest anchor
hashes, ``LOWEST`` of them whatever the length; likeness estimates from two
fingerprints what share of all anchors of two texts they have in common.

Left out: positional matching. Fingerprints hold no positions, so the order of
shared anchors is not seen, and a passage that is a small share of two long
texts mostly leaves no trace in their likeness.

Defined cases: a null text is empty; an empty text has an empty fingerprint and
is like an empty text only; a text too short for an anchor, or without one, has
the hash of the whole text as its only one. Null ids come first in the order of
documents, rows of one id lie in the order of their texts; a single row is its
own next document; an empty table gives an empty result. Further columns are not
read. Memory is some hundred bytes per byte of the longest text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

K, S = 20, 14
LOWEST = 64
CHUNKS_PER_PARTITION = 8
MOST_CHUNKS = 4096

FIRST_ID = -(1 << 63)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), body)[0]


def run_at(data: Column, position: Column, size: int) -> Column:
    """The ``size`` bytes of ``data`` from ``position`` (from 1) on."""
    return F.substring(data, position, F.lit(size))


def anchor_places(data: Column, k: int = K, s: int = S) -> Column:
    """Places, from 1 on, of the closed syncmers of a binary column, ascending.

    The bytes are bound once: a column named inside a lambda is copied whole for
    every place. Single look-ups do for the runs, as slicing copies arrays too.
    """
    n = F.octet_length(data)

    def run_hashes(d: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), n - s + 1), lambda i: F.xxhash64(run_at(d, i, s)))

    def closed(h: Column) -> Column:
        def is_closed(i: Column) -> Column:
            inner = [F.get(h, i + (shift - 1)) for shift in range(k - s + 1)]
            return F.least(*inner).isin(inner[0], inner[-1])

        return F.filter(F.sequence(F.lit(1), n - k + 1), is_closed)

    found = let(let(data, run_hashes), closed)
    return F.when(n >= k, found).otherwise(F.expr("array()").cast("array<int>"))


def hashes_at(data: Column, places: Column, k: int = K) -> Column:
    return let(data, lambda d: F.transform(places, lambda i: F.xxhash64(run_at(d, i, k))))


def lowest_hashes(hashes: Column, data: Column) -> Column:
    """The lowest distinct hashes (48 bits); of a text without anchors that of the whole."""
    own = (
        F.when(F.size(hashes) > 0, hashes)
        .when(F.octet_length(data) > 0, F.array(F.xxhash64(data)))
        .otherwise(F.expr("array()").cast("array<bigint>"))
    )
    short = F.transform(own, lambda x: F.shiftrightunsigned(x, 16))
    return F.slice(F.sort_array(F.array_distinct(short)), 1, LOWEST)


def printed(hashes: Column) -> Column:
    """A fingerprint: the hashes as hexadecimal numbers of twelve digits in a row."""
    return F.array_join(F.transform(hashes, lambda x: F.lpad(F.lower(F.hex(x)), 12, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Estimated shared part of the anchors behind two lists of lowest hashes, 0 to 1."""
    joint = F.slice(F.sort_array(F.array_union(a, b)), 1, LOWEST)
    both = F.size(F.array_intersect(joint, F.array_intersect(a, b)))
    return F.when(F.size(joint) == 0, F.lit(1.0)).otherwise(both / F.size(joint))


def with_next(docs: DataFrame) -> tuple[DataFrame, Window]:
    """(doc_id, text, extra) in chunks of neighbouring ids, and the window over a chunk.

    The bounds are quantiles of the ids, a bounded list. Each bound is an id of
    the table: its rows go to the chunk before too (``extra``), and those of the
    least id to the last chunk, so a chunk holds what follows its last row.
    """
    key = F.coalesce(F.col("doc_id"), F.lit(FIRST_ID))
    width = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = min(width * CHUNKS_PER_PARTITION, MOST_CHUNKS)
    found = docs.select(key.alias("k")).agg(
        F.min("k"), F.percentile_approx("k", [i / parts for i in range(1, parts)], 20 * parts)
    )
    least, others = found.first()
    bounds = sorted({FIRST_ID if least is None else least, *(others or [])})
    listed = F.lit(bounds)
    chunk = F.size(F.filter(listed, lambda b: b <= F.col("k")))
    before = F.when(F.col("own") == 1, F.lit(len(bounds))).otherwise(F.col("own") - 1)
    home = F.struct(F.col("own").alias("chunk"), F.lit(0).alias("extra"))
    places = F.when(F.get(listed, F.col("own") - 1) != F.col("k"), F.array(home)).otherwise(
        F.array(home, F.struct(before.alias("chunk"), F.lit(1).alias("extra")))
    )
    rows = (
        docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), key.alias("k"))
        .withColumn("own", chunk)
        .select("doc_id", "text", "k", F.inline(places))
    )
    return rows, Window.partitionBy("chunk").orderBy("extra", "k", "text")


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprint of every text and of its spliced form, with their likenesses.

    The spliced form ends in as many code points of the next document (or all
    it has) as half the text, rounded down, in place of its own. Texts are
    shuffled once. The spliced form takes over the anchors of the text's head,
    and adds those of the tail and those across the joint.
    """
    rows, order = with_next(docs)
    half = F.floor(F.char_length("text") / 2).cast("int")
    data, head, tail = (F.col(c).cast("binary") for c in ("text", "head", "tail"))
    joint = F.concat(
        F.substring(head, F.greatest(F.octet_length(head) - (K - 2), F.lit(1)), F.lit(K - 1)),
        F.substring(tail, F.lit(1), F.lit(K - 1)),
    )
    in_head = F.size(F.filter("places", lambda i: i + (K - 1) <= F.octet_length("head")))
    spliced = F.concat(
        F.slice("hashes", F.lit(1), in_head),
        hashes_at(joint, F.col("across")),
        hashes_at(tail, F.col("in_tail")),
    )
    found = (
        rows.withColumn("next_text", F.lead("text").over(order))
        .withColumn("head", F.left("text", F.char_length("text") - half))
        .withColumn("tail", F.left(F.coalesce("next_text", F.lit("")), half))
        .withColumn("places", anchor_places(data))
        .withColumn("hashes", hashes_at(data, F.col("places")))
        .withColumn("across", anchor_places(joint))
        .withColumn("in_tail", anchor_places(tail))
        .withColumn("edited", F.concat("head", "tail"))
        .select(
            "doc_id",
            "k",
            "chunk",
            "extra",
            F.char_length("text").cast("long").alias("n_chars"),
            F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
            lowest_hashes(F.col("hashes"), data).alias("lowest"),
            lowest_hashes(spliced, F.col("edited").cast("binary")).alias("edited_lowest"),
            F.col("text"),
        )
    )
    return (
        found.withColumn("next_lowest", F.lead("lowest").over(order))
        .filter("extra = 0")
        .select(
            "doc_id",
            "n_chars",
            "edited_sha256",
            printed(F.col("lowest")).alias("fingerprint"),
            printed(F.col("edited_lowest")).alias("edited_fingerprint"),
            likeness(F.col("lowest"), F.col("edited_lowest")).alias("near_edited"),
            likeness(F.col("lowest"), F.col("next_lowest")).alias("near_next"),
        )
    )
