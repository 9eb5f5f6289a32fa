"""Bounded training samples and n-gram hashing shared by the trained operators."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.llm.common import cut, held_out

# A text is hashed in pieces of this many bytes, so memory does not grow with it.
PIECE_BYTES = 1 << 20


def sample_by_class(rows: DataFrame, label: str, per_class: int, most: int) -> DataFrame:
    """At most ``per_class`` ids of each label and ``most`` in all, (doc_id, label, n).

    The order is a hash of the id, so reruns take the same rows. n is how often
    the label occurs among all of ``rows``. Null ids and labels take no part; of
    an id with several labels the largest counts; of more than ``most`` labels
    the most frequent take part, which bounds the list that is broadcast.
    """
    labelled = (
        rows.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
        .groupBy("doc_id")
        .agg(F.max(label).alias("label"))
    )
    counts = F.broadcast(
        labelled.groupBy("label").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "label").limit(most)
    )
    # Hashes low enough for some twice as many rows as are wanted go to the ranking.
    span = 1 << 40
    low = F.pmod(F.xxhash64("doc_id"), F.lit(span)) < F.lit(2.0 * per_class * span) / F.col("n")
    order = Window.partitionBy("label").orderBy(
        F.pmod(F.xxhash64("doc_id"), F.lit(span)), "doc_id"
    )
    return (
        labelled.join(counts, "label")
        .filter(F.expr("n <= 1000") | low)
        .withColumn("nth", F.row_number().over(order))
        .filter(F.col("nth") <= per_class)
        .orderBy("nth", "label")
        .limit(most)
        .select("doc_id", "label", "n")
    )


def sampled_texts(
    docs: DataFrame, rows: DataFrame, label: str, parts: int, remainder: int,
    per_class: int, most: int,
) -> DataFrame:
    """(doc_id, text, label, n) of a bounded sample, without the held-out ids.

    The ids are bounded by ``most``, which makes broadcasting them safe.
    """
    usable = rows.filter(~held_out(F.col("doc_id"), parts, remainder))
    ids = F.broadcast(sample_by_class(usable, label, per_class, most))
    return cut(
        docs.select("doc_id", "text").filter(F.col("text").isNotNull()).join(ids, "doc_id")
    )


def letters(text: Column) -> Column:
    return text.rlike(r"\p{L}")


def pieces(data: bytes, overlap: int) -> list[np.ndarray]:
    """The bytes in pieces; each starts ``overlap`` bytes before the last one's end."""
    if len(data) <= PIECE_BYTES:
        return [np.frombuffer(data, np.uint8)]
    return [
        np.frombuffer(data[max(0, at - overlap) : at + PIECE_BYTES], np.uint8)
        for at in range(0, len(data), PIECE_BYTES)
    ]


def ngram_buckets(piece: np.ndarray, n: int, bits: int) -> np.ndarray:
    """Hashed bucket of each run of ``n`` bytes."""
    if len(piece) < n:
        return np.empty(0, np.int64)
    wide = piece.astype(np.uint32)
    end = len(piece) - n + 1
    code = wide[:end].copy()
    for i in range(1, n):
        code *= np.uint32(0x01000193)
        code ^= wide[i : end + i]
    code ^= code >> np.uint32(15)
    code *= np.uint32(0x2C1B3C6D)
    code ^= np.uint32(n * 0x9E3779B1 & 0xFFFFFFFF)
    code *= np.uint32(0x297A2D39)
    return (code >> np.uint32(32 - bits)).astype(np.int64)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))
