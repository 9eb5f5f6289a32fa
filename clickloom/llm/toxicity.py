"""Toxicity: a linear classifier on character n-grams scaled by log-count ratios.

Features are the hashed runs of four to six bytes of the lower-cased text,
present or not. Each is scaled by its naive Bayes log-count ratio between the
toxic and the other training texts; a logistic regression on the scaled
features gives the score.

Training reads a bounded sample: ``PER_CLASS`` labelled texts of each class.
Counting and feature extraction run in tasks; the driver gets the counts of the
chosen buckets and the features of the sample. The hash buckets in at least
``MIN_TEXTS`` of these texts are features: the strongest ``FEATURES_PER_TEXT``
per text, from ``LEAST_FEATURES`` to ``MOST_FEATURES``. Others score nothing.

Defined cases: null and empty texts score as texts without a feature; null ids
are scored and not held out; labels other than 0 and 1 and null labels teach
nothing; without a label of either class every score is 0. Repeated rows score
alike. Further columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import held_out, map_batches
from clickloom.llm.sampling import ngram_buckets, pieces, sampled_texts, sigmoid

PER_CLASS = 4000
ORDERS = (4, 5, 6)
BITS = 20
LEAST_FEATURES, FEATURES_PER_TEXT = 8192, 8
MOST_FEATURES = 1 << 16  # as many as 16-bit numbers hold
MIN_TEXTS = 4
THRESHOLD = 0.3
PARTS, REMAINDER = 4, 2


@dataclass(frozen=True)
class ToxicityModel:
    """``feature`` maps a hash bucket to its feature or -1; ``weight`` has one per feature."""

    feature: np.ndarray
    weight: np.ndarray
    bias: float

    def score(self, text: str | None) -> float:
        return float(sigmoid(np.array(self.weight[present(text, self.feature)].sum() + self.bias)))


def normal(text: str | None) -> bytes:
    return f" {(text or '').lower()} ".encode("utf-8", "surrogatepass").replace(b"\n", b" ")


def buckets(text: str | None) -> np.ndarray:
    """The distinct hash buckets of a text."""
    found = [
        ngram_buckets(piece, n, BITS) for n in ORDERS for piece in pieces(normal(text), n - 1)
    ]
    return np.unique(np.concatenate(found))


def present(text: str | None, feature: np.ndarray) -> np.ndarray:
    """The distinct features of a text."""
    found = []
    for n in ORDERS:
        for piece in pieces(normal(text), n - 1):
            hits = feature[ngram_buckets(piece, n, BITS)]
            found.append(hits[hits >= 0])
    return np.unique(np.concatenate(found))


def bucket_counts(sample: DataFrame) -> DataFrame:
    """(bucket, toxic, other): training texts of each class with the bucket."""

    def count(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
        totals = np.zeros((2, 1 << BITS), np.int64)
        labels, texts = batch.column("label").to_pylist(), batch.column("text").to_pylist()
        for label, text in zip(labels, texts, strict=True):
            totals[label, buckets(text)] += 1
        seen = np.flatnonzero(totals.any(axis=0))
        return {"bucket": seen, "toxic": totals[1, seen], "other": totals[0, seen]}

    return (
        map_batches(sample.select("text", "label"), count, "bucket long, toxic long, other long")
        .groupBy("bucket")
        .agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
    )


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> ToxicityModel | None:
    sample = sampled_texts(
        docs, labels.filter(F.col("toxic").isin(0, 1)), "toxic", PARTS, REMAINDER,
        per_class, 2 * per_class,
    )
    sizes = {r["label"]: (r["texts"], r["n"]) for r in sample.groupBy("label").agg(
        F.count("*").alias("texts"), F.first("n").alias("n")).collect()}
    if len(sizes) < 2:
        return None
    (others, all_others), (toxics, all_toxics) = sizes[0], sizes[1]
    most = min(max(LEAST_FEATURES, FEATURES_PER_TEXT * (others + toxics)), MOST_FEATURES)
    p, q = (F.col("toxic") + 1) / F.lit(toxics + 2), (F.col("other") + 1) / F.lit(others + 2)
    strength = F.abs(F.log(p / q)) / F.sqrt(1 / (F.col("toxic") + 1) + 1 / (F.col("other") + 1))
    chosen = (
        bucket_counts(sample)
        .filter(F.col("toxic") + F.col("other") >= MIN_TEXTS)
        .select("bucket", F.log(p / q).alias("ratio"), strength.alias("strength"))
        .orderBy(F.desc("strength"), "bucket")
        .limit(most)
        .toPandas()
    )
    feature = np.full(1 << BITS, -1, np.int32)
    feature[chosen["bucket"].to_numpy(np.int64)] = np.arange(len(chosen), dtype=np.int32)

    def extract(batch: pa.RecordBatch) -> dict[str, list]:
        found = [present(text, feature) for text in batch.column("text").to_pylist()]
        return {"label": batch.column("label"), "found": [x.astype("<u2").tobytes() for x in found]}

    # In an order of their own, so that sums, and so the model, are the same in every run.
    table = (
        map_batches(sample.select("text", "label"), extract, "label int, found binary")
        .orderBy("label", F.xxhash64("found"), "found")
        .toArrow()
    )
    share = {0: all_others / others, 1: all_toxics / toxics}
    mean = (others * share[0] + toxics * share[1]) / (others + toxics)
    weight, bias = fit(table, chosen["ratio"].to_numpy(), {y: s / mean for y, s in share.items()})
    return ToxicityModel(feature, weight.astype(np.float32), bias)


def fit(
    table: pa.Table, ratio: np.ndarray, share: dict[int, float],
    rounds: int = 150, rate: float = 0.05, penalty: float = 1e-4, together: int = 256,
) -> tuple[np.ndarray, float]:
    """Logistic regression on the present features times ``ratio``, by Adam over all rows.

    ``table`` has a label and the features, as 16-bit numbers, per row. They are
    read where Arrow holds them, ``together`` rows at a time: there is one copy.
    """
    parts = []
    for batch in table.to_batches(max_chunksize=together):
        _, ends, data = batch.column("found").buffers()
        at = batch.column("found").offset
        ends = np.frombuffer(ends, np.int32)[at : at + batch.num_rows + 1]
        columns = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]].view("<u2")
        label = batch.column("label").to_numpy().astype(np.float64)
        weights = np.where(label == 1, share[1], share[0]) / table.num_rows
        parts.append((np.diff(ends) // 2, columns, label, weights))
    theta = np.zeros(len(ratio) + 1)
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, rounds + 1):
        slope = np.append(penalty * theta[:-1], 0.0)
        scaled = ratio * theta[:-1]
        for lengths, columns, label, weight in parts:
            rows = np.repeat(np.arange(len(label)), lengths)
            z = np.bincount(rows, scaled[columns], len(label)) + theta[-1]
            error = (sigmoid(z) - label) * weight
            slope[:-1] += ratio * np.bincount(columns, error[rows], len(ratio))
            slope[-1] += error.sum()
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope**2
        theta -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-9)
    return theta[:-1] * ratio, float(theta[-1])


def score_toxicity(docs: DataFrame, model: ToxicityModel | None) -> DataFrame:
    """(doc_id, held_out, score, predicted) per row of ``docs``."""

    def score(batch: pa.RecordBatch) -> dict[str, list]:
        texts = batch.column("text").to_pylist()
        return {
            "doc_id": batch.column("doc_id"),
            "score": [model.score(text) if model else 0.0 for text in texts],
        }

    return map_batches(docs.select("doc_id", "text"), score, "doc_id long, score double").select(
        "doc_id",
        held_out(F.col("doc_id"), PARTS, REMAINDER).alias("held_out"),
        "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"),
    )


def drop_toxic(docs: DataFrame, model: ToxicityModel | None) -> DataFrame:
    """The rows of ``docs`` that score below the threshold, with all their columns."""
    @F.pandas_udf("double")
    def score(texts):
        return texts.map(lambda text: model.score(text) if model else 0.0).astype("float64")

    return docs.filter(score(F.col("text")) < THRESHOLD)
