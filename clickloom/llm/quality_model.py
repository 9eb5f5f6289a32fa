"""Quality: histogram gradient-boosted trees over statistics of a document.

The statistics are counts and shares of words, characters, lines and repeats.
Trees of fixed depth are grown on binned statistics and flattened into arrays,
child 2i+1 or 2i+2, so that a whole batch walks down all trees in numpy.

Training reads a bounded sample: the statistics of ``PER_CLASS`` labelled texts
of each class, made in tasks.

Defined cases: null and empty texts have all statistics 0 and are scored as
such; null ids are scored and not held out; labels other than 0 and 1 and null
labels teach nothing; with labels of one class only every score is that class.
Repeated rows score alike. Further columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import held_out, map_batches
from clickloom.llm.sampling import sampled_texts, sigmoid

PER_CLASS = 4000
THRESHOLD = 0.3
PARTS, REMAINDER = 5, 0
TREES, DEPTH, BINS = 60, 4, 64
RATE, PENALTY, LEAST_WEIGHT = 0.2, 1.0, 1.0

_UPPER_WORD = re.compile(r"\b[^\W\d_]*[A-ZÀ-ÖØ-Þ]{2,}\b")
_CLASSES = np.zeros((6, 256), bool)
for _row, _chars in enumerate(
    (b"#*$%&|<>", b"!?", b".,;:", b"0123456789", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b" \t\n\x0b\x0c\r")
):
    _CLASSES[_row, np.frombuffer(_chars, np.uint8)] = True
N_STATISTICS = 22


def statistics(text: str | None) -> list[float]:
    text = text or ""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    if not words:
        return [0.0] * N_STATISTICS
    n, size = len(words), len(data)
    shares = _CLASSES @ np.bincount(np.frombuffer(data, np.uint8), minlength=256) / size
    counts = Counter(words)
    known = {word: i for i, word in enumerate(counts)}
    ids = np.fromiter(map(known.__getitem__, words), np.int64, n)
    pairs = len(np.unique(ids[:-1] * len(known) + ids[1:])) if n > 1 else 1
    lines = [line for line in text.split("\n") if line.strip()]
    line_words = [line.count(" ") + 1 for line in lines]
    ended = sum(line.rstrip()[-1] in ".!?" for line in lines)
    return [
        np.log1p(n),
        np.log1p(len(lines)),
        sum(map(len, words)) / n,
        *shares.tolist(),
        len(counts) / n,
        np.log1p(n) * len(counts) / n,
        counts.most_common(1)[0][1] / n,
        pairs / max(n - 1, 1),
        float((ids[1:] == ids[:-1]).mean()) if n > 1 else 0.0,
        len(set(lines)) / max(len(lines), 1),
        sum(line_words) / max(len(lines), 1),
        max(line_words, default=0),
        min(line_words, default=0),
        ended / max(len(lines), 1),
        len(_UPPER_WORD.findall(text)) / n,
        text.count(" | ") / n,
        (size - len(text)) / size,
    ]


@dataclass(frozen=True)
class QualityModel:
    """Complete trees in arrays: row = tree, column = node; leaves hold the values."""

    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray
    bias: float

    def score(self, rows: np.ndarray) -> np.ndarray:
        total = np.full(len(rows), self.bias)
        every = np.arange(len(rows))
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf, strict=True):
            node = np.zeros(len(rows), np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (rows[every, feature[node]] > threshold[node])
            total += leaf[node - (2**DEPTH - 1)]
        return sigmoid(total)


def boost(x: np.ndarray, y: np.ndarray, share: np.ndarray) -> QualityModel:
    """Trees on the binned columns of ``x`` that follow the slope of the logistic loss."""
    edges = [np.unique(np.quantile(column, np.linspace(0, 1, BINS)[1:-1])) for column in x.T]
    binned = np.stack([np.searchsorted(e, c, "left") for e, c in zip(edges, x.T, strict=True)], 1)
    inner = 2**DEPTH - 1
    bias = float(np.log((share * y).sum() / (share * (1 - y)).sum()))
    z = np.full(len(y), bias)
    features = np.zeros((TREES, inner), np.int64)
    thresholds = np.full((TREES, inner), np.inf)
    leaves = np.zeros((TREES, inner + 1))
    for tree in range(TREES):
        chance = sigmoid(z)
        slope, bend = share * (chance - y), share * chance * (1 - chance)
        node = np.zeros(len(y), np.int64)
        for level in range(DEPTH):
            first, width = 2**level - 1, 2**level
            best = np.full(width, 1e-6)
            for f, edge in enumerate(edges):
                if not len(edge):
                    continue
                cell = (node - first) * BINS + binned[:, f]
                shape = (width, BINS)
                g = np.bincount(cell, slope, width * BINS).reshape(shape).cumsum(1)
                h = np.bincount(cell, bend, width * BINS).reshape(shape).cumsum(1)
                g_all, h_all = g[:, -1:], h[:, -1:]
                gain = (
                    g**2 / (h + PENALTY)
                    + (g_all - g) ** 2 / (h_all - h + PENALTY)
                    - g_all**2 / (h_all + PENALTY)
                )
                gain[(h < LEAST_WEIGHT) | (h_all - h < LEAST_WEIGHT)] = -1
                gain = gain[:, : len(edge)]
                at = gain.argmax(1)
                value = gain[np.arange(width), at]
                better = value > best
                best[better] = value[better]
                features[tree, first : first + width][better] = f
                thresholds[tree, first : first + width][better] = edge[at[better]]
            rows = np.arange(len(y))
            node = 2 * node + 1 + (x[rows, features[tree, node]] > thresholds[tree, node])
        end = node - inner
        g, h = np.bincount(end, slope, inner + 1), np.bincount(end, bend, inner + 1)
        leaves[tree] = -RATE * g / (h + PENALTY)
        z += leaves[tree][end]
    return QualityModel(features, thresholds, leaves, bias)


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> QualityModel | float:
    """The model, or the only class that is labelled (0 without any label)."""
    sample = sampled_texts(
        docs, labels.filter(F.col("quality").isin(0, 1)), "quality", PARTS, REMAINDER,
        per_class, 2 * per_class,
    )

    def extract(batch: pa.RecordBatch) -> dict[str, list]:
        rows = [statistics(text) for text in batch.column("text").to_pylist()]
        return {"label": batch.column("label"), "n": batch.column("n"), "x": rows}

    table = map_batches(
        sample.select("text", "label", "n"), extract, "label int, n long, x array<double>"
    ).toPandas()
    y = table["label"].to_numpy(np.float64)
    if len(set(y)) < 2:
        return float(y[0]) if len(y) else 0.0
    x = np.stack(table["x"].to_numpy())
    order = np.lexsort((*x.T, y))
    x, y, n = x[order], y[order], table["n"].to_numpy(np.float64)[order]
    share = n / np.where(y == 1, (y == 1).sum(), (y == 0).sum())
    return boost(x, y, share / share.mean())


def score_quality(docs: DataFrame, model: QualityModel | float) -> DataFrame:
    """(doc_id, held_out, score, predicted) per row of ``docs``."""

    def score(batch: pa.RecordBatch) -> dict[str, object]:
        rows = [statistics(text) for text in batch.column("text").to_pylist()]
        x = np.array(rows, np.float64).reshape(len(rows), N_STATISTICS)
        scores = np.full(len(x), model) if isinstance(model, float) else model.score(x)
        return {"doc_id": batch.column("doc_id"), "score": scores}

    return map_batches(docs.select("doc_id", "text"), score, "doc_id long, score double").select(
        "doc_id",
        held_out(F.col("doc_id"), PARTS, REMAINDER).alias("held_out"),
        "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"),
    )
