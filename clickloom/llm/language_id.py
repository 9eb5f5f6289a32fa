"""Language: averaged hashed subword embeddings under a linear softmax.

A text's vector is the mean of the embeddings of its hashed runs of two to four
bytes; a linear softmax over it gives the languages. Embeddings and softmax are
trained together by stochastic gradient descent in numpy. As the softmax is
linear, each bucket's share in each language's logit is a fixed number, so a
text is scored by summing table rows. A temperature fitted on texts kept out of
the descent calibrates the probability, and the probability below which hardly
any such text lies is the limit of rejection.

Training reads a bounded sample: ``PER_LANGUAGE`` texts of each language,
``MOST`` in all, of each a run of up to ``SNIPPET`` characters at a place given
by the hash of the text.

Defined cases: a null text or one without a letter is ``und`` with score 0 and
rejected; a null id is not held out; null languages teach nothing; with no
language to learn from every text is ``und``. Repeated rows are predicted
alike. Further columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import held_out, map_batches
from clickloom.llm.sampling import letters, ngram_buckets, pieces, sampled_texts

PER_LANGUAGE = 1500
MOST = 12_000
SNIPPET = 800
SHORT = 60
ORDERS = (2, 3, 4)
BITS = 16
WIDTH = 16
EPOCHS = 6
RATE = 0.5
PARTS, REMAINDER = 4, 2
UNKNOWN = "und"
# Share of calibration texts that may fall below the limit of rejection.
REJECTED_SHARE = 0.0005


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    table: np.ndarray  # logit shares, a row for each bucket
    bias: np.ndarray
    temperature: float
    limit: float

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.languages or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0
        total, n = np.zeros(len(self.languages)), 0
        for found in grams(text):
            total += self.table.take(found, axis=0).sum(axis=0, dtype=np.float64)
            n += len(found)
        chance = softmax((total / max(n, 1) + self.bias) / self.temperature)
        best = int(chance.argmax())
        return self.languages[best], float(chance[best])


def softmax(logits: np.ndarray) -> np.ndarray:
    powers = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return powers / powers.sum(axis=-1, keepdims=True)


def grams(text: str) -> list[np.ndarray]:
    data = f" {text.lower()} ".encode("utf-8", "surrogatepass").replace(b"\n", b" ")
    return [ngram_buckets(piece, n, BITS) for n in ORDERS for piece in pieces(data, n - 1)]


def train(
    docs: DataFrame, per_language: int = PER_LANGUAGE, most: int = MOST
) -> LanguageModel:
    usable = docs.select("doc_id", "lang").filter(F.col("lang").isNotNull())
    sample = (
        sampled_texts(docs, usable, "lang", PARTS, REMAINDER, per_language, most)
        .filter(letters(F.col("text")))
        .select(
            "doc_id",
            "label",
            F.expr(f"substring(text, cast(pmod(xxhash64(text), {room_sql()}) as int) + 1, {SNIPPET})")
            .alias("snippet"),
        )
        .filter(letters(F.col("snippet")))
        .orderBy("doc_id", "snippet")
        .toPandas()
    )
    languages = tuple(sorted(set(sample["label"])))
    if not languages:
        return LanguageModel((), np.zeros((1 << BITS, 0), np.float32), np.zeros(0), 1.0, 1.0)
    # Short texts are learned too: the first words of every snippet are one more text.
    texts = list(sample["snippet"]) + [text[:SHORT] for text in sample["snippet"]]
    y = np.tile(sample["label"].map(languages.index).to_numpy(), 2)
    document = np.tile(sample["doc_id"].rank(method="dense").to_numpy().astype(np.int64) - 1, 2)
    found = [np.concatenate(grams(text)).astype(np.uint16) for text in texts]
    return fit(found, y, languages, document)


def room_sql() -> str:
    return f"greatest(length(text) - {SNIPPET}, 0) + 1"


def fit(
    found: list[np.ndarray], y: np.ndarray, languages: tuple[str, ...], document: np.ndarray
) -> LanguageModel:
    chance = np.random.default_rng(7)
    embedding = chance.normal(0, 0.1, (1 << BITS, WIDTH)).astype(np.float32)
    softmax_weight = np.zeros((WIDTH, len(languages)), np.float32)
    bias = np.zeros(len(languages), np.float32)
    # All texts of a document stay on one side.
    n = int(document.max()) + 1
    kept = np.isin(document, chance.permutation(n)[: n // 5])
    kept_out, order = np.flatnonzero(kept), np.flatnonzero(~kept)
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        for i in chance.permutation(order):
            buckets, counts = np.unique(found[i], return_counts=True)
            share = (counts / len(found[i])).astype(np.float32)[:, None]
            mean = (embedding[buckets] * share).sum(axis=0)
            error = softmax(mean @ softmax_weight + bias)
            error[y[i]] -= 1
            back = softmax_weight @ error
            softmax_weight -= rate * np.outer(mean, error)
            bias -= rate * 0.1 * error
            # A bucket's step is its share of the text times the number of its buckets.
            embedding[buckets] -= rate * share * len(buckets) * back / 4
    table = embedding @ softmax_weight
    held = kept_out if len(kept_out) else order
    logits = np.stack([table[found[i]].mean(axis=0) + bias for i in held])
    scales = np.geomspace(0.05, 20, 120)
    losses = [
        -np.log(softmax(logits / s)[np.arange(len(held)), y[held]] + 1e-12).mean() for s in scales
    ]
    temperature = float(scales[int(np.argmin(losses))])
    sure = softmax(logits / temperature).max(axis=1)
    limit = float(np.quantile(sure, REJECTED_SHARE))
    return LanguageModel(languages, table, bias.astype(np.float64), temperature, limit)


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, accepted) per row of ``docs``."""

    def predict(batch: pa.RecordBatch) -> dict[str, list]:
        rows = [model.predict(text) for text in batch.column("text").to_pylist()]
        return {
            "doc_id": batch.column("doc_id"),
            "lang_pred": [r[0] for r in rows],
            "score": [r[1] for r in rows],
            "accepted": [r[0] != UNKNOWN and r[1] >= model.limit for r in rows],
        }

    schema = "doc_id long, lang_pred string, score double, accepted boolean"
    return map_batches(docs.select("doc_id", "text"), predict, schema).select(
        "doc_id",
        held_out(F.col("doc_id"), PARTS, REMAINDER).alias("held_out"),
        "lang_pred",
        "score",
        "accepted",
    )


def drop_rejected(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """The rows of ``docs`` whose language is accepted, with all their columns."""

    @F.pandas_udf("boolean")
    def accepted(texts):
        rows = map(model.predict, texts)
        return type(texts)([name != UNKNOWN and score >= model.limit for name, score in rows])

    return docs.filter(accepted(F.col("text")))
