"""Trained operators: held-out accuracy, what they learn from, and awkward input."""

import os
import random

import numpy as np
import pyarrow as pa
import pytest
from llm.helpers import awkward, docs
from pyspark.sql import functions as F

from clickloom.llm import language_id, line_rules, quality_model, sampling, toxicity
from clickloom.llm.common import held_out

DATA = "/root/testdata/sf0.01"
needs_data = pytest.mark.skipif(not os.path.isdir(DATA), reason="test tables are not here")
LABELS = "doc_id long, quality int, toxic int, text string"


def table(spark, name):
    return spark.read.parquet(f"{DATA}/{name}.parquet")


def auc(label, score):
    order = score.rank()
    ones, zeros = (label == 1).sum(), (label == 0).sum()
    return (order[label == 1].sum() - ones * (ones + 1) / 2) / (ones * zeros)


@needs_data
def test_toxicity_on_held_out_rows(spark):
    docs_, labels = table(spark, "documents"), table(spark, "labels")
    got = toxicity.score_toxicity(docs_, toxicity.train(docs_, labels))
    rows = got.join(labels, "doc_id").filter("held_out").toPandas()
    assert auc(rows["toxic"], rows["score"]) > 0.85
    assert got.count() == docs_.count()
    assert got.filter("predicted <> cast(score >= 0.3 as int) or score < 0 or score > 1").count() == 0


@needs_data
def test_quality_on_held_out_rows(spark):
    docs_, labels = table(spark, "documents"), table(spark, "labels")
    got = quality_model.score_quality(docs_, quality_model.train(docs_, labels))
    rows = got.join(labels, "doc_id").filter("held_out").toPandas()
    assert auc(rows["quality"], rows["score"]) > 0.95
    assert (rows["predicted"] == rows["quality"]).mean() > 0.95


@needs_data
def test_language_on_held_out_rows(spark):
    docs_ = table(spark, "documents")
    model = language_id.train(docs_)
    rows = language_id.identify(docs_, model).join(docs_.select("doc_id", "lang"), "doc_id").toPandas()
    held = rows[rows["held_out"]]
    assert (held["lang"] == held["lang_pred"]).mean() > 0.97
    assert held["accepted"].mean() > 0.99
    assert language_id.drop_rejected(docs_, model).count() == rows["accepted"].sum()


@needs_data
def test_a_language_never_learned_is_mostly_rejected(spark):
    docs_ = table(spark, "documents")
    left_out = docs_.agg(F.max("lang")).first()[0]
    model = language_id.train(docs_.filter(F.col("lang") != left_out))
    rows = language_id.identify(docs_, model).join(docs_.select("doc_id", "lang"), "doc_id").toPandas()
    unknown = rows["lang"] == left_out
    assert rows[unknown]["accepted"].mean() < 0.5
    assert rows[~unknown & rows["held_out"]]["accepted"].mean() > 0.99


def toy(spark, n=120):
    rng = random.Random(1)
    rows = [
        (i, " ".join(rng.choices(["good", "kind", "plain", "words"], k=30)) + (" vilestuff" if i % 3 == 0 else ""),
         "en" if i % 2 else "xx", "a")
        for i in range(n)
    ]
    labels = spark.createDataFrame([(i, int(i % 4 > 0), int(i % 3 == 0), "x") for i in range(n)], LABELS)
    return docs(spark, rows), labels


def test_held_out_labels_teach_nothing(spark):
    frame, labels = toy(spark)
    flipped = labels.withColumn(
        "toxic",
        F.when(held_out(F.col("doc_id"), toxicity.PARTS, toxicity.REMAINDER), 1 - F.col("toxic"))
        .otherwise(F.col("toxic")),
    )
    a, b = toxicity.train(frame, labels), toxicity.train(frame, flipped)
    assert (a.weight == b.weight).all() and a.bias == b.bias
    scores = toxicity.score_toxicity(frame, a).toPandas()
    toxic = scores["doc_id"] % 3 == 0
    assert scores[toxic]["predicted"].mean() == 1 and scores[~toxic]["predicted"].mean() == 0
    assert toxicity.drop_toxic(frame, a).count() == (~toxic).sum()


def test_rare_toxic_phrases_beside_many_frequent_ones(spark):
    rng = random.Random(3)
    phrases = ["".join(rng.choices("bcdfghjklmnpqrstvwxz", k=40)) for _ in range(80)]
    plain = [" ".join(rng.choices(["good", "kind", "plain", "words"], k=12)) for _ in range(4000)]
    toxic = [p for i, p in enumerate(phrases) for _ in range(14 if i < 60 else 8)]
    texts = [f"{p} {rest}" for p, rest in zip(toxic, plain, strict=False)] + plain[len(toxic):]
    frame = docs(spark, [(i, text, "en", "a") for i, text in enumerate(texts)])
    labels = spark.createDataFrame([(i, 0, int(i < len(toxic)), "x") for i in range(len(texts))], LABELS)
    got = toxicity.score_toxicity(frame, toxicity.train(frame, labels)).toPandas()
    held = got[got["held_out"]]
    assert held[held["doc_id"].between(60 * 14, len(toxic) - 1)]["predicted"].mean() > 0.9
    assert held[held["doc_id"] >= len(toxic)]["predicted"].mean() < 0.02


def test_models_without_labels(spark):
    frame, labels = toy(spark, 20)
    assert toxicity.train(frame, labels.limit(0)) is None
    assert toxicity.train(frame, labels.withColumn("toxic", F.lit(0))) is None
    assert toxicity.score_toxicity(frame, None).filter("score = 0 and predicted = 0").count() == 20
    assert quality_model.train(frame, labels.limit(0)) == 0.0
    assert quality_model.train(frame, labels.withColumn("quality", F.lit(1))) == 1.0
    assert quality_model.score_quality(frame, 1.0).filter("predicted = 1").count() == 20
    nothing = language_id.train(frame.withColumn("lang", F.lit(None).cast("string")))
    assert language_id.identify(frame, nothing).filter("lang_pred = 'und' and score = 0").count() == 20
    odd = labels.limit(5).withColumn("toxic", F.lit(7)).unionByName(labels.withColumn("doc_id", F.lit(None).cast("long")))
    assert toxicity.train(frame, odd) is None


def test_awkward_documents_are_scored(spark):
    frame, labels = toy(spark)
    full = frame.unionByName(awkward(spark))
    tox = toxicity.score_toxicity(awkward(spark), toxicity.train(full, labels)).toPandas()
    good = quality_model.score_quality(awkward(spark), quality_model.train(full, labels)).toPandas()
    for got in (tox, good):
        assert len(got) == 10 and got["score"].between(0, 1).all() and got["held_out"].notna().all()
    model = language_id.train(full)
    lang = language_id.identify(awkward(spark), model).toPandas()
    und = lang[lang["doc_id"].isin([1, 2, 3])]
    assert (und["lang_pred"] == "und").all() and not und["accepted"].any()
    rest = lang[~lang["doc_id"].isin([1, 2, 3])]
    assert rest["lang_pred"].isin(model.languages).all()
    for empty in (
        toxicity.score_toxicity(docs(spark, []), None), quality_model.score_quality(docs(spark, []), 0.0),
        language_id.identify(docs(spark, []), model), line_rules.clean_lines(docs(spark, [])),
    ):
        assert empty.count() == 0


def test_samples_are_bounded_and_repeatable(spark):
    frame, _ = toy(spark, 400)
    a = sampling.sample_by_class(frame, "lang", 50, 80).collect()
    b = sampling.sample_by_class(frame.repartition(7), "lang", 50, 80).collect()
    assert sorted(a) == sorted(b) and len(a) == 80
    assert {r.label: r.n for r in a} == {"en": 200, "xx": 200}


def test_boosting_learns_a_rule_and_walks_its_trees():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(2000, 5))
    y = ((x[:, 1] > 0.3) ^ (x[:, 3] > 0)).astype(float)
    model = quality_model.boost(x, y, np.ones(2000))
    assert ((model.score(x) > 0.5) == y).mean() > 0.97

    def walk(row):
        total = model.bias
        for f, t, leaf in zip(model.feature, model.threshold, model.leaf, strict=True):
            node = 0
            for _ in range(quality_model.DEPTH):
                node = 2 * node + (2 if row[f[node]] > t[node] else 1)
            total += leaf[node - (2**quality_model.DEPTH - 1)]
        return 1 / (1 + np.exp(-total))

    assert np.allclose([walk(r) for r in x[:50]], model.score(x[:50]))


def test_pieces_of_long_texts_have_all_ngrams(monkeypatch):
    data = bytes(random.Random(2).choices(range(97, 105), k=1000))
    whole = sampling.ngram_buckets(np.frombuffer(data, np.uint8), 4, 16)
    monkeypatch.setattr(sampling, "PIECE_BYTES", 64)
    parts = [sampling.ngram_buckets(p, 4, 16) for p in sampling.pieces(data, 3)]
    assert (np.concatenate(parts) == whole).all()


def test_line_rules_by_hand(spark):
    nav = "Home | News | Sport | Contact | About"
    text = "\n".join([
        "This is a sentence of a text that is here to be read by somebody, and it goes on.",
        nav, nav, "NO!! STOP!! NOW!! WHY!!", "All rights reserved. Someone, somewhere.", "",
        "Another sentence follows that one, with quite some words in it to reach the least length.",
        "And a third one, that says nothing new, but says it with words that are not said before.",
    ])
    got = line_rules.clean_lines(docs(spark, [(1, text, "en", "a"), (2, text, "en", "a")])).collect()
    assert len(got) == 2
    row = got[0]
    assert (row.n_dup_lines, row.n_words, row.kept) == (1, len(text.split()), True)
    assert row.n_symbols == 8 and "Home" not in row.clean_text and "STOP" not in row.clean_text
    assert row.clean_text.count("\n") == 3
    assert row.n_repeat_words == 2 * len(nav.split())
    bad = line_rules.clean_lines(docs(spark, [(1, "\n".join([nav] * 3 + ["x y | " * 30]), "en", "a")])).first()
    assert not bad.kept


def test_line_rules_of_awkward_documents(spark):
    got = line_rules.clean_lines(awkward(spark)).toPandas().set_index("doc_id")
    for i in (1, 2, 3):
        assert got.loc[i, ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]].sum() == 0
        assert got.loc[i, "base_failed"] and not got.loc[i, "kept"]
    assert got.loc[5, "n_repeat_words"] == 11 and got.loc[5, "n_dup_lines"] == 1
    assert line_rules.repeated_words(b"a b c a b c d".split()) == 6
    assert line_rules.repeated_words(b"a a a a".split()) == 4


def test_fit_against_a_dense_regression():
    """The toxicity fit on features in Arrow buffers, against the same steps on a dense matrix."""
    rng = np.random.default_rng(7)
    x = rng.random((90, 40)) < 0.2
    y = rng.integers(0, 2, 90)
    order = np.argsort(y, kind="stable")
    x, y = x[order], y[order]
    found = [np.flatnonzero(row).astype("<u2").tobytes() for row in x]
    table = pa.table({"label": pa.array(y, pa.int32()), "found": pa.array(found, pa.binary())})
    ratio, share = rng.standard_normal(40), {0: 0.8, 1: 1.3}
    weight, bias = toxicity.fit(table.slice(3), ratio, share, rounds=60, together=16)
    a, label = x[3:] * ratio, y[3:]
    theta, first, second = np.zeros(41), np.zeros(41), np.zeros(41)
    for step in range(1, 61):
        error = 1 / (1 + np.exp(-(a @ theta[:-1] + theta[-1]))) - label
        error *= np.where(label == 1, share[1], share[0]) / len(label)
        slope = np.append(a.T @ error + 1e-4 * theta[:-1], error.sum())
        first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope**2
        theta -= 0.05 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-9)
    assert np.abs(weight - theta[:-1] * ratio).max() < 1e-9 and abs(bias - theta[-1]) < 1e-9


def test_a_text_needs_a_letter(spark):
    model = language_id.LanguageModel(("en",), np.zeros((1 << language_id.BITS, 1), np.float32), np.zeros(1), 1.0, 0.0)
    for text in ("½ ²", "①", "12 _", "", None, "́"):
        assert model.predict(text)[0] == "und"
    assert model.predict("½ a")[0] == "en" and model.predict("漢")[0] == "en"


def grow(x, slope, bend, rows, edges, depth):
    """A tree by trying every edge of every column on the rows themselves: (column, edge, sides) or a value."""
    if not depth:
        g, h = sum(slope[i] for i in rows), sum(bend[i] for i in rows)
        return -quality_model.RATE * g / (h + quality_model.PENALTY)
    worth = lambda side: (
        sum(slope[i] for i in side) ** 2 / (sum(bend[i] for i in side) + quality_model.PENALTY)
    )
    best, split = 1e-6, (0, np.inf)
    for f, column in enumerate(edges):
        for edge in column:
            low = [i for i in rows if x[i][f] <= edge]
            high = [i for i in rows if x[i][f] > edge]
            if min(sum(bend[i] for i in side) for side in (low, high)) < quality_model.LEAST_WEIGHT:
                continue
            gain = worth(low) + worth(high) - worth(rows)
            if gain > best:
                best, split = gain, (f, edge)
    f, edge = split
    low = [i for i in rows if x[i][f] <= edge]
    high = [i for i in rows if x[i][f] > edge]
    return f, edge, *(grow(x, slope, bend, side, edges, depth - 1) for side in (low, high))


def walk(tree, row):
    while isinstance(tree, tuple):
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree


def test_boosting_against_trees_grown_row_by_row(monkeypatch):
    monkeypatch.setattr(quality_model, "TREES", 4)
    monkeypatch.setattr(quality_model, "DEPTH", 2)
    monkeypatch.setattr(quality_model, "BINS", 12)
    monkeypatch.setattr(quality_model, "LEAST_WEIGHT", 1.0)
    chance = np.random.default_rng(4)
    x = chance.normal(size=(120, 3))
    y = (x[:, 0] + x[:, 1] * x[:, 2] + chance.normal(0, 0.3, 120) > 0).astype(float)
    share = chance.uniform(0.5, 1.5, 120)
    model = quality_model.boost(x, y, share)
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, 12)[1:-1])) for c in x.T]
    z = np.full(120, np.log((share * y).sum() / (share * (1 - y)).sum()))
    for _ in range(4):
        p = 1 / (1 + np.exp(-z))
        tree = grow(x, share * (p - y), share * p * (1 - p), list(range(120)), edges, 2)
        z += [walk(tree, row) for row in x]
    assert np.allclose(model.score(x), 1 / (1 + np.exp(-z)), atol=1e-9)


def plain_bucket(run, bits):
    """The bucket of a run of bytes, in Python's integers."""
    code = run[0]
    for b in run[1:]:
        code = code * 0x01000193 % 2**32 ^ b
    code ^= code >> 15
    code = code * 0x2C1B3C6D % 2**32 ^ len(run) * 0x9E3779B1 % 2**32
    return code * 0x297A2D39 % 2**32 >> 32 - bits


def test_language_against_a_plain_forward_pass(monkeypatch):
    monkeypatch.setattr(sampling, "PIECE_BYTES", 50)
    rng = np.random.default_rng(2)
    bits = language_id.BITS
    table = rng.normal(size=(1 << bits, 3))
    model = language_id.LanguageModel(("a", "b", "c"), table, rng.normal(size=3), 0.7, 0.0)
    for text in ("a", "Hello World", "äß ½\nzwei", "längerer Text mit vielen Wörtern " * 9):
        data = f" {text.lower()} ".encode().replace(b"\n", b" ")
        found = [plain_bucket(data[i : i + n], bits) for n in (2, 3, 4) for i in range(len(data) - n + 1)]
        logits = [(sum(table[b][k] for b in found) / len(found) + model.bias[k]) / 0.7 for k in range(3)]
        total = sum(np.exp(v) for v in logits)
        name, score = model.predict(text)
        assert name == "abc"[int(np.argmax(logits))]
        assert score == pytest.approx(np.exp(max(logits)) / total, rel=1e-9)
