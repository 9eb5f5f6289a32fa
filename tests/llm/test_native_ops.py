"""Mixing and syncmer fingerprints against plain Python."""

import hashlib
import random
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F
from llm.helpers import awkward, docs

from clickloom.llm import mixing, syncmers


def words(text):
    return len((text or "").encode().split())


@pytest.fixture(scope="module")
def mixed(spark):
    rng = random.Random(3)
    rows = [
        (i, " ".join("x" * rng.randint(1, 9) for _ in range(rng.randint(0, 300))), "en", s)
        for i, s in enumerate(rng.choices(["a", "b", "c", None, "hot"], [1, 1, 5, 2, 20], k=900))
    ]
    return rows, mixing.mixed_sizes(docs(spark, rows), block_words=64).toPandas()


def test_mix_meets_targets(mixed):
    rows, got = mixed
    by_id = {i: (words(t), s) for i, t, _, s in rows}
    got["source"] = [by_id[i][1] or "~" for i in got["doc_id"]]
    assert got["size"].tolist() == [by_id[i][0] for i in got["doc_id"]]
    assert (got["taken"] <= 3 * got["size"]).all()
    sums = got.groupby("source").agg(
        {"taken": "sum", "size": "sum", "target": "first", "source_size": "first"}
    )
    assert (sums["size"] == sums["source_size"]).all()
    assert ((sums["taken"] - sums["target"]).abs() <= 1).all()
    assert abs(sums["target"].sum() - sums["size"].sum()) < 1e-6 * sums["size"].sum()


def test_targets_by_repeated_resharing(mixed):
    rows, got = mixed
    sizes = {}
    for _, text, _, source in rows:
        sizes[source] = sizes.get(source, 0) + words(text)
    names = sorted((s for s in sizes if s is not None)) + [None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    fixed, total = {}, sum(sizes.values())
    while True:
        free = [s for s in names if s not in fixed]
        rest = total - sum(fixed.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 3 * sizes[s]]
        if not over:
            break
        fixed |= {s: 3 * sizes[s] for s in over}
    want = fixed | share
    source = {i: s for i, _, _, s in rows}
    for doc_id, target in zip(got["doc_id"], got["target"], strict=True):
        assert target == pytest.approx(want[source[doc_id]])


def test_mix_order_spreads_sources(spark, mixed):
    rows, _ = mixed
    pieces = mixing.mix(docs(spark, rows), block_words=64).filter("slot is not null").toPandas()
    early = pieces[pieces["slot"] < pieces["slot"].max() / 4]
    share = early.groupby("skey")["n_words"].sum() / early["n_words"].sum()
    whole = pieces.groupby("skey")["n_words"].sum() / pieces["n_words"].sum()
    assert ((share - whole).abs() < 0.05).all()
    assert pieces.groupby("slot")["n_words"].sum().max() <= 64


def test_mix_reruns_agree_and_cases(spark):
    a = mixing.mixed_sizes(awkward(spark)).toPandas().sort_values(["doc_id", "size"])
    b = mixing.mixed_sizes(awkward(spark).repartition(5)).toPandas().sort_values(["doc_id", "size"])
    assert a.fillna(-1).to_numpy().tolist() == b.fillna(-1).to_numpy().tolist()
    assert len(a) == 10
    assert (a[a["size"] == 0]["taken"] == 0).all()
    assert mixing.mixed_sizes(docs(spark, [])).count() == 0
    assert mixing.mixed_sizes(docs(spark, [(1, "", "en", "a")])).first()["taken"] == 0
    copies = mixing.mixed_documents(awkward(spark))
    assert copies.columns == awkward(spark).columns
    assert mixing.mixed_documents(docs(spark, [])).count() == 0


def test_mixed_documents_come_in_the_order_of_the_slots(spark, mixed):
    rows, sizes = mixed
    got = mixing.mixed_documents(docs(spark, rows), block_words=64).collect()
    first = dict(zip(sizes["doc_id"], sizes["first_slot"], strict=True))
    seen = list(dict.fromkeys(r.doc_id for r in got))
    order = [first[i] for i in seen]
    assert order == sorted(order) and len(set(order)) > 50
    total = Counter()
    texts = {i: t for i, t, _, _ in rows}
    cuts = Counter()
    for r in got:
        total[r.doc_id] += words(r.text)
        assert texts[r.doc_id].startswith(r.text)
        if r.text != texts[r.doc_id]:
            cuts[r.source] += 1
    assert total == {i: n for i, n in zip(sizes["doc_id"], sizes["taken"], strict=True) if n}
    assert cuts and max(cuts.values()) == 1


def test_first_words_keep_white_space(spark):
    frame = spark.createDataFrame([("  a\tb \n c\u00a0d  e ",)], "t string")
    got = [frame.select(mixing.first_words(F.col("t"), F.lit(n))).first()[0] for n in (1, 2, 3, 4)]
    assert got == ["  a", "  a\tb", "  a\tb \n c\u00a0d", "  a\tb \n c\u00a0d  e"]


def signed(x):
    return x if x < 1 << 63 else x - (1 << 64)


def plain_lowest(data, k=syncmers.K, s=syncmers.S):
    h = [signed(xxhash.xxh64_intdigest(data[i : i + s], seed=42)) for i in range(len(data) - s + 1)]
    w = k - s + 1
    found = [
        data[i : i + k]
        for i in range(len(data) - k + 1)
        if min(h[i : i + w]) in (h[i], h[i + w - 1])
    ] or ([data] if data else [])
    return sorted({xxhash.xxh64_intdigest(x, seed=42) >> 16 for x in found})[: syncmers.LOWEST]


def plain_likeness(a, b):
    joint = sorted(set(a) | set(b))[: syncmers.LOWEST]
    return 1.0 if not joint else len(set(joint) & set(a) & set(b)) / len(joint)


@pytest.mark.parametrize("case", ["awkward", "one", "random"])
def test_fingerprints_equal_plain_ones(spark, case):
    rng = random.Random(5)
    if case == "awkward":
        frame = awkward(spark)
    elif case == "one":
        frame = docs(spark, [(9, "a single document of some words, long enough", "en", "a")])
    else:
        frame = docs(
            spark,
            [(i * 7, "".join(rng.choices("abcé \n", k=rng.randint(0, 400))), "en", "a") for i in range(60)],
        )
    rows = frame.select("doc_id", "text").toPandas()
    keyed = sorted(
        (float("-inf") if i != i or i is None else i, t or "") for i, t in rows.to_numpy().tolist()
    )
    got = syncmers.fingerprints(frame).toPandas().fillna({"doc_id": float("-inf")})
    want = []
    for at, (doc_id, text) in enumerate(keyed):
        after = keyed[(at + 1) % len(keyed)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        a, e, b = (plain_lowest(x.encode()) for x in (text, edited, after))
        want.append((
            doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(),
            "".join(f"{x:012x}" for x in a), "".join(f"{x:012x}" for x in e),
            plain_likeness(a, e), plain_likeness(a, b),
        ))
    assert sorted(map(tuple, got.to_numpy().tolist())) == sorted(want)


def test_fingerprints_of_nothing(spark):
    assert syncmers.fingerprints(docs(spark, [])).count() == 0


def test_mixed_documents_take_any_column_names(spark):
    frame = awkward(spark).withColumnsRenamed({"size": "mix_copies", "id": "mix_turn", "key": "mix_doc"})
    frame = frame.withColumnRenamed("label", "a.b")
    mixed = mixing.mixed_documents(frame)
    assert mixed.columns == frame.columns
    plain = sorted(str(r["doc_id"]) for r in mixing.mixed_documents(awkward(spark)).collect())
    assert sorted(str(r["doc_id"]) for r in mixed.collect()) == plain
