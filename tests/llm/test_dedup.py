"""SetSketch near-duplicates against all pairs compared in Python."""

import random

import numpy as np
import pytest
from llm.helpers import awkward, docs

from clickloom.llm import near_dedup
from clickloom.llm.components import components


def plain(rows, width, percent=80):
    """{doc_id: (set size, component)} by comparing every pair."""
    sets = {}
    for doc_id, text, *_ in rows:
        words = (text or "").encode().lower().split()
        n = min(width, len(words))
        sets[doc_id] = {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if words else set()
    of = {i: i for i in sets}

    def root(i):
        while of[i] != i:
            i = of[i]
        return i

    ids = sorted(sets)
    for at, a in enumerate(ids):
        for b in ids[at + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                low, high = sorted((root(a), root(b)))
                of[high] = low
    return {i: (len(sets[i]), root(i)) for i in ids}


def found(frame, **options):
    rows = near_dedup.near_duplicates(frame, **options).collect()
    return {r.doc_id: (r.n_shingles, r.component_id) for r in rows}, rows


@pytest.mark.parametrize("width", [4, 5])
def test_equals_all_pairs(spark, width):
    rng = random.Random(width)
    rows, words = [], [f"w{i}" for i in range(400)]
    for _ in range(12):
        base = rng.choices(words, k=rng.randint(3, 150))
        for _ in range(rng.randint(1, 12)):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 25))):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            rows.append((1000 - len(rows) * 3, " ".join(copy), "en", "a"))
    got, out = found(docs(spark, rows), width=width)
    assert got == plain(rows, width)
    assert all(r.kept == (r.doc_id == r.component_id) for r in out)


def test_chains_and_a_large_group_of_near_copies(spark):
    rng = random.Random(1)
    words = [f"v{i}" for i in range(300)]
    base = rng.choices(words, k=120)
    rows = []
    for i in range(250):  # copies that differ from each other more than from the base
        copy = list(base)
        for at in rng.sample(range(120), rng.randint(0, 4)):
            copy[at] = f"own{i}x{at}"
        rows.append((i, " ".join(copy), "en", "a"))
    chain = rng.choices(words, k=100)
    for i in range(30):  # each like its neighbours only
        rows.append((500 + i, " ".join(chain), "en", "a"))
        chain = chain[3:] + [f"new{i}{j}" for j in range(3)]
    got, _ = found(docs(spark, rows), width=4)
    assert got == plain(rows, 4)


@pytest.mark.parametrize("edits", [(0, 5), (2, 5), (4, 12)])
def test_near_copies_about_the_threshold(spark, edits):
    """Groups of one or two bases in which few, some or most pairs are linked."""
    rng = random.Random(edits[1])
    words = [f"v{i}" for i in range(50)]
    base = rng.choices(words, k=100)
    other = base[:70] + rng.choices(words, k=30)
    rows = []
    for i in range(300):
        copy = list(rng.choice([base, base, other]))
        for at in rng.sample(range(100), rng.randint(*edits)):
            copy[at] = rng.choice([f"own{i}x{at}", rng.choice(words)])
        rows.append((i, " ".join(copy), "en", "a"))
    rows += [(300 + i, rows[i * 7][1] + " one more", "en", "a") for i in range(20)]
    rows += [(i, " ".join(rng.choices(words, k=60)), "en", "b") for i in range(5)]  # second texts
    got, _ = found(docs(spark, rows[:320]), width=4)
    assert got == plain(rows[:320], 4)
    assert near_dedup.near_duplicates(docs(spark, rows), width=4).count() == 325


def test_no_pairs_of_near_copies_that_share_nothing_else(spark):
    """500 copies, each with edits of its own, no two of which are linked: hardly a pair is made."""
    base = [f"b{i}" for i in range(150)]
    rng = random.Random(3)
    rows = []
    for i in range(500):
        copy = list(base)
        for at in rng.sample(range(150), 5):
            copy[at] = f"own{i}x{at}"
        rows.append((i, near_dedup.shingles(" ".join(copy), 4).view(np.int64).tolist()))
    members = spark.createDataFrame(
        [(i, i, 0, len(e), e) for i, e in rows],
        "id long, component long, cluster long, n long, elements array<long>",
    )
    told = near_dedup.differences(members, 80)
    pairs = {(r.a, r.b) for r in near_dedup.cluster_pairs(told, 80).collect()}
    sets = [set(e) for _, e in rows]
    linked = [
        (a, b)
        for a in range(500)
        for b in range(a)
        if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    ]
    assert len(pairs) < 2500
    # Every link is a pair, or both sides are pairs of their cluster's closest member.
    closest = told.orderBy("weight", "id").first()["id"]
    near = {a if b == closest else b for a, b in pairs if closest in (a, b)} | {closest}
    assert all((b, a) in pairs or {a, b} <= near for a, b in linked)


def test_cases(spark):
    got = near_dedup.near_duplicates(awkward(spark), width=4).toPandas()
    assert len(got) == 10
    by_id = got.dropna(subset=["doc_id"]).drop_duplicates().set_index("doc_id")
    assert by_id.loc[[1, 2, 3], "n_shingles"].tolist() == [0, 0, 0]
    assert by_id.loc[[1, 2, 3], "component_id"].tolist() == [1, 2, 3]
    assert by_id.loc[6, "component_id"] == 5 and not by_id.loc[6, "kept"]
    nameless = got[got["doc_id"].isna()].iloc[0]
    assert nameless["kept"] and np.isnan(nameless["component_id"])
    assert near_dedup.near_duplicates(docs(spark, [])).count() == 0
    left = near_dedup.drop_near_duplicates(awkward(spark), width=4)
    assert left.columns == awkward(spark).columns
    assert sorted(r.doc_id or 0 for r in left.collect()) == [0, 1, 2, 3, 4, 5, 7, 8]


def test_sketches_merge_and_estimate():
    rng = np.random.default_rng(0)
    values = rng.integers(0, 1 << 63, 3000, dtype=np.uint64)
    a, b = values[:2000], values[500:2500]  # similarity 0.6
    union = near_dedup.merge(near_dedup.sketch(a), near_dedup.sketch(b))
    assert (union == near_dedup.sketch(np.unique(np.concatenate([a, b])))).all()
    equal = (near_dedup.sketch(a) == near_dedup.sketch(b)).mean()
    assert abs(equal - 0.6) < 0.12
    for n in (1, 2, 10, 300, 5000):
        near_dedup.sketch(rng.integers(0, 1 << 63, n, dtype=np.uint64))

    def judged(part):
        other = np.concatenate([a[: int(len(a) * part)], rng.integers(0, 1 << 63, 2, dtype=np.uint64)])
        return bool(near_dedup.likely(
            near_dedup.sketch(a)[None], near_dedup.sketch(other)[None],
            np.array([len(a)]), np.array([len(other)]),
        )[0])

    assert judged(0.81) and judged(0.95)
    assert not judged(0.5)


def test_components_of_paths_rings_and_loops(spark):
    path = [(i, i + 1) for i in range(40)]
    ring = [(100 + i, 100 + (i + 1) % 7) for i in range(7)]
    links = spark.createDataFrame([*path, *ring, (200, 200), (41, 3), (3, 41)], "a long, b long")
    got = {r.id: r.component for r in components(links).collect()}
    assert got == {**{i: 0 for i in range(42)}, **{100 + i: 100 for i in range(7)}}
    assert components(links.limit(0)).count() == 0
