"""Packing and token files against the tokenizer itself."""

import itertools
import random
import zlib

import numpy as np
import pytest
from llm.helpers import awkward, docs
from tokenizers import Tokenizer

from clickloom.llm import packing, token_files
from clickloom.llm.tokenizing import Encoder, default_tokenizer
from clickloom.workspace import fresh_dir


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(default_tokenizer())


def ids_of(library, text):
    return [*library.encode(text or "", add_special_tokens=False).ids, 2]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_encoder_equals_the_library(library, monkeypatch):
    rng = random.Random(2)
    parts = [
        " ", "  ", "\n", "\n\n", "\t", "\r\n", " ", " ", "\x85", "\x1c", "a", "Word", "it's",
        "'s", "don't", "1234", "x1", "...", ",", ".", "end.", "Ünï.", "漢字", "\U0001f600", "é",
        "ſ,", "#", "<|endoftext|>", "ʼn.", "ɐ.", "Ω.", "9.", "!?",
    ]
    texts = ["", None, "plain words here.\nand a line, too", *parts]
    texts += ["".join(rng.choices(parts, k=rng.randint(1, 12))) for _ in range(3000)]
    texts += [" ".join(rng.choices(parts[10:], k=rng.randint(1, 30))) for _ in range(500)]
    coder = Encoder(default_tokenizer())
    want = [np.array(ids_of(library, t)[:-1], "<u4").tobytes() for t in texts]
    assert coder.encode(texts) == want
    monkeypatch.setattr("clickloom.llm.tokenizing.MOST_WORDS", 20)
    monkeypatch.setattr("clickloom.llm.tokenizing.GROUP_CHARS", 50)
    assert Encoder(default_tokenizer()).encode(texts) == want


def least(sizes, capacity):
    """The optimum by trying all ways."""
    best = len(sizes)

    def put(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(sizes):
            best = len(rooms)
            return
        for at in {r: at for at, r in enumerate(rooms) if r >= sizes[i]}.values():
            put(i + 1, [r - sizes[i] * (k == at) for k, r in enumerate(rooms)])
        put(i + 1, [*rooms, capacity - sizes[i]])

    put(0, [])
    return best


def test_pack_is_valid_and_near_the_optimum():
    rng = random.Random(4)
    gaps = 0
    for _ in range(60):
        sizes = sorted((rng.randint(1, 30) for _ in range(rng.randint(0, 11))), reverse=True)
        where, offset = packing.pack(np.array(sizes, np.int64), 30)
        for b in set(where.tolist()):
            inside = sorted((offset[i], sizes[i]) for i in range(len(sizes)) if where[i] == b)
            ends = list(itertools.accumulate(s for _, s in inside))
            assert [o for o, _ in inside] == [0, *ends[:-1]] and ends[-1] <= 30
        used, bound = len(set(where.tolist())), packing.least_bins(np.array(sizes, np.int64), 30)
        assert bound <= least(sizes, 30) <= used
        gaps += used - least(sizes, 30)
    assert gaps == 0


def test_bin_completion_beats_best_fit():
    sizes = np.array([18, 18, 13, 13, 13, 12, 12, 12, 9, 10], np.int64)  # 130 of 4 * 35 = 140
    greedy = len(packing.best_fit(sizes, 35))
    better = packing.complete_bins(sizes, 35, greedy - 1, 10_000)
    if better is not None:
        assert sorted(x for b in better for x in b) == sorted(sizes.tolist())
        assert all(sum(b) <= 35 for b in better)
    assert packing.complete_bins(np.array([20, 20, 20]), 35, 2, 1000) is None


def test_short_pieces_fill_bins_by_more_than_four():
    sizes = 13 * np.random.default_rng(0).integers(4, 16, 300)
    where, _ = packing.pack(sizes, 1024)
    assert np.bincount(where, sizes).max() <= 1024
    assert len(packing.best_fit(sizes, 1024)) == 39
    assert len(set(where.tolist())) == packing.least_bins(sizes, 1024) == 38


def test_fillings_are_those_of_brute_force():
    rng = random.Random(9)
    for _ in range(200):
        sizes = sorted((rng.randint(2, 12) for _ in range(rng.randint(1, 9))), reverse=True)
        gap, loss = rng.randint(1, 30), rng.randint(0, 6)
        got = list(packing.Pieces(np.array(sizes), 30).fillings(gap, loss))
        one = max((s for s in sizes if s <= gap), default=0)
        sets = {c for n in range(len(sizes) + 1) for c in itertools.combinations(sizes, n)}
        want = {c for c in sets if max(one, gap - loss - 1) < sum(c) <= gap}
        if one == gap:
            want = {(one,)}
        elif gap - one <= loss or not one:
            want |= {(one,) if one else ()}
        assert len(got) == len(set(got)) and set(got) == want
        assert [sum(c) for c in got] == sorted(map(sum, got), reverse=True)


def check_pieces(library, rows, got, length=1024):
    want = {}
    for i, text in rows:
        want.setdefault(i, []).append(ids_of(library, text))
    got["doc_id"] = got["doc_id"].astype(object).where(got["doc_id"].notna(), None)
    seen = {}
    for r in got.itertuples():
        seen.setdefault(r.doc_id, []).append((r.start, r.length, r.ids_crc32))
    for i, texts in want.items():
        pieces = []
        for ids in texts:
            cut = [0, *range(len(ids) % length or length, len(ids) + 1, length)] if len(ids) > length else [0, len(ids)]
            pieces += [(a, b - a, crc(ids[a:b])) for a, b in zip(cut, cut[1:], strict=False)]
        assert sorted(seen[i]) == sorted(pieces)
    for _, s in got.sort_values("offset").groupby("sequence_id"):
        ends = s["length"].cumsum()
        assert (s["offset"] == ends - s["length"]).all() and ends.iloc[-1] <= length


def test_packing_of_documents(spark, library):
    rng = random.Random(6)
    rows = [(i, " ".join(rng.choices(["alpha", "beta", "gamma,", "d."], k=rng.randint(0, 900))), "en", "a") for i in range(300)]
    rows.append((999, "word " * 5000, "en", "a"))
    got = packing.pack_documents(docs(spark, rows), shard_docs=64).toPandas()
    check_pieces(library, [(r[0], r[1]) for r in rows], got)
    total = got["length"].sum()
    assert got["sequence_id"].nunique() <= -(-total // 1024) + 6
    cases = [(r.doc_id, r.text) for r in awkward(spark).collect()]
    check_pieces(library, cases, packing.pack_documents(awkward(spark)).toPandas())
    assert packing.pack_documents(docs(spark, [])).count() == 0


def test_dealing_does_not_follow_a_period_of_the_rows(spark, monkeypatch):
    monkeypatch.setattr(packing, "tokenised", lambda docs, *_: docs)
    rows = spark.range(400, numPartitions=1).selectExpr(
        "id AS doc_id", "CASE WHEN id % 2 = 0 THEN 600L ELSE 424L END AS n_tokens", "array(id) AS crcs"
    )
    got = packing.pack_documents(rows, shard_docs=200)
    assert got.count() == 400 and got.select("sequence_id").distinct().count() < 240


def test_token_files_give_all_ids_back(spark, library):
    got = token_files.token_round_trip(awkward(spark)).toPandas()
    rows = sorted(
        ((r.doc_id is not None, r.doc_id or 0, r.text or "") for r in awkward(spark).collect())
    )
    got = got.sort_values("start")
    want_ids = [ids_of(library, text) for *_, text in rows]
    starts = [0, *itertools.accumulate(map(len, want_ids))][:-1]
    ids = [None if x != x else int(x) for x in got["doc_id"]]
    assert ids == [i if named else None for named, i, _ in rows]
    by_id = {(s, n): c for s, n, c in zip(got["start"], got["n_tokens"], got["ids_crc32"], strict=True)}
    assert sum(got["n_tokens"]) == sum(map(len, want_ids))
    for (_, i, _), start, one in zip(rows, starts, want_ids, strict=True):
        if i not in (1, 2):  # both are empty: their order is that of their ids
            assert by_id[start, len(one)] == crc(one)
    assert token_files.token_round_trip(docs(spark, [])).count() == 0


def test_sequences_and_masks(spark, library):
    rows = [(i, f"document {i} " * (i + 1), "en", "a") for i in range(40)]
    folder = fresh_dir(spark, "token-test")
    parts = token_files.write_tokens(docs(spark, rows), folder, sequence=16)
    flat = [x for _, text, *_ in rows for x in ids_of(library, text)]
    read, at = [], 0
    for part, n_docs, n in parts:
        file = token_files.TokenFile(folder, part)
        for number in range(-(-n // 16)):
            ids, mask = file.sequence_at(number)
            assert len(ids) == len(mask) == 16
            read += ids[mask].tolist()
        index = [r for b in file.documents() for r in b.to_pylist()]
        assert len(index) == n_docs and sum(r["n_tokens"] for r in index) == n
        last = index[-1]
        assert file.ids(last["start"], last["n_tokens"]).tolist() == flat[at + last["start"] : at + n]
        at += n
    assert read == flat


def test_encoder_hands_the_library_each_new_word_once_without_separators(monkeypatch):
    coder = Encoder(default_tokenizer())
    sent = []
    ids = coder._ids
    monkeypatch.setattr(coder, "_ids", lambda text: sent.append(text) or ids(text))
    texts = ["quivo marn, quivo\nquivo él¿a marn", "marn (quivo) éla's\nmarn.", "quivo", None, ""]
    found = coder.encode(texts)
    assert found == [np.array(ids(text or ""), "<u4").tobytes() for text in texts]
    pieces = [" quivo", " marn", " él¿a", " (quivo)", " éla's", "\nquivo", "\nmarn"]
    assert sorted("".join(sent)) == sorted("".join(pieces))
    sent.clear()
    assert coder.encode(texts) == found and sent == ["", ""]
