"""Collocations against counts word by word, also with fingerprints that clash."""

import random
import re
from collections import Counter

import __spark_entry__ as contract
import numpy as np
import pytest
from llm.helpers import awkward, docs
from oracle import compare, duck

from clickloom.llm import collocations as col

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, least, top):
    """The contract word by word: rows of (lang, rank, phrase, a, l, r, n, score)."""
    f, n = Counter(), Counter()
    for _, text, lang, _ in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, 6):
                for at in range(len(words) - size + 1):
                    f[lang, tuple(words[at : at + size])] += 1
    found = {key: a for key, a in f.items() if a >= least and len(key[1]) > 1}
    out = []
    for lang in n:
        ranked = []
        for (of, phrase), a in found.items():
            if of != lang:
                continue
            inside = any(
                other == lang and len(longer) > len(phrase) and 100 * b >= 100 * a
                and any(longer[i : i + len(phrase)] == phrase for i in range(len(longer)))
                for (other, longer), b in found.items()
            )
            if inside:
                continue
            cuts = [
                (1000 * a * n[lang] // (f[lang, phrase[:k]] * f[lang, phrase[k:]]), k)
                for k in range(1, len(phrase))
            ]
            score, k = min(cuts)
            ranked.append((-score, -a, " ".join(phrase).encode(), f[lang, phrase[:k]], f[lang, phrase[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(ranked)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n[lang], -score))
    return sorted(out)


def texts(seed=2, count=120):
    rng = random.Random(seed)
    vocabulary = ["the", "The", "red", "fox", "ÜBER", "über", "ab", "ba", "a", "fox-trot", " ", "漢"]
    marks = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r\n", " : "]
    made = []
    for i in range(count):
        parts = []
        for _ in range(rng.randint(0, 60)):
            parts += [rng.choice(vocabulary), rng.choice(marks)]
            if rng.random() < 0.1:
                parts.append("once upon a red time ")
        made.append((i % 90, "".join(parts), rng.choice(["en", "en", "en", "de", None, "und"]), "a"))
    return made


def got(frame, **options):
    return sorted(map(tuple, col.collocations(frame, **options).collect()))


@pytest.mark.parametrize("bits", [64, 9, 3])
def test_against_counts(spark, bits):
    rows = texts()
    frame = docs(spark, rows).repartition(5)
    assert got(frame, least=6, top=25, bits=bits) == plain(rows, 6, 25)


def test_batches_and_long_texts(spark, monkeypatch):
    monkeypatch.setattr(col, "BATCH_BYTES", 300)
    monkeypatch.setattr(col, "PART_BYTES", 50)
    long = "so it goes on and on. " * 3000 + "w" * 50_000 + " end of it " * 200
    rows = [*texts(5, 40), (7, long, "fr", "a"), (8, "so it goes on", "fr", None)]
    assert got(docs(spark, rows), least=20) == plain(rows, 20, 2000)


def test_spans_are_substring_hashes():
    words = col.Words([b"a bc a bc", b"x a bc. a  bc"], ["en", "en"])
    fits, fingerprint, check = words.runs(2)
    same = [0, 2, 5, 7]
    assert fits.tolist() == [True, True, True, False, True, True, False, True]
    assert len(set(fingerprint[same].tolist())) == len(set(check[same].tolist())) == 1
    assert len(set(fingerprint[fits].tolist())) == 3
    assert (np.array([words.phrase(i, 2) for i in same]) == "a bc").all()


def test_products_beyond_64_bits(spark):
    rows = [("en", "", 0, 9_000_000_000_000), ("en", "a", 1, 5_000_000_000),
            ("en", "b", 1, 5_000_000_003), ("en", "a b", 2, 4_999_999_999)]
    frame = spark.createDataFrame(rows, "lang string, phrase string, n_words int, n long")
    score = col.scored(frame).first()["score"]
    assert score == 1000 * 4_999_999_999 * 9_000_000_000_000 // (5_000_000_000 * 5_000_000_003)


def test_awkward_rows(spark):
    frame = awkward(spark)
    rows = [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in frame.collect()]
    assert got(frame, least=2) == plain(rows, 2, 2000)
    assert got(frame.limit(0)) == []
    assert got(docs(spark, [(1, None, None, None), (2, " \n.", "en", "a")]), least=1) == []


def test_query_equals_sql(spark, sf_dir):
    name = "op13_collocations"
    frame = contract.queries()[name](spark, sf_dir)
    assert compare(frame, duck(sf_dir), contract.oracle_sql()[name]) is None
