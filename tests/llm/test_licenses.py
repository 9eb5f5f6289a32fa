"""License scans against plain searches, and expressions against their truth table."""

import itertools
import random
import re

import pytest
from llm.helpers import awkward, docs

from clickloom.llm import licenses

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(text):
    """n_words, n_base, first, last and base labels by a search word by word."""
    words = WORDS.findall((text or "").translate(LOWER))
    found = [
        (at, label)
        for phrase, label in licenses.BASE_PHRASES.items()
        for at in range(len(words))
        if words[at : at + len(phrase.split())] == phrase.split()
    ]
    starts = [at for at, _ in found]
    labels = ",".join(sorted({label for _, label in found}))
    return len(words), len(found), min(starts, default=None), max(starts, default=None), labels


def rows_of(frame):
    return {r["doc_id"]: r.asDict() for r in license_rows(frame)}


def license_rows(frame):
    return licenses.license_scan(frame).collect()


def test_base_places_against_plain_search(spark):
    rng = random.Random(5)
    parts = [*licenses.BASE_PHRASES, *list(licenses.NOTICES)[:9], "Under the MIT", "license", "CC-BY",
             "nc", "é", "MIT_License", "\x00", "under\nthe  mit", "VERSION 2.0"]
    texts = [
        "".join(
            rng.choice([str.upper, str.title, str])(rng.choice(parts)) + rng.choice([" ", ". ", "\n", "-", ""])
            for _ in range(rng.randint(0, 40))
        )
        for _ in range(300)
    ]
    texts.append("under the mit license " * 4000 + "x" * 200_000 + " cc by nc")
    got = rows_of(docs(spark, [(i, t, "en", "a") for i, t in enumerate(texts)]))
    for i, text in enumerate(texts):
        row = got[i]
        base = tuple(row[c] for c in ("n_words", "n_base", "first_word", "last_word", "base_labels"))
        assert base == plain(text), text[:200]
        assert set(filter(None, row["base_labels"].split(","))) <= set(row["labels"].split(","))
        assert 0 <= row["score"] <= 1 and (row["score"] > 0) == (row["labels"] != "")


def test_longest_notice_counts():
    scanned = licenses.scan(b"under the GNU General Public License, version 3; CC BY-NC-SA")
    assert scanned["labels"] == "cc-by-nc,cc-by-nc-sa,gpl-3"
    assert scanned["base_labels"] == "cc-by-nc" and scanned["n_notices"] == 3


@pytest.mark.parametrize(
    "expression, labels, restriction",
    [
        ("MIT", "mit", licenses.PERMISSIVE),
        ("Apache-2.0 or gpl-3.0-only", "apache-2,gpl-3", licenses.PERMISSIVE),
        ("MIT AND CC-BY-NC-4.0", "cc-by-nc,mit", licenses.LIMITED),
        ("GPL-2.0+ WITH Classpath-exception-2.0", "gpl-2,with-classpath-exception-2.0", licenses.WEAK),
        ("AGPL-3.0-or-later", "agpl-3", licenses.NETWORK),
        ("Strange-1.0 OR CC0-1.0", "cc0,strange-1", licenses.PUBLIC),
    ],
)
def test_expressions(expression, labels, restriction):
    terms = licenses.evaluate(expression)
    assert ",".join(sorted(terms.labels)) == labels and terms.restriction == restriction
    assert licenses.evaluate(terms.text)[:2] == terms[:2]


def test_random_expressions_equal_python():
    """and / or against min and max as Python's own parser groups them."""
    names = {"MIT": 0.2, "GPL-3.0": 0.6, "MPL-2.0": 0.4, "CC0-1.0": 0.1, "CC-BY-NC-4.0": 0.9}
    rng = random.Random(8)

    class Level(float):
        __and__ = lambda a, b: Level(max(a, b))
        __or__ = lambda a, b: Level(min(a, b))

    def grown(depth):
        if depth == 0 or rng.random() < 0.2:
            return rng.choice(list(names))
        side = f"{grown(depth - 1)} {rng.choice(['and', 'OR', 'AND', 'or'])} {grown(depth - 1)}"
        return f"({side})" if rng.random() < 0.5 else side

    for _ in range(300):
        expression = grown(5)
        code = re.sub(r"(?i)\band\b", "&", re.sub(r"(?i)\bor\b", "|", expression))
        for at, name in enumerate(names):
            code = code.replace(name, f"v{at}")
        values = {f"v{at}": Level(level) for at, level in enumerate(names.values())}
        terms = licenses.evaluate(expression)
        assert terms.restriction == eval(code, {}, values), expression  # noqa: S307
        assert licenses.evaluate(terms.text).restriction == terms.restriction


@pytest.mark.parametrize(
    "broken", ["", "and", "MIT MIT", "(MIT", "MIT)", "()", "MIT and", "or MIT", "MIT WITH (A or B)",
               "(MIT or ISC) with X", "+", "MIT + +", "MIT, ISC"],
)
def test_malformed(broken):
    with pytest.raises(licenses.Malformed):
        licenses.evaluate(broken)


def test_every_short_sequence_is_parsed_or_refused():
    for n in range(1, 6):
        for words in itertools.product(["A", "and", "or", "with", "(", ")", "+"], repeat=n):
            try:
                terms = licenses.evaluate(" ".join(words))
            except licenses.Malformed:
                continue
            assert licenses.evaluate(terms.text) == terms


def test_tags(spark):
    text = (
        "/* spdx-license-identifier: (MIT OR Apache-2.0) */\n# SPDX-License-Identifier:\tGPL-3.0-only\r\n"
        "SPDX-License-Identifier: MIT Apache\nSPDX-License-Identifier:"
    )
    row = rows_of(docs(spark, [(1, text, "en", "a")]))[1]
    assert row["labels"] == "apache-2,gpl-3,mit" and row["n_malformed"] == 2
    assert row["expression"] == "GPL-3.0-only AND (MIT OR Apache-2.0)"
    assert row["score"] == licenses.SHARE and row["n_base"] == 0


def test_awkward_rows(spark):
    frame = awkward(spark)
    got = license_rows(frame)
    assert len(got) == frame.count()
    for row in got:
        if row["doc_id"] in (1, 2, 3):
            assert (row["n_words"], row["n_base"], row["labels"], row["score"]) == (0, 0, "", 0.0)
            assert row["first_word"] is None and row["expression"] is None
    assert sum(r["doc_id"] is None for r in got) == 1
    assert licenses.license_scan(frame.limit(0)).count() == 0
