"""License terms of documents: notice phrases, identifier tags and their expressions.

One Aho-Corasick automaton goes over the lower-cased words of a whole text and
finds every notice phrase and every place of an identifier tag
(``SPDX-License-Identifier:``). What follows a tag on its line is a license
expression: a shunting-yard parser brings it into postfix order (``+`` and
``with`` bind closest, then ``and``, then ``or``) and evaluates it to the labels
it names and to how much it restricts reuse. With ``or`` the freer side can be
chosen, with ``and`` the stricter one holds, and an exception after ``with``
frees a copyleft license to the level of a weak one.

Several notices of one text hold together. ``score`` is the restriction of all
of them: 0 for a text without license terms, else from 0.1 (public domain) to 1
(all rights reserved, or a license no table knows). A notice phrase inside a longer one of the method does
not count beside it; base phrases always count.

Words are runs of ASCII letters and digits and of anything beyond ASCII, A-Z
lower-cased. Defined cases: null and wordless texts have no words, no places,
empty labels and score 0; an expression that does not parse adds no label and is
counted in ``n_malformed``, as is a tag without one; repeated rows are judged
each by itself; a null id is returned as it is; further columns are not read; an
empty table gives an empty result. Texts of any length are searched whole.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator
from typing import NamedTuple

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from clickloom.llm.common import map_batches

# The phrases every result counts, as words, and the label of each.
BASE_PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
# Further notices the method knows.
NOTICES = {
    "mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "apache license 2 0": "apache-2",
    "apache software license": "apache",
    "redistribution and use in source and binary forms": "bsd",
    "bsd 2 clause": "bsd-2-clause",
    "bsd 3 clause": "bsd-3-clause",
    "isc license": "isc",
    "zlib license": "zlib",
    "boost software license": "bsl",
    "mozilla public license": "mpl",
    "mozilla public license version 2": "mpl-2",
    "eclipse public license": "epl",
    "eclipse public license version 2": "epl-2",
    "gnu general public license": "gpl",
    "gnu general public license version 2": "gpl-2",
    "gnu general public license version 3": "gpl-3",
    "gnu lesser general public license": "lgpl",
    "gnu lesser general public license version 3": "lgpl-3",
    "gnu affero general public license": "agpl",
    "gnu affero general public license version 3": "agpl-3",
    "creative commons attribution": "cc-by",
    "cc by 4 0": "cc-by",
    "cc by sa": "cc-by-sa",
    "creative commons attribution sharealike": "cc-by-sa",
    "cc by nd": "cc-by-nd",
    "cc by nc sa": "cc-by-nc-sa",
    "cc by nc nd": "cc-by-nc-nd",
    "creative commons attribution noncommercial": "cc-by-nc",
    "cc0 1 0 universal": "cc0",
    "dedicated to the public domain": "public-domain",
    "released into the public domain": "public-domain",
    "all rights reserved": "all-rights-reserved",
}
TAG = "spdx license identifier"

# How much a family of licenses restricts reuse; the longest matching start counts.
PUBLIC, PERMISSIVE, WEAK, SHARE, NETWORK, LIMITED, RESERVED = 0.1, 0.2, 0.4, 0.6, 0.7, 0.9, 1.0
RESTRICTION = {
    "cc0": PUBLIC, "public-domain": PUBLIC, "unlicense": PUBLIC, "0bsd": PUBLIC,
    "mit": PERMISSIVE, "apache": PERMISSIVE, "bsd": PERMISSIVE, "isc": PERMISSIVE,
    "zlib": PERMISSIVE, "bsl": PERMISSIVE, "cc-by": PERMISSIVE, "python": PERMISSIVE,
    "mpl": WEAK, "epl": WEAK, "lgpl": WEAK, "cddl": WEAK,
    "gpl": SHARE, "cc-by-sa": SHARE, "agpl": NETWORK,
    "cc-by-nc": LIMITED, "cc-by-nd": LIMITED,
}

SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, "
    "base_labels string, labels string, score double, n_notices long, n_malformed long, "
    "expression string"
)

_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32
    for b in range(256)
)
_TAG_LINE = re.compile(rb"(?i)spdx-license-identifier[\x20\x09]*:([^\x0A-\x0D]*)")
_TOKEN = re.compile(r"[()+]|[^\s()+]+")
_COMMENT_END = re.compile(r"\s*(\*/|-->|#}|\*\)|%>).*$")
_IDENTIFIER = re.compile(r"[A-Za-z0-9][A-Za-z0-9.:-]*")


class Terms(NamedTuple):
    """What an expression, or a notice, stands for."""

    labels: frozenset[str]
    restriction: float
    text: str
    rank: int = 9  # of the operator on top, for brackets in the text


class Malformed(ValueError):
    """Not a license expression."""


def label_of(identifier: str) -> str:
    """The label of a license identifier: its family and version, in lower case."""
    name = re.sub(r"(-only|-or-later)$", "", identifier.lower())
    if name.startswith("cc-by"):
        return re.sub(r"-\d[\d.]*$", "", name)
    if name.startswith("cc0"):
        return "cc0"
    return re.sub(r"(-\d+)\.0$", r"\1", name)


def restriction_of(label: str) -> float:
    """The class of the longest family the label belongs to; all rights reserved without one."""
    parts = label.split("-")
    for n in range(len(parts), 0, -1):
        found = RESTRICTION.get("-".join(parts[:n]))
        if found is not None:
            return found
    return RESERVED


def license_terms(identifier: str) -> Terms:
    label = label_of(identifier)
    return Terms(frozenset([label]), restriction_of(label), identifier)


def _bracketed(side: Terms, rank: int) -> str:
    return f"({side.text})" if side.rank < rank else side.text


def _either(a: Terms, b: Terms) -> Terms:
    text = f"{_bracketed(a, 1)} OR {_bracketed(b, 1)}"
    return Terms(a.labels | b.labels, min(a.restriction, b.restriction), text, 1)


def together(terms: list[Terms]) -> Terms:
    """All of one or more terms at once."""
    if len(terms) == 1:
        return terms[0]
    text = " AND ".join(_bracketed(one, 2) for one in terms)
    labels = frozenset().union(*(one.labels for one in terms))
    return Terms(labels, max(one.restriction for one in terms), text, 2)


def _excepted(license_: Terms, exception: str) -> Terms:
    if license_.rank < 8:
        raise Malformed("an exception belongs to one license")
    freed = min(license_.restriction, WEAK) if license_.restriction < LIMITED else license_.restriction
    labels = license_.labels | {f"with-{exception.lower()}"}
    return Terms(labels, freed, f"{license_.text} WITH {exception}", 3)


_RANK = {"or": 1, "and": 2, "with": 3}


def postfix(expression: str) -> list[tuple[str, str]]:
    """(kind, word) of an expression's words in postfix order, by shunting-yard.

    Kinds are ``name``, ``+`` and the operators. All operators are taken from the
    left. ``Malformed`` is raised unless operands and operators alternate.
    """
    out: list[tuple[str, str]] = []
    waiting: list[str] = []
    operand_next = True
    for word in _TOKEN.findall(expression):
        kind = word.lower()
        if kind == "(":
            if not operand_next:
                raise Malformed("bracket after an operand")
            waiting.append(kind)
        elif kind == ")":
            while not operand_next and waiting and waiting[-1] != "(":
                out.append((op := waiting.pop(), op))
            if operand_next or not waiting:
                raise Malformed("bracket without a partner")
            waiting.pop()
        elif kind == "+":
            if operand_next or out[-1][0] != "name":
                raise Malformed("plus without a license")
            out.append(("+", "+"))
        elif kind in _RANK:
            if operand_next:
                raise Malformed("operator without a left side")
            while waiting and waiting[-1] != "(" and _RANK[waiting[-1]] >= _RANK[kind]:
                out.append((op := waiting.pop(), op))
            waiting.append(kind)
            operand_next = True
        else:
            if not operand_next or not _IDENTIFIER.fullmatch(word):
                raise Malformed(f"unexpected {word!r}")
            out.append(("name", word))
            operand_next = False
    if operand_next or "(" in waiting:
        raise Malformed("incomplete")
    return out + [(op, op) for op in reversed(waiting)]


def evaluate(expression: str) -> Terms:
    """The terms of a license expression; ``Malformed`` if it is none."""
    stack: list[Terms | str] = []
    known = lambda x: license_terms(x) if isinstance(x, str) else x
    for kind, word in postfix(expression):
        if kind == "name":
            stack.append(word)  # a license, or the exception of a ``with``
        elif kind == "+":
            one = license_terms(stack.pop())
            stack.append(one._replace(text=f"{one.text}+", rank=8))
        elif kind == "with":
            exception, license_ = stack.pop(), known(stack.pop())
            if not isinstance(exception, str):
                raise Malformed("an exception is a name")
            stack.append(_excepted(license_, exception))
        else:
            right, left = known(stack.pop()), known(stack.pop())
            stack.append(_either(left, right) if kind == "or" else together([left, right]))
    return known(stack.pop())


def words_of(text: bytes) -> bytes:
    """The words of a text, lower-cased, each after one blank, and a last blank."""
    words = text.translate(_WORD_BYTES).split()
    return b" " + b" ".join(words) + b" " if words else b""


@functools.lru_cache(maxsize=1)
def automaton() -> ahocorasick.Automaton:
    """All phrases between blanks; one per worker process."""
    found = ahocorasick.Automaton()
    for phrase in (*BASE_PHRASES, *NOTICES, TAG):
        found.add_word(f" {phrase} ", phrase)
    found.make_automaton()
    return found


def places(words: bytes) -> Iterator[tuple[int, int, str]]:
    """(first byte, first word, phrase) of every phrase found, by the end of the place."""
    text = words.decode("latin-1")  # one character per byte, as the phrases are ASCII
    at = number = 0
    for last, phrase in automaton().iter(text):
        start = last - len(phrase) - 1
        if start >= at:
            number += text.count(" ", at, start)
        else:
            number -= text.count(" ", start, at)
        at = start
        yield start, number, phrase


def expressions(text: bytes) -> Iterator[str]:
    """What follows each identifier tag on its line, without the end of a comment."""
    for match in _TAG_LINE.finditer(text):
        yield _COMMENT_END.sub("", match[1].decode("utf-8", "replace")).strip()


def scan(text: bytes) -> dict:
    """The columns of ``SCHEMA``, but for the id, of one text."""
    words = words_of(text)
    base: list[tuple[int, str]] = []
    notices: list[tuple[int, int, str]] = []
    tagged = False
    for start, number, phrase in places(words):
        if phrase in BASE_PHRASES:
            base.append((number, BASE_PHRASES[phrase]))
        if phrase == TAG:
            tagged = True
        else:
            notices.append((start, start + len(phrase), phrase))
    found: list[Terms] = []
    malformed = 0
    for expression in expressions(text) if tagged else ():
        try:
            found.append(evaluate(expression))
        except Malformed:
            malformed += 1
    # Widest first from the left: what ends no later than one before lies inside it.
    end = -1
    n_notices = 0
    for _, stop, phrase in sorted(notices, key=lambda x: (x[0], -x[1])):
        if stop > end or phrase in BASE_PHRASES:
            label = BASE_PHRASES.get(phrase) or NOTICES[phrase]
            found.append(Terms(frozenset([label]), restriction_of(label), label))
            n_notices += 1
        end = max(end, stop)
    apart = {one.text: one for one in found}
    joint = together([apart[name] for name in sorted(apart)]) if apart else None
    numbers = [number for number, _ in base]
    return {
        "n_words": max(words.count(b" ") - 1, 0),
        "n_base": len(base),
        "first_word": min(numbers, default=None),
        "last_word": max(numbers, default=None),
        "base_labels": ",".join(sorted({label for _, label in base})),
        "labels": ",".join(sorted(joint.labels)) if joint else "",
        "score": joint.restriction if joint else 0.0,
        "n_notices": n_notices,
        "n_malformed": malformed,
        "expression": joint.text if joint else None,
    }


def license_scan(docs: DataFrame) -> DataFrame:
    """One row per document: places of base phrases, labels, joint expression, score."""

    def run(batch: pa.RecordBatch) -> dict[str, list]:
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        rows = [scan(text or b"") for text in texts]
        names = [field.split()[0] for field in SCHEMA.split(", ")[1:]]
        return {"doc_id": batch.column("doc_id"), **{n: [r[n] for r in rows] for n in names}}

    return map_batches(docs.select("doc_id", "text"), run, SCHEMA)
