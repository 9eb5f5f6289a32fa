"""Quality rules that clean lines first and then judge what is left.

Each line is held against punctuation, navigation and boilerplate rules; failing
lines go. A document that loses too many of its word characters that way is
rejected, as is one that fails the base rules (too few words, or too many words
in repeated three-word windows).

Defined cases: a null or wordless text has zero counts, fails the base rules and
is not kept; lines without a word are neither judged nor counted; a null id is
returned as it is; repeated rows are judged each by itself; further columns are
not read. Words are split at ASCII white space only.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import map_batches

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_LOST_PERCENT = 50

# Punctuation: some sentence mark must occur, and other marks must not crowd the words.
SENTENCE_MARK = r'[.!?…:;"”»)]'
CROWDING_MARK = r"[!?*#$%&<>{}|^~=_]"
# Navigation: three or more separators, one per six words at least.
SEPARATOR = r"[|»›•·]"
# Boilerplate: set phrases of page frames and license lines, in lower case.
BOILERPLATE = (
    "all rights reserved|privacy policy|cookie policy|accept cookies|terms of (use|service)"
    "|enable javascript|lorem ipsum|click here|sign up|log in|subscribe"
    "|licensed under|released under"
)

SPACES = " \t\n\x0b\x0c\r"
_MARK, _CROWD, _SEPARATOR, _FRAME, _SYMBOL = (
    re.compile(x) for x in (SENTENCE_MARK, CROWDING_MARK, SEPARATOR, BOILERPLATE, r"[#*$%&|<>]")
)

SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
    "n_repeat_words long, removed_chars long, clean_text string"
)


def line_fails(line: str, n_words: int) -> bool:
    if not _MARK.search(line) or 2 * len(_CROWD.findall(line)) > n_words:
        return True
    separators = len(_SEPARATOR.findall(line))
    if separators >= 3 and 6 * separators >= n_words:
        return True
    return bool(_FRAME.search(line.lower()))


def word_chars(text: str) -> int:
    return len(text) - sum(map(text.count, SPACES))


def repeated_words(words: list[bytes]) -> int:
    """Words inside three-word windows that occur twice or more."""
    if len(words) < 4:
        return 0
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
    pairs = np.unique(ids[:-1] * len(known) + ids[1:], return_inverse=True)[1]
    _, window, count = np.unique(
        pairs[:-1].astype(np.int64) * len(known) + ids[2:], return_inverse=True, return_counts=True
    )
    again = count[window] > 1
    covered = np.zeros(len(words), bool)
    for shift in range(3):
        covered[shift : shift + len(again)] |= again
    return int(covered.sum())


def measure(text: str | None) -> tuple[int, int, int, int, int, int, str]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, removed_chars, clean text."""
    text = text or ""
    words = text.encode("utf-8", "surrogatepass").split()
    seen: set[str] = set()
    repeats = removed = 0
    left = []
    for line in text.split("\n"):
        n_words = len(line.encode("utf-8", "surrogatepass").split())
        if not n_words:
            left.append(line)
            continue
        repeats += line in seen
        seen.add(line)
        if line_fails(line, n_words):
            removed += word_chars(line)
        else:
            left.append(line)
    return (
        len(words), word_chars(text), len(_SYMBOL.findall(text)), repeats, repeated_words(words),
        removed, "\n".join(left),
    )


def clean_lines(docs: DataFrame, with_text: bool = True) -> DataFrame:
    """Counts, verdict and (``with_text``) the text without its failing lines, per document."""
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "removed_chars")

    def judge(batch: pa.RecordBatch) -> dict[str, list]:
        rows = [measure(text) for text in batch.column("text").to_pylist()]
        columns = dict(zip((*names, "clean_text"), zip(*rows, strict=True), strict=False))
        columns = {n: list(columns.get(n, ())) for n in (*names, "clean_text")}
        if not with_text:
            columns["clean_text"] = [None] * batch.num_rows
        return {"doc_id": batch.column("doc_id"), **columns}

    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )
    lost = 100 * F.col("removed_chars") > MAX_LOST_PERCENT * F.col("word_chars")
    judged = (
        map_batches(docs.select("doc_id", "text"), judge, SCHEMA)
        .withColumn("base_failed", failed)
        .withColumn("kept", ~F.col("base_failed") & ~lost)
    )
    return judged if with_text else judged.drop("clean_text")
