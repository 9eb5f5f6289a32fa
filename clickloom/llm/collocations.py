"""Collocations: frequent phrases of two to five words that occur more often than chance.

Every task hashes its words, and all runs of words of one length, by prefix
polynomials in numpy (Rabin-Karp): the hash of a run is a difference of two
prefix sums, so no text is built for it. Each run has a fingerprint, which
stands for its language and its words, and a second hash by other bases to check
it. Tasks send counts per fingerprint with a pointer to one occurrence (a
document and a word in it), the shuffle adds them up, and fingerprints with
``LEAST`` occurrences go on. Runs are counted by rising length, and only those
whose shorter parts were all frequent: a bitmap of the frequent fingerprints of
the pass before, of fixed size whatever the data, goes to all tasks. Before pairs
of words are counted one by one, all of them are counted in cells by their hash,
and only those of crowded cells go on. A bit too many lets a run through to be
counted; none is lost.

Only frequent phrases become text, cut out at their pointers, and are hashed
again to see that they are what was counted. Where the second hash shows that a
fingerprint stands for several phrases, these are counted by their text.

A phrase's score compares its count with what its weakest cut would have by
chance; phrases that hardly occur outside a longer one are dropped.

Language is a group, and a null one is ``und``. Null texts are empty. Text is
split into pieces at ASCII sentence marks and line ends and into words at blanks
and tabs; A-Z are lower-cased. Ties are broken by count, then by the phrase in
byte order. Repeated rows and ids count each; ids are not read, nor are further
columns. Empty tables, and languages without a frequent phrase, give no row.
Texts of any length are counted whole; a task holds one text, and its words, at
a time at least.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.llm.common import cut, map_batches
from clickloom.operators.bounds import fits_broadcast

MOST_WORDS = 5
# The lengths counted in each pass over the texts; 0 counts the words of a language.
PASSES = ((0, 1), (2,), (3,), (4, 5))
LEAST = 100
TOP = 2000

# Text hashed at once by a task; a longer text is hashed by itself.
BATCH_BYTES = 4 << 20
PART_BYTES = 1 << 19
# The bitmap of frequent fingerprints: 8 MB at every size.
BITMAP_BITS = 1 << 26
CHUNK_BITS = 32_768  # of Spark's bitmap aggregate
# Cells in which runs of two words are counted before they are told apart; 16 MB of bits.
SKETCH_CELLS = 1 << 27
SKETCH_CHUNK = 1 << 16
SKETCH_HELD = 1 << 23  # cells a task gathers before it sends them
FINGERPRINT_BITS = 64
# A pointer: the upper bits of a document's hash, then the place of a word in it.
PLACE_BITS = 30

_U = np.uint64
_MIX1, _MIX2 = _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB)
# Odd bases, so that they have inverses modulo 2^64: of bytes and of words, twice.
BYTE_BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
WORD_BASES = (0xC2B2AE3D27D4EB4F, 0xAF251AF3B0F025B5)

# 0: in a word, 1: between words, 2: between pieces.
_KIND = np.zeros(256, np.uint8)
_KIND[list(b" \t")] = 1
_KIND[list(b".,;:!?\n\x0b\x0c\r")] = 2
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values."""
    x = (x ^ (x >> _U(30))) * _MIX1
    x = (x ^ (x >> _U(27))) * _MIX2
    return x ^ (x >> _U(31))


_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base^0 to base^(n - 1) modulo 2^64; the longest list made so far is kept."""
    held = _POWERS.get(base)
    if held is None or len(held) < n:
        held = np.full(1 << max(n - 1, 1).bit_length(), base, _U)
        held[0] = 1
        _POWERS[base] = np.multiply.accumulate(held, out=held)
    return held[:n]


def spans(values: np.ndarray, starts: np.ndarray, stops: np.ndarray, base: int) -> np.ndarray:
    """The polynomial of ``values`` over each span, by differences of prefix sums."""
    prefix = np.zeros(len(values) + 1, _U)
    np.cumsum(values * powers(base, len(values)), out=prefix[1:])
    inverse = pow(base, -1, 1 << 64)
    return (prefix[stops] - prefix[starts]) * powers(inverse, len(prefix))[starts]


def word_hashes(data: np.ndarray, starts: np.ndarray, stops: np.ndarray, base: int) -> np.ndarray:
    """The hash of the bytes of each word, for words of about ``PART_BYTES`` at a time."""
    table = mixed(np.arange(256, dtype=_U) * _U(base) + _U(1))
    out = np.empty(len(starts), _U)
    at = 0
    while at < len(starts):
        low = starts[at]
        to = max(int(np.searchsorted(stops, low + PART_BYTES, side="right")), at + 1)
        part = table[data[low : stops[to - 1]]]
        out[at:to] = mixed(spans(part, starts[at:to] - low, stops[at:to] - low, base))
        at = to
    return out


class Words:
    """The words of some texts: two hashes each, their pieces, texts and places."""

    def __init__(self, texts: list[bytes], langs: list[str]) -> None:
        joined = b"\n".join(texts).translate(_LOWER)
        data = np.frombuffer(joined, np.uint8)
        kind = _KIND[data]
        inside = np.zeros(len(data) + 2, np.int8)
        inside[1:-1] = kind == 0
        steps = np.diff(inside)
        self.starts, self.stops = np.flatnonzero(steps == 1), np.flatnonzero(steps == -1)
        # Words are in one piece if no mark lies between them.
        marks = np.flatnonzero(kind == 2)
        self.piece = np.searchsorted(marks, self.starts)
        ends = np.cumsum(np.array([len(t) + 1 for t in texts], np.int64))
        self.text = np.searchsorted(ends, self.starts, side="right")
        first = np.searchsorted(self.text, np.arange(len(texts)))
        self.place = np.arange(len(self.starts)) - first[self.text]
        self.hashes = [word_hashes(data, self.starts, self.stops, base) for base in BYTE_BASES]
        lang = np.array([xxhash.xxh3_64_intdigest(x.encode()) for x in langs], _U)
        self.lang = lang[self.text] if len(texts) else np.empty(0, _U)
        self.joined = joined

    def __len__(self) -> int:
        return len(self.starts)

    def runs(self, n: int, bits: int = FINGERPRINT_BITS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(fits, fingerprint, check) of the run of ``n`` words from each word on.

        ``fits`` tells where the run lies within one piece. No words at all are a
        run as well: it stands for the language.
        """
        m = max(len(self) - n + 1, 0) if n else len(self)
        at = np.arange(m)
        found = []
        for values, base in zip(self.hashes, WORD_BASES, strict=True):
            run = spans(values, at, at + n, base) if n else np.zeros(m, _U)
            found.append(mixed(mixed(run + _U(n)) + self.lang[:m]))
        fits = self.piece[:m] == self.piece[n - 1 : n - 1 + m] if n else np.ones(m, bool)
        return fits, found[0] >> _U(64 - bits), found[1]

    def phrase(self, word: int, n: int) -> str:
        """The ``n`` words from ``word`` on, one blank between them."""
        some = zip(self.starts[word : word + n], self.stops[word : word + n], strict=True)
        return b" ".join(self.joined[a:b] for a, b in some).decode("utf-8", "replace")


class Bitmap:
    """A set of fingerprints, and perhaps some more, in a fixed number of bits."""

    def __init__(self, bits: int, chunk_bits: int, chunks: list[tuple[int, bytes]]) -> None:
        self.bits = np.zeros(bits // 8, np.uint8)
        for at, chunk in chunks:
            self.bits[at * chunk_bits // 8 :][: len(chunk)] = np.frombuffer(chunk, np.uint8)

    def has(self, values: np.ndarray) -> np.ndarray:
        cell = cells_of(values, 8 * len(self.bits))
        return (self.bits[cell >> 3] >> (cell & 7).astype(np.uint8) & 1).astype(bool)


def cells_of(values: np.ndarray, bits: int) -> np.ndarray:
    return (mixed(values) & _U(bits - 1)).astype(np.int64)


def bitmap_of(frame: DataFrame, column: str) -> Bitmap:
    """The bitmap of a column of longs; the driver gets its 8 MB at most."""

    def run(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
        cell = cells_of(batch.column(column).to_numpy().view(_U), BITMAP_BITS)
        return {"chunk": cell // CHUNK_BITS, "bit": cell % CHUNK_BITS}

    cells = map_batches(frame.select(column), run, "chunk long, bit long")
    chunks = cells.groupBy("chunk").agg(F.bitmap_construct_agg("bit").alias("bits")).collect()
    return Bitmap(BITMAP_BITS, CHUNK_BITS, chunks)


def doc_hash(docs: DataFrame) -> DataFrame:
    """(doc, lang, text) per row with a word: ``doc`` holds 34 bits of a hash of both."""
    lang, text = F.coalesce("lang", F.lit("und")), F.coalesce("text", F.lit(""))
    doc = F.shiftrightunsigned(F.xxhash64(lang, text), PLACE_BITS)
    return docs.select(doc.alias("doc"), lang.alias("lang"), text.alias("text")).filter(text != "")


def batches_of_words(
    batches: Iterable[pa.RecordBatch],
) -> Iterator[tuple[Words, np.ndarray, list[str]]]:
    """(words, doc hashes, languages) of about ``BATCH_BYTES`` of text at a time."""

    def out(rows: list[tuple[int, str, bytes]]) -> tuple[Words, np.ndarray, list[str]]:
        rows.sort(key=lambda row: row[0])
        langs = [row[1] for row in rows]
        docs = np.array([row[0] for row in rows], np.int64)
        return Words([row[2] for row in rows], langs), docs, langs

    held: list[tuple[int, str, bytes]] = []
    size = 0
    for batch in batches:
        docs, langs = (batch.column(c).to_pylist() for c in ("doc", "lang"))
        for row in zip(docs, langs, batch.column("text").cast(pa.binary()), strict=True):
            text = row[2].as_py()
            if held and size + len(text) > BATCH_BYTES:
                yield out(held)
                held, size = [], 0
            held.append((row[0], row[1], text))
            size += len(text) + 1
    if held:
        yield out(held)


def counted(fingerprint: np.ndarray, check: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first place, count) of each different pair of values."""
    order = np.argsort(fingerprint)
    f, c = fingerprint[order], check[order]
    same = f[1:] == f[:-1]
    if (same & (c[1:] != c[:-1])).any():  # two phrases of one fingerprint
        order = np.lexsort((check, fingerprint))
        f, c = fingerprint[order], check[order]
        same = (f[1:] == f[:-1]) & (c[1:] == c[:-1])
    if not len(f):
        return order, order
    at = np.concatenate([[0], np.flatnonzero(~same) + 1])
    return np.minimum.reduceat(order, at), np.diff(at, append=len(f))


def crowded_cells(docs: DataFrame, size: int, least: int, bits: int) -> Bitmap:
    """The cells into which runs of ``size`` words fall ``least`` times, all runs counted.

    A run that occurs that often is in one of them; nearly all others are not, as
    long as there are more cells than different runs. Two bytes per occurrence are
    shuffled, and a task adds up one chunk of cells at a time.
    """

    def sent(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        cells = np.sort(np.concatenate(held))
        chunks, first = np.unique(cells // SKETCH_CHUNK, return_index=True)
        parts = np.split((cells % SKETCH_CHUNK).astype("<u2"), first[1:])
        blobs = pa.array([part.tobytes() for part in parts], pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(chunks, pa.int64()), blobs], ["chunk", "cells"])

    def dealt(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for words, _, _ in batches_of_words(batches):
            fits, fingerprint, _ = words.runs(size, bits)
            held.append(cells_of(fingerprint[fits], SKETCH_CELLS).astype(np.int32))
            if sum(map(len, held)) > SKETCH_HELD:
                yield from sent(held)
                held = []
        if sum(map(len, held)):
            yield from sent(held)

    def added(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def crowded(chunk: int, counts: np.ndarray) -> pa.RecordBatch:
            packed = np.packbits(counts >= least, bitorder="little").tobytes()
            return pa.RecordBatch.from_arrays(
                [pa.array([chunk], pa.int64()), pa.array([packed], pa.binary())], ["chunk", "bits"]
            )

        at, counts = None, np.zeros(SKETCH_CHUNK, np.int64)
        for batch in batches:
            for chunk, cells in zip(batch.column("chunk").to_pylist(), batch.column("cells"), strict=True):
                if chunk != at:
                    if at is not None and counts.max() >= least:
                        yield crowded(at, counts)
                    at, counts[:] = chunk, 0
                counts += np.bincount(np.frombuffer(cells.as_py(), "<u2"), minlength=SKETCH_CHUNK)
        if at is not None and counts.max() >= least:
            yield crowded(at, counts)

    found = (
        docs.mapInArrow(dealt, "chunk long, cells binary")
        .repartition("chunk")
        .sortWithinPartitions("chunk")
        .mapInArrow(added, "chunk long, bits binary")
    )
    return Bitmap(SKETCH_CELLS, SKETCH_CHUNK, found.collect())


RUN_SCHEMA = "n_words int, fingerprint long, check long, n long, pointer long"


def counted_runs(docs: DataFrame, sizes: tuple[int, ...], known: dict, bits: int) -> DataFrame:
    """``RUN_SCHEMA`` per run, task and batch: runs whose parts are all in ``known``.

    ``known`` holds broadcast bitmaps by the length of the parts. Documents of a
    batch are taken in the order of their hashes, and the pointer is to the first
    occurrence, so pointers of all tasks gather in few documents.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words, doc, _ in batches_of_words(batches):
            frequent = {part: held.value.has(words.runs(part, bits)[1]) for part, held in known.items()}
            for size in sizes:
                fits, fingerprint, check = words.runs(size, bits)
                for part, has in frequent.items():
                    for start in range(size - part + 1):
                        fits &= has[start : start + len(fits)]
                at = np.flatnonzero(fits)
                first, n = counted(fingerprint[at], check[at])
                at = at[first]
                columns = [
                    np.full(len(at), size, np.int32), fingerprint[at].view(np.int64),
                    check[at].view(np.int64), n,
                    doc[words.text[at]] << PLACE_BITS | words.place[at],
                ]
                names = [field.split()[0] for field in RUN_SCHEMA.split(", ")]
                yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), names)

    return docs.mapInArrow(run, RUN_SCHEMA)


def frequent_runs(docs: DataFrame, least: int, bits: int) -> DataFrame:
    """(n_words, fingerprint, low, high, n, pointer) of all runs with ``least`` occurrences.

    ``low`` and ``high`` are the least and greatest check of the fingerprint. The
    run of no words counts the words of its language; it is kept if frequent.
    """
    context = docs.sparkSession.sparkContext
    found: DataFrame | None = None
    known: dict = {}
    for sizes in PASSES:
        level = cut(
            counted_runs(docs, sizes, known, bits)
            .groupBy("n_words", "fingerprint")
            .agg(
                F.min("check").alias("low"), F.max("check").alias("high"),
                F.sum("n").alias("n"), F.min("pointer").alias("pointer"),
            )
            .filter(F.col("n") >= least)
        )
        found = level if found is None else found.unionByName(level)
        for held in known.values():
            held.unpersist()
        part = sizes[-1]
        if part == MOST_WORDS:
            break
        last = level.filter(F.col("n_words") == part)
        known = {part: context.broadcast(bitmap_of(last, "fingerprint"))}
        if part == 1:  # most pairs of words are rare, though both words are not
            known[2] = context.broadcast(crowded_cells(docs, 2, least, bits))
    return found


def pointed_phrases(docs: DataFrame, runs: DataFrame, bits: int) -> DataFrame:
    """(lang, phrase, n_words, n) of ``runs``, cut out of the documents at their pointers.

    Only documents that are pointed to are shuffled. A document whose hash is the
    same by chance has other words at the place and gives nothing.
    """
    runs = runs.withColumn("doc", F.shiftrightunsigned("pointer", PLACE_BITS))
    wanted = docs.sparkSession.sparkContext.broadcast(bitmap_of(runs, "doc"))

    def chosen(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = wanted.value.has(batch.column("doc").to_numpy().view(_U))
            yield batch.filter(pa.array(keep))

    def slices(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                words = Words([row["text"].encode()], [row["lang"]])
                hashed = {}
                for run in row["runs"]:
                    size, place = run["n_words"], run["pointer"] & ((1 << PLACE_BITS) - 1)
                    if size not in hashed:
                        hashed[size] = [x.view(np.int64) for x in words.runs(size, bits)[1:]]
                    fingerprint, check = hashed[size]
                    if (
                        place < len(fingerprint)
                        and fingerprint[place] == run["fingerprint"]
                        and check[place] == run["low"]
                    ):
                        out.append((row["lang"], words.phrase(place, size), size, run["n"]))
            columns = list(zip(*out, strict=True)) or [()] * 4
            kinds = [pa.string(), pa.string(), pa.int32(), pa.int64()]
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, ["lang", "phrase", "n_words", "n"])

    fields = F.struct("n_words", "fingerprint", "low", "n", "pointer")
    lists = runs.groupBy("doc").agg(F.collect_list(fields).alias("runs"))
    texts = docs.mapInArrow(chosen, docs.schema).dropDuplicates(["doc", "lang", "text"])
    found = texts.join(lists, "doc").mapInArrow(
        slices, "lang string, phrase string, n_words int, n long"
    )
    return found.distinct()


def recounted_phrases(docs: DataFrame, runs: DataFrame, least: int, bits: int) -> DataFrame:
    """(lang, phrase, n_words, n) of the phrases that share a fingerprint of ``runs``, by text."""
    mixed_up = docs.sparkSession.sparkContext.broadcast(bitmap_of(runs, "fingerprint"))
    sizes = range(MOST_WORDS + 1)

    def texts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words, _, langs in batches_of_words(batches):
            for size in sizes:
                fits, fingerprint, check = words.runs(size, bits)
                at = np.flatnonzero(fits & mixed_up.value.has(fingerprint))
                first, n = counted(fingerprint[at], check[at])
                at = at[first]
                columns = [
                    pa.array([langs[words.text[i]] for i in at], pa.string()),
                    pa.array([words.phrase(i, size) for i in at], pa.string()),
                    pa.array(np.full(len(at), size, np.int32)),
                    pa.array(fingerprint[at].view(np.int64)),
                    pa.array(n),
                ]
                yield pa.RecordBatch.from_arrays(
                    columns, ["lang", "phrase", "n_words", "fingerprint", "n"]
                )

    schema = "lang string, phrase string, n_words int, fingerprint long, n long"
    return (
        docs.mapInArrow(texts, schema)
        .join(runs.select("n_words", "fingerprint"), ["n_words", "fingerprint"], "left_semi")
        .groupBy("lang", "phrase", "n_words")
        .agg(F.sum("n").alias("n"))
        .filter(F.col("n") >= least)
    )


def frequent_phrases(
    docs: DataFrame, least: int = LEAST, bits: int = FINGERPRINT_BITS
) -> DataFrame:
    """(lang, phrase, n_words, n) of all phrases of up to five words that occur ``least`` times.

    The phrase of no words has the number of words of its language. ``bits`` of a
    fingerprint are used; fewer only make more phrases share one.
    """
    docs = doc_hash(docs)
    runs = frequent_runs(docs, least, bits)
    phrases = pointed_phrases(docs, runs.filter("low = high"), bits)
    shared = cut(runs.filter("low <> high"))
    if not shared.isEmpty():
        phrases = phrases.unionByName(recounted_phrases(docs, shared, least, bits))
    return cut(phrases)


def _part(start: Column, length: Column) -> Column:
    return F.array_join(F.slice(F.split("phrase", " "), start, length), " ")


def scored(phrases: DataFrame) -> DataFrame:
    """(lang, phrase, n_words, a, l, r, n, score) of the phrases of two words and more.

    The cut with the lowest score counts, of equal ones the first. Products are
    decimals of 38 digits, which are exact.
    """
    totals = phrases.filter("n_words = 0").select("lang", F.col("n").alias("total"))
    if fits_broadcast(totals):
        totals = F.broadcast(totals)  # one row per language
    k = F.col("k")
    cuts = (
        phrases.filter("n_words > 1")
        .withColumn("k", F.explode(F.sequence(F.lit(1), F.col("n_words") - 1)))
        .withColumn("left_part", _part(F.lit(1), k))
        .withColumn("right_part", _part(k + 1, F.col("n_words") - k))
    )
    parts = phrases.select("lang", F.col("phrase").alias("part"), F.col("n").alias("times"))
    for side, name in (("left_part", "l"), ("right_part", "r")):
        held = parts.withColumnsRenamed({"part": side, "times": name})
        cuts = cuts.join(held, ["lang", side])
    wide = {c: f"cast({c} AS decimal(19, 0))" for c in ("n", "total", "l", "r")}
    product = f"1000 * {wide['n']} * {wide['total']} div ({wide['l']} * {wide['r']})"
    best = F.min(F.struct(F.expr(product).alias("score"), "k", "l", "r", "total")).alias("cut")
    return (
        cuts.join(totals, "lang")
        .groupBy("lang", "phrase", "n_words", "n")
        .agg(best)
        .select(
            "lang", "phrase", "n_words", F.col("n").alias("a"), "cut.l", "cut.r",
            F.col("cut.total").alias("n"), "cut.score",
        )
    )


def whole_phrases(phrases: DataFrame) -> DataFrame:
    """The phrases of two words and more that occur outside longer ones, too.

    A phrase occurs at least as often as any longer one it lies in. If it occurs
    no more often than one of these, so do the phrases between them, one of which
    is a word longer: only those are compared.
    """
    long = phrases.filter("n_words > 2")
    inner = F.col("n_words") - 1
    covers = long.select(
        "lang", "n", F.explode(F.array(_part(F.lit(1), inner), _part(F.lit(2), inner))).alias("phrase")
    ).distinct()
    return phrases.filter("n_words > 1").join(covers, ["lang", "phrase", "n"], "left_anti")


def collocations(
    docs: DataFrame, least: int = LEAST, top: int = TOP, bits: int = FINGERPRINT_BITS
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of each language."""
    phrases = frequent_phrases(docs, least, bits)
    kept = whole_phrases(phrases).select("lang", "phrase")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (
        scored(phrases)
        .join(kept, ["lang", "phrase"], "left_semi")
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= top)
        .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
    )
