"""Token ids in Arrow files of equal-length sequences with masks.

Documents are range-partitioned by id; each task writes one Arrow IPC file whose
batches hold two fixed-size lists, the ids and the mask of each sequence, and
one index file with the place of every document in the stream of ids. Fixed-size
lists lie flat in the file, so a memory-mapped sequence or document is a slice of
it. The last sequence of a file is filled up with id 0 under a false mask.

A file appears under its name only when it is complete, and a repeated task
writes the same bytes, so lost executors do no harm. The folder must be one that
``pyarrow.fs`` reaches on driver and executors.

Defined cases: a null or empty text is the end id alone; null ids come first;
rows with one id lie in the order of their texts, each with its own place; an
empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs, ipc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm.tokenizing import END_ID, default_tokenizer, encoder
from clickloom.workspace import fresh_dir

SEQUENCE = 1024
BATCH_SEQUENCES = 512
INDEX = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])


def locate(uri: str) -> tuple[fs.FileSystem, str]:
    if uri.startswith("file:"):
        uri = "/" + uri.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(uri)


def token_schema(sequence: int, wide: bool) -> pa.Schema:
    kind = pa.uint32() if wide else pa.uint16()
    return pa.schema([("ids", pa.list_(kind, sequence)), ("mask", pa.list_(pa.bool_(), sequence))])


class TokenWriter:
    """Appends documents to one token file and its index."""

    def __init__(self, folder: str, part: int, attempt: int, sequence: int, wide: bool) -> None:
        self.files, self.folder = locate(folder)
        self.files.create_dir(self.folder, recursive=True)
        self.sequence, self.schema = sequence, token_schema(sequence, wide)
        self.kind = "<u4" if wide else "<u2"
        self.names = [(f"{self.folder}/.{n}-{part}-{attempt}", f"{self.folder}/{n}-{part:06d}.arrow")
                      for n in ("tokens", "index")]
        self.out = [self.files.open_output_stream(name) for name, _ in self.names]
        self.tokens = ipc.new_file(self.out[0], self.schema)
        self.index = ipc.new_file(self.out[1], INDEX)
        self.waiting: list[bytes] = []
        self.n_waiting = self.n_tokens = self.n_docs = 0

    def append(self, doc_ids: list[int | None], ids: list[bytes]) -> None:
        sizes = np.array([len(x) // 4 for x in ids], np.int64)
        starts = self.n_tokens + sizes.cumsum() - sizes
        self.index.write(pa.record_batch([doc_ids, starts, sizes], schema=INDEX))
        self.n_tokens += int(sizes.sum())
        self.n_docs += len(ids)
        for x in ids:
            self.waiting.append(x)
            self.n_waiting += len(x) // 4
            if self.n_waiting >= self.sequence * BATCH_SEQUENCES:
                self._flush(self.n_waiting // self.sequence * self.sequence)

    def _flush(self, n: int) -> None:
        """Write the first ``n`` waiting ids; fill the last sequence up if they run short."""
        flat = np.frombuffer(b"".join(self.waiting), "<u4")
        now, later = flat[:n], flat[n:]
        self.waiting, self.n_waiting = [later.tobytes()], len(later)
        room = -len(now) % self.sequence
        mask = np.arange(len(now) + room) < len(now)
        lists = [
            pa.FixedSizeListArray.from_arrays(pa.array(x), self.sequence)
            for x in (np.append(now, np.zeros(room)).astype(self.kind), mask)
        ]
        self.tokens.write(pa.record_batch(lists, schema=self.schema))

    def close(self) -> tuple[int, int]:
        if self.n_waiting:
            self._flush(self.n_waiting)
        for writer, out in zip((self.tokens, self.index), self.out, strict=True):
            writer.close()
            out.close()
        for written, name in self.names:
            self.files.move(written, name)
        return self.n_docs, self.n_tokens


class TokenFile:
    """Random access to the sequences and documents of one token file."""

    def __init__(self, folder: str, part: int) -> None:
        files, path = locate(folder)
        names = [f"{path}/{n}-{part:06d}.arrow" for n in ("tokens", "index")]
        if isinstance(files, fs.LocalFileSystem):
            sources = [pa.memory_map(name) for name in names]
        else:
            sources = [files.open_input_file(name) for name in names]
        self.tokens, self.index = map(ipc.open_file, sources)
        self.sequence = self.tokens.schema.field("ids").type.list_size
        self.starts: list[int] = [0]  # first id of each batch, as far as looked
        self.at, self.batch = -1, None

    def _batch(self, i: int) -> pa.RecordBatch:
        if self.at != i:
            self.at, self.batch = i, self.tokens.get_batch(i)
        return self.batch

    def _find(self, position: int) -> int:
        """The batch that holds the id at ``position``."""
        while self.starts[-1] <= position:
            rows = self._batch(len(self.starts) - 1).num_rows
            self.starts.append(self.starts[-1] + rows * self.sequence)
        return int(np.searchsorted(self.starts, position, "right")) - 1

    def sequence_at(self, number: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids (a view of the file) and mask of a sequence."""
        i = self._find(number * self.sequence)
        row = number - self.starts[i] // self.sequence
        batch = self._batch(i)
        ids, mask = (
            batch.column(c).values.slice(row * self.sequence, self.sequence) for c in (0, 1)
        )
        return ids.to_numpy(), mask.to_numpy(zero_copy_only=False)

    def ids(self, start: int, n: int) -> np.ndarray:
        """``n`` ids from ``start`` on; a view where they lie in one batch."""
        parts = []
        while n:
            i = self._find(start)
            low = start - self.starts[i]
            values = self._batch(i).column(0).values
            part = values.slice(low, min(n, len(values) - low)).to_numpy()
            parts.append(part)
            start, n = start + len(part), n - len(part)
        return parts[0] if len(parts) == 1 else np.concatenate(parts)

    def documents(self) -> Iterator[pa.RecordBatch]:
        for i in range(self.index.num_record_batches):
            yield self.index.get_batch(i)


def write_tokens(
    docs: DataFrame, folder: str, tokenizer: str | None = None, sequence: int = SEQUENCE
) -> list[tuple[int, int, int]]:
    """Write all documents below ``folder``: (part, n_docs, n_tokens), one per file, in order.

    The driver gets these few numbers per file and nothing else.
    """
    path = tokenizer or default_tokenizer()
    end = np.array([END_ID], "<u4").tobytes()
    tie = F.xxhash64("text")
    ordered = (
        docs.select("doc_id", "text")
        .repartitionByRange(F.col("doc_id").asc_nulls_first(), tie)
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), tie, "text")
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, writer = TaskContext.get(), None
        part = task.partitionId()
        for batch in batches:
            if writer is None:
                wide = encoder(path).library.get_vocab_size() > 1 << 16
                writer = TokenWriter(folder, part, task.taskAttemptId(), sequence, wide)
            texts = encoder(path).encode(batch.column("text").to_pylist())
            writer.append(batch.column("doc_id").to_pylist(), [x + end for x in texts])
        if writer:
            n_docs, n_tokens = writer.close()
            yield pa.RecordBatch.from_pydict({"part": [part], "docs": [n_docs], "ids": [n_tokens]})

    return sorted(map(tuple, ordered.mapInArrow(run, "part long, docs long, ids long").collect()))


def read_tokens(spark: SparkSession, folder: str, parts: list[tuple[int, int, int]]) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document of the files, one task per file."""
    before, rows = 0, []
    for part, _, n_tokens in parts:
        rows.append((part, before))
        before += n_tokens

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, base in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                file = TokenFile(folder, part)
                for index in file.documents():
                    doc_ids, starts, sizes = (c.to_pylist() for c in index.columns)
                    crcs = [
                        zlib.crc32(file.ids(start, n).astype("<u4").tobytes())
                        for start, n in zip(starts, sizes, strict=True)
                    ]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(doc_ids, pa.int64()),
                            pa.array([base + start for start in starts], pa.int64()),
                            pa.array(sizes, pa.int64()),
                            pa.array(crcs, pa.int64()),
                        ],
                        names=["doc_id", "start", "n_tokens", "ids_crc32"],
                    )

    files = spark.createDataFrame(rows, "part long, base long").repartition(max(1, len(rows)), "part")
    return files.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_round_trip(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Write the documents to token files in the shared folder and read every one back."""
    spark = docs.sparkSession
    folder = fresh_dir(spark, "tokens")
    return read_tokens(spark, folder, write_tokens(docs, folder, tokenizer))
