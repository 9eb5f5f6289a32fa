"""WARC archives of captures, and a merged index of what they hold.

Captures whose payload was met before are written as revisits that name the
first one. Every record is a gzip member of its own, and an index line holds the
member's offset and length, so one record is read without the rest of its archive.
Reading goes by the records' lengths, never by a separator, so payloads may hold anything.

Every archive read gives a run of index lines sorted by URL key and time, written to a
file. The runs are merged from the files by loser trees (``run_merge``), so the lines
come out in the global order of the keys and each page's history stands together.
The folder must be one that ``pyarrow.fs`` reaches on driver and executors.

Defined cases: a null payload is empty; payloads under ``LEAST_BYTES`` are never
revisits; a null URL is an empty one; a capture without an id can be a revisit
but never what another refers to, unless no copy has an id; rows that repeat the
id of the first capture are responses too; an empty table gives an empty result.
Further columns are not read. A task holds one record at a time, and the index
lines of one archive; a page may be as long as a Spark string, an archive any length.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterable, Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm.common import cut
from clickloom.llm.run_merge import merge_runs, publish, run_name, settle_count, write_run
from clickloom.llm.token_files import locate
from clickloom.workspace import fresh_dir

LEAST_BYTES = 100
FILE_BYTES = 32 << 20
HEADER_BYTES = 600  # about what a record has besides its payload
READ_BYTES = 1 << 20
GZIP = 31  # zlib's number for a gzip member
EOL = "\r\n"
FIRST_DATE = 1_704_067_200  # captures are dated by their id, one second each, from 2024 on
DATE_SPAN = 10 * 365 * 86_400
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

INDEX_ARROW = pa.schema([
    ("url_key", pa.string()), ("captured", pa.string()), ("page_id", pa.int64()),
    ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()),
    ("payload_digest", pa.string()), ("run", pa.string()), ("place", pa.int64()),
    ("length", pa.int64()),
])
INDEX_SCHEMA = (
    "url_key string, captured string, page_id long, record_type string, refers_to long, "
    "payload_bytes long, payload_digest string, run string, place long, length long"
)


def captures(pages: DataFrame) -> DataFrame:
    """(page_id, url, payload, payload_bytes, payload_digest, refers_to) per page.

    Only ids and digests are compared; the payloads are dealt once, to archives
    of about ``FILE_BYTES``.
    """
    payload = F.coalesce("html", F.lit(""))
    described = pages.select(
        "page_id",
        F.octet_length(payload).cast("long").alias("payload_bytes"),
        F.sha2(payload.cast("binary"), 256).alias("payload_digest"),
    )
    names = cut(described)
    big = names.filter(F.col("payload_bytes") >= LEAST_BYTES)
    first = big.groupBy("payload_digest").agg(
        F.min("page_id").alias("refers_to"), F.count("*").alias("copies")
    )
    revisits = (
        big.join(first.filter("copies > 1 and refers_to is not null"), "payload_digest")
        .filter(~F.col("page_id").eqNullSafe(F.col("refers_to")))
        .select("page_id", "payload_digest", "refers_to")
        .distinct()
    )
    total = names.agg(F.sum(F.col("payload_bytes") + HEADER_BYTES)).first()[0] or 0
    files = max(1, -(-total // FILE_BYTES))
    keys = ["id_key", "payload_digest"]
    id_key = F.coalesce(F.col("page_id").cast("string"), F.lit("")).alias("id_key")
    full = pages.select(
        "page_id",
        F.coalesce("url", F.lit("")).alias("url"),
        payload.alias("payload"),
        F.octet_length(payload).cast("long").alias("payload_bytes"),
        F.sha2(payload.cast("binary"), 256).alias("payload_digest"),
        id_key,
    ).repartition(files, *keys)
    named = revisits.select(id_key, "payload_digest", "refers_to").repartition(files, *keys)
    return full.join(named, keys, "left").drop("id_key")


def record() -> Column:
    """The text of a record up to the two line ends that close it."""
    id_of = lambda c: F.concat(
        F.lit("<urn:uuid:"),
        F.regexp_replace(
            F.md5(c.cast("string").cast("binary")),
            "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5",
        ),
        F.lit(">"),
    )
    revisit = F.col("refers_to").isNotNull()
    head = F.when(revisit, F.lit(f"HTTP/1.1 200 OK{EOL}{EOL}")).otherwise(
        F.concat(
            F.lit(f"HTTP/1.1 200 OK{EOL}Content-Type: text/html; charset=utf-8{EOL}Content-Length: "),
            F.col("payload_bytes"), F.lit(EOL * 2),
        )
    )
    block = F.concat(head, F.when(revisit, F.lit("")).otherwise(F.col("payload")))
    at = F.lit(FIRST_DATE) + F.pmod(F.coalesce("page_id", F.lit(0)), F.lit(DATE_SPAN))
    fields = {
        "WARC-Type": F.when(revisit, "revisit").otherwise("response"),
        "WARC-Record-ID": F.coalesce(
            id_of(F.col("page_id")), id_of(F.col("payload_digest"))
        ),
        "WARC-Date": F.date_format(F.timestamp_seconds(at), "yyyy-MM-dd'T'HH:mm:ss'Z'"),
        "WARC-Target-URI": F.regexp_replace("url", r"[\r\n]", " "),
        "WARC-Payload-Digest": F.concat(F.lit("sha256:"), F.col("payload_digest")),
        "WARC-Profile": F.when(revisit, F.lit(REVISIT_PROFILE)),
        "WARC-Refers-To": id_of(F.col("refers_to")),
        "X-Page": F.col("page_id").cast("string"),
        "X-Refers-To-Page": F.col("refers_to").cast("string"),
        "X-Payload-Length": F.col("payload_bytes").cast("string"),
        "Content-Type": F.lit("application/http;msgtype=response"),
        "Content-Length": F.octet_length(block).cast("string"),
    }
    lines = [F.concat(F.lit(f"{EOL}{name}: "), value) for name, value in fields.items()]
    return F.concat(F.lit("WARC/1.1"), F.concat_ws("", *lines), F.lit(EOL * 2), block)


def write_archives(caught: DataFrame, folder: str) -> int:
    """One archive per partition of ``caught``, each record a gzip member: how many there are."""

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()

        def members(out: pa.NativeFile) -> None:
            for batch in batches:
                for text in batch.column(0):
                    packer = zlib.compressobj(wbits=GZIP)
                    out.write(packer.compress(f"{text.as_py()}{EOL * 2}".encode()))
                    out.write(packer.flush())

        publish(folder, archive_name(part), members)
        yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int64())})

    return settle_count(caught.select(record().alias("value")).mapInArrow(write, "part long"))


def archive_name(part: int) -> str:
    return f"archive-{part:08d}.warc.gz"


def url_key(url: str) -> str:
    """Host labels from the right, then the path and query, in lower case."""
    try:
        parts = urlsplit(url.strip().lower())
        host = parts.hostname or ""
    except ValueError:
        return url.lower()
    query = f"?{parts.query}" if parts.query else ""
    labels = ",".join(reversed(host.removeprefix("www.").split(".")))
    return f"{labels}){parts.path or '/'}{query}"


def members(file: pa.NativeFile) -> Iterator[tuple[int, int, bytes]]:
    """(offset, length, content) of the gzip members of a file, read ``READ_BYTES`` at a time."""
    at, seen, waiting = 0, 0, b""
    while True:
        unpacker, parts = zlib.decompressobj(wbits=GZIP), []
        while not unpacker.eof:
            data = waiting or file.read(READ_BYTES)
            if not data:
                if seen > at:
                    raise ValueError(f"the member at offset {at} is cut off")
                return
            seen += 0 if waiting else len(data)
            waiting = b""
            parts.append(unpacker.decompress(data))
        waiting = unpacker.unused_data
        end = seen - len(waiting)
        yield at, end - at, b"".join(parts)
        at = end


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and block of one record; the block goes by its stated length."""
    end = data.index(b"\r\n\r\n")
    version, *lines = data[:end].decode("utf-8").split(EOL)
    if not version.startswith("WARC/"):
        raise ValueError("no record")
    fields = dict(line.split(": ", 1) for line in lines)
    stop = end + 4 + int(fields["Content-Length"])
    if data[stop:] != b"\r\n\r\n":
        raise ValueError("a record does not end where it says")
    return fields, data[end + 4 : stop]


def read_record(folder: str, run: str, place: int, length: int) -> tuple[dict[str, str], bytes]:
    """The record an index line points to; nothing else of its archive is read."""
    files, path = locate(folder)
    with files.open_input_file(f"{path}/{run}") as file:
        file.seek(place)
        return parse_record(zlib.decompress(file.read(length), wbits=GZIP))


def index_lines(run: str, file: pa.NativeFile) -> list[tuple]:
    """The index lines of an archive, sorted: a run. Payloads are measured as read."""
    lines = []
    for place, length, data in members(file):
        fields, block = parse_record(data)
        refers_to = fields.get("X-Refers-To-Page")
        if fields["WARC-Type"] == "response":
            payload = memoryview(block)[block.index(b"\r\n\r\n") + 4 :]
            size, digest = len(payload), hashlib.sha256(payload).hexdigest()
        else:
            size = int(fields["X-Payload-Length"])
            digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
        page = fields.get("X-Page")
        lines.append((
            url_key(fields["WARC-Target-URI"]), fields["WARC-Date"],
            None if page is None else int(page), fields["WARC-Type"],
            None if refers_to is None else int(refers_to), size, digest, run, place, length,
        ))
    return sorted(lines, key=line_order)


def line_order(line: tuple) -> tuple:
    page = line[2]
    return line[0], line[1], page is not None, page or 0, line[7], line[8]


def write_runs(spark: SparkSession, folder: str, archives: int) -> None:
    """Read every archive back, one per task, and write its index lines as a sorted run."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = locate(folder)
        for batch in batches:
            for part in batch.column(0).to_pylist():
                name = archive_name(part)
                with files.open_input_file(f"{path}/{name}") as file:
                    write_run(folder, run_name(0, part), index_lines(name, file), INDEX_ARROW)
                yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int64())})

    parts = spark.range(0, archives, 1, max(1, archives)).mapInArrow(run, "part long")
    if settle_count(parts) != archives:
        raise RuntimeError("not every archive was indexed")


def merged_index(spark: SparkSession, folder: str, archives: int) -> DataFrame:
    """All index lines in the order of URL key, time and id, merged from the runs of the archives."""
    return merge_runs(spark, folder, archives, line_order, INDEX_ARROW, INDEX_SCHEMA)


def archive_round_trip(pages: DataFrame) -> DataFrame:
    """Write all pages to archives in the shared folder and give the merged index of them."""
    spark = pages.sparkSession
    folder = fresh_dir(spark, "warc")
    archives = write_archives(captures(pages), folder)
    write_runs(spark, folder, archives)
    return merged_index(spark, folder, archives)
