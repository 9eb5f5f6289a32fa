"""WARC archives: round trips and the merged index."""

import hashlib
import random
import zlib

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from clickloom.llm import run_merge, warc
from clickloom.workspace import fresh_dir

SCHEMA = "page_id long, url string, html string, key string, run string, payload string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "k", "r", "p") for r in rows], SCHEMA)


def expected(rows):
    first = {}
    for i, _, html in rows:
        if i is not None and len((html or "").encode()) >= 100:
            first[html] = min(i, first.get(html, i))
    out = []
    for i, _, html in rows:
        data = (html or "").encode()
        to = first.get(html) if len(data) >= 100 else None
        again = to is not None and to != i
        out.append((i, len(data), hashlib.sha256(data).hexdigest(),
                    "revisit" if again else "response", to if again else None))
    return sorted(out, key=repr)


def test_round_trip_of_awkward_pages(spark, monkeypatch):
    monkeypatch.setattr(warc, "FILE_BYTES", 2000)
    long = "<p>a repeated page</p>" * 20
    trap = "x" * 100 + "\r\n\r\n\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    rows = [
        (5, "http://b.example/x?q=1", long), (3, "https://www.b.example/x?q=1", long), (9, None, long),
        (1, "http://a.example\r\nX-Page: 77", trap), (2, "not a url [", trap), (4, "", None),
        (6, "http://c.example", ""), (7, "http://c.example", "short"), (8, "http://c.example", "short"),
        (None, "http://d.example", long), (10, "http://ü.example/ä", "é" * 60), (11, "u", "é" * 60),
        (12, "http://a.example", "﻿ \x00 odd \U0001f600" * 9),
    ]
    got = warc.archive_round_trip(pages(spark, rows)).collect()
    columns = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted((tuple(r[c] for c in columns) for r in got), key=repr) == expected(rows)
    assert warc.archive_round_trip(pages(spark, [])).count() == 0


@pytest.mark.parametrize("fan_in", [64, 3])
def test_index_is_in_global_order(spark, monkeypatch, fan_in):
    monkeypatch.setattr(warc, "FILE_BYTES", 6000)
    monkeypatch.setattr(run_merge, "FAN_IN", fan_in)
    monkeypatch.setattr(run_merge, "RANGE_LINES", 30)
    monkeypatch.setattr(run_merge, "BATCH_LINES", 7)
    rng = random.Random(3)
    rows = [(i, f"http://h{rng.randint(0, 3)}.example/{rng.randint(0, 5)}", "x" * rng.randint(0, 300)) for i in range(200)]
    folder = fresh_dir(spark, "warc-test")
    archives = warc.write_archives(warc.captures(pages(spark, rows)), folder)
    assert archives > 9
    warc.write_runs(spark, folder, archives)
    merged = warc.merged_index(spark, folder, archives)
    assert merged.rdd.getNumPartitions() > 3
    lines = [tuple(r) for r in merged.collect()]
    assert lines == sorted(lines, key=warc.line_order)
    assert sorted(x[2] for x in lines) == list(range(200))
    for line in lines[::20]:
        fields, block = warc.read_record(folder, *line[7:10])
        assert fields["X-Page"] == str(line[2])
        assert fields["WARC-Type"] == line[3]
        if line[3] == "response":
            assert block.endswith(b"\r\n\r\n" + rows[line[2]][2].encode())


def test_one_url_with_most_captures_is_spread(spark, monkeypatch):
    monkeypatch.setattr(warc, "FILE_BYTES", 20_000)
    monkeypatch.setattr(run_merge, "RANGE_LINES", 50)
    rows = [(i, "http://hot.example/" if i % 10 else None, f"p{i}") for i in range(600)]
    folder = fresh_dir(spark, "warc-test")
    archives = warc.write_archives(warc.captures(pages(spark, rows)), folder)
    warc.write_runs(spark, folder, archives)
    merged = warc.merged_index(spark, folder, archives)
    sizes = merged.groupBy(F.spark_partition_id()).count().toPandas()["count"]
    assert sizes.sum() == 600 and sizes.max() <= 150


def write_runs(folder, runs):
    for i, run in enumerate(runs):
        run_merge.write_run(folder, run_merge.run_name(0, i), run, warc.INDEX_ARROW)


def index_line(key, second, page, run, place):
    return key, str(second), page, "response", None, 0, "", run, place, 1


def random_runs(rng, n, most):
    return [
        sorted(
            (index_line(rng.choice("abc"), rng.randint(0, 9), rng.choice([None, 1, 2]), f"r{k}", i)
             for i in range(rng.randint(0, most))),
            key=warc.line_order,
        )
        for k in range(n)
    ]


def test_loser_tree_merges_like_sorting():
    rng = random.Random(8)
    for n in (1, 2, 3, 5, 8, 13):
        runs = random_runs(rng, n, 20)
        merged = list(run_merge.LoserTree(runs, warc.line_order))
        assert merged == sorted((x for run in runs for x in run), key=warc.line_order)
    assert list(run_merge.LoserTree([], warc.line_order)) == []


def test_slices_of_runs_hold_each_line_once(tmp_path, monkeypatch):
    monkeypatch.setattr(run_merge, "BATCH_LINES", 4)
    rng = random.Random(5)
    runs = random_runs(rng, 6, 40)
    folder = f"file:{tmp_path}"
    write_runs(folder, runs)
    names = [run_merge.run_name(0, i) for i in range(len(runs))]
    everything = sorted((x for run in runs for x in run), key=warc.line_order)
    files, path = run_merge.locate(folder)
    opened = [run_merge.RunFile(files, f"{path}/{n}", warc.line_order) for n in names]
    fences = [fence for run in opened for fence in run.fences()]
    assert sum(n for _, n in fences) == len(everything)
    for ranges in (1, 2, 7, 1000):
        bounds = [None, *run_merge.cuts(fences, warc.line_order, ranges), None]
        assert len(bounds) <= ranges + 1
        got = [
            list(run_merge.merged_lines(folder, names, warc.line_order, low, high))
            for low, high in zip(bounds, bounds[1:])
        ]
        assert [x for part in got for x in part] == everything


def test_a_merge_holds_one_batch_of_each_run(tmp_path, monkeypatch):
    """While lines are taken one by one, no run is ever more than a batch ahead."""
    monkeypatch.setattr(run_merge, "BATCH_LINES", 5)
    runs = [[index_line("k", f"{i:04d}", i, f"r{k}", i) for i in range(k, 400, 4)] for k in range(4)]
    write_runs(f"file:{tmp_path}", runs)
    read = []
    plain = run_merge.RunFile._lines
    monkeypatch.setattr(run_merge.RunFile, "_lines", staticmethod(lambda b: read.append(b.num_rows) or plain(b)))
    names = [run_merge.run_name(0, i) for i in range(4)]
    taken = 0
    for _ in run_merge.merged_lines(f"file:{tmp_path}", names, warc.line_order):
        taken += 1
        assert sum(read) - taken <= 4 * 5
    assert taken == 400


def test_a_cut_archive_is_an_error(tmp_path):
    packed = zlib.compress(b"WARC/1.1\r\nContent-Length: 2\r\n\r\nab\r\n\r\n", wbits=31)
    found = list(warc.members(pa.BufferReader(packed + packed)))
    assert [(at, n) for at, n, _ in found] == [(0, len(packed)), (len(packed), len(packed))]
    assert warc.parse_record(found[1][2]) == ({"Content-Length": "2"}, b"ab")
    with pytest.raises(ValueError):
        list(warc.members(pa.BufferReader(packed + packed[:-3])))
