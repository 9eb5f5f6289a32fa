import json
import os
import random
import time
from dataclasses import replace
from datetime import datetime, timedelta, timezone
from types import SimpleNamespace

import pytest
from conftest import as_message, event, purchase
from pyspark.sql import functions as F

from clickloom.operators import checkouts, dedup, keyed_streams, sessions, silver, state
from clickloom.operators.enrich import enrich
from clickloom.operators.routing import observe_routes, parse_messages, valid_events
from clickloom.options import JobOptions
from clickloom.plans import fixture
from clickloom.sources.messages import message_frame, read_file_stream, read_message_table, read_messages
from clickloom.sources.tables import read_table
from clickloom.streaming import job, metrics, sinks, state_rows
from clickloom.streaming.alert_writer import AlertFileWriter, AlertLogWriter
from clickloom.workspace import fresh_dir

START = datetime(2024, 1, 1, tzinfo=timezone.utc)


def at(minutes, **changes):
    stamp = (START + timedelta(minutes=minutes)).isoformat()
    return event(**{"event_type": "page_view", "event_timestamp": stamp, **changes})


@pytest.fixture
def folder(spark):
    return fresh_dir(spark, "stream-test")


@pytest.fixture
def options(folder):
    return JobOptions(
        source_format="parquet",
        source_path=f"{folder}/in",
        max_files_per_trigger=1,
        table_base=f"{folder}/tables",
        checkpoint_base=f"{folder}/checkpoints",
        shuffle_partitions=4,
    )


def drop_files(spark, path, *batches):
    """One file per batch, with arrival times that keep their order."""
    for payloads in batches:
        rows = [as_message(payload, i) for i, payload in enumerate(payloads)]
        add_file(message_frame(spark, rows), path)


def add_file(frame, path):
    frame.coalesce(1).write.mode("append").parquet(path)
    names = [n for n in os.listdir(path) if n.endswith(".parquet")]
    newest = max(names, key=lambda n: os.stat(f"{path}/{n}").st_mtime_ns)
    position = len(names)
    os.utime(f"{path}/{newest}", (1_700_000_000 + position, 1_700_000_000 + position))


def events_of(raw):
    return enrich(valid_events(parse_messages(raw)))


def run(stream, name, options):
    path = options.table(name)
    query = sinks.to_table(stream, name, path, options, available_now=True)
    query.awaitTermination()
    return read_table(stream.sparkSession, path), query


def test_file_source_gives_the_envelope(spark, options):
    drop_files(spark, options.source_path, [event(), "bad"])
    stream = read_messages(spark, options)
    assert stream.isStreaming
    assert stream.schema == read_message_table(spark, options.source_path).schema
    got, _ = run(stream, "copy", options)
    assert got.count() == 2


def test_late_rows_leave_the_cells_but_not_bronze(spark, options):
    # A batch drops rows below the watermark its predecessor ran with: 25 minutes
    # for the third batch.
    drop_files(
        spark,
        options.source_path,
        [at(0, event_id="a"), at(1, event_id="b"), at(30, event_id="c")],
        [at(60, event_id="d")],
        [at(2, event_id="late"), at(56, event_id="in time"), at(120, event_id="e")],
    )
    events = events_of(read_messages(spark, options))
    cells, query = run(silver.stream_cells(events), "cells", options)
    starts = {
        int((r.window_start - datetime(1970, 1, 1)).total_seconds() // 60)
        - int(START.timestamp() // 60): r.event_count
        for r in cells.withColumn("window_start", F.col("window_start").cast("timestamp_ntz")).collect()
    }
    assert starts == {0: 1, 1: 1, 30: 1, 56: 1, 60: 1}
    reports = metrics.progress_frame(spark, [query])
    assert reports.agg(F.sum("late_rows_dropped")).first()[0] > 0
    bronze, _ = run(events, "bronze", options)
    assert bronze.count() == 7


def test_cells_are_complete_across_batches(spark, options):
    """A window fed by several micro-batches is written once, with exact counts."""
    users = ["U-1", "U-2", "U-1", "U-3"]
    first = [at(0, event_id=f"a{i}", user_id=u, session_id=f"S-{u}") for i, u in enumerate(users)]
    second = [at(0, event_id=f"b{i}", user_id=u, session_id=f"S-{u}x") for i, u in enumerate(users)]
    drop_files(spark, options.source_path, first, second, [at(20, event_id="z")], [at(40, event_id="y")])
    cells, _ = run(silver.stream_cells(events_of(read_messages(spark, options))), "cells", options)
    row = cells.filter("event_count > 1").collect()
    assert [(r.event_count, r.unique_users, r.unique_sessions) for r in row] == [(8, 3, 6)]


@pytest.mark.parametrize("width, step", [("1 minute", None), ("5 minutes", "1 minute")])
def test_stream_cells_equal_batch_cells(spark, options, width, step):
    rng_minutes = [i * 7 % 90 for i in range(200)]
    payloads = [
        (purchase if i % 3 == 0 else event)(
            event_id=f"e{i}",
            event_timestamp=(START + timedelta(minutes=m, seconds=i % 60)).isoformat(),
            user_id=f"U-{i % 9}",
            session_id=f"S-{i % 13}",
            product_id=f"P-{i % 5}",
        )
        for i, m in enumerate(rng_minutes)
    ]
    drop_files(spark, options.source_path, payloads)
    # A fixed clock, or the lag columns would differ.
    clock = F.lit("2024-01-01 03:00:00").cast("timestamp")

    def events(raw):
        return enrich(valid_events(parse_messages(raw), clock))

    got, _ = run(
        silver.stream_cells(events(read_messages(spark, options)), width, step), "cells", options
    )
    table = events(read_message_table(spark, options.source_path))
    whole = silver.sliding_cells(table, width, step) if step else silver.batch_cells(table, width)
    newest = table.agg(F.max("event_ts") - F.expr("interval 5 minutes")).first()[0]
    want = whole.filter(F.col("window_end") <= F.lit(newest))
    assert sorted(got.collect()) == sorted(want.collect()) and got.count() > 50

    approx, _ = run(
        silver.stream_cells_approx(events(read_messages(spark, options)), width, step, error=0.01),
        "approx",
        options,
    )
    keys = ["window_start", "event_type", "event_date", "device_type", "funnel_stage"]
    far = F.abs(F.col("a.unique_users") - F.col("b.unique_users")) > 1
    both = approx.alias("a").join(got.alias("b"), keys)
    assert both.count() == got.count() and both.filter(far).count() == 0


def enriched_at_three(raw):
    """Events by a fixed clock, or the lag columns of two runs would differ."""
    clock = F.lit("2024-01-01 03:00:00").cast("timestamp")
    return enrich(valid_events(parse_messages(raw), clock))


@pytest.mark.parametrize("width, step", [("5 minutes", "1 minute"), ("5 minutes", "2 minutes")])
def test_sliding_stream_cells_equal_a_row_per_window_and_value(spark, options, width, step):
    """Values that come again, before and after, in files minutes late: some windows take them."""
    rng = random.Random(width + step)
    batches = [
        [
            (purchase if i % 7 == 0 else event)(
                event_id=f"e{batch}-{i}",
                event_timestamp=(START + timedelta(minutes=6 * batch, seconds=-rng.randrange(1_800))).isoformat(),
                user_id=f"U-{rng.randrange(6)}",
                session_id=rng.choice(["S-1", "S-2", "\u00e9 \"S\"\n1"]),
                product_id=rng.choice([None, "P-1", "", "P-2"]),
                device_type=rng.choice([None, "mobile"]),
            )
            for i in range(30)
        ]
        for batch in range(9)
    ]
    drop_files(spark, options.source_path, *batches)
    stream = enriched_at_three(read_messages(spark, options))
    got, query = run(silver.stream_cells(stream, width, step), "cells", options)
    assert len(query.recentProgress) >= 9
    facts = silver._facts(stream.withWatermark("event_ts", "5 minutes"))
    window = F.window("event_ts", width, step)
    values = silver._merge_facts(facts.groupBy(window, *silver.CELL_KEYS, "kind", "item"))
    plain = silver.finished(silver._count_facts(values.groupBy("window", *silver.CELL_KEYS)))
    want, _ = run(plain, "plain", options)

    def rows(frame):
        return sorted(frame.collect(), key=str)

    assert rows(got) == rows(want) and got.count() > 50
    table = enriched_at_three(read_message_table(spark, options.source_path))
    whole = silver.sliding_cells(table, width, step)
    taken = got.agg(F.sum("event_count")).first()[0]
    closed = whole.join(got, "window_start", "left_semi").agg(F.sum("event_count")).first()[0]
    assert 0 < taken < closed  # some came too late


def test_sliding_stream_state_grows_with_cells_not_with_values(spark, options):
    """A row per cell and window, and the panes of all values in a fixed number of rows."""
    hot = [at(0, event_id=f"e{i}", user_id=f"U-{i}", session_id=f"S-{i}") for i in range(1_500)]
    drop_files(spark, options.source_path, hot, hot, [at(60, event_id="z")])
    events = events_of(read_messages(spark, options))
    cells, query = run(silver.stream_cells(events, "5 minutes", "1 minute"), "cells", options)
    first = [r for r in query.recentProgress if r["numInputRows"]][0]
    assert sum(op["numRowsTotal"] for op in first["stateOperators"]) <= 5 + 256
    counts = cells.select("event_count", "unique_users", "unique_sessions", "unique_products_viewed")
    assert [tuple(r) for r in counts.collect()] == 5 * [(3_000, 1_500, 1_500, 1)]


def test_sliding_stream_forgets_panes(spark, options):
    batches = [[at(60 * b, event_id=f"e{b}-{i}", session_id=f"S-{b}-{i}") for i in range(200)] for b in range(8)]
    drop_files(spark, options.source_path, *batches)
    events = events_of(read_messages(spark, options))
    run(silver.stream_cells(events, "5 minutes", "1 minute"), "cells", options)
    state = state_rows.state_rows(spark, options.checkpoint("cells"), 1)
    held = state.agg(F.sum(F.length("value.groupState.panes"))).first()[0] // 24
    assert 200 <= held < 4 * 200


def test_stream_sessions_equal_batch_sessions(spark, options):
    payloads = [at(m, event_id=f"e{m}-{u}", user_id=f"U-{u}") for u in range(4) for m in range(0, 600, 11 + 9 * u)]
    drop_files(spark, options.source_path, payloads)
    got, _ = run(sessions.stream_sessions(events_of(read_messages(spark, options))), "sessions", options)
    table = events_of(read_message_table(spark, options.source_path))
    newest = table.agg(F.max("event_ts") - F.expr("interval 5 minutes")).first()[0]
    want = sessions.batch_sessions(table).filter(F.col("session_end") <= F.lit(newest))
    assert sorted(got.collect()) == sorted(want.collect()) and got.count() > 3


def test_stream_dedup_over_batches(spark, options):
    once = [at(i, event_id=f"e{i}") for i in range(5)]
    hot = [at(3, event_id="hot") for _ in range(40)]
    drop_files(spark, options.source_path, [*once, *hot], [*once, at(6, event_id="new"), *hot])
    got, _ = run(dedup.dedup_stream(events_of(read_messages(spark, options))), "once", options)
    assert sorted(r.event_id for r in got.collect()) == sorted(["hot", "new", *(f"e{i}" for i in range(5))])


def arrivals(spark, path, *batches):
    """One file per batch of (event_id, minutes of event time or None)."""
    for batch in batches:
        rows = [(i, None if m is None else START + timedelta(minutes=m)) for i, m in batch]
        add_file(spark.createDataFrame(rows, "event_id string, event_ts timestamp"), path)


def followed(spark, path):
    schema = "event_id string, event_ts timestamp"
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def test_stream_dedup_loses_nothing_to_an_unreadable_time(spark, options):
    """Event times hours apart, falling, and one that is missing; each event twice."""
    files = [[(f"e{i}", -600 * i), ("bad", None)] for i in range(6)]
    arrivals(spark, options.source_path, *files, [(f"e{i}", -600 * i) for i in range(6)])
    got, _ = run(dedup.dedup_stream(followed(spark, options.source_path)), "once", options)
    assert sorted(r.event_id for r in got.collect()) == ["bad", *(f"e{i}" for i in range(6))]


def test_stream_dedup_forgets_keys(spark, options):
    """State holds what came within ``keep``, however many keys there were before."""
    rows = []
    for i in range(4):
        arrivals(spark, options.source_path, [(f"e{i}-{j}", 0) for j in range(100)])
        frame = dedup.dedup_stream(followed(spark, options.source_path), keep="1 second")
        _, query = run(frame, "once", options)
        rows.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
        time.sleep(2)
    assert rows[0] == 100 and max(rows) <= 200


@pytest.mark.parametrize("order", ["shuffled", "reversed in file", "ordered"])
def test_keyed_streams_equal_batch_state(spark, options, order):
    rng = random.Random(order)
    kinds = ["add_to_cart", "remove_from_cart", "checkout_start", "checkout_complete", "user_login",
             "user_logout", "page_view"]
    rows = [
        (f"e{i:04d}", rng.choice(kinds), START + timedelta(seconds=i * 20 + 0.0005 * (i % 3)),
         rng.choice(["U-1", "U-2", "U-hot"]), rng.choice(["S-1", "S-2", "S-hot"]),
         rng.choice([None, 3.5, 20.25, float("nan")]), rng.choice([None, 1, 4]))
        for i in range(300)
    ]
    schema = ("event_id string, event_type string, event_ts timestamp, user_id string, "
              "session_id string, price double, quantity int")  # fmt: skip
    sent = [rows[at : at + 50] for at in range(0, 300, 50)]
    for i, part in enumerate(sent):
        part = [*part, (f"no-time-{i}", "add_to_cart", None, "U-1", "S-1", 5.0, 1)]
        if order == "reversed in file":
            part.reverse()
        if order == "shuffled":
            rng.shuffle(part)
        add_file(spark.createDataFrame(part, schema), options.source_path)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(options.source_path)
    closed = rows[-1][2] - timedelta(minutes=5)
    batch = spark.createDataFrame(rows, schema)
    for on_stream, on_batch, key, column in (
        (keyed_streams.stream_cart, state.cart_state, "session_id", "running_cart"),
        (keyed_streams.stream_login, state.login_state, "user_id", "logged_in"),
    ):
        got, query = run(on_stream(stream), column, options)
        names = ["event_id", key, "event_type", "event_ts", column]
        want = on_batch(batch).filter(F.col("event_ts") < closed).select(names)
        assert sorted(map(tuple, got.select(names).collect())) == sorted(map(tuple, want.collect()))
        assert len(query.recentProgress) >= 6


def test_keyed_streams_forget_idle_keys(spark, options):
    schema = "event_id string, event_type string, event_ts timestamp, session_id string, price double, quantity int"
    for i, (session, minute) in enumerate([("S-a", 0), ("S-b", 10), ("S-b", 200), ("S-a", 210), ("S-c", 400)]):
        row = [(f"e{i}", "add_to_cart", START + timedelta(minutes=minute), session, 2.0, 1)]
        add_file(spark.createDataFrame(row, schema), options.source_path)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(options.source_path)
    got, _ = run(keyed_streams.stream_cart(stream, keep="60 minutes"), "cart", options)
    assert {r.event_id: r.running_cart for r in got.collect()} == {"e0": 2.0, "e1": 2.0, "e2": 2.0, "e3": 2.0}


def test_keyed_streams_keep_the_state_of_many_keys_in_few_rows(spark, options):
    schema = "event_id string, event_type string, event_ts timestamp, session_id string, price double, quantity int"
    for i in range(2):
        rows = [
            (f"e{i}-{n}", "add_to_cart", START + timedelta(minutes=10 * i), None if n == 5 else f"S-{n}", 2.0, 1)
            for n in range(2_000)
        ]
        add_file(spark.createDataFrame(rows, schema), options.source_path)
    last = [("z", "add_to_cart", START + timedelta(minutes=40), "S-z", 2.0, 1)]
    add_file(spark.createDataFrame(last, schema), options.source_path)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(options.source_path)
    got, query = run(keyed_streams.stream_cart(stream), "cart", options)
    shown = {(r.event_id, r.session_id): r.running_cart for r in got.collect()}
    assert shown == {
        (f"e{i}-{n}", None if n == 5 else f"S-{n}"): 2.0 + 2 * i for i in range(2) for n in range(2_000)
    }
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] <= keyed_streams.BUCKETS


def test_ordered_files_deal_a_part_over_many_tasks(spark, options):
    rows = spark.range(0, 150_000, 1, 1).withColumn("part", (F.col("id") % 3).cast("int"))
    text = lambda r: r.select(F.col("id").cast("string").alias("text"), "_part", "_file")
    path = f"{options.source_path}/in"
    files = fixture.ordered_files(rows.filter("part < 2"), F.col("part"), path, text)
    sizes = spark.read.parquet(path).groupBy(F.input_file_name(), "_part").count().collect()
    assert files > 1 and len(sizes) == 2 * files
    assert max(r["count"] for r in sizes) < 1.5 * fixture.ROWS_PER_FILE
    back = spark.read.parquet(path)
    assert back.agg(F.count("*"), F.countDistinct("text")).first()[:] == (100_000, 100_000)
    assert back.filter(F.col("text").cast("long") % 3 != F.col("_part")).count() == 0


def test_job_restarts_without_repeating(spark, options):
    first = [at(0, event_id="a"), purchase(event_id="p"), "bad", at(1, event_type="odd", event_id="o")]
    drop_files(spark, options.source_path, first)
    job.backfill(read_messages(spark, options), options)

    def counts():
        names = ("bronze", "corrupt_records", "rejected_records", "dead_letters", "silver_agg")
        return [read_table(spark, options.table(n)).count() for n in names]

    assert counts()[:4] == [2, 1, 1, 2]
    job.backfill(read_messages(spark, options), options)
    assert counts()[:4] == [2, 1, 1, 2]
    drop_files(spark, options.source_path, [at(200, event_id="b")])
    queries = job.backfill(read_messages(spark, options), options)
    assert counts()[:4] == [3, 1, 1, 2]
    assert {"bronze", "silver_agg", "alerts", "corrupt", "rejected"} <= set(queries)
    assert all(not s["active"] and s["exception"] is None for s in metrics.query_status(queries.values()))
    assert read_table(spark, options.bronze_path).columns[-1] == "event_date"
    assert "_written_at" in read_table(spark, options.silver_agg_path).columns


def test_analytics_from_bronze_equal_those_from_messages(spark, options, folder):
    payloads = [
        purchase(
            event_id=f"e{i}",
            event_timestamp=(START + timedelta(minutes=i * 3 + (300 if i > 100 else 0))).isoformat(),
            user_id=f"U-{i % 5}",
        )
        for i in range(150)
    ]
    drop_files(spark, options.source_path, [*payloads, "bad"])

    def run_job(**changes):
        o = replace(options, **changes)
        job.backfill(read_messages(spark, o), o)
        lag = ("_written_at", "avg_processing_lag_ms", "max_processing_lag_ms")
        return [
            sorted(read_table(spark, p).drop(*lag).collect(), key=str)
            for p in (o.silver_agg_path, o.silver_sessions_path)
        ]

    direct = run_job()
    layered = run_job(
        analytics_from_bronze=True,
        table_base=f"{folder}/tables2",
        checkpoint_base=f"{folder}/checkpoints2",
    )
    assert direct == layered and all(direct)


def test_analytics_follow_a_running_bronze_query(spark, options):
    drop_files(spark, options.source_path, [at(i, event_id=f"e{i}") for i in range(0, 90, 30)])
    o = replace(options, analytics_from_bronze=True, trigger_interval_secs=1)
    queries = job.start_all(read_messages(spark, o), o)
    try:
        queries["bronze"].processAllAvailable()
        queries["silver_agg"].processAllAvailable()
        assert read_table(spark, o.silver_agg_path).count() == 2
    finally:
        for query in queries.values():
            query.stop()


def test_processing_time_trigger(spark, options):
    drop_files(spark, options.source_path, [event()])
    query = sinks.write_bronze(events_of(read_messages(spark, options)), options)
    query.processAllAvailable()
    query.stop()
    assert read_table(spark, options.bronze_path).count() == 1


def file_writer(path):
    """A writer that keeps its alerts in files: the log of a worker is out of reach."""

    class FileWriter:
        def open(self, partition_id, epoch_id):
            os.makedirs(path, exist_ok=True)
            self.file = open(f"{path}/{partition_id}-{epoch_id}", "w")
            return True

        def process(self, row):
            self.file.write(row.alert_text + "\n")

        def close(self, error):
            self.file.close()

    return FileWriter()


def test_alert_writer_gets_high_value_purchases_only(spark, options, folder):
    drop_files(
        spark,
        options.source_path,
        [
            purchase(event_id="p1", order_id="ORD-1", cart_value=640.0),
            purchase(cart_value=5.0),
            event(cart_value=900.0),
        ],
    )
    events = events_of(read_messages(spark, options))
    sinks.write_alerts(events, options, True, file_writer(f"{folder}/seen")).awaitTermination()
    lines = [line for n in os.listdir(f"{folder}/seen") for line in open(f"{folder}/seen/{n}")]
    assert len(lines) == 1 and "order_id=ORD-1 " in lines[0]
    sinks.write_alert_table(events, options, available_now=True).awaitTermination()
    assert read_table(spark, options.alerts_path).first().order_id == "ORD-1"


def test_alert_log_writer(caplog):
    writer = AlertLogWriter()
    assert writer.open(0, 0)
    writer.process(SimpleNamespace(alert_text="ALERT"))
    writer.close(ValueError("lost"))
    writer.close(None)
    assert [r.getMessage() for r in caplog.records] == ["ALERT", "alert writer failed: lost"]


def test_alert_file_writer_replaces_and_leaves_no_halves(tmp_path):
    writer = AlertFileWriter(f"file:{tmp_path}/alerts")
    row = SimpleNamespace(event_id="e", alert_text="one\ntwo")
    for again in (1, 2):
        assert writer.open(3, 7)
        for _ in range(again):
            writer.process(row)
        writer.close(None)
    assert writer.open(4, 7)
    writer.process(row)
    writer.close(ValueError("lost"))
    assert writer.open(5, 7)
    writer.close(None)
    assert os.listdir(tmp_path / "alerts") == ["000000000007-000003.json"]
    lines = (tmp_path / "alerts" / "000000000007-000003.json").read_text().splitlines()
    assert [json.loads(line) for line in lines] == [{"event_id": "e", "alert_text": "one\ntwo"}] * 2


def test_progress_and_observed_routes(spark, options):
    drop_files(spark, options.source_path, [event(), "bad", event(event_type="odd")], [event()])
    routed = observe_routes(parse_messages(read_messages(spark, options)))
    _, query = run(routed.select("kafka_offset", "route"), "routes", options)
    rows = metrics.progress_frame(spark, [query]).orderBy("batch_id").collect()
    assert [r.input_rows for r in rows] == [3, 1]
    assert json.loads(rows[0].observed)["routes"] == {
        "total": 3,
        "valid": 1,
        "corrupt": 1,
        "rejected": 1,
    }
    assert rows[0].query == "routes" and "triggerExecution" in rows[0].duration_ms


def test_progress_log(caplog):
    caplog.set_level("INFO", logger="clickloom.metrics")
    report = {
        "id": "q",
        "runId": "r",
        "name": "bronze",
        "batchId": 3,
        "timestamp": "2024-01-01T00:00:00.000Z",
        "numInputRows": 10,
        "inputRowsPerSecond": "NaN",
        "processedRowsPerSecond": 20.0,
        "durationMs": {"addBatch": 5},
        "stateOperators": [{"numRowsDroppedByWatermark": 2, "numRowsTotal": 7}],
    }
    log = metrics.ProgressLog()
    log.onQueryStarted(SimpleNamespace(id="q", name="bronze"))
    log.onQueryProgress(SimpleNamespace(progress=SimpleNamespace(json=json.dumps(report))))
    log.onQueryIdle(SimpleNamespace())
    log.onQueryTerminated(SimpleNamespace(id="q", exception=None))
    log.onQueryTerminated(SimpleNamespace(id="q", exception="boom"))
    started, progress, ended, failed = caplog.records
    assert '"query": "bronze"' in started.getMessage()
    row = json.loads(progress.getMessage().removeprefix("query progress "))
    assert (row["batch_id"], row["late_rows_dropped"], row["state_rows"]) == (3, 2, 7)
    assert (ended.levelname, failed.levelname) == ("INFO", "ERROR")
    assert "boom" in failed.getMessage()


def test_kafka_sinks_need_the_connector(spark, options):
    """Without the Kafka jar the sinks fail when started, not before."""
    from pyspark.errors import AnalysisException

    drop_files(spark, options.source_path, [event()])
    events = events_of(read_file_stream(spark, options.source_path))
    try:
        sinks.write_kafka_events(events, options, "run", available_now=True).stop()
    except AnalysisException as missing:
        assert "kafka" in str(missing)


def test_checkouts_pair_and_time_out(spark, options):
    schema = "event_id string, event_type string, event_ts timestamp, session_id string, cart_value double"
    steps = [
        [("s1", "checkout_start", 0, "A"), ("s2", "checkout_start", 1, "B"), ("x", "page_view", 2, "B")],
        [("c1", "checkout_complete", 10, "A"), ("c0", "checkout_complete", 0, "C"), ("n", "checkout_start", None, "A")],
        [("s3", "checkout_start", 90, "A"), ("c3", "checkout_complete", 90, "A"), ("c4", "checkout_complete", 95, "A")],
        [("s5", "checkout_start", 200, "D"), ("c6", "checkout_complete", 200, "E")],
    ]
    for rows in steps:
        part = [(i, k, None if m is None else START + timedelta(minutes=m), s, 1.0) for i, k, m, s in rows]
        add_file(spark.createDataFrame(part, schema), options.source_path)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(options.source_path)
    got, _ = run(checkouts.stream_checkouts(stream, "30 minutes"), "checkouts", options)
    assert {(r.start_id, r.complete_id, r.abandoned) for r in got.collect()} == {
        ("s1", "c1", False), ("s2", None, True), ("s3", "c3", False), ("s3", "c4", False),
    }


def test_state_of_cells_can_be_read(spark, options):
    rows = [at(0, event_id="a"), at(0, event_id="b", user_id="U-2"), at(90, event_id="c")]
    drop_files(spark, options.source_path, rows[:2], rows[2:])
    run(silver.stream_cells(events_of(read_messages(spark, options)), "1 minute"), "cells", options)
    checkpoint = options.checkpoint("cells")
    left = state_rows.open_cells(spark, checkpoint).collect()
    assert [(r.state_rows, r.distinct_values) for r in left] == [(4, 3)]
    assert state_rows.operators_of(spark, checkpoint).count() == 2
