"""One query per operator, over the test tables.

Timestamps leave as TIMESTAMP_NTZ in UTC. Streaming queries read the table as a
stream, write to a new folder below the shared one, and return the folder read
back as a table.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.functions.columns import category_url, page_url
from clickloom.operators import dedup, serialize, silver, totals
from clickloom.operators.alerts import high_value_purchases
from clickloom.operators.catalog import lookup
from clickloom.operators.checkouts import stream_checkouts
from clickloom.operators.enrich import enrich
from clickloom.operators.frequent import most_frequent
from clickloom.operators.keyed_streams import stream_cart, stream_login
from clickloom.operators.quality import quality_report
from clickloom.operators.quality_growing import report_of_summaries, summarise_new_dates
from clickloom.operators.rollups import (
    estimated_cells,
    event_cube,
    merged_cells,
    sketched_cells,
)
from clickloom.operators.routing import (
    corrupt_records,
    dead_letters,
    observe_routes,
    parse_messages,
    rejected_records,
    routing_counts,
    valid_events,
    with_route,
)
from clickloom.operators.sessions import batch_sessions, stream_sessions
from clickloom.operators.state import cart_state, login_state
from clickloom.options import JobOptions
from clickloom.plans import fixture
from clickloom.session import prepare
from clickloom.sources.tables import read_table, write_bucketed, write_table
from clickloom.streaming import job, metrics, sinks, state_rows
from clickloom.streaming.alert_writer import AlertFileWriter, shared_files
from clickloom.workspace import fresh_dir

# The test events are 12 hours to days apart per user; sessions use this gap.
TEST_GAP = "12 hours"
RUN_ID = "backfill"
_STAMP = "yyyy-MM-dd HH:mm:ss"
MAX_USERS = 500
PART_TYPES = ("ECONOMY", "LARGE", "MEDIUM")

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    """Register a query under ``name``."""

    def register(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return _plain_times(build(prepare(spark), sf_dir))

        QUERIES[name] = run
        return run

    return register


# --- Shared inputs ---------------------------------------------------------------


def _flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture.clicks(fixture.events_table(spark, sf_dir))


def _parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_messages(fixture.messages(_flat(spark, sf_dir)))


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid, enriched events by way of the messages."""
    return enrich(valid_events(_parsed(spark, sf_dir), fixture.clock()))


def _message_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture.messages(fixture.clicks(fixture.events_stream(spark, sf_dir)))


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich(valid_events(parse_messages(_message_stream(spark, sf_dir)), fixture.clock()))


def _plain_times(frame: DataFrame) -> DataFrame:
    zoned = [name for name, kind in frame.dtypes if kind == "timestamp"]
    return frame.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned}) if zoned else frame


def _run_options(spark: SparkSession, name: str) -> JobOptions:
    folder = fresh_dir(spark, name)
    return JobOptions(
        source_format="parquet",
        source_path=folder,
        table_base=f"{folder}/tables",
        checkpoint_base=f"{folder}/checkpoints",
    )


def _drain(stream: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Run a stream over all that is there and read back what it wrote."""
    spark = stream.sparkSession
    options = _run_options(spark, name)
    path = options.table(name)
    sinks.to_table(stream, name, path, options, partition_by, available_now=True).awaitTermination()
    return read_table(spark, path)


# --- Parsing, routing, enrichment --------------------------------------------------


@query("parse_valid")
def _parse_valid(spark, sf_dir):
    return valid_events(_parsed(spark, sf_dir), fixture.clock())


@query("corrupt_records")
def _corrupt(spark, sf_dir):
    records = corrupt_records(_parsed(spark, sf_dir), fixture.clock())
    # The text of an event differs between engines; its event type does not.
    # The digest is of the whole text if it is no JSON, else of some of its fields.
    fields = [F.get_json_object("raw_json", f"$.{c}") for c in ("user_id", "session_id", "ip_address")]
    whole = F.when(fields[0].isNull(), F.col("raw_json")).otherwise(F.concat_ws("|", *fields))
    return records.select(
        F.md5(whole.cast("binary")).alias("raw_digest"),
        F.get_json_object("raw_json", "$.event_type").alias("event_type"),
        (F.col("raw_json") == "not json {{").alias("is_broken"),
        "kafka_timestamp",
        "partition",
        "offset",
        "_corrupt_ts",
    )


@query("rejected_records")
def _rejected(spark, sf_dir):
    return rejected_records(_parsed(spark, sf_dir), fixture.clock()).drop("raw_json")


@query("routing_counts")
def _routes(spark, sf_dir):
    return routing_counts(_parsed(spark, sf_dir))


@query("route_by_reason")
def _route_by_reason(spark, sf_dir):
    parsed = with_route(_parsed(spark, sf_dir))
    return parsed.groupBy("route", "reject_reason").agg(F.count("*").alias("messages"))


@query("enrich_events")
def _enrich_events(spark, sf_dir):
    return _events(spark, sf_dir)


@query("page_urls")
def _page_urls(spark, sf_dir):
    products = fixture.catalog(spark, sf_dir)
    events = lookup(_flat(spark, sf_dir), products)
    return events.select(
        "event_id",
        "event_type",
        page_url().alias("built_url"),
        category_url(F.concat("catalog_category", F.lit(" "), "catalog_name")).alias("category_url"),
    )


# --- Aggregates ------------------------------------------------------------------


@query("silver_agg_1m")
def _silver_agg_1m(spark, sf_dir):
    return silver.batch_cells(_events(spark, sf_dir), "1 minute")


@query("silver_agg_6h")
def _silver_agg_6h(spark, sf_dir):
    return silver.batch_cells(_events(spark, sf_dir), "6 hours")


@query("sliding_5m")
def _sliding_5m(spark, sf_dir):
    return silver.sliding_cells(_events(spark, sf_dir), "5 minutes", "1 minute")


@query("sliding_5m_2m")
def _sliding_5m_2m(spark, sf_dir):
    """A width that is no multiple of the step."""
    return silver.sliding_cells(_events(spark, sf_dir), "5 minutes", "2 minutes")


@query("sliding_12h")
def _sliding_12h(spark, sf_dir):
    return silver.sliding_cells(_events(spark, sf_dir), "12 hours", "3 hours")


@query("sessions")
def _sessions(spark, sf_dir):
    return batch_sessions(_events(spark, sf_dir), TEST_GAP)


@query("sessions_30m")
def _sessions_30m(spark, sf_dir):
    return batch_sessions(_events(spark, sf_dir))


@query("totals_by_type_date")
def _totals_by_type_date(spark, sf_dir):
    return totals.totals_by_type_and_date(_events(spark, sf_dir))


@query("grand_total")
def _grand_total(spark, sf_dir):
    return totals.grand_total(_events(spark, sf_dir))


@query("event_type_share")
def _event_type_share(spark, sf_dir):
    return totals.event_type_share(_events(spark, sf_dir))


@query("top_event_type")
def _top_event_type(spark, sf_dir):
    return totals.top_event_type(_events(spark, sf_dir))


@query("sessions_per_user")
def _sessions_per_user(spark, sf_dir):
    return totals.sessions_per_user(_events(spark, sf_dir))


def _rolled_up(spark, sf_dir, widths: list[str]) -> DataFrame:
    """Cells of the last width, each width from the table of the one before it.

    Of the distinct counts, whether they are within three standard errors.
    """
    folder = fresh_dir(spark, "rollup")
    cells = sketched_cells(_events(spark, sf_dir), "1 minute")
    for width in widths:
        path = f"{folder}/{width.replace(' ', '_')}"
        write_table(cells, path)
        cells = merged_cells(read_table(spark, path), width)
    found, names = estimated_cells(cells), silver.DISTINCT_COUNTS
    keys = (*silver.CELL_KEYS, "window_start")
    exact = silver.batch_cells(_events(spark, sf_dir), widths[-1])
    exact = exact.select(*keys, *(F.col(c).alias(f"exact_{c}") for c in names))
    return found.join(exact, list(keys)).select(
        *(c for c in found.columns if c not in names),
        *((F.abs(F.col(c) - F.col(f"exact_{c}")) <= 0.05 * F.col(f"exact_{c}")).alias(f"{c}_near")
          for c in names),
    )


@query("rollup_hours")
def _rollup_hours(spark, sf_dir):
    return _rolled_up(spark, sf_dir, ["1 hour"])


@query("rollup_days")
def _rollup_days(spark, sf_dir):
    """Days from hours from minutes."""
    return _rolled_up(spark, sf_dir, ["1 hour", "1 day"])


@query("event_cube")
def _event_cube(spark, sf_dir):
    return event_cube(_events(spark, sf_dir)).withColumn("grouping", F.col("grouping").cast("int"))


@query("top_products")
def _top_products(spark, sf_dir):
    return most_frequent(_events(spark, sf_dir), "product_id", 20)


@query("top_sessions")
def _top_sessions(spark, sf_dir):
    """Values far more than counters, none of them frequent."""
    return most_frequent(_events(spark, sf_dir), "session_id", 20, counters=50)


def _bucketed(spark, sf_dir) -> DataFrame:
    name = f"bronze_{uuid.uuid4().hex}"
    path = f"{fresh_dir(spark, 'bucketed')}/bronze"
    return write_bucketed(_events(spark, sf_dir), name, path, buckets=8)


@query("bucketed_sessions")
def _bucketed_sessions(spark, sf_dir):
    return batch_sessions(_bucketed(spark, sf_dir), TEST_GAP)


@query("bucketed_sessions_per_user")
def _bucketed_sessions_per_user(spark, sf_dir):
    return totals.sessions_per_user(_bucketed(spark, sf_dir))


# --- Alerts, tables, duplicates ----------------------------------------------------


@query("high_value_alerts")
def _high_value_alerts(spark, sf_dir):
    return high_value_purchases(_events(spark, sf_dir), 500.0)


@query("bronze_read")
def _bronze_read(spark, sf_dir):
    """Write the bronze table, then read it back by path."""
    path = f"{fresh_dir(spark, 'bronze_read')}/bronze"
    write_table(_events(spark, sf_dir), path)
    return read_table(spark, path)


@query("silver_read")
def _silver_read(spark, sf_dir):
    path = f"{fresh_dir(spark, 'silver_read')}/silver_agg"
    cells = silver.batch_cells(_events(spark, sf_dir), "1 minute")
    write_table(cells, path, ("event_date", "event_type"))
    return read_table(spark, path)


@query("dedup_events")
def _dedup_events(spark, sf_dir):
    delivered = fixture.with_resent(_flat(spark, sf_dir))
    return dedup.dedup_batch(delivered, order=["delivery"]).select(
        "event_id", "event_type", "user_id", "event_ts", "delivery"
    )


def _dated(flat: DataFrame) -> DataFrame:
    return flat.select(
        "event_id",
        "event_type",
        "user_id",
        "cart_value",
        F.lit(1).alias("version"),
        F.to_date("event_ts").alias("event_date"),
    )


def _corrections(flat: DataFrame) -> DataFrame:
    """Resent events as corrections, the odd ones older than what is stored."""
    resent = flat.filter("resent").withColumns(
        {
            "version": F.when(F.col("n") % 2 == 1, 0).otherwise(2),
            "event_type": F.lit("corrected"),
        }
    )
    return resent.select(
        "event_id", "event_type", "user_id", "cart_value", "version",
        F.to_date("event_ts").alias("event_date"),
    )


@query("upsert_latest")
def _upsert_latest(spark, sf_dir):
    """Target and corrections merged; per key the newest version stays."""
    flat = _flat(spark, sf_dir)
    return dedup.upsert(_dated(flat), _corrections(flat), ["event_id"], "version")


@query("upsert_into_table")
def _upsert_into_table(spark, sf_dir):
    """The same merge in place, applied twice: the second time changes nothing.

    Some events have no date, and the corrections bring a column of their own.
    """
    flat = _flat(spark, sf_dir)
    undated = F.when(F.substring("event_id", -1, 1) != "3", F.col("event_date"))
    path = f"{fresh_dir(spark, 'upsert')}/events"
    write_table(_dated(flat).withColumn("event_date", undated), path)
    fixes = _corrections(flat).withColumn("event_date", undated).withColumn("fixed_by", F.lit("ops"))
    apply = dedup.upsert_each_batch(path, order="version")
    for batch_id in (0, 1):
        apply(fixes, batch_id)
    return read_table(spark, path)


# --- State and lookup --------------------------------------------------------------


@query("cart_state")
def _cart_states(spark, sf_dir):
    return cart_state(_events(spark, sf_dir)).select(
        "event_id", "session_id", "event_type", "event_ts", "running_cart"
    )


@query("login_state")
def _login_states(spark, sf_dir):
    return login_state(_events(spark, sf_dir)).select(
        "event_id", "user_id", "event_type", "event_ts", "logged_in"
    )


@query("catalog_lookup")
def _catalog_lookup(spark, sf_dir):
    found = lookup(_flat(spark, sf_dir), fixture.doubled_catalog(spark, sf_dir))
    return found.select(
        "event_id", "product_id", "catalog_name", "catalog_category", "catalog_price"
    )


@query("catalog_lookup_large")
def _catalog_lookup_large(spark, sf_dir):
    """The lookup as planned for a catalog above the broadcast bound."""
    products = fixture.doubled_catalog(spark, sf_dir)
    found = lookup(_flat(spark, sf_dir), products, max_rows=0)
    return found.select(
        "event_id", "product_id", "catalog_name", "catalog_category", "catalog_price"
    )


# --- Messages ----------------------------------------------------------------------


def _wire(flat: DataFrame) -> DataFrame:
    return flat.withColumn("event_timestamp", fixture.event_timestamp())


@query("json_round_trip")
def _json_round_trip(spark, sf_dir):
    back = serialize.round_trip(_wire(_flat(spark, sf_dir)))
    return back.select(
        F.col("event_id").alias("sent_id"),
        *(F.col(f"parsed_back.{c}").alias(c) for c in fixture.WIRE_FIELDS),
        F.size(F.json_object_keys("event_json")).alias("fields_sent"),
    )


def _header(name: str):
    found = F.filter("headers", lambda h: h["key"] == name)
    return found[0]["value"].cast("string")


@query("kafka_rows")
def _kafka_rows(spark, sf_dir):
    rows = serialize.kafka_rows(_wire(_flat(spark, sf_dir)), RUN_ID)
    text = F.col("value").cast("string")
    return rows.select(
        F.col("key").cast("string").alias("message_key"),
        F.get_json_object(text, "$.event_id").alias("event_id"),
        F.get_json_object(text, "$.cart_value").cast("double").alias("cart_value"),
        _header("event_type").alias("header_event_type"),
        _header("producer_run_id").alias("header_run_id"),
        _header("schema_version").alias("header_version"),
        F.size("headers").alias("header_count"),
    )


@query("dlq_rows")
def _dlq_rows(spark, sf_dir):
    letters = dead_letters(_parsed(spark, sf_dir))
    text = F.col("value").cast("string")
    return letters.select(
        F.col("key").cast("string").alias("message_key"),
        F.get_json_object(text, "$.event_id").alias("event_id"),
        F.get_json_object(text, "$.event_type").alias("event_type"),
        (text == "not json {{").alias("is_broken"),
    )


# --- Quality -----------------------------------------------------------------------


def _quality_input(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """The delivered events, duplicates and unknown types included, and the catalog.

    Products and categories come from the catalog, and sound ids become UUIDs, so
    that most rules have events on both sides.
    """
    products = fixture.catalog(spark, sf_dir)
    digest = F.md5(F.col("event_id").cast("binary"))
    parts = [F.substring(digest, start, n) for start, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    delivered = lookup(_wire(fixture.with_resent(_flat(spark, sf_dir))), products)
    spoiled = {
        name: F.when(F.col("n") % 20 == at, wrong).otherwise(F.col(name)).alias(name)
        for name, (at, wrong) in {
            "device_type": (5, F.lit("tv")),
            "page_url": (6, F.lit("")),
            "price": (7, -F.col("price")),
            "cart_value": (8, -F.col("cart_value")),
            "quantity": (9, F.col("quantity") + 9),
            "payment_method": (10, F.lit("cash")),
            "search_query": (11, F.lit("")),
        }.items()
    }
    wire = delivered.select(
        "n",
        F.to_date("event_ts").alias("event_date"),
        *(
            spoiled.get(c, c)
            for c in fixture.WIRE_FIELDS
            if c not in ("event_id", "user_id", "session_id")
        ),
        F.when(F.col("fault").isNull(), F.concat_ws("-", *parts))
        .otherwise(F.col("event_id"))
        .alias("event_id"),
        F.when(F.col("fault").eqNullSafe("no_user_id"), "").otherwise(F.col("user_id")).alias("user_id"),
        F.when(~F.col("fault").eqNullSafe("no_session_id"), F.col("session_id")).alias("session_id"),
        F.when(F.col("fault").eqNullSafe("broken_json"), "yesterday")
        .otherwise(F.col("event_timestamp"))
        .alias("event_timestamp"),
        F.col("catalog_name").alias("product_name"),
        F.when(F.col("n") % 20 == 12, "OTHER").otherwise(F.col("catalog_category")).alias("category"),
    )
    # Some of the texts are cut off, some have a field without a value.
    text = serialize.event_json()
    sent = (
        F.when(F.col("n") % 20 == 13, F.substring(text, 1, 5))
        .when(F.col("n") % 20 == 14, F.concat(F.lit('{"no_field":null,'), F.substr(text, F.lit(2))))
        .otherwise(text)
    )
    return wire.withColumn("event_json", sent), products


@query("quality_report")
def _quality(spark, sf_dir):
    """All rules over the delivered events."""
    events, products = _quality_input(spark, sf_dir)
    return quality_report(events, products, MAX_USERS, PART_TYPES)


@query("quality_growing")
def _quality_growing(spark, sf_dir):
    """The same report from summaries of dates, the last two appended and read on their own."""
    events, products = _quality_input(spark, sf_dir)
    folder = fresh_dir(spark, "quality")
    table, summary = f"{folder}/events", f"{folder}/summary"
    last = events.agg(F.max("event_date")).first()[0]
    late = F.col("event_date") > F.date_sub(F.lit(last), 2)
    for part in (events.filter(~late), events.filter(late)):
        write_table(part, table)
        summarise_new_dates(spark, table, summary, products, PART_TYPES)
    return report_of_summaries(spark, summary, MAX_USERS, PART_TYPES)


# --- Streams -----------------------------------------------------------------------


@query("stream_silver_append")
def _stream_silver_append(spark, sf_dir):
    options = _run_options(spark, "silver_agg")
    cells = silver.stream_cells(_event_stream(spark, sf_dir), "1 minute")
    sinks.write_silver_agg(cells, options, available_now=True).awaitTermination()
    return read_table(spark, options.silver_agg_path).drop("_written_at")


@query("stream_silver_6h")
def _stream_silver_6h(spark, sf_dir):
    return _drain(silver.stream_cells(_event_stream(spark, sf_dir), "6 hours"), "silver_6h")


@query("stream_silver_approx")
def _stream_silver_approx(spark, sf_dir):
    """The approximate cells; of the distinct counts, whether they are near the exact ones."""
    cells = silver.stream_cells_approx(_event_stream(spark, sf_dir), "6 hours")
    found = _drain(cells, "silver_approx")
    exact = silver.batch_cells(_events(spark, sf_dir), "6 hours")
    keys = (*silver.CELL_KEYS, "window_start")
    names = silver.DISTINCT_COUNTS
    exact = exact.select(*keys, *(F.col(c).alias(f"exact_{c}") for c in names))
    return found.join(exact, list(keys)).select(
        *(c for c in found.columns if c not in names),
        *((F.abs(F.col(c) - F.col(f"exact_{c}")) <= 1 + 0.2 * F.col(f"exact_{c}")).alias(f"{c}_near")
          for c in names),
    )


@query("stream_event_totals")
def _stream_event_totals(spark, sf_dir):
    """Running totals in complete mode, most frequent first.

    The memory sink holds the result in the driver: one row per event type, of
    which routing lets ten through.
    """
    options = _run_options(spark, "totals")
    counts = totals.event_type_counts(_event_stream(spark, sf_dir)).orderBy(F.desc("event_count"))
    name = f"event_totals_{uuid.uuid4().hex}"
    run = (
        sinks.sink(counts, name, options, available_now=True)
        .outputMode("complete")
        .format("memory")
        .start()
    )
    run.awaitTermination()
    return spark.table(name)


@query("stream_sliding")
def _stream_sliding(spark, sf_dir):
    cells = silver.stream_cells(_event_stream(spark, sf_dir), "5 minutes", "1 minute")
    return _drain(cells, "sliding")


@query("stream_sessions")
def _stream_sessions_12h(spark, sf_dir):
    return _drain(stream_sessions(_event_stream(spark, sf_dir), TEST_GAP), "sessions")


def _by_file(frame: DataFrame, part, name: str, made=lambda rows, *more: rows) -> DataFrame:
    """``frame`` as a stream of files in the order of ``part``, one per micro-batch.

    ``made`` gives what the files hold of the rows, with the columns named to it beside.
    """
    spark = frame.sparkSession
    path = f"{fresh_dir(spark, name)}/in"
    files = fixture.ordered_files(frame, part, path, lambda rows: made(rows, "_part", "_file"))
    reader = spark.readStream.schema(made(frame).schema).option("recursiveFileLookup", "true")
    return reader.option("maxFilesPerTrigger", files).parquet(path)


def _sent_by_file(flat: DataFrame, name: str) -> DataFrame:
    """The messages of click events as a stream of files by their ``part``."""
    return _by_file(flat, F.col("part"), name, fixture.messages)


@query("stream_dedup")
def _stream_dedup(spark, sf_dir):
    """Resent events over several files, some of them without a readable time.

    The second copy comes a file later if its first is at a file's end; here the
    copies of an event arrive within one file and the next.
    """
    flat = fixture.in_parts(spark, _flat(spark, sf_dir))
    unreadable = F.col("n") % 4 == 1
    delivered = fixture.with_resent(flat).withColumns(
        {
            "kafka_timestamp": F.col("event_ts").cast("timestamp"),
            "event_ts": F.when(~unreadable, F.col("event_ts").cast("timestamp")),
        }
    )
    again = F.col("part") + F.when(unreadable & (F.col("delivery") == 2), 1).otherwise(0)
    stream = _by_file(delivered, again, "dedup_files")
    once = dedup.dedup_stream(stream, position=["n", "delivery"])
    return _drain(once.select("event_id", "event_type", "user_id", "event_ts"), "dedup")


@query("stream_dedup_lag")
def _stream_dedup_lag(spark, sf_dir):
    """Copies over several files whose events lie hours behind their arrival, and out of order.

    Messages come in the order of a hash, so that event times jump back and forth
    over the whole month; some times cannot be read; the second copy of an event
    comes up to five files after the first. Everything stays at the defaults.
    """
    flat = _flat(spark, sf_dir)
    stamp = F.col("event_ts").cast("timestamp")
    unreadable = F.col("n") % 4 == 1
    came = F.pmod(F.xxhash64("n"), F.lit(8)).cast("int")
    delivered = fixture.with_resent(flat).withColumns(
        {
            "kafka_timestamp": stamp + F.expr("INTERVAL 7 HOURS"),
            "event_ts": F.when(~unreadable, stamp),
            "came": came + F.when(F.col("delivery") == 2, 1 + F.col("n") % 5).otherwise(0),
        }
    )
    stream = _by_file(delivered, F.col("came").cast("int"), "lag_files")
    once = dedup.dedup_stream(stream, position=["n", "delivery"])
    return _drain(once.select("event_id", "event_type", "user_id", "event_ts"), "dedup_lag")


def _events_by_file(spark, sf_dir, name: str) -> DataFrame:
    """Valid events as a stream of twelve files in the order of time."""
    flat = fixture.in_parts(spark, _flat(spark, sf_dir))
    return valid_events(parse_messages(_sent_by_file(flat, name)), fixture.clock())


@query("stream_cart")
def _stream_cart(spark, sf_dir):
    return _drain(stream_cart(_events_by_file(spark, sf_dir, "cart_files")), "cart")


@query("stream_login")
def _stream_login(spark, sf_dir):
    return _drain(stream_login(_events_by_file(spark, sf_dir, "login_files")), "login")


@query("stream_checkouts")
def _stream_checkouts(spark, sf_dir):
    events = _events_by_file(spark, sf_dir, "checkout_files")
    return _drain(stream_checkouts(events, "8 hours"), "checkouts")


def _late_cells(spark, sf_dir) -> DataFrame:
    """Cells over ordered files in which some events come three files late and are dropped.

    Spark drops by the watermark of the micro-batch before, which two files before
    the late one have moved past the event.
    """
    flat = fixture.in_parts(spark, _flat(spark, sf_dir))
    part = F.col("part") + F.when(F.expr(fixture.LATE), 3).otherwise(0)
    stream = _sent_by_file(flat.withColumn("part", part), "late_files")
    events = enrich(valid_events(parse_messages(stream), fixture.clock()))
    return silver.stream_cells(events, "1 minute")


@query("stream_late")
def _stream_late(spark, sf_dir):
    return _drain(_late_cells(spark, sf_dir), "late_cells")


@query("stream_state_left")
def _stream_state_left(spark, sf_dir):
    """What the state of the late cells holds in the end: the windows still open."""
    options = _run_options(spark, "state_left")
    run = sinks.to_table(
        _late_cells(spark, sf_dir), "cells", options.table("cells"), options, available_now=True
    )
    run.awaitTermination()
    return state_rows.open_cells(spark, options.checkpoint("cells"))


@query("stream_bronze")
def _stream_bronze(spark, sf_dir):
    return _drain(_event_stream(spark, sf_dir), "bronze", ("event_date",))


@query("stream_alerts")
def _stream_alerts(spark, sf_dir):
    return _drain(high_value_purchases(_event_stream(spark, sf_dir), 500.0), "alerts")


@query("stream_alert_writer")
def _stream_alert_writer(spark, sf_dir):
    """What the row writer of the alert sink was given, read from the files it wrote."""
    folder = fresh_dir(spark, "alert_files")
    files, path = shared_files(folder)
    files.create_dir(path, recursive=True)
    written = sinks.write_alerts(
        _event_stream(spark, sf_dir), _run_options(spark, "alert_writer"), True, AlertFileWriter(folder)
    )
    written.awaitTermination()
    return spark.read.schema("event_id string, alert_text string").json(folder)


@query("stream_lookup")
def _stream_lookup(spark, sf_dir):
    found = lookup(_event_stream(spark, sf_dir), fixture.catalog(spark, sf_dir))
    return _drain(found.select("event_id", "product_id", "catalog_name", "catalog_price"), "lookup")


@query("stream_job_from_bronze")
def _stream_job_from_bronze(spark, sf_dir):
    """The job with analytics fed by bronze, over many files with a small cap.

    One row per table: its rows, their events and a digest of what they say.
    """
    options = replace(_run_options(spark, "job_from_bronze"), analytics_from_bronze=True)
    flat = fixture.in_parts(spark, _flat(spark, sf_dir))
    job.backfill(_sent_by_file(flat, "job_files"), options)
    return _table_digests(spark, options, ("bronze", "silver_agg"))


def _table_digests(spark, options: JobOptions, names: tuple[str, ...] | None = None) -> DataFrame:
    """Per table of a job: rows, events (or amounts in cents), and what times and keys add up to."""
    text = {
        "bronze": ["event_id", "event_type", "user_id"],
        "corrupt": [F.col("offset").cast("string")],
        "rejected": ["reject_reason", "event_type"],
        "dead_letters": [F.col("key").cast("string")],
        "silver_agg": ["event_type", "device_type", "funnel_stage", F.date_format("window_start", _STAMP)],
        "silver_sessions": ["user_id", F.date_format("session_start", _STAMP), F.date_format("session_end", _STAMP)],
        "alerts": ["event_id", "order_id", "user_id"],
    }
    paths = {
        "bronze": options.bronze_path,
        "corrupt": options.corrupt_path,
        "rejected": options.rejected_path,
        "dead_letters": options.table("dead_letters"),
        "silver_agg": options.silver_agg_path,
        "silver_sessions": options.silver_sessions_path,
        "alerts": options.alerts_path,
    }
    frames = []
    for name in names or paths:
        table = read_table(spark, paths[name])
        counted = F.col("event_count") if "event_count" in table.columns else F.lit(1)
        # Seven hex digits of a digest per row: sums that differ if any row does.
        line = F.md5(F.concat_ws("|", *text[name]).cast("binary"))
        digest = F.conv(F.substring(line, 1, 7), 16, 10).cast("bigint")
        frames.append(
            table.agg(
                F.lit(name).alias("table_name"),
                F.count("*").alias("row_count"),
                F.coalesce(F.sum(counted), F.lit(0)).cast("bigint").alias("events"),
                F.coalesce(F.sum(digest), F.lit(0)).alias("digest"),
            )
        )
    return reduce(DataFrame.unionByName, frames)


@query("stream_job")
def _stream_job(spark, sf_dir):
    """Run the whole job twice on one checkpoint; what every table it wrote holds."""
    options = _run_options(spark, "job")
    for _ in range(2):
        job.backfill(_message_stream(spark, sf_dir), options)
        alerts = sinks.write_alert_table(_event_stream(spark, sf_dir), options, available_now=True)
        alerts.awaitTermination()
    return _table_digests(spark, options)


@query("stream_progress")
def _stream_progress(spark, sf_dir):
    """Input rows and observed routes of a run, added up over all its micro-batches."""
    options = _run_options(spark, "progress")
    metrics.keep_progress(spark, 10_000)
    flat = fixture.in_parts(spark, _flat(spark, sf_dir))
    routed = observe_routes(parse_messages(_sent_by_file(flat, "progress_files")))
    run = sinks.to_table(
        routed.select("kafka_offset", "route", "reject_reason"),
        "routes",
        options.table("routes"),
        options,
        available_now=True,
    )
    run.awaitTermination()
    return metrics.route_totals(metrics.progress_frame(spark, [run])).drop("batches")
