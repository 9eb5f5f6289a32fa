"""The clickstream job: one source, all sinks."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from clickloom.operators.enrich import enrich
from clickloom.operators.routing import (
    corrupt_records,
    dead_letters,
    parse_messages,
    rejected_records,
    valid_events,
)
from clickloom.operators.sessions import stream_sessions
from clickloom.operators.silver import stream_cells
from clickloom.options import JobOptions
from clickloom.session import build_session, prepare
from clickloom.sources.messages import read_messages
from clickloom.sources.tables import follow_table
from clickloom.streaming import sinks
from clickloom.streaming.metrics import ProgressLog
from clickloom.workspace import with_locations

logger = logging.getLogger("clickloom.job")


def start_ingest(
    raw: DataFrame, options: JobOptions, available_now: bool = False
) -> dict[str, StreamingQuery]:
    """Start the sinks that need the messages themselves."""
    parsed = parse_messages(raw)
    events = enrich(valid_events(parsed))
    return _by_name(
        sinks.write_corrupt(corrupt_records(parsed), options, available_now),
        sinks.write_rejected(rejected_records(parsed), options, available_now),
        sinks.write_dead_letters(dead_letters(parsed), options, available_now),
        sinks.write_bronze(events, options, available_now),
    )


def start_analytics(
    events: DataFrame, options: JobOptions, available_now: bool = False
) -> dict[str, StreamingQuery]:
    """Start the sinks fed by valid, enriched events."""
    cells = stream_cells(events, watermark=options.watermark)
    sessions = stream_sessions(events, options.session_gap, options.watermark)
    return _by_name(
        sinks.write_silver_agg(cells, options, available_now),
        sinks.write_sessions(sessions, options, available_now),
        sinks.write_alerts(events, options, available_now),
    )


def start_all(
    raw: DataFrame, options: JobOptions, available_now: bool = False
) -> dict[str, StreamingQuery]:
    """Start every sink on a stream of raw messages; queries by name.

    Each query reads the source at its own pace and keeps its own offsets, so a
    slow or failed sink does not hold up the others.

    With ``options.analytics_from_bronze`` only the ingest sinks read messages.
    Cells, sessions and alerts follow the bronze table, where the events are
    already parsed and each query reads just the columns it needs. They trail
    bronze by one trigger and take whole commits, however large.
    """
    queries = start_ingest(raw, options, available_now)
    if options.analytics_from_bronze:
        if available_now:
            _wait(queries)
        # Taken from the plan, so that the schema is known before any row is.
        schema = enrich(valid_events(parse_messages(raw))).schema
        events = follow_table(
            raw.sparkSession,
            options.bronze_path,
            schema,
            fmt=options.table_format,
        )
    else:
        events = enrich(valid_events(parse_messages(raw)))
    return queries | start_analytics(events, options, available_now)


def backfill(raw: DataFrame, options: JobOptions) -> dict[str, StreamingQuery]:
    """Work through everything the source holds, then stop.

    ``raw`` should be read with ``options.uncapped()``, as ``run_backfill`` does.
    """
    queries = start_all(raw, options, available_now=True)
    _wait(queries)
    return queries


def run_backfill(spark: SparkSession, options: JobOptions) -> dict[str, StreamingQuery]:
    """A backfill of the source the options name, without the caps of a live job."""
    options = with_locations(prepare(spark), options).uncapped()
    return backfill(read_messages(spark, options), options)


def _by_name(*queries: StreamingQuery) -> dict[str, StreamingQuery]:
    return {query.name: query for query in queries}


def _wait(queries: dict[str, StreamingQuery]) -> None:
    for query in queries.values():
        query.awaitTermination()


def run(spark: SparkSession, options: JobOptions) -> None:
    """Run until any query ends, then stop the others."""
    prepare(spark)
    options = with_locations(spark, options)
    spark.streams.addListener(ProgressLog())
    queries = start_all(read_messages(spark, options), options)
    logger.info("queries: %s", {name: str(q.id) for name, q in queries.items()})
    try:
        spark.streams.awaitAnyTermination()
    finally:
        for query in queries.values():
            query.stop()


def main() -> None:
    logging.basicConfig(
        level=logging.INFO, format="%(levelname)s %(asctime)s %(name)s: %(message)s"
    )
    options = JobOptions.from_env()
    run(build_session(options), options)


if __name__ == "__main__":
    main()
