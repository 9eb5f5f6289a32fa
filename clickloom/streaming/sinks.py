"""Streaming sinks. Each query has a name and a checkpoint of its own."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from clickloom.operators.alerts import high_value_purchases
from clickloom.operators.dedup import upsert_each_batch
from clickloom.operators.serialize import kafka_rows
from clickloom.operators.silver import with_written_at
from clickloom.options import JobOptions
from clickloom.streaming import alert_writer

FILES_PER_DATE = 8

# The row writer travels with the query; executors need no copy of this package.
cloudpickle.register_pickle_by_value(alert_writer)


def sink(
    frame: DataFrame,
    name: str,
    options: JobOptions,
    available_now: bool = False,
    interval: str | None = None,
) -> DataStreamWriter:
    """Append writer with name, checkpoint and trigger.

    ``available_now`` works through everything present and stops (backfills and
    tests); otherwise a micro-batch starts every trigger interval.
    """
    writer = (
        frame.writeStream.queryName(name)
        .outputMode("append")
        .option("checkpointLocation", options.checkpoint(name))
    )
    if available_now:
        return writer.trigger(availableNow=True)
    return writer.trigger(
        processingTime=interval or f"{options.trigger_interval_secs} seconds"
    )


def to_table(
    frame: DataFrame,
    name: str,
    path: str,
    options: JobOptions,
    partition_by: Sequence[str] = (),
    available_now: bool = False,
) -> StreamingQuery:
    """Append a stream to a table; exactly once, by the checkpoint and the table log."""
    writer = sink(frame, name, options, available_now).format(options.table_format)
    if options.table_format == "delta":
        writer = writer.option("mergeSchema", "true")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.start(path)


def write_bronze(events: DataFrame, options: JobOptions, available_now: bool = False):
    """Events by date; a salt spreads a date over ``FILES_PER_DATE`` tasks and files.

    Without the repartition every task of a trigger would write a file for every
    date it meets.
    """
    salt = F.pmod(F.xxhash64("event_id"), F.lit(FILES_PER_DATE))
    return to_table(
        events.repartition("event_date", salt),
        "bronze", options.bronze_path, options, ("event_date",), available_now,
    )


def write_upserts(
    events: DataFrame, name: str, path: str, options: JobOptions, available_now: bool = False, **how
) -> StreamingQuery:
    """Merge every micro-batch into a table; replaying one changes nothing."""
    apply = upsert_each_batch(path, fmt=options.table_format, **how)
    return sink(events, name, options, available_now).foreachBatch(apply).start()


def write_silver_agg(cells: DataFrame, options: JobOptions, available_now: bool = False):
    """Cells arrive here once, after the watermark has passed their window.

    The cells of a date and type go to ``FILES_PER_DATE`` tasks at most, by their
    window and device, and each of these writes one file.
    """
    salt = F.pmod(F.xxhash64("window_start", "device_type"), F.lit(FILES_PER_DATE))
    return to_table(
        with_written_at(cells).repartition("event_date", "event_type", salt),
        "silver_agg",
        options.silver_agg_path,
        options,
        ("event_date", "event_type"),
        available_now,
    )


def write_sessions(sessions: DataFrame, options: JobOptions, available_now: bool = False):
    return to_table(
        sessions, "silver_sessions", options.silver_sessions_path, options, (), available_now
    )


def write_corrupt(records: DataFrame, options: JobOptions, available_now: bool = False):
    return to_table(records, "corrupt", options.corrupt_path, options, (), available_now)


def write_rejected(records: DataFrame, options: JobOptions, available_now: bool = False):
    return to_table(records, "rejected", options.rejected_path, options, (), available_now)


def write_alerts(
    events: DataFrame,
    options: JobOptions,
    available_now: bool = False,
    writer: object | None = None,
) -> StreamingQuery:
    """Send high-value purchases to a row writer, by default the log."""
    alerts = high_value_purchases(events, options.alert_purchase_threshold)
    rows = writer or alert_writer.AlertLogWriter()
    return sink(alerts, "alerts", options, available_now).foreach(rows).start()


def write_alert_table(events: DataFrame, options: JobOptions, available_now: bool = False):
    """The same alerts as rows of a table."""
    alerts = high_value_purchases(events, options.alert_purchase_threshold)
    return to_table(alerts, "alert_table", options.alerts_path, options, (), available_now)


def write_kafka_events(
    events: DataFrame, options: JobOptions, run_id: str, available_now: bool = False
) -> StreamingQuery:
    """Publish events as JSON messages, one micro-batch per pacing interval."""
    return _to_kafka(
        kafka_rows(events, run_id),
        "kafka_events",
        options.topic,
        options,
        available_now,
        f"{options.replay_interval_ms} milliseconds",
    )


def publish_events(events: DataFrame, options: JobOptions, run_id: str) -> None:
    """Publish a table of events once, as fast as the brokers take them."""
    (
        kafka_rows(events, run_id)
        .write.format("kafka")
        .option("kafka.bootstrap.servers", options.bootstrap_servers)
        .option("topic", options.topic)
        .option("includeHeaders", "true")
        .save()
    )


def write_dead_letters(
    letters: DataFrame, options: JobOptions, available_now: bool = False
) -> StreamingQuery:
    """Send refused messages, key and value unchanged, to the dead-letter topic.

    With a file source they go to a table instead.
    """
    if options.source_format != "kafka":
        return to_table(
            letters, "dead_letters", options.table("dead_letters"), options, (), available_now
        )
    return _to_kafka(letters, "dead_letters", options.dlq_topic, options, available_now)


def _to_kafka(frame, name, topic, options, available_now, interval=None) -> StreamingQuery:
    return (
        sink(frame, name, options, available_now, interval)
        .format("kafka")
        .option("kafka.bootstrap.servers", options.bootstrap_servers)
        .option("topic", topic)
        .option("includeHeaders", "true")
        .start()
    )
