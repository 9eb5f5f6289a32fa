"""Raw messages: Kafka, envelope files, or literal payloads."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from clickloom.options import JobOptions
from clickloom.schema import ENVELOPE_SCHEMA

# Fixed values of the consumer.
SESSION_TIMEOUT_MS = 30_000
HEARTBEAT_INTERVAL_MS = 10_000


def kafka_settings(options: JobOptions) -> dict[str, str]:
    """Options of the Kafka source.

    ``min_partitions`` cuts the topic's partitions into more tasks than it has
    partitions, as parsing is bound by the processor.

    The consumer group is a prefix, not a fixed id: every query of the job reads
    the topic on its own, and queries sharing one id disturb each other.
    """
    settings = {
        "kafka.bootstrap.servers": options.bootstrap_servers,
        "subscribe": options.topic,
        "startingOffsets": options.starting_offsets,
        "groupIdPrefix": options.consumer_group,
        "failOnDataLoss": str(options.fail_on_data_loss).lower(),
        "kafka.session.timeout.ms": str(SESSION_TIMEOUT_MS),
        "kafka.heartbeat.interval.ms": str(HEARTBEAT_INTERVAL_MS),
    }
    if options.max_offsets_per_trigger:
        settings["maxOffsetsPerTrigger"] = str(options.max_offsets_per_trigger)
    if options.min_partitions:
        settings["minPartitions"] = str(options.min_partitions)
    return settings


def read_kafka_stream(spark: SparkSession, options: JobOptions) -> DataFrame:
    """Key, value, topic, partition, offset and timestamp of new messages."""
    return spark.readStream.format("kafka").options(**kafka_settings(options)).load()


def read_file_stream(
    spark: SparkSession, path: str, fmt: str = "parquet", max_files_per_trigger: int | None = None
) -> DataFrame:
    """The same frame from a folder that envelope files are dropped into."""
    reader = spark.readStream.format(fmt).schema(ENVELOPE_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def read_messages(spark: SparkSession, options: JobOptions) -> DataFrame:
    """The stream the options ask for."""
    if options.source_format == "kafka":
        return read_kafka_stream(spark, options)
    return read_file_stream(
        spark, options.source_path, options.source_format, options.max_files_per_trigger
    )


def read_message_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Envelope files as a table, for backfills."""
    return spark.read.format(fmt).schema(ENVELOPE_SCHEMA).load(path)


def message_frame(
    spark: SparkSession, rows: Iterable[tuple], topic: str = "clickstream-events"
) -> DataFrame:
    """A static envelope frame from (key, value, partition, offset, timestamp) rows."""
    full = [(key, value, topic, part, at, time, 0) for key, value, part, at, time in rows]
    return spark.createDataFrame(full, ENVELOPE_SCHEMA)
