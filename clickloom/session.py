"""Session setup."""

from __future__ import annotations

import importlib.util

from pyspark import SparkConf
from pyspark.sql import SparkSession

from clickloom.options import JobOptions

APP_NAME = "clickloom"

# Needed for right results in every session this library runs in.
REQUIRED = {
    # event_date, event_hour and event_minute depend on the zone.
    "spark.sql.session.timeZone": "UTC",
}

# Better plans at scale; applied only where the session has no value of its own.
PREFERRED = {
    # State beyond the executor heap, with incremental checkpoints.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Merge the sessions of a hot user inside each task before the shuffle.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}

STATIC = {
    "spark.sql.streaming.schemaInference": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.kafka.consumer.cache.timeout": "10m",
}

DELTA = {
    "spark.sql.extensions": "io.delta.sql.DeltaSparkSessionExtension",
    "spark.sql.catalog.spark_catalog": "org.apache.spark.sql.delta.catalog.DeltaCatalog",
    "spark.databricks.delta.schema.autoMerge.enabled": "true",
}


def delta_available() -> bool:
    return importlib.util.find_spec("delta") is not None


def session_settings(options: JobOptions) -> dict[str, str]:
    """All settings of a session built for ``options``."""
    settings = {**STATIC, **PREFERRED, **REQUIRED}
    if options.shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(options.shuffle_partitions)
    if options.table_format == "delta":
        if not delta_available():
            raise RuntimeError("table_format=delta needs the delta package on the path")
        settings.update(DELTA)
    return settings


def build_session(options: JobOptions | None = None, master: str | None = None) -> SparkSession:
    """A session with the settings above; what spark-submit passed wins over them.

    ``spark.sql.shuffle.partitions`` is left to the submit command unless the
    options name a value: it also fixes the number of state store partitions of
    a stream for the life of its checkpoint.
    """
    options = options or JobOptions()
    submitted = SparkConf()
    builder = SparkSession.builder.appName(APP_NAME)
    if master:
        builder = builder.master(master)
    for name, value in session_settings(options).items():
        if name in REQUIRED or not submitted.contains(name):
            builder = builder.config(name, value)
    if options.table_format == "delta":
        from delta import configure_spark_with_delta_pip

        builder = configure_spark_with_delta_pip(builder)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else built.

    The shuffle width stays what the session has: it fixes the state stores of a
    stream for the life of its checkpoint, and only the caller knows the cluster.
    """
    for name, value in REQUIRED.items():
        if spark.conf.get(name, None) != value:
            spark.conf.set(name, value)
    already_set = spark.conf.getAll
    for name, value in PREFERRED.items():
        if name not in already_set:
            spark.conf.set(name, value)
    return spark
