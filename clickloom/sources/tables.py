"""Tables the job has written."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_table(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    first_date: date | str | None = None,
    last_date: date | str | None = None,
) -> DataFrame:
    """A table by path; the dates prune the ``event_date`` partitions scanned.

    Columns that later files have and earlier ones lack are in the result.
    """
    table = spark.read.option("mergeSchema", "true").format(fmt).load(path)
    if first_date is not None:
        table = table.filter(F.col("event_date") >= F.lit(first_date).cast("date"))
    if last_date is not None:
        table = table.filter(F.col("event_date") <= F.lit(last_date).cast("date"))
    return table


def follow_table(
    spark: SparkSession,
    path: str,
    schema: StructType,
    partition_by: Sequence[str] = ("event_date",),
    fmt: str = "parquet",
) -> DataFrame:
    """A table as a stream of the rows appended to it, whole commits at a time.

    A commit holds files of many dates in no order. A cap on files would cut it,
    and the watermark of a later date in one part would drop the other part as
    late; so there is none, and a trigger takes all commits that are there.

    Files come back with the partition columns last. A stream started on a table
    that is still empty cannot find that out by itself and would mix up columns,
    so the schema is put in that order here.
    """
    reader = spark.readStream.format(fmt)
    if fmt != "delta":
        inner = [f for f in schema if f.name not in partition_by]
        reader = reader.schema(StructType([*inner, *(schema[c] for c in partition_by)]))
    return reader.load(path)


def write_table(
    frame: DataFrame,
    path: str,
    partition_by: tuple[str, ...] = ("event_date",),
    fmt: str = "parquet",
    mode: str = "append",
) -> None:
    """Batch write of a partitioned table.

    The rebalance gathers each partition value into few files of even size and
    splits the value that holds most rows; without it every task would write a
    file for every date it meets. ``overwrite`` replaces the partitions that
    ``frame`` has rows of.
    """
    (
        frame.hint("rebalance", *partition_by)
        .write.format(fmt)
        .mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .save(path)
    )


def write_bucketed(
    frame: DataFrame,
    table: str,
    path: str,
    buckets: int,
    key: str = "user_id",
    order: Sequence[str] = ("event_ts",),
) -> DataFrame:
    """Batch write of a table bucketed by ``key`` and sorted within buckets; returns it.

    Rows of a key are in one bucket, as messages of a user are in one partition of
    a topic, so aggregates and windows by the key read it without a shuffle. The
    layout is in the catalog, not in the files: read it as ``spark.table(table)``.
    A bucket is one task's work when it is read, so a hot key makes a large bucket;
    tables with such keys are better left to the shuffle, which splits them.
    """
    (
        frame.repartition(buckets, key)
        .write.format("parquet")
        .bucketBy(buckets, key)
        .sortBy(key, *order)
        .option("path", path)
        .mode("overwrite")
        .saveAsTable(table)
    )
    return frame.sparkSession.table(table)
