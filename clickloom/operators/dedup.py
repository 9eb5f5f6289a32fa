"""Duplicate removal and idempotent upsert."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickloom.workspace import settled

EVENT_KEY = ("event_id",)
MESSAGE_POSITION = ("kafka_partition", "kafka_offset")
COPY_SALTS = 32


def first_per_key(
    rows: DataFrame, keys: Sequence[str], order: Sequence[str | Column]
) -> DataFrame:
    """The first row of each key in the given order.

    ``row_number() = 1`` is planned with a group limit before the shuffle, so
    each task sends at most one row per key: a key with very many copies does
    not pile up in one task.
    """
    ranked = Window.partitionBy(*keys).orderBy(*order)
    return (
        rows.withColumn("_rank", F.row_number().over(ranked))
        .filter(F.col("_rank") == 1)
        .drop("_rank")
    )


def dedup_batch(
    events: DataFrame,
    keys: Sequence[str] = EVENT_KEY,
    order: Sequence[str | Column] | None = None,
) -> DataFrame:
    """One row per key: the first in ``order``, or any if the copies are equal."""
    if order is None:
        return events.dropDuplicates(list(keys))
    return first_per_key(events, keys, order)


def dedup_stream(
    events: DataFrame,
    keys: Sequence[str] = EVENT_KEY,
    keep: str = "5 minutes",
    position: Sequence[str] = MESSAGE_POSITION,
) -> DataFrame:
    """One row per key on a stream; a key is remembered for ``keep`` after it came.

    The clock is that of the query: all rows of a micro-batch have the time the
    batch began, which Spark writes to the checkpoint before it runs. No row can
    be older than the watermark of this clock, so none is ever late, however far
    its event time lies behind, in whatever order events come, and with or without
    a readable time. State holds the keys of the last ``keep`` of operation. A
    copy that comes later than that passes; a restart does not forget keys, as
    the watermark moves on only after the first micro-batch.

    A stream cannot combine copies before its shuffle, so all copies of one key
    would meet in one task. They are first cut down to one per key and salt,
    with the salt taken from the ``position`` that tells copies apart, and then
    to one per key. Without such columns there is only the second step.

    A query has one watermark column, so windows over event time need a query of
    their own, on the table this one writes.
    """
    marked = events.withColumn("_came", F.current_timestamp()).withWatermark("_came", keep)
    position = [c for c in position if c in events.columns]
    if position:
        salt = F.pmod(F.xxhash64(*position), F.lit(COPY_SALTS))
        marked = marked.withColumn("_salt", salt).dropDuplicatesWithinWatermark([*keys, "_salt"])
    return marked.dropDuplicatesWithinWatermark(list(keys)).drop("_salt", "_came")


def upsert(
    target: DataFrame, updates: DataFrame, keys: Sequence[str], order: str
) -> DataFrame:
    """Target with updates applied: per key the row with the greatest ``order``.

    On equal ``order`` the update wins, so applying the same updates twice gives
    the same table.
    """
    both = target.withColumn("_update", F.lit(0)).unionByName(
        updates.withColumn("_update", F.lit(1)), allowMissingColumns=True
    )
    newest = [F.col(order).desc_nulls_last(), F.col("_update").desc()]
    return first_per_key(both, keys, newest).drop("_update")


def upsert_table(
    spark: SparkSession,
    path: str,
    updates: DataFrame,
    keys: Sequence[str] = EVENT_KEY,
    order: str = "kafka_offset",
    partition: str = "event_date",
    fmt: str = "parquet",
) -> None:
    """Apply ``updates`` to a partitioned table in place.

    The driver gets the list of touched partitions, as it plans them anyway.
    Delta tables are merged by Delta. Otherwise only the partitions the updates
    touch are read and replaced (dynamic partition overwrite); the rest of the
    table is neither scanned nor written. Rows without a partition value form a
    partition of their own and are merged like any other. A key must keep its
    partition, as an event keeps its date. Columns that only the updates have are
    added to the table: older files lack them and read as null. The updates are
    computed once, into the shared checkpoint folder, and read twice from there.

    The table must be written by batch jobs, not be the folder of a streaming
    file sink. Spark replaces the partitions at commit, by delete and rename: a
    driver that dies between the two leaves a touched partition missing until the
    same updates are applied again to a restored copy; Delta has no such gap.
    """
    if fmt == "delta":
        return _merge_delta(spark, path, updates, keys, order)
    updates = settled(updates)
    dates = [r[0] for r in updates.select(partition).distinct().collect()]
    if not dates:
        return
    named = [d for d in dates if d is not None]
    touched = F.col(partition).isin(named) if named else F.lit(False)
    if None in dates:
        touched = touched | F.col(partition).isNull()
    target = spark.read.option("mergeSchema", "true").format(fmt).load(path)
    merged = upsert(target.filter(touched), updates, keys, order)
    (
        merged.hint("rebalance", partition)
        .write.format(fmt)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition)
        .save(path)
    )


def upsert_each_batch(path: str, **how) -> Callable[[DataFrame, int], None]:
    """The function to hand to ``foreachBatch``; replaying a batch is harmless."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        upsert_table(batch.sparkSession, path, batch, **how)

    return apply


def _merge_delta(
    spark: SparkSession, path: str, updates: DataFrame, keys: Sequence[str], order: str
) -> None:
    from delta.tables import DeltaTable

    newest = first_per_key(updates, keys, [F.col(order).desc_nulls_last()])
    same_key = " AND ".join(f"t.{k} = u.{k}" for k in keys)
    (
        DeltaTable.forPath(spark, path)
        .alias("t")
        .merge(newest.alias("u"), same_key)
        .whenMatchedUpdateAll(condition=f"t.{order} IS NULL OR u.{order} >= t.{order}")
        .whenNotMatchedInsertAll()
        .execute()
    )
