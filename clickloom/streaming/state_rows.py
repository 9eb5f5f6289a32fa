"""What a query keeps in its state, read from the checkpoint as a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.operators.silver import CELL_KEYS


def state_rows(spark: SparkSession, checkpoint: str, operator: int = 0) -> DataFrame:
    """(key, value, partition_id) of one stateful operator after its last micro-batch.

    Operators are numbered from the sink back; a query that runs can be read too.
    """
    return spark.read.format("statestore").option("operatorId", operator).load(checkpoint)


def operators_of(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The stateful operators of a checkpoint: names, partitions and batches kept."""
    return spark.read.format("state-metadata").load(checkpoint)


def open_cells(spark: SparkSession, checkpoint: str, operator: int = 1) -> DataFrame:
    """State rows per cell whose window the watermark has not passed.

    Of the two aggregates of ``stream_cells`` the one at the source holds, per cell, one row of
    measures and one per distinct user, session and product.
    """
    keys = state_rows(spark, checkpoint, operator).select("key.*")
    return keys.groupBy("window", *CELL_KEYS).agg(
        F.count("*").alias("state_rows"), F.count("kind").alias("distinct_values")
    ).select(
        F.col("window.start").alias("window_start"), *CELL_KEYS, "state_rows", "distinct_values"
    )
