"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from clickloom.workspace import shared_dir

# A word: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def id_remainder(doc_id: Column, parts: int) -> Column:
    """crc32 of the id's text modulo ``parts``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(parts)


def held_out(doc_id: Column, parts: int, remainder: int) -> Column:
    """Rows no model may learn from; a null id is not held out."""
    return F.coalesce(id_remainder(doc_id, parts) == remainder, F.lit(False))


def cut(frame: DataFrame) -> DataFrame:
    """Write ``frame`` to the cluster's shared checkpoint folder and go on from there.

    The rows survive lost executors and what made them never runs again. Spark
    removes the files with the frame when ``cleanCheckpoints`` is set.
    """
    context = frame.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(f"{shared_dir(frame.sparkSession)}/checkpoints")
    return frame.checkpoint()


def release(spark: SparkSession) -> None:
    """Let Spark remove the shuffle and checkpoint files of frames no longer held.

    It does so when the driver collects garbage, which a large heap can put off
    for many jobs. Called between the stages of an operator that has several.
    """
    gc.collect()
    spark._jvm.System.gc()


def word_count(text: Column) -> Column:
    """Words of a text as long; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def map_batches(
    frame: DataFrame, function: Callable[[pa.RecordBatch], dict[str, list]], schema: str
) -> DataFrame:
    """One output batch per Arrow batch of ``frame``: ``function`` gives its columns."""
    fields = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = function(batch)
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[f.name], type=f.type, from_pandas=True) for f in fields],
                schema=fields,
            )

    return frame.mapInArrow(run, schema)
