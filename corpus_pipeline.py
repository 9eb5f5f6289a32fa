"""A corpus pipeline of the training-data operators, stage by stage.

Each stage takes the rows its predecessor kept and gives documents again, but
for the last, which gives the places of their pieces in packed sequences. Models
are trained on the labelled rows of a stage's own input.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from clickloom.llm import language_id, mixing, near_dedup, packing, toxicity
from clickloom.llm.common import read
from clickloom.workspace import fresh_dir


# Rows that go to a Python worker at once. Texts can be long, and a worker keeps the memory
# of its largest batch from stage to stage.
BATCH_ROWS = 2_000


def _small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model scores below its threshold."""
    _small_batches(spark)
    return toxicity.drop_toxic(docs, toxicity.train(docs, read(spark, sf_dir, "labels")))


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the model does not reject."""
    _small_batches(spark)
    return language_id.drop_rejected(docs, language_id.train(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of near duplicates.

    Five-word shingles and a similarity of 0.8.
    """
    _small_batches(spark)
    return near_dedup.drop_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in the order of the mix, each once for every pass that takes it."""
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the tokenised documents with their places in the sequences."""
    _small_batches(spark)
    return packing.pack_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("language_id", keep_known_languages),
    ("near_dedup", drop_near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# The trained stages and the tokenizer have no SQL form; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each writes Parquet that the next one reads."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        folder = fresh_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
