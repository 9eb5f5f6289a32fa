"""One query per operator, over its whole table, and the SQL some of them must equal."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clickloom.llm import (
    collocations,
    language_id,
    licenses,
    line_rules,
    mixing,
    near_dedup,
    packing,
    quality_model,
    syncmers,
    token_files,
    toxicity,
    warc,
    whitening,
)
from clickloom.llm.common import read


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return toxicity.score_toxicity(docs, toxicity.train(docs, read(spark, sf_dir, "labels")))


def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed_sizes(read(spark, sf_dir, "documents"))


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(read(spark, sf_dir, "documents"), width=4)


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read(spark, sf_dir, "documents"))


def op5_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = quality_model.train(docs, read(spark, sf_dir, "labels"))
    return quality_model.score_quality(docs, model)


def op6_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.fingerprints(read(spark, sf_dir, "documents"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = warc.archive_round_trip(read(spark, sf_dir, "pages"))
    return index.select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op8_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules.clean_lines(read(spark, sf_dir, "documents"), with_text=False)


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return language_id.identify(docs, language_id.train(docs))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_round_trip(read(spark, sf_dir, "documents"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(read(spark, sf_dir, "embeddings"))


def op12_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(read(spark, sf_dir, "documents"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read(spark, sf_dir, "documents"))


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_source_mixing": op2_source_mixing,
    "op3_near_dedup": op3_near_dedup,
    "op4_packing": op4_packing,
    "op5_quality_model": op5_quality_model,
    "op6_syncmers": op6_syncmers,
    "op7_warc": op7_warc,
    "op8_line_rules": op8_line_rules,
    "op9_language_id": op9_language_id,
    "op10_token_files": op10_token_files,
    "op11_whitening": op11_whitening,
    "op12_licenses": op12_licenses,
    "op13_collocations": op13_collocations,
}
