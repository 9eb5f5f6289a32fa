"""All queries of the subpackage against their SQL, and the pipeline against plain steps."""

import os
from collections import Counter

import __spark_entry__ as contract
import corpus_pipeline
import pytest
from oracle import compare, duck

from clickloom.llm import language_id, mixing, near_dedup, packing, toxicity
from clickloom.llm.oracle import ORACLES
from clickloom.llm.queries import QUERIES

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="test tables are not here")


def test_all_are_registered():
    assert {int(name[2:].split("_")[0]) for name in QUERIES} == set(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(contract.queries())
    assert set(ORACLES) <= set(contract.oracle_sql())
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "language_id", "near_dedup", "mixing", "packing",
    ]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, name):
    assert compare(QUERIES[name](spark, DATA), duck(DATA), ORACLES[name]) is None


def test_whitening_gives_eight_rows_for_each_vector(spark):
    got = QUERIES["op11_whitening"](spark, DATA)
    vectors = spark.read.parquet(f"{DATA}/embeddings.parquet")
    assert got.count() == 8 * vectors.count()
    assert got.agg({"identity_error": "max"}).first()[0] < 1e-9


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - {"op11_whitening"}))
def test_other_queries_give_a_row_for_each_document(spark, name):
    got = QUERIES[name](spark, DATA)
    n_docs = spark.read.parquet(f"{DATA}/documents.parquet").count()
    assert got.select("doc_id").distinct().count() == n_docs
    assert got.count() == n_docs or name.startswith("op4")


def test_stages_do_what_their_operators_say(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:4]:
        before, docs = docs, stage(spark, docs, DATA).cache()
        assert docs.columns == before.columns
        kept[name] = (before, docs)
    ids = lambda frame: sorted(r.doc_id for r in frame.select("doc_id").collect())

    before, after = kept["toxicity"]
    model = toxicity.train(before, spark.read.parquet(f"{DATA}/labels.parquet"))
    assert ids(after) == ids(toxicity.score_toxicity(before, model).filter("predicted = 0"))
    before, after = kept["language_id"]
    assert ids(after) == ids(language_id.identify(before, language_id.train(before)).filter("accepted"))
    before, after = kept["near_dedup"]
    assert ids(after) == ids(near_dedup.near_duplicates(before).filter("kept"))
    before, after = kept["mixing"]
    taken = {r.doc_id: r.taken for r in mixing.mixed_sizes(before).collect() if r.taken}
    words = Counter()
    for r in after.collect():
        words[r.doc_id] += len(r.text.encode().split())
        assert r.n_chars == len(r.text)
    assert words == taken

    got = corpus_pipeline.run(spark, DATA)
    want = packing.pack_documents(docs)
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, got.select(columns).collect())) == sorted(
        map(tuple, want.select(columns).collect())
    )
