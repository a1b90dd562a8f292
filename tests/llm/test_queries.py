"""Registered queries and the pipeline on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from corpusloom.llm import queries

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")

COLUMNS = {
    "op1": {"doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"},
    "op2": {"page_id", "url", "text", "n_chars"},
    "op3": {"doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"},
    "op4": {"doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"},
    "op5": {"doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"},
    "op6": {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"},
    "op8": {"doc_id", "n_shingles", "component_id", "kept"},
    "op9": {"doc_id", "held_out", "score", "predicted"},
    "op11": {"doc_id", "held_out", "lang_pred", "score"},
    "op12": {"conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"},
    "op13": {"vec_id", "code", "error", "label_error", "codebooks_sha256"},
}


def test_all_are_registered():
    assert {q.split("_")[0] for q in queries.QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_contract(spark, name):
    out = queries.QUERIES[name](spark, SF)
    assert COLUMNS.get(name.split("_")[0], set()) <= set(out.columns)
    table = {"op2": "pages", "op13": "embeddings"}.get(name.split("_")[0], "documents")
    if not name.startswith(("op10", "op12")):
        assert out.count() == spark.read.parquet(f"{SF}/{table}.parquet").count()


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_sql(spark, name):
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    df = queries.QUERIES[name](spark, SF)
    rel = con.execute(queries.SQL[name])
    names = [d[0] for d in rel.description]
    assert sorted(names) == sorted(df.columns)
    at = [names.index(c) for c in df.columns]
    assert sorted((tuple(r) for r in df.collect()), key=repr) == sorted((tuple(r[i] for i in at) for r in rel.fetchall()), key=repr)


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "neardup", "decontamination", "pii", "bpe"]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        if name != "bpe":
            assert out.dtypes == docs.dtypes, name
            assert 0 < out.count() <= docs.count()
            docs = spark.createDataFrame(out.collect(), docs.schema)
    whole = corpus_pipeline.run(spark, SF)
    assert sorted(r["doc_id"] for r in whole.collect()) == sorted(r["doc_id"] for r in docs.collect())
