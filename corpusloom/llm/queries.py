"""The registered queries of the training-data operators, and the SQL that some of them equal."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, decontamination, html_extract, langid, neardup, oracle, pii, prefix_trie, quality, sharding, syncmers, token_counts, vector_codes
from .common import table

#: Files of public tokenizers; parameters of the operators.
WORD_BPE, PIECE_BPE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("piece_bpe_32k.model")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(table(spark, sf_dir, "documents"))


def op2_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontamination.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.detect(table(spark, sf_dir, "documents"))
    shown = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    counts = [count(k) for k in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(shown("base"), 256).alias("base_sha256"), shown("spans").alias("spans"))


def op5_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.compare_edited(table(spark, sf_dir, "documents"))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = bpe.round_trip(table(spark, sf_dir, "documents"), WORD_BPE)
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), PIECE_BPE)


def op8_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.cluster(table(spark, sf_dir, "documents"), shingle=4, percent=80)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))
    return out.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), F.col("quality_score").alias("score"), (F.col("quality_score") >= 0.5).cast("int").alias("predicted"))


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = chat.rotate(table(spark, sf_dir, "conversations"))
    spans = F.array_join(F.transform("mask", lambda m: F.concat_ws(":", m["start"].cast("string"), m["end"].cast("string"))), ",")
    return out.select("conv_id", "part", "participant", "n_turns", "rendered", spans.alias("mask"), "n_masked")


def op11_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = langid.classify(docs, langid.learn(docs.filter(~langid.held_out(F.col("doc_id")))))
    return out.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "margin", "rejected")


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sharding": op1_sharding,
    "op2_html_extract": op2_html_extract,
    "op3_decontamination": op3_decontamination,
    "op4_pii": op4_pii,
    "op5_syncmers": op5_syncmers,
    "op6_bpe": op6_bpe,
    "op7_token_counts": op7_token_counts,
    "op8_neardup": op8_neardup,
    "op9_quality": op9_quality,
    "op10_chat": op10_chat,
    "op11_langid": op11_langid,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_vector_codes": op13_vector_codes,
}

SQL: dict[str, str] = oracle.SQL | chat.SQL | {"op12_prefix_trie": prefix_trie.SQL, "op13_vector_codes": vector_codes.SQL}
