"""From raw documents to token ids in five stages, each written and read again.

Each function of STAGES takes (spark, docs, sf_dir) and works on all that the stage
before it kept. All but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import bpe, decontamination, neardup, pii, quality
from corpusloom.llm.common import Scratch, table
from corpusloom.llm.queries import WORD_BPE


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject (a score under 0.5) go.

    Null and empty texts are scored like all others; equal texts get equal scores, so
    repeated rows stay or go together; an empty table stays empty; other columns, of
    any name, are kept as they are.
    """
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    held = docs.select("text", F.struct("*").alias("row"))  # names that the score makes cannot meet those of docs
    return quality.score(held, model).filter(F.col("quality_score") >= 0.5).select("row.*")


def neardup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: the one with the smallest doc_id (words in fives, similarity 0.8).

    Documents without words are in no group and stay. Rows that repeat an id are
    one document, so they stay or go together. An empty table stays empty.
    """
    kept = neardup.cluster(docs, shingle=5, percent=80).filter("kept").select("doc_id").distinct()
    own = "kept_id"
    while own in docs.columns:
        own += "_"
    return docs.join(kept.select(F.col("doc_id").alias(own)), F.col("doc_id").eqNullSafe(F.col(own)), "left_semi")


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go.

    Null and empty texts hold none and stay; repeated rows stay or go together; an
    empty benchmark removes nothing.
    """
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data becomes <EMAIL>, <IP>, <CARD> or <PHONE>; n_chars follows the text.

    All rows stay, repeated ones too; a null text stays null and its n_chars too.
    """
    clean = pii.redact(docs)
    return clean.withColumn("n_chars", F.length("text").cast("long"))


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and ids of each text; null and empty texts have none, repeated rows get equal ids."""
    ids = bpe.encode(docs, WORD_BPE)
    return ids.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality_stage),
    ("neardup", neardup_stage),
    ("decontamination", decontamination_stage),
    ("pii", pii_stage),
    ("bpe", bpe_stage),
]

#: No SQL expresses the trained stages; tests/llm/test_pipeline.py holds the rows of each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STAGES applied to documents; each stage's rows are a Parquet table in the shared folder, which goes when the next one is written."""
    docs, scratch = table(spark, sf_dir, "documents"), Scratch(spark, "pipeline")
    for _, stage in STAGES:
        before, docs = docs, scratch.put(stage(spark, docs, sf_dir))
        scratch.free(before)
    return docs
