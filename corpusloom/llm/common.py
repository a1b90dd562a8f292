"""Table access, tables of intermediate rows and digest helpers of the training-data operators."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import Scratch, remove, shared_folder, small_batches, table

__all__ = ["Scratch", "keyed", "remove", "sha256_hex", "shared_folder", "small_batches", "table", "unkeyed"]


def keyed(df: DataFrame, id_col: str, *others: Column) -> DataFrame:
    """The id as text and other columns: pandas would turn whole numbers beside nulls into floats, and lose large ids."""
    return df.select(F.col(id_col).cast("string").alias("doc_id"), *others)


def unkeyed(df: DataFrame, source: DataFrame, id_col: str) -> DataFrame:
    """The id in its own type again."""
    return df.withColumn("doc_id", F.col("doc_id").cast(source.schema[id_col].dataType))


def sha256_hex(data: bytes | str) -> str:
    return hashlib.sha256(data.encode("utf-8") if isinstance(data, str) else data).hexdigest()
