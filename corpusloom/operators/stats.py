"""Size statistics: exclusive quantiles over exact counts, top-k, duplicates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

POINTS = (50, 95, 99)


def size_stats(rows: DataFrame, value: str, by: list[str] | None = None) -> DataFrame:
    """n, max, min, median (cut to a whole number) and p50, p95, p99 of a whole-number column, per group.

    Quantiles are exclusive: place p*(n+1)/100, between neighbours, cut to a whole
    number; with under 100 values each is the largest. Values are counted first
    (map-side), so what is sorted are distinct values, not rows.
    """
    by = by or []
    counts = rows.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("c"))
    keys = [F.col(b) for b in by] or [F.lit(0)]
    order = Window.partitionBy(*keys).orderBy(value)
    whole = Window.partitionBy(*keys)
    placed = counts.withColumns({"upto": F.sum("c").over(order.rowsBetween(Window.unboundedPreceding, 0)), "n": F.sum("c").over(whole)})

    def at(rank):
        """The value at a rank (from 1): the first whose running count reaches it."""
        return F.min(F.when(F.col("upto") >= rank, F.col(value)))

    n = F.col("n")
    aggs = [F.max("n").alias("n"), F.max(value).alias("max_chars"), F.min(value).alias("min_chars"), F.floor((at(F.floor((n + 1) / 2)) + at(F.floor(n / 2) + 1)) / 2).alias("median_chars")]
    for p in POINTS:
        j = F.greatest(F.lit(1), F.least(F.floor(p * (n + 1) / 100), n - 1))
        d = p * (n + 1) - j * 100
        low, high, rest = at(j), at(j + 1), F.max(d)
        aggs.append(F.when(F.max("n") < 100, F.max(value)).otherwise(F.floor((low * (100 - rest) + high * rest) / 100)).cast("long").alias(f"p{p}"))
    return placed.groupBy(*by).agg(*aggs)


def top_k(rows: DataFrame, order: list, k: int) -> DataFrame:
    """The first k by a total order; Spark keeps k rows a task, not a sorted table."""
    return rows.orderBy(*order).limit(k)


def duplicate_report(rows: DataFrame, key: str, sample: str, first: int = 5) -> DataFrame:
    """Keys of more than one row: how many, the first few of `sample`, and how many more there are.

    Copies are counted before they move; for samples, each task keeps its own first few.
    """
    counts = rows.groupBy(key).agg(F.count("*").alias("copies")).filter(F.col("copies") > 1)
    place = Window.partitionBy(key).orderBy(sample)
    few = rows.join(counts.select(key), key, "left_semi").withColumn("place", F.row_number().over(place)).filter(F.col("place") <= first)
    listed = few.groupBy(key).agg(F.array_join(F.array_sort(F.collect_list(sample)).cast("array<string>"), ",").alias("samples"))
    return counts.join(listed, key).select(key, "copies", "samples", F.greatest(F.col("copies") - first, F.lit(0)).alias("more"))


def field_histogram(heads: DataFrame, fields: list[str], head: str = "head") -> DataFrame:
    """field, missing: how many rows' maps lack each key; an empty value is there."""
    one = heads.agg(*(F.count_if(~F.map_contains_key(F.col(head), f)).alias(f) for f in fields))
    return one.select(F.explode(F.array(*(F.struct(F.lit(f).alias("field"), F.col(f).alias("missing")) for f in fields))).alias("x")).select("x.field", "x.missing")
