"""Hierarchical weighted hash tree: place keys by weighted hash draws per level.

A fleet is a tree of regions, racks and shards. A key descends from the root:
at each node every child gets a draw, -ln(u) / weight with u a hash of (path of
the child, key), and the smallest draw wins. Since a child's draw depends on its
own path and weight only, a change of weight moves keys only into or out of the
subtree whose weight changed; the rest of the tree keeps its keys.

Growth law (`key`): the founding fleet of FOUNDING shards is a fixed tree, and
each later shard is commissioned as a subtree of its own below the root. So the
place of a key is decided by doc_id and the shard count alone, and one more shard
takes keys only into itself.

Everything is Spark expressions; a row needs no other row to find its shard.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Shards of the founding fleet: two regions of two racks of two shards.
FOUNDING = 8

#: Parts of each shard within which rows are numbered; so no task holds a whole shard.
BINS = 1024


@dataclass(frozen=True)
class Node:
    """A region or rack (with children) or a shard (with a number)."""

    name: str
    weight: float
    children: tuple[Node, ...] = ()
    shard: int | None = None


def branch(name: str, children: list[Node]) -> Node:
    """A node that weighs what its children weigh."""
    return Node(name, sum(c.weight for c in children), tuple(children))


def fleet(shards: int, founding: int = FOUNDING) -> Node:
    """The tree of a shard count; only growth beyond the founding fleet keeps the law."""
    if shards < founding:
        raise ValueError(f"a fleet has at least its {founding} founding shards")
    half = max(1, founding // 2)
    leaf = lambda i: Node(f"s{i}", 1.0, (), i)
    regions = []
    for r, lo in enumerate(range(0, founding, half)):
        own = list(range(lo, min(founding, lo + half)))
        regions.append(branch(f"r{r}", [branch(f"k{k}", [leaf(i) for i in own[at : at + 2]]) for k, at in enumerate(range(0, len(own), 2))]))
    for i in range(founding, shards):
        regions.append(branch(f"x{i}", [branch("k0", [leaf(i)])]))
    return branch("", regions)


def _draw(key: Column, path: str, weight: float) -> Column:
    """-ln(u) / weight; u in (0, 1) from 52 bits of a digest of path and key."""
    bits = F.conv(F.substring(F.md5(F.concat(F.lit(path + ":"), key)), 1, 13), 16, 10).cast("double")
    return -F.log((bits + 0.5) / F.lit(float(2**52))) / F.lit(float(weight))


def shard_of(key: Column, tree: Node, path: str = "") -> Column:
    """The shard of a key (a string column; null counts as the empty string)."""
    if tree.shard is not None:
        return F.lit(tree.shard)
    key = F.coalesce(key, F.lit(""))
    live = [c for c in tree.children if c.weight > 0]
    below = [shard_of(key, c, f"{path}/{c.name}") for c in live]
    if len(live) == 1:
        return below[0]
    draws = F.array(*(F.struct(_draw(key, f"{path}/{c.name}", c.weight).alias("d"), F.lit(i).alias("i")) for i, c in enumerate(live)))
    won = F.array_min(draws)["i"]
    out = F.when(won == 0, below[0])
    for i in range(1, len(below) - 1):
        out = out.when(won == i, below[i])
    return out.otherwise(below[-1])


def assign(docs: DataFrame, shards: int = FOUNDING, id_col: str = "doc_id", text_col: str = "text", bins: int = BINS) -> DataFrame:
    """One row per row of docs: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    size is the text's UTF-8 bytes plus 1 (null: 1); text_crc32 of a null text is
    that of the empty one. A null doc_id is placed as the empty key. Slots number
    each shard's rows from 0 without gaps, by (bin, doc_id, size, crc); rows equal
    in all three are alike in every column, so ties cannot show. An empty table
    gives no rows; other columns are not looked at.
    """
    key = F.col("doc_id").cast("string")
    part = F.pmod(F.conv(F.substring(F.md5(F.coalesce(key, F.lit(""))), 20, 7), 16, 10).cast("long"), F.lit(bins)).cast("int")
    text = F.coalesce(F.col("text"), F.lit(""))
    ids = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    placed = ids.withColumns({"shard": shard_of(key, fleet(shards)), "bin": part})
    rows = placed.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        "shard",
        "bin",
        shard_of(key, fleet(shards + 1)).alias("grown_shard"),
    )
    # shards x bins counts, whatever the input: their running sum is where each bin's slots begin.
    # Both windows hold one bin; the rows of one document id repeated without end would still share a bin.
    counts = placed.groupBy("shard", "bin").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    begins = counts.select("shard", "bin", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("begin"))
    within = Window.partitionBy("shard", "bin").orderBy("doc_id", "size", "text_crc32")
    numbered = rows.withColumn("at", F.row_number().over(within) - 1)
    return numbered.join(F.broadcast(begins), ["shard", "bin"]).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        "shard",
        (F.col("begin") + F.col("at")).cast("long").alias("slot"),
        "grown_shard",
    )
