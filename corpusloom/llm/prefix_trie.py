"""Conversation prefix trie: which conversations share which first turns.

A node is a distinct sequence of first d turns; its owner is its smallest member. A
conversation that owns the node at one depth owns all its deeper ones, since members only
get fewer. So each conversation's first owned depth is found by binary search: in every
round all open conversations look up the digest of their middle prefix in the table of
prefix-digest minima, in one join. The depths that a conversation owns are its chain; a
chain hangs on the node that the last failed look-up named. Chains are the tree: what
lies below a chain is summed bottom-up by doubling (a chain adds what the chains 1, 2,
4, ... steps below it have gathered), and running sums along a chain give each node's part.

No task holds a whole group. Turns are numbered through range partitions and their
counts, running sums have two levels (blocks of places, then the blocks), the ids
that end at one node are joined in blocks, and the blocks of a large one stream through
one SHA-256. A prefix is told by the sum of 128-bit digests of (place, role, text) in
four parts modulo 2^32, which can be summed in any order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ordered import numbered, running
from .common import Scratch

#: Ids that are joined into one text at once.
IDS = 512

#: Conversations share turns with the first of their group of so many ids, at most LONGEST_HEAD of them.
GROUP, LONGEST_HEAD = 20, 3

_WORD = r"[^\x20\x09-\x0D]+"
_EMPTY = hashlib.sha256(b"").hexdigest()


def turns(conversations: DataFrame, scratch: Scratch) -> DataFrame:
    """conv_id, pos (from 0), digest, words: turns by their number, null first, equal numbers by the digest.

    The digest is that of role and text (null: empty). Rows without a conv_id belong to no
    conversation and are left out; repeated rows are repeated turns.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))
    rows = conversations.filter("conv_id IS NOT NULL").select("conv_id", "turn", digest.alias("digest"), F.size(F.regexp_extract_all(text, F.lit(_WORD), 0)).cast("long").alias("words"))
    return numbered(rows, ["conv_id"], ["turn", "digest"], "pos", scratch).drop("turn")


def rebuilt(own: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(conv_id, depth, digest, words) of rebuilt turns, and (conv_id, size) of all conversations.

    A conversation c takes the first h turns of the first one of its group of GROUP ids
    (fewer if that has fewer), and then its own after its first h; h is crc32 of c's
    decimals modulo LONGEST_HEAD + 1.
    """
    own = scratch.put(own)
    sizes = own.groupBy("conv_id").agg(F.count("*").alias("n"))
    first = F.col("conv_id") - F.col("conv_id") % GROUP
    asked = sizes.select("conv_id", "n", first.alias("head"), (F.crc32(F.col("conv_id").cast("string")) % (LONGEST_HEAD + 1)).alias("h"))
    given = sizes.select(F.col("conv_id").alias("head"), F.col("n").alias("given"))
    convs = scratch.put(asked.join(given, "head", "left").withColumn("k", F.least("h", F.coalesce("given", F.lit(0)))).drop("given"))
    heads = own.filter(F.col("pos") < LONGEST_HEAD).select(F.col("conv_id").alias("head"), "pos", "digest", "words")
    taken = convs.join(heads, "head").filter("pos < k").select("conv_id", (F.col("pos") + 1).alias("depth"), "digest", "words")
    kept = own.join(convs.select("conv_id", "h", "k"), "conv_id").filter("pos >= h").select("conv_id", (F.col("pos") - F.col("h") + F.col("k") + 1).alias("depth"), "digest", "words")
    return taken.unionByName(kept), convs.select("conv_id", (F.col("k") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("size"))


def prefixes(rows: DataFrame) -> DataFrame:
    """conv_id, depth, k1, k2 (the prefix of that depth), words of its last turn."""
    term = F.md5(F.concat(F.col("depth").cast("string"), F.lit(":"), F.col("digest")))
    parts = {f"s{i}": F.conv(F.substring(term, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)}
    summed = running(rows.withColumns(parts), ["conv_id"], "depth", list(parts))
    low = lambda i: F.pmod(F.col(f"s{i}"), F.lit(1 << 32))
    pair = lambda i, j: F.shiftleft(low(i), 32).bitwiseOR(low(j))
    return summed.select("conv_id", "depth", pair(0, 1).alias("k1"), pair(2, 3).alias("k2"), "words")


def first_owned(prefix: DataFrame, minima: DataFrame, sizes: DataFrame, root, scratch: Scratch) -> DataFrame:
    """conv_id, size, first, below for each conversation: the first depth that it owns, and the owner one above.

    first is size + 1 where it owns none (below then owns its last turn too). Every round
    halves the depths of each open conversation, and with them the rows that are read.
    """
    start = sizes.withColumns({"lo": F.lit(1).cast("long"), "hi": F.col("size") + 1, "below": F.lit(root).cast(sizes.schema["conv_id"].dataType)})
    done = [start.filter("size = 0")]
    found = minima.select("depth", "k1", "k2", "owner")
    open_rows = scratch.put(prefix.drop("words").join(start, "conv_id"))
    while not open_rows.isEmpty():
        middle = F.floor((F.col("lo") + F.col("hi")) / 2).cast("long")
        probe = open_rows.filter(F.col("depth") == middle).join(found, ["depth", "k1", "k2"])
        own = F.col("owner") == F.col("conv_id")
        step = probe.select("conv_id", "size", F.when(own, F.col("lo")).otherwise(F.col("depth") + 1).alias("lo"), F.when(own, F.col("depth")).otherwise(F.col("hi")).alias("hi"), F.when(own, F.col("below")).otherwise(F.col("owner")).alias("below"))
        step = scratch.put(step)
        done.append(step.filter("lo = hi"))
        left = open_rows.select("conv_id", "depth", "k1", "k2").join(step.filter("lo < hi"), "conv_id").filter("depth >= lo AND depth < hi")
        before, open_rows = open_rows, scratch.put(left)
        scratch.free(before)
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out.select("conv_id", "size", F.when(F.col("conv_id") == F.lit(root), 0).otherwise(F.col("lo")).cast("long").alias("first"), F.when(F.col("conv_id") != F.lit(root), F.col("below")).alias("below"))


def below_chains(chains: DataFrame, values: list[str], scratch: Scratch) -> DataFrame:
    """chains (conv_id, up, values) with each value summed over the chain and all chains below it.

    After k rounds a chain has what is less than 2^k steps below it, and `up` is the chain
    2^k steps above; a chain that hangs on the root's has no `up`, so the root's sums are its own.
    """
    now = scratch.put(chains)
    while not now.filter("up IS NOT NULL").isEmpty():
        gain = now.filter("up IS NOT NULL").groupBy(F.col("up").alias("conv_id")).agg(*(F.sum(v).alias(f"_{v}") for v in values))
        higher = now.select(F.col("conv_id").alias("up"), F.col("up").alias("_up"))
        out = now.join(gain, "conv_id", "left").join(higher, "up", "left")
        out = scratch.put(out.select("conv_id", F.col("_up").alias("up"), *((F.col(v) + F.coalesce(f"_{v}", F.lit(0))).alias(v) for v in values)))
        scratch.free(now)
        now = out
    return now


def digest_of_ids(ends: DataFrame, scratch: Scratch) -> DataFrame:
    """conv_id, depth, ends_sha256: the digest of the comma-joined members that end at a node, ascending."""
    node = ["conv_id", "depth"]
    ends = scratch.put(ends)
    large = scratch.put(ends.groupBy(*node).agg(F.count("*").alias("n")).filter(F.col("n") > IDS).select(*node))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list("member")), lambda x: x.cast("string")), ",")
    out = ends.join(large, node, "left_anti").groupBy(*node).agg(F.sha2(joined, 256).alias("ends_sha256"))
    if large.isEmpty():
        return out
    placed = numbered(ends.join(large, node, "left_semi"), node, ["member"], "place", scratch)
    blocks = placed.groupBy(*node, F.floor(F.col("place") / IDS).alias("block")).agg(joined.alias("ids"))

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One running digest; rows come by node and block."""
        at, digest, names = None, None, ["conv_id", "depth", "ends_sha256"]
        row = lambda: pa.RecordBatch.from_arrays([pa.array([at[0]], kinds[0]), pa.array([at[1]], kinds[1]), pa.array([digest.hexdigest()])], names=names)
        for batch in batches:
            kinds = [batch.schema.field("conv_id").type, batch.schema.field("depth").type]
            for c, d, ids in zip(*(batch.column(x).to_pylist() for x in ("conv_id", "depth", "ids")), strict=True):
                if at != (c, d):
                    if at is not None:
                        yield row()
                    at, digest = (c, d), hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
        if at is not None:
            yield row()

    dealt = blocks.repartition(*node).sortWithinPartitions(*node, "block")  # a row for IDS members, however many a node has
    kind = lambda c: ends.schema[c].dataType.simpleString()
    return out.unionByName(dealt.mapInArrow(stream, f"conv_id {kind('conv_id')}, depth {kind('depth')}, ends_sha256 string"))


def trie(rows: DataFrame, sizes: DataFrame, scratch: Scratch) -> DataFrame:
    """One row per node: conv_id (its smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    rows: conv_id, depth (from 1, gapless), digest, words; sizes: conv_id, size. The root
    (depth 0) has no text and no parent. Without conversations there are no nodes.
    """
    sizes = scratch.put(sizes)
    root, total = sizes.agg(F.min("conv_id"), F.count("*")).first()
    prefix = scratch.put(prefixes(rows))
    minima = scratch.put(prefix.groupBy("depth", "k1", "k2").agg(F.min("conv_id").alias("owner"), F.count("*").alias("n_convs"), F.max("words").alias("words")))
    chains = scratch.put(first_owned(prefix, minima, sizes, root, scratch))
    owning = chains.filter("first <= size")
    hung = owning.filter("below IS NOT NULL").select(F.col("below").alias("conv_id"), (F.col("first") - 1).alias("depth"), F.col("conv_id").alias("chain"))

    top = sizes.sparkSession.createDataFrame([(root, 0, total, 0)] if total else [], f"conv_id {sizes.schema['conv_id'].dataType.simpleString()}, depth long, n_convs long, words long")
    nodes = minima.select(F.col("owner").alias("conv_id"), "depth", "n_convs", "words").unionByName(top)
    forks = hung.groupBy("conv_id", "depth").agg(F.count("*").alias("forks"))
    nodes = nodes.join(owning.drop("below"), "conv_id").join(forks, ["conv_id", "depth"], "left")
    children = (F.col("depth") < F.col("size")).cast("long") + F.coalesce("forks", F.lit(0))
    nodes = nodes.withColumn("n_children", children).withColumns({"n_leaves": (F.col("n_children") == 0).cast("long"), "saved_tokens": (F.col("n_convs") - 1) * F.col("words")})
    nodes = scratch.put(nodes.drop("forks", "size", "first", "words"))

    sums = ["n_leaves", "saved_tokens"]
    own = nodes.groupBy("conv_id").agg(*(F.sum(v).alias(v) for v in sums))
    up = owning.filter("below IS NOT NULL").select("conv_id", F.when(F.col("below") != F.lit(root), F.col("below")).alias("up"))
    whole = below_chains(up.join(own, "conv_id"), sums, scratch)
    gain = hung.join(whole.select(F.col("conv_id").alias("chain"), *sums), "chain").groupBy("conv_id", "depth").agg(*(F.sum(v).alias(f"g_{v}") for v in sums))
    here = nodes.join(gain, ["conv_id", "depth"], "left").withColumns({v: F.col(v) + F.coalesce(f"g_{v}", F.lit(0)) for v in sums}).drop(*(f"g_{v}" for v in sums))
    summed = running(here, ["conv_id"], "depth", sums, down=True)

    ends = chains.select(F.when(F.col("first") <= F.col("size"), F.col("conv_id")).otherwise(F.col("below")).alias("conv_id"), F.col("size").alias("depth"), F.col("conv_id").alias("member"))
    out = summed.join(chains.select("conv_id", "first", "below"), "conv_id").join(digest_of_ids(ends, scratch), ["conv_id", "depth"], "left")
    parent = F.when(F.col("depth") > F.col("first"), F.col("conv_id")).otherwise(F.col("below"))
    return out.select("conv_id", "depth", parent.alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(_EMPTY)).alias("ends_sha256"))


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """The trie of rebuilt conversations (conv_id, turn, role, text; other columns are not looked at).

    Null roles and texts are empty, null turns come first, equal turn numbers stand by
    the digest of role and text, repeated rows are repeated turns, rows without a conv_id
    are left out; an empty table has no nodes. Texts and conversations have any length.
    """
    scratch = Scratch(conversations.sparkSession, "trie")
    rows, sizes = rebuilt(turns(conversations.select("conv_id", "turn", "role", "text"), scratch), scratch)
    return trie(rows, sizes, scratch)


_LETTERS = "md5(concat(length(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, '')))"

#: All prefixes as texts, all ancestors of all nodes.
SQL = rf"""
WITH tab AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda c, j: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS tab),
t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, {_LETTERS}) - 1 AS pos, {_LETTERS} AS x,
  len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS words FROM conversations WHERE conv_id IS NOT NULL),
b AS (SELECT DISTINCT conv_id, list_transform(regexp_extract_all(hex(encode(conv_id::VARCHAR)), '..'), lambda h: ('0x' || h)::BIGINT) AS bytes FROM t),
c AS (SELECT conv_id, xor(list_reduce(list_prepend(4294967295::BIGINT, bytes), lambda a, y: xor(a // 256, tab[xor(a % 256, y) + 1])), 4294967295) % 4 AS h FROM b, tab),
r AS (
  SELECT c.conv_id, 0 AS own, pos, x, words FROM c JOIN t ON t.conv_id = c.conv_id - c.conv_id % 20 AND t.pos < c.h
  UNION ALL SELECT conv_id, 1, pos, x, words FROM c JOIN t USING (conv_id) WHERE pos >= h),
q AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY own, pos) AS d, x, words FROM r),
p AS MATERIALIZED (
  SELECT conv_id, d, md5(string_agg(x, ',') OVER (PARTITION BY conv_id ORDER BY d)) AS k, words FROM q
  UNION ALL SELECT conv_id, 0, '', 0 FROM c),
n AS MATERIALIZED (SELECT d, k, min(conv_id) AS conv_id, count(*) AS n_convs, max(words) AS words FROM p GROUP BY d, k),
up AS MATERIALIZED (SELECT n.d, n.k, a.k AS pk, m.conv_id AS parent FROM n JOIN p a ON a.conv_id = n.conv_id AND a.d = n.d - 1 JOIN n m ON m.d = a.d AND m.k = a.k),
f AS (SELECT d - 1 AS d, pk AS k, count(*) AS n_children FROM up GROUP BY 1, 2),
o AS MATERIALIZED (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN f USING (d, k)),
s AS (SELECT a.d, a.k, count(*) FILTER (n_children = 0) AS n_leaves, sum((n_convs - 1) * o.words) AS saved FROM o JOIN p a ON a.conv_id = o.conv_id AND a.d <= o.d GROUP BY 1, 2),
l AS (SELECT conv_id, max(d) AS d FROM p GROUP BY 1),
e AS (SELECT d, k, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids FROM l JOIN p USING (conv_id, d) GROUP BY 1, 2)
SELECT conv_id, d AS depth, parent AS parent_conv_id, n_convs, n_children, n_leaves, saved::BIGINT AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM o LEFT JOIN up USING (d, k) JOIN s USING (d, k) LEFT JOIN e USING (d, k)"""
