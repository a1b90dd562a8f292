"""Near-duplicates by bottom-k sketches, with exact links.

A document's set holds the hashes of its word shingles. One hash function orders
all shingles; the K smallest of a set are its sketch.

1. Equal sets fall together first, so a group of copies is one set from here on.
2. Inverted lists of retained values generate overlaps. A value that more than LIST
   sets retain (a passage that many documents share, a group of near copies) is hot
   and makes no pairs; each set stands in the lists of the FEW smallest cold values
   of its sketch. Of two sets with similarity 0.8, of which the share of hot values is
   at most NEARLY_ALL, no retained cold value is common with a probability below 1e-6.
3. Overlap counts, then the union sketch (the K smallest of two sketches together
   estimate the similarity without bias) remove unlikely pairs; what is left is
   verified on full sets: 100 * intersection >= T * union. Where both sets fit
   their sketches the sketch is the full set. A list makes LIST * LIST / 2 pairs at
   most, so pairs grow with the number of sets and not with the size of a group.
4. Sets with a larger share of hot values (members of large groups of near copies)
   are compared with a few pivots of each of their hot lists, round by round, which
   joins a group without making its pairs. The sets that are still outside the main
   component of a list are then looked up on full sets among all of these sets, in
   blocks, by an exact prefix filter: sets meet only where they share one of the
   rarest values of both.
5. Components of the verified links: by alternating stars over all executors, or,
   up to a counted number of links, by union-find in one task.

Texts are read once for sketches; the full sets of those that must be compared, and
of no others, are made in a second reading and kept as sorted arrays until the end.

Nulls, empty texts and texts without words have the empty set and are linked with
nothing; a null doc_id is the largest; repeated rows are equal sets.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, keyed, small_batches, unkeyed
from .wordhash import NONSPACE, grams, pieces, words

#: Values of a sketch; cold values of it whose lists are used; sets of a list that still makes pairs.
K, FEW, LIST = 64, 32, 32

#: Share of hot values from which a set is compared by pivots, and its hot lists that are used.
NEARLY_ALL, HOT_LISTS = 0.6, 12

#: Pivots of a hot list, rounds, and hot lists of a set that are used in a round.
PIVOTS, ROUNDS, ROUND_LISTS = 4, 3, 4

#: Rows up to which a table may be broadcast (they are counted first).
SMALL = 100_000

#: Links up to which one task works out the components.
ONE_TASK = 200_000

#: Bytes of the full sets of a block of the look-up.
BLOCK = 2 << 20

_MARGIN = 5.5  # standard deviations by which an estimate may be off


def shingle_sets(run: list[bytes], size: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text; fewer words than size make one shingle of them all."""
    w = words(run, NONSPACE)
    g = grams(w.hash, size).view(np.int64)
    for i in range(len(run)):
        a, b = int(w.first[i]), int(w.first[i + 1])
        if b - a >= size:
            yield np.unique(g[a : b - size + 1])
        elif b > a:
            yield grams(w.hash[a:b], b - a).view(np.int64)
        else:
            yield np.zeros(0, dtype=np.int64)


def _signature(s: np.ndarray) -> bytes | None:
    return hashlib.sha256(s.tobytes()).digest()[:16] if len(s) else None


def signed(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, n (set size), sig (128 bits that name the set; null for the empty one) and sketch."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for at, texts in pieces(b["text"]):  # what leaves together is a piece, not a batch
                sets = list(shingle_sets(texts, size))
                yield pd.DataFrame({"doc_id": b["doc_id"].iloc[at : at + len(sets)].to_numpy(), "n": [len(s) for s in sets], "sig": [_signature(s) for s in sets], "sketch": [s[:K] for s in sets]})

    out = keyed(docs, "doc_id", F.col("text")).mapInPandas(run, "doc_id string, n long, sig binary, sketch array<long>")
    return unkeyed(out, docs, "doc_id")


def estimate(a: Column, b: Column) -> Column:
    """Similarity of two sets from the K smallest of their sketches together."""
    union = F.slice(F.array_sort(F.array_union(a, b)), 1, K)
    return F.size(F.array_intersect(F.array_intersect(a, b), union)).cast("double") / F.size(union)


def _small(df: DataFrame) -> DataFrame:
    """A written table, to be broadcast only where it has few rows, which is counted."""
    return F.broadcast(df) if df.limit(SMALL + 1).count() <= SMALL else df


def _least_overlap(share: Column, n: Column) -> Column:
    """Common cold values that a similar pair has all but surely, by the share of hot values."""
    by = F.when(share <= 0.0, 8).when(share <= 0.2, 4).when(share <= 0.35, 2).otherwise(1)
    return F.least(by, F.ceil(F.least(n, F.lit(FEW)) * 0.6 * (1 - share)), n).cast("long")


class Clusters:
    """One run over one table; every table that it writes goes when the run no longer needs it."""

    def __init__(self, docs: DataFrame, size: int, percent: int) -> None:
        small_batches(docs.sparkSession)
        self.docs, self.size, self.percent = docs, size, percent
        self.scratch = Scratch(docs.sparkSession, "neardup")

    def distinct_sets(self, own: DataFrame) -> DataFrame:
        """One row per distinct set: sig, k (64 bits of it), n, sketch, least (its smallest doc_id). Copies are combined before they move."""
        sets = own.filter(F.col("sig").isNotNull()).groupBy("sig").agg(F.min("doc_id").alias("least"), F.first("n").alias("n"), F.first("sketch").alias("sketch"))
        return self.scratch.put(sets.withColumn("k", F.xxhash64("sig")))

    def lists(self, sets: DataFrame) -> DataFrame:
        """k, sig, n, share (of its retained values that are hot), cold (values whose lists it is in), vs (its hot lists, where it is nearly all hot).

        k stands for a set in lists and pairs. Two sets that met in one k would give
        candidates too many, never a link too many.
        """
        crowded = self.scratch.put(sets.select(F.explode("sketch").alias("v")).groupBy("v").count().filter(F.col("count") > LIST).select("v"))
        hot = sets.select("k", F.explode("sketch").alias("v")).join(_small(crowded), "v").groupBy("k").agg(F.array_sort(F.collect_list("v")).alias("hot"))  # of at most K values a set
        out = sets.join(hot, "k", "left").withColumn("hot", F.coalesce("hot", F.array().cast("array<long>"))).withColumn("share", F.size("hot") / F.size("sketch"))
        cold = F.slice(F.array_except("sketch", "hot"), 1, FEW).alias("cold")
        out = self.scratch.put(out.select("k", "sig", "n", "share", cold, F.when(F.col("share") > NEARLY_ALL, F.slice("hot", 1, HOT_LISTS)).alias("vs")))
        self.scratch.free(crowded)
        return out

    def cold_pairs(self, lists: DataFrame) -> DataFrame:
        """ka, kb (ka < kb): pairs that meet often enough in cold lists, and may be similar by their sizes."""
        rows = lists.select(F.explode("cold").alias("v"), F.struct("k", "n", "share").alias("s"))
        held = rows.groupBy("v").agg(F.collect_list("s").alias("m")).filter(F.size("m") > 1)  # at most LIST, as v is not hot
        a = held.select(F.explode("m").alias("a"), "m")

        def partner(b: Column) -> Column:
            n, m = F.col("a.n"), b["n"]
            return (b["k"] > F.col("a.k")) & (n * 100 >= m * self.percent) & (m * 100 >= n * self.percent)

        met = a.select("a", F.explode(F.filter("m", partner)).alias("b")).select(F.col("a.k").alias("ka"), F.col("b.k").alias("kb"), F.least("a.n", "b.n").alias("n"), F.greatest("a.share", "b.share").alias("share"))
        counted = met.groupBy("ka", "kb").agg(F.count("*").alias("c"), F.first("n").alias("n"), F.first("share").alias("share"))
        return counted.filter(F.col("c") >= _least_overlap(F.col("share"), F.col("n"))).select("ka", "kb")

    def estimated(self, pairs: DataFrame, sets: DataFrame) -> DataFrame:
        """ka, kb, a, b (their sigs) and sure of the pairs that may be similar; where sure, they are links."""
        t = self.percent / 100
        pairs = self.scratch.put(pairs)
        met = self.scratch.put(pairs.select(F.explode(F.array("ka", "kb")).alias("k")).distinct())
        few = sets.join(_small(met), "k", "left_semi")  # sketches of few sets move with the pairs
        side = lambda x: few.select(F.col("k").alias(f"k{x}"), F.col("sig").alias(x), F.col("n").alias(f"n{x}"), F.col("sketch").alias(f"s{x}"))
        both = pairs.join(side("a"), "ka").join(side("b"), "kb")
        sure = (F.col("na") <= K) & (F.col("nb") <= K)
        whole = F.size(F.array_intersect("sa", "sb")).cast("double") / F.size(F.array_union("sa", "sb"))
        # K of at least max(na, nb) values are looked at, without replacement
        unseen = F.greatest(1 - K / F.greatest("na", "nb"), F.lit(0.1))
        low = t - _MARGIN * F.sqrt(t * (1 - t) / K * unseen)
        keep = F.when(sure, whole >= t - 1e-9).otherwise(estimate(F.col("sa"), F.col("sb")) >= low)
        out = self.scratch.put(both.filter(keep).select("ka", "kb", "a", "b", sure.alias("sure")))
        self.scratch.free(pairs, met)
        return out

    def fetch(self, sets: DataFrame, keys: DataFrame) -> None:
        """Keep the full sets (k, sig, n, full: sorted hashes, eight bytes each) of these keys, from one document each."""
        keys = self.scratch.put(keys.distinct())
        need = self.scratch.put(sets.select("k", "sig", "least").join(_small(keys), "k", "left_semi"))
        asked = _small(need.select("least").distinct().withColumnRenamed("least", "asked"))
        size = self.size

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                for _, texts in pieces(b["text"]):
                    own = [s for s in shingle_sets(texts, size) if len(s)]
                    yield pd.DataFrame({"sig": [_signature(s) for s in own], "n": [len(s) for s in own], "full": [s.tobytes() for s in own]})

        read = self.docs.join(asked, F.col("doc_id").eqNullSafe(F.col("asked")), "left_semi").select("text").mapInPandas(run, "sig binary, n long, full binary")
        # a document that repeats an id may bring a set that nobody asked for
        found = read.join(_small(need).select("sig", "k"), "sig").groupBy("sig").agg(F.first("k").alias("k"), F.first("n").alias("n"), F.first("full").alias("full"))
        self.full = self.scratch.put(found)
        self.scratch.free(keys, need)

    def verified(self, pairs: DataFrame) -> DataFrame:
        """a, b of the pairs (ka, kb) that are links: estimated from the union sketch, then verified on full sets."""
        side = lambda x: self.full.select(F.col("k").alias(f"k{x}"), F.col("sig").alias(x), F.col("full").alias(f"s{x}"))
        both = pairs.select("ka", "kb").join(side("a"), "ka").join(side("b"), "kb").select("a", "b", "sa", "sb")
        percent, t = self.percent, self.percent / 100

        def likely(x: np.ndarray, y: np.ndarray) -> bool:
            union = np.union1d(x[:K], y[:K])[:K]
            common = len(np.intersect1d(np.intersect1d(x[:K], y[:K], assume_unique=True), union, assume_unique=True))
            return common / len(union) >= t - _MARGIN * math.sqrt(t * (1 - t) / K)

        def linked(x: bytes, y: bytes) -> bool:
            s, o = np.frombuffer(x, dtype=np.int64), np.frombuffer(y, dtype=np.int64)
            if min(len(s), len(o)) * 100 < max(len(s), len(o)) * percent or not likely(s, o):
                return False
            common = len(np.intersect1d(s, o, assume_unique=True))
            return 100 * common >= percent * (len(s) + len(o) - common)

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                yield b.loc[[linked(x, y) for x, y in zip(b["sa"], b["sb"], strict=True)], ["a", "b"]]

        return both.mapInPandas(run, "a binary, b binary")

    def components(self, links: DataFrame) -> DataFrame:
        """node, label (the smallest node of its component) of the linked nodes.

        Up to ONE_TASK links, which are counted, one task unites them; more are united
        by alternating large and small stars over all executors, with equal labels.
        """
        put, free = self.scratch.put, self.scratch.free
        edges = put(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter(F.col("u") != F.col("v")).distinct())
        if edges.count() <= ONE_TASK:
            out = put(edges.coalesce(1).mapInPandas(_united, "node binary, label binary"))
            free(edges)
            return out
        before = None
        while True:
            both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
            least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
            large = both.join(least, "u").filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct()
            down = large.groupBy("u").agg(F.min("v").alias("m"))
            small = large.join(down, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").unionByName(down.select("u", F.col("m").alias("v"))).distinct()
            old, edges = edges, put(small)
            free(old)
            now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
            if now == before or not now[0]:
                break
            before = now
        out = put(edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()))
        free(edges)
        return out

    def join_hot(self, members: DataFrame, links: DataFrame, labels: DataFrame) -> DataFrame:
        """Labels after the sets that are nearly all hot (k, sig, n, vs) have been linked too."""
        put, free = self.scratch.put, self.scratch.free
        for r in range(ROUNDS):
            some = F.slice("vs", r * ROUND_LISTS + 1, ROUND_LISTS)  # members of a group share most lists, so few are enough
            now = put(_labelled(members, labels).select("k", "sig", "label", F.explode(some).alias("v")))
            picks = [F.min(F.struct(F.xxhash64("sig", F.lit(r * PIVOTS + i)).alias("h"), F.col("k").alias("p"), F.col("label").alias("pl"))).alias(f"p{i}") for i in range(PIVOTS)]
            pivots = put(now.groupBy("v").agg(*picks).select("v", F.explode(F.array_distinct(F.array(*(F.struct(f"p{i}.p", f"p{i}.pl") for i in range(PIVOTS))))).alias("x")).select("v", "x.p", "x.pl"))
            pairs = now.join(_small(pivots), "v").filter((F.col("p") != F.col("k")) & (F.col("pl") != F.col("label"))).select(F.col("k").alias("ka"), F.col("p").alias("kb")).distinct()
            old, links = links, put(links.unionByName(self.verified(pairs)))
            free(old, labels, now, pivots)
            labels = self.components(links)
        now = put(_labelled(members, labels).select("sig", "label", F.explode("vs").alias("v")))
        main = put(now.groupBy("v", "label").count().groupBy("v").agg(F.max(F.struct("count", "label")).alias("m")).select("v", F.col("m.label").alias("main")))
        outside = put(now.join(_small(main), "v").filter(F.col("label") != F.col("main")).select("sig").distinct())
        if not outside.isEmpty():
            all_full = put(_labelled(members.select("sig"), labels).join(self.full, "sig").select("sig", "label", "n", "full"))
            asked = put(all_full.join(_small(outside), "sig", "left_semi"))
            old, links = links, put(links.unionByName(self.looked_up(asked, all_full)))
            free(old, labels, all_full, asked)
            labels = self.components(links)
        free(now, main, outside, links)
        return labels

    def prefixes(self, rows: DataFrame) -> DataFrame:
        """sig and v of the values by which a set (sig, n, full) meets all sets of rows that it may be linked with.

        Values are ordered by the number of sets that hold them, the rarest first, ties by
        value. Linked sets have at least `need` = ceil(percent * n / 100) values in common, so
        the first common one is among the first n - need + 1 of either set. Values that
        one set alone holds come first and meet nothing: only the m others are ranked,
        and the first m - need + 1 of them kept.
        """

        def values(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                for sig, n, x in zip(b["sig"], b["n"], b["full"], strict=True):
                    v = np.frombuffer(x, dtype=np.int64)
                    yield pd.DataFrame({"sig": [sig] * len(v), "n": np.full(len(v), n), "v": v})

        held = self.scratch.put(rows.select("sig", "n", "full").mapInPandas(values, "sig binary, n long, v long"))
        shared = held.groupBy("v").count().filter(F.col("count") > 1)
        own = Window.partitionBy("sig")  # the values of one set
        place, m = F.row_number().over(own.orderBy("count", "v")), F.count(F.lit(1)).over(own)
        need = F.ceil(F.col("n") * self.percent / 100)
        ranked = held.join(shared, "v").select("sig", "v", place.alias("place"), (m - need + 1).alias("last"))
        out = self.scratch.put(ranked.filter(F.col("place") <= F.col("last")).select("sig", "v"))
        self.scratch.free(held)
        return out

    def looked_up(self, asked: DataFrame, answering: DataFrame) -> DataFrame:
        """Exact links between asked sets and all answering ones (sig, label, n, full), as pairs of labels; the asked are among the answering.

        The asked are dealt into bands of like sizes and each band, by its counted bytes,
        into blocks. An answering set goes to the blocks of its band that hold one of its
        prefix values and to no others; what comes to a block is counted and cut into
        chunks. A block's full sets are inverted and each answering set counts its common
        values with every set of the block at once. One link between two components is
        as good as all, so each block gives at most one per pair of labels.
        """
        percent, put, free = self.percent, self.scratch.put, self.scratch.free
        # a little wider than the largest ratio of sizes that a link allows, so partners are in touching bands
        band = F.floor(F.log("n") / (1.01 * math.log(100 / percent))).cast("int") if percent < 100 else F.col("n").cast("int")
        parts = lambda n: (F.floor(F.sum(n) * 8 / BLOCK) + 1).cast("int")
        place = lambda n, seed: F.pmod(F.xxhash64("sig", F.lit(seed)), F.col(n)).cast("int")
        prefix = self.prefixes(answering)
        near = asked.select("sig", "n", F.explode(F.array(band - 1, band, band + 1)).alias("band"))
        # bands grow with the logarithm of the largest set, so this is a short table
        blocks = F.broadcast(near.groupBy("band").agg(parts("n").alias("blocks")))
        near = put(near.join(blocks, "band").select("sig", "band", place("blocks", 1).alias("block")))
        wanted = near.join(prefix, "sig").select("band", "v", "block").distinct()
        offered = answering.select("sig", "n", band.alias("band")).join(prefix, "sig")
        met = put(offered.join(wanted, ["band", "v"]).select("band", "block", "sig", "n").distinct())
        chunks = put(met.groupBy("band", "block").agg(parts("n").alias("chunks")))
        every = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk")
        full = lambda df: df.select("sig", *(F.col(c).alias(c) for c in ("label", "full")))
        q = near.join(chunks, ["band", "block"]).select("sig", "band", "block", every).join(full(asked), "sig").drop("sig")
        a = met.join(chunks, ["band", "block"]).select("sig", "band", "block", place("chunks", 2).alias("chunk")).join(full(answering), "sig").drop("sig")

        def run(q: pd.DataFrame, a: pd.DataFrame) -> pd.DataFrame:
            out: set[tuple[bytes, bytes]] = set()
            if len(q) and len(a):
                sets = [np.frombuffer(x, dtype=np.int64) for x in q["full"]]
                values, n = np.concatenate(sets), np.array([len(s) for s in sets])
                order = np.argsort(values, kind="stable")
                values, owner = values[order], np.repeat(np.arange(len(sets)), n)[order]
                theirs = [bytes(x) for x in q["label"]]
                for label, x in zip(a["label"], a["full"], strict=True):
                    s, mine = np.frombuffer(x, dtype=np.int64), bytes(label)
                    lo, hi = np.searchsorted(values, s, side="left"), np.searchsorted(values, s, side="right")
                    met = [owner[i:j] for i, j in zip(lo.tolist(), hi.tolist(), strict=True) if j > i]
                    if not met:
                        continue
                    c = np.bincount(np.concatenate(met), minlength=len(n))
                    for i in np.flatnonzero(100 * c >= percent * (n + len(s) - c)).tolist():
                        if theirs[i] != mine:
                            out.add((min(theirs[i], mine), max(theirs[i], mine)))
            return pd.DataFrame(sorted(out), columns=["a", "b"])

        keys = ("band", "block", "chunk")
        out = put(q.groupBy(*keys).cogroup(a.groupBy(*keys)).applyInPandas(run, "a binary, b binary"))
        free(prefix, near, met, chunks)
        return out

    def run(self) -> DataFrame:
        put, free = self.scratch.put, self.scratch.free
        own = put(signed(self.docs, self.size))
        sets = self.distinct_sets(own)
        lists = self.lists(sets)
        cold = self.estimated(self.cold_pairs(lists), sets)
        members = put(lists.filter(F.col("vs").isNotNull()).select("k", "sig", "n", "vs"))
        free(lists)
        unsure = cold.filter(~F.col("sure"))
        self.fetch(sets, unsure.select(F.explode(F.array("ka", "kb")).alias("k")).unionByName(members.select("k")))
        links = put(cold.filter("sure").select("a", "b").unionByName(self.verified(unsure)))
        labels = self.components(links)
        if not members.isEmpty():
            labels = self.join_hot(members, links, labels)
        named = _labelled(sets.select("sig", "least"), labels)
        least = named.groupBy("label").agg(F.min("least").alias("component_id"))
        place = put(named.select("sig", "label").join(least, "label").select("sig", "component_id"))
        free(self.full, links, labels, cold, members, sets)
        own = own.select("doc_id", "n", "sig").join(place, "sig", "left")
        component = F.when(F.col("sig").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
        return own.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), component.eqNullSafe(F.col("doc_id")).alias("kept"))


def _united(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Components of one task's edges by union-find; the smallest node is the root."""
    up: dict[bytes, bytes] = {}

    def top(x: bytes) -> bytes:
        while (y := up.setdefault(x, x)) != x:
            up[x] = up[y]
            x = up[x]
        return x

    for batch in batches:
        for u, v in zip(batch["u"], batch["v"], strict=True):
            a, b = top(bytes(u)), top(bytes(v))
            if a != b:
                up[max(a, b)] = min(a, b)
    nodes = list(up)
    yield pd.DataFrame({"node": nodes, "label": [top(x) for x in nodes]})


def _labelled(members: DataFrame, labels: DataFrame) -> DataFrame:
    return members.join(labels.withColumnRenamed("node", "sig"), "sig", "left").withColumn("label", F.coalesce("label", "sig"))


def cluster(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of docs: doc_id, n_shingles, component_id (smallest doc_id reachable), kept.

    Shingles of `shingle` words; links where 100 * intersection >= percent * union.
    Ids may be of any type with an order. See the module for nulls, empty texts, ties
    and repeated rows; other columns are not looked at; an empty table gives no rows.
    """
    return Clusters(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), shingle, percent).run()
