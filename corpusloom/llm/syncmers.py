"""Document fingerprints by closed syncmers, in Spark expressions only.

The letters are a text's words (runs without white space). Each k-mer of K words
has W = K - S + 1 inner s-mers of S words; a k-mer is chosen when the smallest of
their hashes is that of its first or of its last s-mer. Whether a k-mer is chosen
depends on the k-mer alone, so a shared passage has the same anchors wherever it
stands, at the same distances from each other; a text with words but no chosen
k-mer has one anchor of all its words. The fingerprint lists the anchors'
hashes in text order; likeness is the Jaccard index of two anchor sets.

The sliding minimum is made by doubling: minima over 2, 4, 8 s-mers, each from the
one before, so the work is a few passes over the array of words, whatever the text.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Words of an inner s-mer, s-mers of a k-mer (a power of two), and words of a k-mer.
S = 2
W = 8
K = W + S - 1

#: Rows of a range of ids, the most ranges, and ids that are drawn for each bound (a million at most).
RANGE_ROWS = 512
MOST_RANGES = 16_384
DRAWN = 64


def word_hashes(text: Column) -> Column:
    """Hash of each word; null and blank texts have none."""
    words = F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[ \t\n\x0B\f\r]+"), "")
    return F.transform(words, lambda w: F.xxhash64(w))


def _from(a: Column, first: int) -> Column:
    """The array without its first elements."""
    return F.slice(a, F.lit(first + 1), F.greatest(F.size(a) - first, F.lit(0)))


def with_anchors(df: DataFrame, text_col: str, out: str) -> DataFrame:
    """df with column `out`: array of anchor hashes in text order.

    A text with words of which no k-mer is chosen (fewer than K words, or a short
    one) has one anchor, all its words; a text without words has none. The steps are columns of their own, because each
    is used more than once.
    """
    h, s = f"__h_{out}", f"__s_{out}"
    df = df.withColumn(h, word_hashes(F.col(text_col)))
    pair = F.zip_with(F.col(h), _from(F.col(h), 1), lambda a, b: F.xxhash64(a, b))
    df = df.withColumn(s, F.slice(pair, F.lit(1), F.greatest(F.size(h) - (S - 1), F.lit(0))))
    step, m = 1, s
    while step < W:
        new = f"__m{step * 2}_{out}"
        df = df.withColumn(new, F.zip_with(F.col(m), _from(F.col(m), step), lambda a, b: F.least(a, b)))
        step, m = step * 2, new
    places = F.filter(
        F.sequence(F.lit(1), F.size(h) - (K - 1)),
        lambda i: (F.get(F.col(s), i - 1) == F.get(F.col(m), i - 1)) | (F.get(F.col(s), i + (W - 2)) == F.get(F.col(m), i - 1)),
    )
    at = f"__at_{out}"
    df = df.withColumn(at, F.when(F.size(h) >= K, places).otherwise(F.array().cast("array<int>")))
    anchors = (
        F.when(F.size(at) > 0, F.transform(at, lambda i: F.xxhash64(F.slice(F.col(h), i, F.lit(K)))))
        .when(F.size(h) > 0, F.array(F.xxhash64(F.col(h))))
        .otherwise(F.array().cast("array<bigint>"))
    )
    made = df.withColumn(out, anchors)
    return made.drop(*(c for c in made.columns if c.startswith("__") and c.endswith(f"_{out}")))


def as_text(anchors: Column) -> Column:
    """The fingerprint: the low 32 bits of each anchor, eight hex digits each, in text order."""
    return F.array_join(F.transform(anchors, lambda a: F.lpad(F.lower(F.hex(a.bitwiseAND(F.lit(0xFFFFFFFF)))), 8, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard index of two anchor sets; 1 where both are empty."""
    both = F.size(F.array_intersect(a, b))
    either = F.size(F.array_union(a, b))
    return F.when(either == 0, F.lit(1.0)).otherwise(both.cast("double") / either)


def range_of(x: Column, bounds: list, kind: str) -> Column:
    """How many bounds (of Spark's type `kind`) lie below x, by bisection in a constant array; 0 for null."""
    if not bounds:
        return F.lit(0)
    held = F.from_json(F.lit(json.dumps([b if isinstance(b, int) else str(b) for b in bounds])), f"array<{kind}>")
    steps = [1 << j for j in reversed(range(len(bounds).bit_length()))]
    found = F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), lambda at, by: F.when((at + by <= len(bounds)) & (F.get(held, at + by - 1) < x), at + by).otherwise(at))
    return F.when(x.isNull(), F.lit(0)).otherwise(found)


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text and rng of docs, and the rows that stand behind each range's last, marked `guest`.

    Ids, of any type with an order, are cut into ranges at quantiles of DRAWN ids a
    bound; where the cuts lie decides who works, never a result. A range's guests are
    the rows with the smallest id of the range after it (after the last: of the
    first). So the row after any row is in its own range and no window spans the
    table. Only the drawn ids and each range's smallest one reach the driver.
    """
    ids = docs.select("doc_id")
    n = ids.count()
    want = max(1, min(MOST_RANGES, n // RANGE_ROWS))
    kind = docs.schema["doc_id"].dataType.simpleString()
    bounds: list = []
    if want > 1:
        drawn = sorted(r[0] for r in ids.filter(F.col("doc_id").isNotNull()).sample(min(1.0, DRAWN * want / n), 7).collect())
        bounds = sorted({drawn[len(drawn) * i // want] for i in range(1, want)}) if drawn else []
    rows = docs.select("doc_id", "text", range_of(F.col("doc_id"), bounds, kind).alias("rng"))
    least = rows.groupBy("rng").agg(F.min("doc_id").alias("i"), F.max(F.col("doc_id").isNull()).alias("none"))
    first = [(r["rng"], None if r["none"] else r["i"]) for r in least.orderBy("rng").collect()]
    hosts = [(i, first[k - 1][0]) for k, (_, i) in enumerate(first)]
    own = rows.withColumn("guest", F.lit(False))
    if not hosts:
        return own
    small = docs.sparkSession.createDataFrame(hosts, f"first {kind}, host int")
    guests = docs.select("doc_id", "text").join(F.broadcast(small), F.col("doc_id").eqNullSafe(F.col("first")))
    return own.unionByName(guests.select("doc_id", "text", F.col("host").alias("rng"), F.lit(True).alias("guest")))


def fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, anchors (array of long, in text order), fingerprint (their text).

    Null and empty texts and those without words have no anchors and the empty fingerprint; equal texts
    have equal fingerprints. Other columns are not looked at.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return with_anchors(rows, "text", "anchors").select("doc_id", "anchors", as_text(F.col("anchors")).alias("fingerprint"))


def compare_edited(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of each text and of its edited text, and how alike they and the next document's are.

    The edited text has its last floor(n_chars / 2) code points replaced by the
    first as many (or all) of the next document, by ascending doc_id; after the
    last comes the first. Null texts count as empty; null ids come first; rows
    with one id are ordered by text. One row per row of docs, none for an empty
    table (one lone row is its own next). Two fingerprints without anchors are
    alike (1.0). Texts are moved once, to the range of their id.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    dealt = with_anchors(with_next(rows).repartition("rng"), "text", "anchors")
    order = Window.partitionBy("rng").orderBy("guest", F.asc_nulls_first("doc_id"), "text")
    near = dealt.withColumns({"next_text": F.lead("text").over(order), "next_anchors": F.lead("anchors").over(order)}).filter(~F.col("guest"))
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = near.withColumns({"n_chars": n.cast("long"), "edited": F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("next_text"), F.lit(1), half))})
    out = with_anchors(edited.drop("text", "next_text"), "edited", "edited_anchors")
    return out.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        as_text(F.col("anchors")).alias("fingerprint"),
        as_text(F.col("edited_anchors")).alias("edited_fingerprint"),
        likeness(F.col("anchors"), F.col("edited_anchors")).alias("near_edited"),
        likeness(F.col("anchors"), F.col("next_anchors")).alias("near_next"),
    )
