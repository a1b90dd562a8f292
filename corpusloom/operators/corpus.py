"""Rows of a collection: first-wins dedupe, neighbours, incremental recompute, derived metadata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X

SCHEMA_VERSION = 1
SPARSE_CHARS = 300


def path_order(path: Column) -> Column:
    """Sorts paths by their parts, as file trees are walked; plain strings sort otherwise."""
    return F.split(path, "/")


def keep_first(rows: DataFrame, key: Column, order: list[Column], null_keys: str = "keep") -> DataFrame:
    """Of rows with one key the first by a total order; rows without a key are all kept, or dropped.

    The smallest of each key is found by aggregation, which combines on the map
    side, so a key with most of the rows is no task's burden.
    """
    marked = rows.withColumns({"__k": key.cast("string"), "__o": F.struct(*(o.alias(f"o{i}") for i, o in enumerate(order)))})
    has = F.col("__k").isNotNull() & (F.col("__k") != "")
    first = marked.filter(has).groupBy("__k").agg(F.min_by(F.struct(*rows.columns), F.col("__o")).alias("__r")).select("__r.*")
    if null_keys == "drop":
        return first
    return first.unionByName(marked.filter(~has | F.col("__k").isNull()).drop("__k", "__o"))


def dedupe_counts(rows: DataFrame, key: str) -> DataFrame:
    """n_raw, n_unique, n_skipped; rows without a key count as unique each."""
    got = rows.agg(F.count("*").alias("n_raw"), F.countDistinct(F.nullif(F.col(key).cast("string"), F.lit(""))).alias("k"), F.sum((F.coalesce(F.col(key).cast("string"), F.lit("")) == "").cast("long")).alias("none"))
    unique = F.col("k") + F.coalesce("none", F.lit(0))
    return got.select("n_raw", unique.alias("n_unique"), (F.col("n_raw") - unique).alias("n_skipped"))


def neighbours(rows: DataFrame, group: list[str], order: list[Column], key: str) -> DataFrame:
    """rows with prev_id and next_id inside their group."""
    w = Window.partitionBy(*group).orderBy(*order)
    return rows.withColumns({"prev_id": F.lag(key).over(w), "next_id": F.lead(key).over(w)})


#: Fixed value: the section whose folders are sub courses.
SPECIAL_SECTION = "Automation Tutorials"


def place_columns(path: Column, special: str = SPECIAL_SECTION, course_from_section: bool = True, root: str = "") -> dict[str, Column]:
    """course, sub_course, module_dir and module_title of a lesson folder's path below the root, which is three deep or more.

    The second folder is the module; under the special section it is the sub course
    too, named without its index.
    """
    parts = F.split(path, "/")
    section, module = F.get(parts, F.lit(0)), F.get(parts, F.lit(1))
    bare = X.strip_index(module)
    return {"course": section if course_from_section else F.lit(root), "sub_course": F.when(section == special, bare), "module_dir": module, "module_title": bare}


def seen_rank(rows: DataFrame, key: str, order: list[Column], name: str = "seen") -> DataFrame:
    """rows with their place (from 1) among those of one key, in a total order."""
    return rows.withColumn(name, F.row_number().over(Window.partitionBy(key).orderBy(*order)))


def first_rows(rows: DataFrame, order: list[Column], limit: int | None = None) -> DataFrame:
    """rows in a total order; with a limit the first so many, of which each task keeps no more."""
    ordered = rows.orderBy(*order)
    return ordered if limit is None else ordered.limit(limit)


def incremental(current: DataFrame, previous: DataFrame, key: str, force: bool = False) -> DataFrame:
    """current with `cached`: the previous row has this version, the same body and some tags."""
    prev = previous.select(F.col(key), F.col("schema").alias("__s"), F.col("body_sha").alias("__b"), F.size("tags").alias("__t"))
    hit = (F.col("__s") == SCHEMA_VERSION) & F.col("__b").eqNullSafe(F.col("body_sha")) & (F.col("__t") > 0) & F.lit(not force)
    return current.join(prev, key, "left").withColumn("cached", F.coalesce(hit, F.lit(False))).drop("__s", "__b", "__t")


def is_sparse(html: Column, transcript: Column, least: int = SPARSE_CHARS) -> Column:
    return F.length(F.coalesce(html, F.lit(""))) + F.length(F.coalesce(transcript, F.lit(""))) < least


#: A tag and the words of a place that earn it, in the order in which tags are given.
SPARSE_TAGS = [
    ("n8n", ["n8n"]),
    ("make", ["make"]),
    ("agentic-workflows", ["agentic"]),
    ("community-call", ["community", "call"]),
    ("template", ["template", "blueprint"]),
    ("resource", ["resource", "library"]),
    ("niche-pack", ["niche", "pack"]),
    ("sales-training", ["sales"]),
    ("vibe-coding", ["vibe", "coding"]),
]
#: A concept and the words that must all be there; the first that fits counts.
SPARSE_CONCEPTS = [("N8N Blueprint Library", ["blueprint"]), ("Niche Packs", ["niche", "pack"]), ("Community Exclusives", ["community", "exclusive"]), ("Community Calls", ["community", "call"])]


def sparse_metadata(course: Column, sub_course: Column, module: Column, resources: Column) -> dict[str, Column]:
    """summary, tags and concept from a place alone, for rows too short to classify."""
    ctx = F.lower(F.concat(course, F.lit(" "), F.coalesce(sub_course, F.lit("")), F.lit(" "), module))
    any_of = lambda ws: F.greatest(*(ctx.contains(w) for w in ws), F.lit(False))
    tags = F.array_compact(F.array(*(F.when(any_of(ws), F.lit(t)) for t, ws in SPARSE_TAGS), F.lit("reference")))
    concept = F.coalesce(F.nullif(X.strip(F.btrim(X.strip(module), F.lit(":"))), F.lit("")), course)
    for name, ws in reversed(SPARSE_CONCEPTS):
        every = F.lit(True)
        for w in ws:
            every = every & ctx.contains(w)
        concept = F.when(every, F.lit(name)).otherwise(concept)
    said = F.concat(F.lit("Reference entry in "), course, F.lit(" › "), module, F.lit("."))
    files = F.when(resources > 0, F.concat(F.lit(" Includes "), resources.cast("string"), F.lit(" downloadable resource"), F.when(resources != 1, F.lit("s")).otherwise(F.lit("")), F.lit("."))).otherwise(F.lit(""))
    return {"summary": F.left(F.concat(said, files), F.lit(X.SUMMARY_LIMIT)), "tags": F.slice(F.array_distinct(tags), 1, 5), "concept": concept}


def coerced(summary: Column, tags: Column, concepts: Column, aliases: Column) -> dict[str, Column]:
    """A model's answer within its limits: 200 characters, 7 kebab-case tags, 5 concepts, 2 aliases; null and empty names go."""
    full = lambda a: F.filter(F.coalesce(a, F.array().cast("array<string>")), lambda x: x.isNotNull() & (x != ""))
    return {
        "summary": F.left(F.coalesce(summary, F.lit("")), F.lit(X.SUMMARY_LIMIT)),
        "tags": F.slice(F.transform(full(tags), X.kebab), 1, 7),
        "concepts": F.slice(F.transform(full(concepts), X.strip), 1, 5),
        "aliases": F.slice(F.transform(full(aliases), X.strip), 1, 2),
    }


def is_unclassified(summary: Column, tags: Column, concepts: Column) -> Column:
    none = lambda a: a.isNull() | (F.size(a) == 0)
    return F.coalesce(summary, F.lit("")).eqNullSafe("") | none(tags) | none(concepts)


def glob_pattern(glob: str) -> str:
    """A shell glob, found anywhere, as a pattern of Java's: *, ?, [seq] and [!seq]."""
    out, at = "", 0
    while at < len(glob):
        c, at = glob[at], at + 1
        if c == "[" and (end := glob.find("]", at + 1 + (glob[at : at + 1] == "!"))) > 0:
            seq = glob[at:end].replace("\\", "\\\\").replace("[", "\\[").replace("&&", "&\\&")
            out += f"[^{seq[1:]}]" if seq.startswith("!") else f"[{'\\' if seq.startswith('^') else ''}{seq}]"
            at = end + 1
        else:
            out += {"*": ".*", "?": "."}.get(c, c if c.isalnum() or c in " _" else "\\" + c)
    return f"(?s)^.*{out}.*$"


def route(cached: Column, sparse: Column, place: Column, mode: str, globs: list[str], special: str, default: str) -> Column:
    """Which backend a row goes to: cached, then sparse, then by glob in hybrid mode, else the mode's own."""
    chosen = F.lit(default)
    if mode == "hybrid":
        hit = F.lit(False)
        for g in globs:
            hit = hit | place.rlike(glob_pattern(g))
        chosen = F.when(hit, F.lit(special)).otherwise(F.lit(default))
    elif mode != "auto":
        chosen = F.lit(mode)
    return F.when(cached, F.lit("cached")).when(sparse, F.lit("sparse")).otherwise(chosen)
