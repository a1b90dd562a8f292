"""Integrity checks as rows (check, level, message), and their exit code."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..session import written
from ..sources import folders
from ..sources import notes as N
from . import graph

LEVELS = {"OK": 0, "WARN": 1, "FAIL": 2}

#: Fields that a rendered note must have.
REQUIRED = ["lesson_id", "body_sha", "tags", "concepts"]

#: Samples of a failure that are told one by one.
FIRST = 5


def row(name: Column | str, level: str, message: Column) -> list[Column]:
    return [(F.lit(name) if isinstance(name, str) else name).alias("check"), F.lit(level).alias("level"), message.alias("message")]


def _shown(c: Column) -> Column:
    return c.cast("string")


def _first_and_more(bad: DataFrame, name: str, message: Column, order: list[Column], more: str) -> DataFrame:
    """A FAIL for each of the first few rows of a total order, and one for the rest."""
    few = bad.orderBy(*order).limit(FIRST).select(*row(name, "FAIL", message))
    rest = bad.agg(F.count("*").alias("n")).filter(F.col("n") > FIRST).select(*row(name, "FAIL", F.concat(F.lit("... +"), _shown(F.col("n") - FIRST), F.lit(f" {more}"))))
    return few.unionByName(rest)


def report(checks: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)


def exit_code(rows: DataFrame) -> DataFrame:
    """Counts by level and the worst level's code."""
    code = F.max(F.when(F.col("level") == "FAIL", 2).when(F.col("level") == "WARN", 1).otherwise(0))
    return rows.agg(*(F.count_if(F.col("level") == x).alias(f"n_{x.lower()}") for x in LEVELS), F.coalesce(code, F.lit(0)).alias("exit_code"))


def gate(code: Column) -> Column:
    """What a run does after the checks: a 2 blocks, a 1 goes on with a warning."""
    return F.when(code == 2, "block").when(code == 1, "warn").otherwise("go")


def unique_ids(meta: DataFrame) -> DataFrame:
    """lesson.json files (path, text): bad JSON, ids that several files share, files without an id."""
    j = F.from_json("text", N.LESSON, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "bad"})
    rows = meta.withColumn("j", j).withColumn("good", F.col("j").isNotNull() & F.col("j.bad").isNull())
    rows = rows.withColumn("id", F.when(F.col("good"), F.coalesce(F.nullif("j.lessonId", F.lit("")), F.nullif("j.lesson_id", F.lit("")))))
    bad = rows.filter(~F.col("good")).select(*row("lesson.json parse", "FAIL", F.col("path")))
    twice = rows.filter(F.col("id").isNotNull()).groupBy("id").agg(F.count("*").alias("n"), F.min(F.split("path", "/")).alias("at")).filter("n > 1")
    told = _first_and_more(twice, "duplicate lessonId", F.concat(F.col("id"), F.lit(": "), _shown(F.col("n")), F.lit(" occurrences")), [F.col("at"), F.col("id")], "more dupes")
    sums = rows.agg(F.count("*").alias("total"), F.count_if(F.col("good") & F.col("id").isNull()).alias("missing"))
    lacking = sums.filter("missing > 0").select(*row("missing lessonId", "WARN", F.concat(_shown(F.col("missing")), F.lit("/"), _shown(F.col("total")), F.lit(" lesson.json files lack lessonId"))))
    dupes = twice.agg(F.count("*").alias("dupes"))
    fine = sums.join(F.broadcast(dupes), F.lit(True)).filter("missing = 0 AND dupes = 0").select(*row("lesson_id unique", "OK", F.concat(_shown(F.col("total")), F.lit(" lesson.json checked"))))  # one row each
    return report([bad, told, lacking, fine])


def schema_fields(notes: DataFrame, required: list[str] | None = None, version: int = 1) -> DataFrame:
    """Notes (path, head by lines): another version, and fields that those of this version lack (empty ones are there)."""
    required = required or REQUIRED
    rows = notes.withColumn("right", F.coalesce(N.first_value(F.col("head"), "vault_schema") == str(version), F.lit(False)))
    wrong = _first_and_more(rows.filter(~F.col("right")), "vault_schema missing", F.col("path"), [F.split("path", "/")], "more")
    lacks = [F.count_if(F.col("right") & ~F.map_contains_key("head", f)).alias(f) for f in required]
    sums = rows.agg(F.count("*").alias("total"), F.count_if(~F.col("right")).alias("wrong"), *lacks)
    each = sums.select(F.explode(F.array(*(F.struct(F.lit(f).alias("field"), F.col(f).alias("n")) for f in required))).alias("x")).filter("x.n > 0")
    missing = each.select(*row(F.concat(F.lit("missing field `"), F.col("x.field"), F.lit("`")), "WARN", F.concat(_shown(F.col("x.n")), F.lit(" lessons"))))
    clean = reduce(lambda a, b: a & b, (F.col(f) == 0 for f in ("wrong", *required)))
    return report([wrong, missing, sums.filter(clean).select(*row("schema valid", "OK", F.concat(_shown(F.col("total")), F.lit(" lessons"))))])


def orphan_stubs(files: DataFrame, notes: DataFrame) -> DataFrame:
    """Concept pages (Concepts/*.md) that no note (head by lines) names."""
    stubs = files.filter(F.col("path").rlike(r"^Concepts/[^/]*\.md$")).select(F.regexp_extract("path", r"^Concepts/(.*)\.md$", 1).alias("name"))
    mentioned = notes.select(F.explode(F.try_element_at("head", F.lit("concepts"))).alias("concept"))
    folder = files.agg(F.count_if(F.col("path").startswith("Concepts/")).alias("n"))
    none = folder.filter("n = 0").select(*row("no Concepts/ folder", "WARN", F.lit("skip")))
    sums = stubs.agg(F.count("*").alias("total")).join(F.broadcast(graph.orphans(stubs, mentioned).agg(F.count("*").alias("lone"))), F.lit(True)).join(F.broadcast(folder), F.lit(True)).filter("n > 0")  # one row each
    bad = sums.filter("lone > 0").select(*row("orphan concept stubs", "WARN", F.concat(_shown(F.col("lone")), F.lit("/"), _shown(F.col("total")), F.lit(" stubs unreferenced"))))
    return report([none, bad, sums.filter("lone = 0").select(*row("concept stubs referenced", "OK", F.concat(_shown(F.col("total")), F.lit(" stubs all referenced"))))])


def content_pages(files: DataFrame) -> DataFrame:
    """Pages of contents: Markdown at the top but for readme and claude, and _*.md one folder deep in a folder that is not hidden."""
    top = F.col("path").rlike(r"^[^/]+\.md$") & ~F.lower("path").isin("readme.md", "claude.md")
    return files.filter(top | F.col("path").rlike(r"^[^./][^/]*/_[^/]*\.md$"))


def page_targets(files: DataFrame) -> DataFrame:
    """Links of the pages of contents that lead nowhere."""
    pages = content_pages(files)
    sums = graph.link_ratio(graph.resolve_links(graph.page_links(pages), files)).join(F.broadcast(pages.agg(F.count("*").alias("pages"))), F.lit(True))  # one row each
    across = F.concat(F.lit(" across "), _shown(F.col("pages")), F.lit(" MOCs"))
    bad = sums.filter("broken > 0").select(*row("broken MOC wikilinks", "WARN", F.concat(_shown(F.col("broken")), F.lit("/"), _shown(F.col("checked")), F.lit(" links unresolved"), across)))
    return report([bad, sums.filter("broken = 0").select(*row("MOC wikilinks resolve", "OK", F.concat(_shown(F.col("checked")), F.lit(" links"), across)))])


def replaced_names(notes: DataFrame, mapping: DataFrame | None, spark: SparkSession, broken: bool = False) -> DataFrame:
    """Of the sampled notes (path, text), those that link to a name that the mapping (variant, canonical) replaces; None: there is none, or a broken one."""
    if broken:
        return spark.range(1).select(*row("mapping parse", "WARN", F.lit("the mapping is no JSON")))
    if mapping is None:
        return spark.range(1).select(*row("no canonicalize-mapping.json", "WARN", F.lit("skip")))
    name = lambda c: F.lower(X.strip(F.col(c)))
    asked = mapping.agg(F.count_if(name("variant") != name("canonical")).alias("variants"))
    sampled = notes.orderBy(F.split("path", "/")).limit(graph.SAMPLE).agg(F.count("*").alias("n"))
    sums = graph.stale_links(notes, mapping).agg(F.count("*").alias("hits")).join(F.broadcast(asked), F.lit(True)).join(F.broadcast(sampled), F.lit(True))  # one row each
    n = _shown(F.col("n"))
    return report([
        sums.filter("variants = 0").select(*row("no canonicalized concepts to check", "OK", F.lit(""))),
        sums.filter("variants > 0 AND hits > 0").select(*row("body wikilinks reference canonicalized variants", "WARN", F.concat(_shown(F.col("hits")), F.lit("/"), n, F.lit(" sampled lessons")))),
        sums.filter("variants > 0 AND hits = 0").select(*row("body wikilinks clean (sample)", "OK", F.concat(n, F.lit(" lessons sampled")))),
    ])


def nested_copy(paths: DataFrame, root: str) -> DataFrame:
    """Paths inside a folder of the root's own name: a collection copied into itself."""
    return paths.filter((F.element_at(F.split("path", "/"), 1) == root) & F.col("path").contains("/"))


def no_copy(files: DataFrame, root: str) -> DataFrame:
    n = nested_copy(files, root).agg(F.count("*").alias("n"))
    return report([n.filter("n > 0").select(*row("nested duplicate vault", "FAIL", F.lit(f"{root} exists"))), n.filter("n = 0").select(*row("no nested duplicate vault", "OK", F.lit("")))])


def report_on_disk(spark: SparkSession, root: str) -> DataFrame:
    """vault_report of the folder root, with the mapping of replaced names that lies in it."""
    listing = written(folders.tree(spark, root))
    asked = F.col("name").endswith(".md") | (F.col("name") == "lesson.json")
    files = folders.contents(listing.filter(asked), root, gone=True).unionByName(listing.filter(~asked).select("path", F.lit(None).cast("string").alias("text")))
    return vault_report(files, root.rstrip("/").rpartition("/")[2], mapping_file=folders.contents(listing.filter(F.col("path") == N.MAPPING), root))


def vault_report(files: DataFrame, root: str, mapping: DataFrame | None = None, mapping_file: DataFrame | None = None) -> DataFrame:
    """All checks of a vault's files (path; text of Markdown and lesson.json): check, level, message.

    Files and the parsed heads of notes are written once, as every check reads them; no text moves between
    tasks but those of the sampled notes. The
    names that were replaced come as rows (variant, canonical) or as the file that has them (path, text; no
    row: there is none), which may be no JSON.
    """
    broken = None
    if mapping_file is not None:
        mapping_file = written(mapping_file)
        state = mapping_file.select(F.try_parse_json("text").isNull().alias("bad")).first()  # one file
        broken = bool(state and state["bad"])
        mapping = N.replaced(mapping_file) if state and not broken else None
    files = written(files.select("path", "text"))
    headed = files.filter(F.col("path").endswith(".md")).select("path", N.frontmatter(F.col("text"), lines=True).alias("head"))
    places = files.filter(X.basename(F.col("path")) == "lesson.json").select("path", F.lit(None).cast("map<string,array<string>>").alias("head"))
    notes = written(N.notes_beside_lessons(headed.unionByName(places)))
    first = notes.orderBy(F.split("path", "/")).limit(graph.SAMPLE).select("path").distinct()
    sampled = files.join(F.broadcast(first), "path", "left_semi")  # as many rows as the sample has
    return report([
        unique_ids(files.filter(X.basename(F.col("path")) == "lesson.json")),
        schema_fields(notes),
        orphan_stubs(files, notes),
        page_targets(files),
        replaced_names(sampled, mapping, files.sparkSession, bool(broken)),
        no_copy(files, root),
    ])
