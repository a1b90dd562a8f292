"""Sinks: rendered notes, pages of contents, reports. Rendering is a column; folders.py writes one file a row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators.corpus import SCHEMA_VERSION
from . import folders

#: Marks a page that was generated and may be replaced or removed.
AUTO_NOTE = "<!-- generated page: do not edit -->"


def yaml_list(items: Column) -> Column:
    full = F.array_join(F.transform(items, lambda x: F.concat(F.lit("\n- "), X.yaml_quoted(x))), "")
    return F.when(F.coalesce(F.size(items), F.lit(0)) <= 0, F.lit(" []")).otherwise(full)


def head(fields: list[tuple[str, Column, str]]) -> Column:
    """Frontmatter in the given order; kinds: text (quoted), raw and list. Null texts and raw values are left out."""
    lines = []
    for name, c, kind in fields:
        value = yaml_list(c) if kind == "list" else F.concat(F.lit(" "), X.yaml_quoted(c) if kind == "text" else c.cast("string"))
        lines.append(F.when(c.isNotNull() | F.lit(kind == "list"), F.concat(F.lit(f"{name}:"), value)))
    return F.concat(F.lit("---\n"), F.array_join(F.array_compact(F.array(*lines)), "\n"), F.lit("\n---\n"))


def nav_block(prev: Column, module: Column, nxt: Column) -> Column:
    """Links to the neighbours (null: none) and up to the module."""
    parts = F.array_compact(F.array(F.when(prev.isNotNull(), F.concat(F.lit("← "), prev)), F.concat(F.lit("⇡ "), module), F.when(nxt.isNotNull(), F.concat(nxt, F.lit(" →")))))
    return F.concat(F.lit(f"{X.NAV_START}\n**Nav:** "), F.array_join(parts, " · "), F.lit(f"\n{X.NAV_END}"))


#: Columns of a former head that a new one carries on, with their kinds, in order (fixed values).
CARRIED = [("ai_engine", "text"), ("source", "text"), ("transcribed_at", "text"), ("model", "text"), ("language", "text"), ("duration_sec", "raw"), ("word_count", "raw")]


def carried(old: Column, new: dict[str, Column]) -> dict[str, Column]:
    """Provenance of a note: the new value, else that of its former head (a map of lists)."""
    before = lambda k: F.get(F.try_element_at(old, F.lit(k)), F.lit(0))
    return {k: F.coalesce(new[k].cast("string"), before(k)) if k in new else before(k) for k, _ in CARRIED}


def rendered_note(n: dict[str, Column]) -> Column:
    """A lesson note: head, title, summary, sections that have content, navigation and related concepts.

    tags, concepts, aliases and related are arrays of text, resources one of (label,
    href); null is empty. sub_course and the columns of CARRIED are left out where null.
    """
    null = F.lit(None).cast("string")
    fields = [("vault_schema", F.lit(SCHEMA_VERSION), "raw"), ("title", n["title"], "text"), ("aliases", n["aliases"], "list"), ("course", n["course"], "text"), ("sub_course", n["sub_course"], "text"), ("module", n["module"], "text"), ("module_index", n["module_index"], "raw"), ("lesson_index", n["lesson_index"], "raw"), ("lesson_id", n["lesson_id"].cast("string"), "text"), ("summary", F.coalesce(n["summary"], F.lit("")), "text"), ("tags", n["tags"], "list"), ("concepts", n["concepts"], "list"), ("body_sha", n["body_sha"], "text")]
    fields += [(k, n.get(k, null), kind) for k, kind in CARRIED]
    section = lambda title, c: F.when(F.coalesce(c, F.lit("")) != "", F.concat(F.lit(f"## {title}\n\n"), c))
    files = F.array_join(F.transform(n["resources"], lambda r: F.concat(F.lit("- ["), r["label"], F.lit("]("), r["href"], F.lit(")"))), "\n")
    body = F.array_compact(F.array(section("Lesson notes", n["notes"]), section("Transcript", n["transcript"]), section("Resources", files)))
    body = F.when(F.size(body) == 0, F.lit("_No content captured for this lesson._")).otherwise(F.array_join(body, "\n\n"))
    quote = F.when(F.coalesce(n["summary"], F.lit("")) != "", F.concat(F.lit("\n> "), n["summary"], F.lit("\n"))).otherwise(F.lit(""))
    links = F.coalesce(F.array_join(n["related"], "\n- "), F.lit(""))
    related = F.when(links != "", F.concat(F.lit(f"\n\n{X.RELATED_START}\n## Related concepts\n- "), links, F.lit(f"\n{X.RELATED_END}"))).otherwise(F.lit(""))
    return F.concat(head(fields), F.lit("\n# "), X.clean_title(n["title"]), F.lit("\n"), quote, F.lit("\n"), body, F.lit("\n\n"), nav_block(n["prev"], n["module_link"], n["next"]), related, F.lit("\n"))


#: Fields of a transcript's head that are not quoted (fixed values).
RAW_FIELDS = frozenset(("source", "server_port", "duration_sec", "word_count", "upload_sec", "inference_sec"))


def transcript_note(fields: dict[str, Column], title: Column, body: Column) -> Column:
    """A transcript: its head in the given order, its title and its paragraphs."""
    return F.concat(head([(k, c, "raw" if k in RAW_FIELDS else "text") for k, c in fields.items()]), F.lit("\n# "), title, F.lit("\n\n"), body, F.lit("\n"))


def stale_pages(pages: DataFrame, expected: DataFrame) -> DataFrame:
    """Generated pages (path, text) of courses that are expected no more: names that begin with _, one folder deep.

    A page is generated if it holds the mark or its frontmatter says so in exactly
    these words; hand-written ones are never listed.
    """
    kind = lambda key, value: X.frontmatter_value(F.col("text"), key).eqNullSafe(value)
    auto = F.col("text").contains(AUTO_NOTE) | kind("moc_type", "module") | kind("type", "module-moc")
    return pages.filter(F.col("path").rlike(r"^[^/]+/_[^/]*\.md$") & auto).join(expected.select("path"), "path", "left_anti").select("path")


def stale_on_disk(spark: SparkSession, root: str, expected: DataFrame, listing: DataFrame | None = None) -> DataFrame:
    """stale_pages of the folder root, which is walked unless its listing is there."""
    pages = (folders.tree(spark, root) if listing is None else listing).filter(F.col("name").startswith("_") & F.col("name").endswith(".md"))
    return stale_pages(folders.contents(pages.filter(F.col("path").rlike("^[^/]+/[^/]+$")), root), expected)


def failure_marks(rows: DataFrame, path: str = "path", error: str = "error") -> DataFrame:
    """path and text of the mark of each failed row."""
    bad = rows.filter(F.col(error).isNotNull())
    return bad.select(F.concat(path, F.lit(".FAILED")).alias("path"), F.concat(F.lit("# Transcription failed\n\n"), F.col(error), F.lit("\n")).alias("text"))


def write_report(rows: DataFrame, path: str) -> None:
    """Rows as JSON lines, through Spark's commit protocol."""
    rows.write.mode("overwrite").json(path)


def errors_and_rows(rows: DataFrame, error_col: str = "error") -> tuple[DataFrame, DataFrame]:
    """(rows without an error, rows with one): the second is the table of failure marks."""
    return rows.filter(F.col(error_col).isNull()), rows.filter(F.col(error_col).isNotNull())
