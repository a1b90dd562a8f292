"""Sources: lesson folders, Markdown notes with frontmatter, sidecars and lists.

Folders are walked and read by folders.py, which sees names that begin with _ or a dot too.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as X
from ..operators.corpus import keep_first, path_order, place_columns
from ..session import written
from .folders import contents, heads, tree

LESSON = T.StructType(
    [
        T.StructField("lessonId", T.StringType()),
        T.StructField("lesson_id", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("lessonIndex", T.IntegerType()),
        T.StructField("moduleIndex", T.IntegerType()),
        T.StructField("moduleTitle", T.StringType()),
        T.StructField("hasVideo", T.BooleanType()),
        T.StructField("relativePath", T.StringType()),
        T.StructField("bad", T.StringType()),
    ]
)

#: Names a transcript may have, best first (fixed values).
TRANSCRIPTS = [r"transcript\.md", r"\d{2}\. .*\.md", r"transcript\.parakeet\.md", r"transcript\.remote\.md"]

#: Kinds of generated pages, which are no lesson notes (fixed values).
PAGE_TYPES = ("module-moc", "course-moc", "vault-root", "concept")


def files(spark: SparkSession, root: str, pattern: str | None = None) -> DataFrame:
    """path (below the root), size, modified; a pattern is a name or "*" and how names end. Contents are not read."""
    rows = tree(spark, root)
    if pattern:
        rows = rows.filter(F.col("name").endswith(pattern[1:]) if pattern.startswith("*") else F.col("name") == pattern)
    return rows.select("path", "size", "modified")


def texts(spark: SparkSession, root: str, pattern: str) -> DataFrame:
    """path and text of whole files; bytes that are no UTF-8 become the replacement sign."""
    return contents(files(spark, root, pattern), root)


def shown(listing: DataFrame) -> DataFrame:
    """Rows (path) that stand in no hidden folder."""
    return listing.filter(~F.col("path").rlike(r"(^|/)\.[^/]*/"))


def lessons_of(meta: DataFrame, listing: DataFrame, course_from_section: bool = True, root: str = "") -> DataFrame:
    """One row per lesson: metadata with its fallbacks, places, transcript and page paths.

    meta: path and text of the lesson.json files; listing: the paths of all files. Bad
    JSON, lessons with neither transcript nor page, and lessons without an id are left
    out; of one id the first by path parts counts, and is left out if its folder is
    fewer than three deep. Empty titles and module titles are none. lesson_id is empty
    where only the other spelling of the key is there.
    """
    parsed = meta.withColumn("j", F.from_json("text", LESSON, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "bad"}))
    parsed = parsed.filter(F.col("j").isNotNull() & F.col("j.bad").isNull()).select(X.parent(F.col("path")).alias("dir"), "j.*")
    found = listing.select("path", X.parent(F.col("path")).alias("dir"), X.basename(F.col("path")).alias("name"))
    rank = F.lit(None).cast("int")
    for i, p in reversed(list(enumerate(TRANSCRIPTS))):
        rank = F.when(F.col("name").rlike(f"(?s)^{p}$"), F.lit(i)).otherwise(rank)
    found = found.withColumn("rank", rank).filter(F.col("rank").isNotNull() | (F.col("name") == "index.html"))
    sources = found.groupBy("dir").agg(
        F.min_by("path", F.when(F.col("rank").isNotNull(), F.struct("rank", "path"))).alias("transcript_path"),
        F.max(F.when(F.col("name") == "index.html", F.col("path"))).alias("index_html_path"),
    )
    text = lambda c: F.nullif(F.col(c), F.lit(""))
    key = F.coalesce(text("lessonId"), text("lesson_id"))
    kept = keep_first(parsed.join(sources, "dir").withColumn("key", key).filter(F.col("key").isNotNull()), F.col("key"), [path_order(F.col("dir"))], null_keys="drop")
    place = place_columns(F.col("dir"), course_from_section=course_from_section, root=root)
    return kept.filter(F.size(F.split("dir", "/")) >= 3).select(
        F.coalesce("lessonId", F.lit("")).alias("lesson_id"),
        *(c.alias(n) for n, c in place.items() if n != "module_title"),
        F.coalesce(text("moduleTitle"), place["module_title"]).alias("module_title"),
        F.coalesce("moduleIndex", F.lit(0)).alias("module_index"),
        F.coalesce("lessonIndex", F.lit(0)).alias("lesson_index"),
        F.coalesce(text("title"), X.basename(F.col("dir"))).alias("lesson_title"),
        F.coalesce("hasVideo", F.lit(False)).alias("has_video"),
        F.coalesce("relativePath", F.lit("")).alias("relative_path"),
        F.col("dir").alias("lesson_dir"),
        "transcript_path",
        "index_html_path",
    )


def scan_lessons(spark: SparkSession, root: str, course_from_section: bool = True) -> DataFrame:
    """lessons_of the folders below root, which are walked once."""
    listing = written(files(spark, root))
    return lessons_of(contents(listing.filter(X.basename(F.col("path")) == "lesson.json"), root), listing, course_from_section, root.rstrip("/").rsplit("/", 1)[-1])


def transcription_metadata(dirs: DataFrame, meta: DataFrame, override: str | None = None) -> DataFrame:
    """dir, title, lesson_title, module_title, lesson_id, relative_path and output file of each video folder.

    The folder's name without its index stands in for a missing title, the whole name
    if nothing is left of it; without lesson.json, or a bad one, the other fields are
    empty. An override names the output instead of the title.
    """
    parsed = meta.select(X.parent(F.col("path")).alias("dir"), F.from_json("text", LESSON, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "bad"}).alias("j"))
    rows = dirs.select("dir").join(parsed.filter(F.col("j").isNotNull() & F.col("j.bad").isNull()), "dir", "left")
    name = X.basename(F.col("dir"))
    bare = X.strip(X.strip_index(name))
    fallback = F.when(F.col("j").isNull(), F.coalesce(F.nullif(bare, F.lit("")), name)).otherwise(bare)
    rows = rows.select(
        "dir",
        F.coalesce(F.nullif("j.title", F.lit("")), fallback).alias("title"),
        F.coalesce("j.title", fallback).alias("lesson_title"),
        *(F.coalesce(f"j.{c}", F.lit("")).alias(n) for c, n in (("moduleTitle", "module_title"), ("lessonId", "lesson_id"), ("relativePath", "relative_path"))),
    )
    return rows.withColumn("output", F.lit(override) if override else F.concat(X.sanitize_title(F.col("title")), F.lit(".remote.md")))


_HEAD = re.compile(r"^---\s*\n(.*?)\n---\s*\n", re.S)
_BLOCK = re.compile(r"^(?P<key>[^ :\n][^:\n]*|):(?:[^\S\n]*(?P<value>\S.*)|[^\S\n]*\n?(?P<rest>(?:(?!- |[^ \n][^\n]*:|:).*(?:\n|\Z)|- .*(?:\n|\Z))*))", re.M)
_ITEM = re.compile(r"^- (.*\S.*)$", re.M)


def _bare(text: str) -> str:
    return text.strip().strip('"').strip("'")


def parse_lines(text: str) -> dict[str, list[str]]:
    """Frontmatter by lines, all values text: a key without a value is a list of the "- x" lines that follow it.

    A value is a list of one; `[]` stays text; indented lines, and items that follow a
    value, are passed over.
    """
    head = _HEAD.match(text)
    found = _BLOCK.finditer("\n".join(head[1].splitlines())) if head else ()
    return {m["key"].strip(): [_bare(m["value"])] if m["value"] else [_bare(x) for x in _ITEM.findall(m["rest"] or "")] for m in found}


def parse_yaml(text: str) -> dict[str, list[str]]:
    """Frontmatter as YAML where a parser for it is installed, else by lines; what is no mapping is empty.

    A scalar is a list of one, written as YAML's plain text (true, null, 1); nested
    values become JSON.
    """
    if not text.startswith("---\n") or (end := text.find("\n---\n", 4)) < 0:
        return {}
    try:
        import yaml
    except ImportError:
        return parse_lines(text)
    try:
        got = yaml.load(text[4:end], Loader=getattr(yaml, "CSafeLoader", yaml.SafeLoader))  # safe either way
    except yaml.YAMLError:
        return {}
    shown = lambda v: v if isinstance(v, str) else json.dumps(v, ensure_ascii=False, default=str)
    return {str(k): [shown(x) for x in v] if isinstance(v, list) else [] if v is None else [shown(v)] for k, v in got.items()} if isinstance(got, dict) else {}


#: _HEAD for Spark's own expressions, whose \\s is another set of signs.
_BLANK = r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
_HEAD_JAVA = rf"(?s)\A---{_BLANK}*\n.*?\n---{_BLANK}*\n"

_MAP = T.MapType(T.StringType(), T.ArrayType(T.StringType()))


def frontmatter(text: Column, lines: bool = False) -> Column:
    """MAP<STRING, ARRAY<STRING>> of a note's head, as YAML or by lines. Bodies stay where they are: only what may be a head goes to Python."""
    parse = parse_lines if lines else parse_yaml

    @F.pandas_udf(_MAP)
    def parsed(ts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for b in ts:
            yield pd.Series([parse(t or "") for t in b], dtype=object)

    # the longer of what either reader takes for the head, ends included; on it each finds what it finds in the whole
    by_lines, end = F.regexp_extract(text, _HEAD_JAVA, 0), F.locate("\n---\n", text, 5)
    return parsed(F.when(text.startswith("---"), F.substring(text, F.lit(1), F.greatest(F.length(by_lines), F.when(end > 0, end + 4).otherwise(0)))))


def first_value(head: Column, key: str) -> Column:
    return F.get(F.try_element_at(head, F.lit(key)), F.lit(0))


def heads_of(all_notes: DataFrame) -> DataFrame:
    """path and head of the notes (path, text) that may have one, as a table: contents are read, and heads parsed, once."""
    return written(all_notes.filter(F.col("text").startswith("---")).select("path", frontmatter(F.col("text")).alias("head")))


def inventory(all_notes: DataFrame, version: int = 1) -> DataFrame:
    """path, text and head of lesson notes (path, text): rendered ones of this version, no generated pages, of one lesson_id the first by path parts."""
    return lesson_notes(all_notes.withColumn("head", frontmatter(F.col("text"))), version)


def lesson_notes(rows: DataFrame, version: int = 1) -> DataFrame:
    """inventory of notes whose heads are there (path, head)."""
    rows = rows.filter((first_value(F.col("head"), "vault_schema") == str(version)) & ~F.coalesce(first_value(F.col("head"), "type"), F.lit("")).isin(*PAGE_TYPES))
    rows = rows.filter(F.coalesce(first_value(F.col("head"), "moc_type"), F.lit("")) == "")
    lesson = F.coalesce(F.nullif(first_value(F.col("head"), "lesson_id"), F.lit("")), first_value(F.col("head"), "lessonId"))
    return keep_first(rows, lesson, [path_order(F.col("path"))])


def notes(spark: SparkSession, root: str) -> DataFrame:
    """inventory of the Markdown files below root; hidden folders are not read."""
    return inventory(shown(texts(spark, root, "*.md")))


def notes_beside_lessons(all_files: DataFrame) -> DataFrame:
    """Markdown files (path and other columns) in a folder that holds a lesson.json, but for pages (_*.md) and hidden folders."""
    dirs = all_files.filter(X.basename(F.col("path")) == "lesson.json").select(X.parent(F.col("path")).alias("dir"))
    name = X.basename(F.col("path"))
    own = all_files.filter(name.endswith(".md") & ~name.startswith("_") & ~F.col("path").rlike(r"(^|/)\.[^/]*/"))
    return own.withColumn("dir", X.parent(F.col("path"))).join(dirs, "dir", "left_semi").drop("dir")


_VIDEO = "path string, duration_s double, size_mb double, codec string, dominant_type string, confidence double, profile string, error string"


def classified(reports: DataFrame, text: str = "text") -> DataFrame:
    """Videos of classification reports (JSON texts) that have a path and no error; a report that is no JSON has none."""
    kind = f"videos array<struct<{_VIDEO}>>"
    got = reports.withColumn("__v", F.explode(F.from_json(text, kind)["videos"])).filter(F.col("__v.path").isNotNull() & F.col("__v.error").isNull())
    return got.select(*(c for c in reports.columns if c != text), "__v.*")


def classification(spark: SparkSession, path: str) -> DataFrame:
    return classified(spark.read.option("wholetext", "true").text(path).withColumnRenamed("value", "text"))


def listed_titles(lines: DataFrame, column: str = "value") -> DataFrame:
    """Distinct titles of lines that begin with "- "."""
    return lines.filter(F.col(column).startswith("- ")).select(X.strip(F.substr(F.col(column), F.lit(3))).alias("title")).distinct()


def failure_titles(spark: SparkSession, path: str) -> DataFrame:
    return listed_titles(spark.read.text(path))


def named_videos(listing: DataFrame, names: tuple[str, ...] = ("video.mp4",), limit: int | None = None) -> DataFrame:
    """Files of exact names, of each name in turn by their path as text; optionally the first so many."""
    place = F.array_position(F.array(*map(F.lit, names)), X.basename(F.col("path")))
    rows = listing.withColumn("pass", place.cast("int")).filter(F.col("pass") > 0).orderBy("pass", "path")
    return rows if limit is None else rows.limit(limit)


def videos(spark: SparkSession, root: str, *names: str) -> DataFrame:
    """named_videos below root; with size and time, without content."""
    return named_videos(files(spark, root), names or ("video.mp4",))


def head_fingerprint(content: Column, size: Column, modified: Column) -> Column:
    """The same of contents that are a column already."""
    return F.struct(F.sha2(F.substring(content, 1, 1 << 20), 256).alias("source_sha256_head"), size.alias("source_size"), modified.alias("source_mtime"))


def video_heads(spark: SparkSession, root: str, *names: str) -> DataFrame:
    """heads of the videos below root, in no order: the folders are walked once, and nothing is sorted."""
    return heads(tree(spark, root).filter(F.col("name").isin(*(names or ("video.mp4",)))), root)


def fingerprints(spark: SparkSession, root: str, *names: str) -> DataFrame:
    """path, source_sha256_head, source_size and source_mtime of videos below root; at most a mebibyte of each is read."""
    return video_heads(spark, root, *names).drop("bytes_read")


#: Where a run leaves the names that it has replaced (fixed value).
MAPPING = ".vault-notes/canonicalize-mapping.json"


def replaced(mapping: DataFrame) -> DataFrame:
    """variant and canonical of mapping files (path, text): their `concepts`, or the whole where that key is missing; what is no object has none."""
    whole = F.try_parse_json("text")
    own = F.coalesce(F.try_variant_get(whole, "$.concepts", "variant"), whole)
    pairs = F.map_entries(F.try_variant_get(own, "$", "map<string,variant>"))
    rows = mapping.select(F.when(F.schema_of_variant(whole).startswith("OBJECT") & F.schema_of_variant(own).startswith("OBJECT"), pairs).alias("p"))
    return rows.select(F.explode("p").alias("x")).select(F.col("x.key").alias("variant"), F.coalesce(F.try_variant_get("x.value", "$", "string"), F.lit("None")).alias("canonical"))


_ANSWER = "text string, segments array<struct<text:string,start:double,end:double>>, language string, duration double"


def recognised(answer: Column, language: str = "unknown") -> Column:
    """text, segments, language and whole seconds of a recogniser's JSON answer; without a duration the last segment's end counts."""
    j = F.from_json(answer, _ANSWER)
    segments = F.coalesce(j["segments"], F.array().cast("array<struct<text:string,start:double,end:double>>"))
    end = F.when(F.size(segments) > 0, F.element_at(segments, -1)["end"])
    seconds = F.coalesce(F.nullif(j["duration"], F.lit(0.0)), end, F.lit(0.0)).cast("int")
    return F.struct(X.strip(F.coalesce(j["text"], F.lit(""))).alias("text"), segments.alias("segments"), F.coalesce(j["language"], F.lit(language)).alias("language"), seconds.alias("duration_sec"), F.coalesce(end, F.lit(0.0)).cast("int").alias("last_end"))


def probe(text: Column) -> Column:
    """width, height, codec, duration and size of a probe's JSON: the first video stream."""
    kind = "streams array<struct<codec_type:string,codec_name:string,width:int,height:int>>, format struct<duration:string,size:string>"
    j = F.from_json(text, kind)
    v = F.get(F.filter(j["streams"], lambda s: s["codec_type"] == "video"), 0)
    return F.struct(v["width"].alias("width"), v["height"].alias("height"), v["codec_name"].alias("codec"), j["format"]["duration"].try_cast("double").alias("duration"), j["format"]["size"].try_cast("long").alias("size"))


def resources(all_files: DataFrame, folder: str = "resources") -> DataFrame:
    """dir and the sorted names of the files in its resource folder."""
    own = all_files.filter(F.col("path").rlike(rf"/{folder}/[^./][^/]*$"))
    return own.groupBy(X.parent(X.parent(F.col("path"))).alias("dir")).agg(F.array_sort(F.collect_list(X.basename(F.col("path")))).alias("resources"))


LEGACY = "transcript.remote.md"


def rename_plan(listing: DataFrame, titled: DataFrame, legacy: str = LEGACY) -> DataFrame:
    """dir, old, new, status of each legacy transcript and failure mark: rename, or exists where the new name is taken.

    titled: dir and title of the video folders. A title whose name is the legacy one
    asks for nothing.
    """
    here = listing.select(X.parent(F.col("path")).alias("dir"), X.basename(F.col("path")).alias("name"))
    new = F.concat(X.sanitize_title(F.col("title")), F.lit(".remote.md"))
    asked = titled.select("dir", new.alias("base")).filter(F.col("base") != legacy)
    asked = asked.select("dir", F.explode(F.array(*(F.struct(F.lit(legacy + x).alias("old"), F.concat("base", F.lit(x)).alias("new")) for x in ("", ".FAILED")))).alias("x")).select("dir", "x.*")
    have = here.withColumnRenamed("name", "old")
    taken = here.withColumnRenamed("name", "new").withColumn("taken", F.lit(True))
    plan = asked.join(have, ["dir", "old"], "left_semi").join(taken, ["dir", "new"], "left")
    return plan.select("dir", "old", "new", F.when(F.col("taken"), "exists").otherwise("rename").alias("status"))


def sibling_videos(flagged: DataFrame, listing: DataFrame, name: str = "video.mp4") -> DataFrame:
    """The video beside each flagged transcript (path), where there is one."""
    beside = F.concat(X.parent(F.col("path")), F.lit(f"/{name}"))
    return flagged.select(beside.alias("video")).join(listing.select(F.col("path").alias("video")), "video", "left_semi")
