"""A vault of lesson folders made of the tables, for the queries over files.

Each document is a lesson folder with its own lesson.json, transcripts, page and
resources; what is in the files comes from expressions that Spark and DuckDB read
alike, so a query's SQL starts from the same values and never parses a file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..session import table

NL = "chr(10)"

#: Columns of a lesson folder, in this order; each may use those before it.
FOLDER = {
    "section": "CASE WHEN doc_id % 5 = 0 THEN 'Automation Tutorials' ELSE source END",
    "module": "(doc_id % 3 + 1) || '-' || lang || ' module'",
    "dir": "CASE WHEN doc_id % 41 = 0 THEN section || '/' || doc_id || '-Lesson' ELSE section || '/' || module || CASE WHEN doc_id % 7 = 0 THEN '/9-extra' ELSE '' END || '/' || doc_id || '-Lesson ' || (doc_id % 10) END",
    "bad": "doc_id % 43 = 0",
    "j_id": "CASE WHEN doc_id % 37 = 0 OR doc_id % 31 = 0 THEN NULL WHEN doc_id % 29 = 0 THEN 'L' || (doc_id - 1) ELSE 'L' || doc_id END",
    "j_alias": "CASE WHEN doc_id % 31 = 0 THEN 'M' || doc_id END",
    "j_title": "CASE WHEN doc_id % 11 = 0 THEN NULL WHEN doc_id % 13 = 0 THEN '' ELSE (doc_id % 120) || '. Lesson: ' || lang || ' ' || (doc_id % 17) END",
    "j_module": "CASE WHEN doc_id % 4 = 0 THEN NULL WHEN doc_id % 6 = 1 THEN '' ELSE lang || ' unit' END",
    "j_module_index": "CASE WHEN doc_id % 10 = 0 THEN NULL ELSE CAST(doc_id % 3 AS INT) END",
    "j_index": "CAST(doc_id % 120 AS INT)",
    "j_video": "CASE WHEN doc_id % 9 = 0 THEN NULL ELSE doc_id % 2 = 0 END",
    "j_rel": "CASE WHEN doc_id % 8 = 0 THEN NULL ELSE 'rel/' || doc_id END",
    "t1": "doc_id % 2 = 0",
    "t2": "doc_id % 3 = 0",
    "t3": "doc_id % 5 = 1",
    "t4": "doc_id % 5 = 2",
    "page": "doc_id % 4 = 1",
    "summary": "CASE WHEN doc_id % 3 = 1 THEN 'About ' || lang || ' no. ' || doc_id ELSE '' END",
    "schema": "CASE WHEN doc_id % 21 = 0 THEN 2 ELSE 1 END",
    "concept": "CASE WHEN doc_id % 6 = 0 THEN upper(lang) || ' Notes' ELSE lang || ' Notes' END",
    "second": "'Topic ' || (doc_id % 23)",
    "tag": "'tag ' || (doc_id % 5)",
    "note_id": "'L' || (doc_id - doc_id % 15 % 4)",
}


def folders_sql() -> str:
    """The same as a chain of DuckDB's common table expressions; the last is named v."""
    steps, before = [], "documents"
    for i, (name, sql) in enumerate(FOLDER.items()):
        last = "v" if i == len(FOLDER) - 1 else f"v{i}"
        steps.append(f"{last} AS (SELECT *, {sql} AS {name} FROM {before})")
        before = last
    return "WITH " + ", ".join(steps)


def folders(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "documents")
    for name, sql in FOLDER.items():
        rows = rows.withColumn(name, F.expr(sql))
    return rows


def _lines(*parts: Column | str) -> Column:
    return F.concat(*(F.lit(p) if isinstance(p, str) else p for p in parts))


def lesson_json() -> Column:
    made = F.to_json(F.struct(*(F.col(c).alias(n) for c, n in (("j_id", "lessonId"), ("j_alias", "lesson_id"), ("j_title", "title"), ("j_module", "moduleTitle"), ("j_module_index", "moduleIndex"), ("j_index", "lessonIndex"), ("j_video", "hasVideo"), ("j_rel", "relativePath")))))
    return F.when(F.col("bad"), F.lit("{bad")).otherwise(made)


def raw_transcript() -> Column:
    return _lines("# A heading\n\n> quoted line\n\n", F.col("text"), "\n")


def rendered_transcript() -> Column:
    """A note as an earlier run left it, with generated blocks to be taken out."""
    head = _lines("---\nvault_schema: ", F.col("schema").cast("string"), '\nlesson_id: "', F.col("note_id"), '"\nbody_sha: "abc"\nlanguage: "', F.col("lang"), '"\nduration_sec: ', F.col("j_index").cast("string"), "\ntags:\n- ", F.col("tag"), "\n- 'it''s'\nconcepts:\n- \"", F.col("concept"), '"\n- "', F.col("second"), '"\naliases: []\n---\n')
    body = _lines("\n# A title\n\n> Summary.\n\n## Lesson notes\n\nold notes\n\n## Transcript\n\n", F.col("text"), "\n\n## Resources\n\n- [a](b)\n\n", f"{X.NAV_START}\n**Nav:** ⇡ [[x]]\n{X.NAV_END}\n\n{X.RELATED_START}\n## Related concepts\n- [[Concepts/y|y]]\n{X.RELATED_END}\n")
    return _lines(head, body)


def page_html() -> Column:
    shown = F.replace(F.replace(F.replace("text", F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    return _lines("<html><head><title>x</title></head><body><div class=\"nav\"><a href=\"/home\">Home</a></div><div id=\"m\" class='main content'><h2>", F.col("lang"), "</h2><div><p>", shown, "</p></div></div><div class=\"resources wide\"><div><a class=\"f\" href=\"/f/", F.col("doc_id").cast("string"), "\">File <b>", F.col("doc_id").cast("string"), "</b></a></div><a href='b.pdf'> two  words </a><a href=\"\">none</a></div><a href=\"/after\">After</a></body></html>")


def files(spark: SparkSession, sf: str) -> DataFrame:
    """path, text and doc_id of all files of all folders."""
    rows = folders(spark, sf)
    file = lambda when, name, text: F.when(when, F.struct(F.concat("dir", F.lit(f"/{name}")).alias("path"), text.alias("text")))
    each = [
        file(F.lit(True), "lesson.json", lesson_json()),
        file(F.col("t1"), "transcript.md", raw_transcript()),
        file(F.col("t2"), "07. Old title.md", rendered_transcript()),
        file(F.col("t3"), "transcript.parakeet.md", F.col("text")),
        file(F.col("t4"), "transcript.remote.md", F.col("text")),
        file(F.col("page"), "index.html", page_html()),
        file(F.col("doc_id") % 3 == 1, "resources/z.txt", F.lit("z")),
        file(F.col("doc_id") % 3 == 1, "resources/a.pdf", F.lit("a")),
        file(F.col("doc_id") % 3 == 1, "resources/.hidden", F.lit("h")),
        file(F.col("doc_id") % 2 == 1, "video.mp4", F.lit("v")),
        file(F.col("doc_id") % 6 == 0, "video.hevc.mp4", F.lit("hevc")),
    ]
    return rows.select("doc_id", F.explode(F.array_compact(F.array(*each))).alias("f")).select("doc_id", "f.path", "f.text")


#: The vault's lessons as DuckDB sees them, after folders_sql(): named lessons.
LESSONS_SQL = """,
found AS (SELECT *, CASE WHEN t1 THEN 'transcript.md' WHEN t2 THEN '07. Old title.md' WHEN t3 THEN 'transcript.parakeet.md' WHEN t4 THEN 'transcript.remote.md' END AS transcript, coalesce(j_id, j_alias) AS key FROM v),
kept AS (SELECT * FROM found WHERE NOT bad AND key IS NOT NULL AND (transcript IS NOT NULL OR page) QUALIFY row_number() OVER (PARTITION BY key ORDER BY string_split(dir, '/')) = 1),
lessons AS (SELECT *, coalesce(j_id, '') AS lesson_id, section AS course, string_split(dir, '/')[2] AS module_dir, regexp_replace(string_split(dir, '/')[2], '^[0-9]+-', '') AS bare_module,
  coalesce(nullif(j_module, ''), regexp_replace(string_split(dir, '/')[2], '^[0-9]+-', '')) AS module_title, coalesce(j_module_index, 0) AS module_index, j_index AS lesson_index,
  coalesce(nullif(j_title, ''), string_split(dir, '/')[-1]) AS lesson_title FROM kept WHERE len(string_split(dir, '/')) >= 3)"""
