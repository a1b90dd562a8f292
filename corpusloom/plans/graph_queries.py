"""Queries over concepts, pages of contents, links and names; part, documents, pages and nation stand in for notes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import corpus, graph, stats
from ..session import table

_MAPPING = [("red", "Crimson"), ("Red", "Crimson"), ("blue", "Azure"), ("green", "green"), ("brass", " ring"), ("Brand#13", "House"), ("Brand#31", "House"), ("Brand#22", "Brand#22")]


def empty_modules(spark: SparkSession, sf: str) -> DataFrame:
    nations = table(spark, sf, "nation").select("n_nationkey", "n_name")
    return graph.without_lessons(nations, table(spark, sf, "supplier").filter("s_suppkey % 4 = 0").withColumnRenamed("s_nationkey", "n_nationkey"), ["n_nationkey"])


def _mentions(spark: SparkSession, sf: str) -> DataFrame:
    cased = F.when(F.col("p_partkey") % 3 == 0, F.upper("p_brand")).otherwise(F.col("p_brand"))
    rows = table(spark, sf, "part").select("p_partkey", F.concat(F.split("p_name", " "), F.array(cased)).alias("concepts"))
    return graph.mentions(rows, "p_partkey", "concepts", [F.col("p_partkey")])


_MENTIONS = "WITH m AS (SELECT p_partkey, unnest(list_concat(string_split(p_name, ' '), [CASE WHEN p_partkey % 3 = 0 THEN upper(p_brand) ELSE p_brand END])) AS concept, generate_subscripts(list_concat(string_split(p_name, ' '), [p_brand]), 1) - 1 AS pos FROM part)"


def concept_index(spark: SparkSession, sf: str) -> DataFrame:
    out = graph.concept_index(_mentions(spark, sf), "p_partkey")
    return out.select("canonical", "lesson_count", F.sha2("lessons", 256).alias("lessons_sha"))


def concept_counts(spark: SparkSession, sf: str) -> DataFrame:
    n = _mentions(spark, sf).groupBy("concept").agg(F.count("*").alias("n"))
    return n.agg(F.count("*").alias("n_unique"), F.sum("n").alias("n_total"))


def inventory_order(spark: SparkSession, sf: str) -> DataFrame:
    return graph.frequency(_mentions(spark, sf))


def concept_case_collapse(spark: SparkSession, sf: str) -> DataFrame:
    return graph.canonical_casing(_mentions(spark, sf))


def related_links(spark: SparkSession, sf: str) -> DataFrame:
    targets = table(spark, sf, "part").select(F.col("p_brand").alias("concept")).distinct().withColumn("path", F.concat(F.lit("Concepts/"), X.safe_filename(F.col("concept")), F.lit(".md")))
    return graph.related(_mentions(spark, sf), targets, "p_partkey")


def _mapping(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(_MAPPING, "variant string, canonical string").filter("variant <> canonical")


def _applied(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "part").select("p_partkey", F.concat(F.split("p_name", " "), F.array("p_brand", F.lit("House"))).alias("concepts"))
    return graph.apply_canonical(rows, "p_partkey", "concepts", _mapping(spark))


def canon_apply(spark: SparkSession, sf: str) -> DataFrame:
    return _applied(spark, sf).select("p_partkey", F.array_join("new", ",").alias("concepts"), "n_replaced", "changed")


def canon_stats(spark: SparkSession, sf: str) -> DataFrame:
    """Notes changed, and replacements of concepts and of tags apart."""
    tags = table(spark, sf, "part").select("p_partkey", F.when(F.col("p_partkey") % 3 == 0, F.array("p_type", F.lit("red"), F.lit("red"))).otherwise(F.array("p_type")).alias("tags"))
    return graph.canonical_stats(_applied(spark, sf), graph.apply_canonical(tags, "p_partkey", "tags", _mapping(spark).filter("variant = 'red'")), "p_partkey")


_MAP = "map AS (SELECT * FROM (VALUES " + ", ".join(f"('{a}', '{b}')" for a, b in _MAPPING) + ") t(variant, canonical) WHERE variant <> canonical)"
_APPLIED = f"""
WITH {_MAP}, e AS (SELECT p_partkey, unnest(l) AS name, generate_subscripts(l, 1) AS pos FROM (SELECT p_partkey, list_concat(string_split(p_name, ' '), [p_brand, 'House']) AS l FROM part)),
t AS (SELECT e.*, coalesce(canonical, name) AS c FROM e LEFT JOIN map ON name = variant),
f AS (SELECT p_partkey, c, min(pos) AS pos FROM t WHERE trim(c) <> '' GROUP BY p_partkey, c),
o AS (SELECT p_partkey, list(name ORDER BY pos) AS old, count(*) FILTER (WHERE c <> name) AS n FROM t GROUP BY p_partkey),
w AS (SELECT p_partkey, list(c ORDER BY pos) AS new FROM f GROUP BY p_partkey)"""


def orphan_concepts(spark: SparkSession, sf: str) -> DataFrame:
    stubs = table(spark, sf, "part").select(F.col("p_brand").alias("name")).union(table(spark, sf, "region").select("r_name")).distinct()
    return graph.orphans(stubs, _mentions(spark, sf))


def _pages(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as pages with links: to a part's page by path, to one by name, to a folder, and to a heading, which is none."""
    i = F.col("doc_id").cast("string")
    said = F.concat("text", F.lit(" [[Concepts/"), F.col("lang"), F.lit(" page|shown]] [[Part "), (F.col("doc_id") % 300).cast("string"), F.lit("]] [[ Parts ]] [[x#y]] [[gone/Part "), i, F.lit("]]"))
    return table(spark, sf, "documents").select(i.alias("path"), said.alias("text"))


def link_resolution(spark: SparkSession, sf: str) -> DataFrame:
    files = table(spark, sf, "part").select(F.concat(F.lit("Parts/Part "), (F.col("p_partkey") % 200).cast("string"), F.lit(".md")).alias("path"))
    files = files.union(table(spark, sf, "documents").filter("lang < 'f'").select(F.concat(F.lit("Concepts/"), "lang", F.lit(" page.md"))))
    return graph.link_report(graph.resolve_links(graph.page_links(_pages(spark, sf)), files))


def custom_order(spark: SparkSession, sf: str) -> DataFrame:
    at = graph.custom_order(F.col("n_name"), ["CHINA", "FRANCE", "BRAZIL"])
    return table(spark, sf, "nation").select("n_name", at.alias("place")).orderBy("place", "n_name")


def _titles(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select("page_id", F.concat((F.col("page_id") % 13).cast("string"), F.lit(". "), F.regexp_extract("html", "<title>([^<]*)", 1), F.lit(' /:a?[b]#..')).alias("t"))


def safe_filename(spark: SparkSession, sf: str) -> DataFrame:
    return _titles(spark, sf).select("page_id", X.safe_filename(F.col("t")).alias("name"))


def sanitize_title(spark: SparkSession, sf: str) -> DataFrame:
    return _titles(spark, sf).select("page_id", X.sanitize_title(F.col("t")).alias("name"))


def clean_title(spark: SparkSession, sf: str) -> DataFrame:
    return _titles(spark, sf).select("page_id", X.clean_title(F.col("t")).alias("title"), X.numbered_name(F.col("page_id"), F.col("t")).alias("file"))


def index_prefix(spark: SparkSession, sf: str) -> DataFrame:
    name = F.concat(F.col("p_size").cast("string"), F.lit("-"), F.col("p_name"))
    return table(spark, sf, "part").select("p_partkey", X.strip_index(name).alias("name"), X.yaml_quoted(F.concat(F.lit('a"'), F.col("p_name"))).alias("quoted"))


def normalize_concept(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select("p_partkey", X.normalize_concept(F.concat(F.lit(" A/"), F.col("p_brand"), F.lit(":*? "))).alias("k"))


def html_text_length(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select("page_id", X.html_text_length(F.col("html"), "article", "").alias("chars"))


def html_links(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select("page_id", F.posexplode(X.html_links(F.col("html"))).alias("pos", "x")).select("page_id", "pos", "x.label", "x.href")


def html_markdown(spark: SparkSession, sf: str) -> DataFrame:
    from ..functions.html import markdown

    return table(spark, sf, "pages").select("page_id", markdown(F.col("html")).alias("markdown"))


def place_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Folders three, four and five deep, in the special section and in others."""
    i = F.col("doc_id")
    path = F.concat_ws("/", F.when(i % 4 == 0, F.lit(corpus.SPECIAL_SECTION)).otherwise(F.col("source")), F.concat((i % 9).cast("string"), F.lit("-"), "lang"), F.when(i % 3 > 0, F.lit("2-deep")), F.when(i % 3 > 1, F.lit("deeper")), i.cast("string"))
    made = corpus.place_columns(path)
    return table(spark, sf, "documents").select("doc_id", *(c.alias(n) for n, c in made.items()))


def path_order(spark: SparkSession, sf: str) -> DataFrame:
    p = F.concat(F.lit("a"), F.when(F.col("p_partkey") % 2 == 0, F.lit(" b")).otherwise(F.lit("")), F.lit("/"), F.col("p_name"))
    rows = table(spark, sf, "part").select("p_brand", p.alias("path"))
    return corpus.keep_first(rows, F.col("p_brand"), [corpus.path_order(F.col("path"))])


def required_fields(spark: SparkSession, sf: str) -> DataFrame:
    """Keys that heads lack; an empty value is there."""
    i = F.col("event_id")
    head = F.map_from_entries(F.array_compact(F.array(F.when(i % 97 > 0, F.struct(F.lit("lesson_id").alias("k"), F.array(i.cast("string")).alias("v"))), F.when(i % 7 > 0, F.struct(F.lit("title").alias("k"), F.array().cast("array<string>").alias("v"))))))
    return stats.field_histogram(table(spark, sf, "events").select(head.alias("head")), ["lesson_id", "title", "summary"])


QUERIES = {f.__name__: f for f in (empty_modules, concept_index, concept_counts, inventory_order, concept_case_collapse, related_links, canon_apply, canon_stats, orphan_concepts, link_resolution, custom_order, safe_filename, sanitize_title, clean_title, index_prefix, normalize_concept, html_text_length, html_links, html_markdown, place_columns, path_order, required_fields)}

_BAD = r"""'[\\/:*?"<>|#^\[\]]'"""
_SAFE = lambda c: f"coalesce(nullif(left(regexp_replace(regexp_replace(trim(regexp_replace({c}, {_BAD}, '', 'g')), '\\.+$', ''), '\\s+', ' ', 'g'), 180), ''), 'Untitled')"
_CLEAN = lambda c: f"trim(regexp_replace({c}, '^\\s*\\d+\\.\\s*', ''))"
_TITLES = "WITH t AS (SELECT page_id, (page_id % 13) || '. ' || regexp_extract(html, '<title>([^<]*)', 1) || ' /:a?[b]#..' AS t FROM pages)"
SQL = {
    "empty_modules": "SELECT n_nationkey, n_name FROM nation n WHERE NOT EXISTS (SELECT 1 FROM supplier WHERE s_suppkey % 4 = 0 AND s_nationkey = n_nationkey)",
    "concept_index": _MENTIONS + ", c AS (SELECT lower(concept) AS k, arg_min(concept, (p_partkey, pos)) AS canonical FROM m GROUP BY 1) SELECT canonical, count(*)::BIGINT AS lesson_count, sha256(string_agg(p_partkey::VARCHAR, ',' ORDER BY p_partkey, pos)) AS lessons_sha FROM m JOIN c ON lower(concept) = k GROUP BY canonical",
    "concept_counts": _MENTIONS + " SELECT count(DISTINCT concept)::BIGINT AS n_unique, count(*)::BIGINT AS n_total FROM m",
    "inventory_order": _MENTIONS + " SELECT concept, count(*)::BIGINT AS n FROM m GROUP BY 1 ORDER BY 2 DESC, 1",
    "concept_case_collapse": _MENTIONS + " SELECT lower(concept) AS lowered, arg_min(concept, (p_partkey, pos)) AS canonical FROM m GROUP BY 1",
    "related_links": _MENTIONS + ", b AS (SELECT DISTINCT p_brand AS concept FROM part) SELECT p_partkey, count(*)::BIGINT AS n_links, string_agg(CASE WHEN replace(concept, '#', '') = concept THEN '[[Concepts/' || concept || ']]' ELSE '[[Concepts/' || replace(concept, '#', '') || '|' || concept || ']]' END, ', ' ORDER BY pos) AS links FROM m JOIN b USING (concept) GROUP BY 1",
    "canon_apply": _APPLIED + " SELECT p_partkey, array_to_string(new, ',') AS concepts, n::BIGINT AS n_replaced, old IS DISTINCT FROM new AS changed FROM o JOIN w USING (p_partkey)",
    "canon_stats": _APPLIED + """,
te AS (SELECT p_partkey, unnest(l) AS name, generate_subscripts(l, 1) AS pos FROM (SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN [p_type, 'red', 'red'] ELSE [p_type] END AS l FROM part)),
tc AS (SELECT te.*, coalesce(canonical, name) AS c FROM te LEFT JOIN map ON name = variant AND variant = 'red'),
tf AS (SELECT p_partkey, c, min(pos) AS pos FROM tc WHERE trim(c) <> '' GROUP BY p_partkey, c),
tn AS (SELECT p_partkey, list(c ORDER BY pos) AS tags_new FROM tf GROUP BY p_partkey),
td AS (SELECT p_partkey, list(name ORDER BY pos) AS tags_old, count(*) FILTER (WHERE c <> name) AS m FROM tc GROUP BY p_partkey)
SELECT count(*) FILTER (WHERE old IS DISTINCT FROM new OR tags_old IS DISTINCT FROM tags_new)::BIGINT AS files_changed, sum(n)::BIGINT AS concept_replacements, sum(m)::BIGINT AS tag_replacements FROM o JOIN w USING (p_partkey) JOIN tn USING (p_partkey) JOIN td USING (p_partkey)""",
    "orphan_concepts": _MENTIONS + ", s AS (SELECT DISTINCT p_brand AS name FROM part UNION SELECT r_name FROM region) SELECT name FROM s WHERE lower(name) NOT IN (SELECT lower(concept) FROM m)",
    "link_resolution": """
WITH f AS (SELECT DISTINCT 'Part ' || (p_partkey % 200) AS p FROM part), t AS (SELECT doc_id, lang, len(regexp_extract_all(text, '\\[\\[([^\\]|#]+)(?:\\|[^\\]]+)?\\]\\]')) AS own FROM documents)
SELECT doc_id::VARCHAR AS page, (4 + own)::BIGINT AS n_links, (1 + own + (lang >= 'f')::INT + ('Part ' || (doc_id % 300) NOT IN (SELECT p FROM f))::INT)::BIGINT AS n_broken FROM t""",
    "custom_order": "SELECT n_name, coalesce(list_position(['CHINA', 'FRANCE', 'BRAZIL'], n_name) - 1, 999)::INT AS place FROM nation ORDER BY 2, 1",
    "safe_filename": f"{_TITLES} SELECT page_id, {_SAFE('t')} AS name FROM t",
    "sanitize_title": _TITLES + r""" SELECT page_id, coalesce(nullif(left(trim(regexp_replace(regexp_replace(t, '[\\/:*?"<>|]', '-', 'g'), '\s+', ' ', 'g'), ' .' || chr(9) || chr(10) || chr(13)), 200), ''), 'untitled') AS name FROM t""",
    "clean_title": f"{_TITLES} SELECT page_id, {_CLEAN('t')} AS title, printf('%02d', page_id) || '. ' || {_SAFE(_CLEAN('t'))} || '.md' AS file FROM t",
    "index_prefix": """SELECT p_partkey, p_name AS name, '"a\\"' || p_name || '"' AS quoted FROM part""",
    "normalize_concept": "SELECT p_partkey, lower('A' || p_brand) AS k FROM part",
    "html_text_length": r"SELECT page_id, length(trim(regexp_replace(regexp_replace(regexp_extract(html, '(?s)<article>(.*?)</article>', 1), '<[^>]+>', ' ', 'g'), '\s+', ' ', 'g')))::INT AS chars FROM pages",
    "html_links": r"""
WITH l AS (SELECT page_id, regexp_extract_all(html, '(?is)<a\s(?:[^>]*?\s)?href\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^\s>"'']+))[^>]*>(.*?)</a>', 1) AS a, regexp_extract_all(html, '(?is)<a\s(?:[^>]*?\s)?href\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^\s>"'']+))[^>]*>(.*?)</a>', 2) AS b, regexp_extract_all(html, '(?is)<a\s(?:[^>]*?\s)?href\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^\s>"'']+))[^>]*>(.*?)</a>', 3) AS c, regexp_extract_all(html, '(?is)<a\s(?:[^>]*?\s)?href\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^\s>"'']+))[^>]*>(.*?)</a>', 4) AS t FROM pages),
e AS (SELECT page_id, trim(coalesce(unnest(a), '') || coalesce(unnest(b), '') || coalesce(unnest(c), '')) AS href, trim(regexp_replace(regexp_replace(unnest(t), '<[^>]+>', ' ', 'g'), '\s+', ' ', 'g')) AS label, generate_subscripts(a, 1) AS i FROM l)
SELECT page_id, (row_number() OVER (PARTITION BY page_id ORDER BY i) - 1)::INT AS pos, label, href FROM e WHERE label <> '' AND href <> ''""",
    "place_columns": "SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN 'Automation Tutorials' ELSE source END AS course, CASE WHEN doc_id % 4 = 0 THEN lang END AS sub_course, (doc_id % 9) || '-' || lang AS module_dir, lang AS module_title FROM documents",
    "path_order": "WITH p AS (SELECT p_brand, 'a' || CASE WHEN p_partkey % 2 = 0 THEN ' b' ELSE '' END || '/' || p_name AS path FROM part) SELECT p_brand, path FROM p QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY string_split(path, '/')) = 1",
    "required_fields": "SELECT 'lesson_id' AS field, count(*) FILTER (WHERE event_id % 97 = 0)::BIGINT AS missing FROM events UNION ALL SELECT 'title', count(*) FILTER (WHERE event_id % 7 = 0) FROM events UNION ALL SELECT 'summary', count(*) FROM events",
}
