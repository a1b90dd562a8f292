"""Queries over a vault's files: lessons, notes, pages of contents, integrity."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import html
from ..functions import text as X
from ..operators import corpus, graph, integrity, kernels
from ..session import scratch_folder, table, written
from ..settings import Settings
from ..sources import folders, sinks
from ..sources import notes as N
from . import build, vault
from .vault import LESSONS_SQL, NL, folders_sql

_ROOT = "My vault"


def _named(files: DataFrame, name: str) -> DataFrame:
    return files.filter(X.basename(F.col("path")) == name)


def _lessons(spark: SparkSession, sf: str) -> DataFrame:
    files = vault.files(spark, sf)
    return N.lessons_of(_named(files, "lesson.json"), files)


def vault_lessons(spark: SparkSession, sf: str) -> DataFrame:
    return _lessons(spark, sf).withColumns({c: X.basename(F.col(c)) for c in ("transcript_path", "index_html_path")})


def vault_one_course(spark: SparkSession, sf: str) -> DataFrame:
    """The same where the whole vault is one course, counted by module."""
    files = vault.files(spark, sf)
    rows = N.lessons_of(_named(files, "lesson.json"), files, course_from_section=False, root=_ROOT)
    return rows.groupBy("course", "module_dir", "sub_course").agg(F.count("*").alias("n"))


def first_lessons(spark: SparkSession, sf: str) -> DataFrame:
    """A limited run: the first ten lessons in the order of the walk."""
    return corpus.first_rows(_lessons(spark, sf).select("lesson_id", "lesson_dir"), [corpus.path_order(F.col("lesson_dir"))], 10)


def lesson_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    rows = corpus.neighbours(_lessons(spark, sf).withColumn("at", corpus.path_order(F.col("lesson_dir"))), ["course", "module_dir"], [F.col("lesson_index"), F.col("lesson_title"), F.col("at")], "lesson_dir")
    return rows.select("lesson_dir", "prev_id", "next_id")


def first_seen(spark: SparkSession, sf: str) -> DataFrame:
    """Which of the folders that name one id comes first, second and so on."""
    rows = vault.folders(spark, sf).select("dir", F.coalesce("j_id", "j_alias").alias("key")).filter("key IS NOT NULL")
    return corpus.seen_rank(rows, "key", [corpus.path_order(F.col("dir"))])


def transcription_metadata(spark: SparkSession, sf: str) -> DataFrame:
    files = vault.files(spark, sf)
    dirs = _named(files, "video.mp4").select(X.parent(F.col("path")).alias("dir"))
    return N.transcription_metadata(dirs, _named(files, "lesson.json").filter(F.col("doc_id") % 19 != 0))


def decoded_sources(spark: SparkSession, sf: str) -> DataFrame:
    """Bytes that are no UTF-8 become the replacement sign."""
    content = F.concat(F.col("text").cast("binary"), F.unhex(F.lit("C328FF61")))
    return table(spark, sf, "documents").select("doc_id", F.sha2(X.decoded(content), 256).alias("sha"))


def _content(spark: SparkSession, sf: str) -> DataFrame:
    """One row per folder with any source: transcript body, page as Markdown, and its resources."""
    files = vault.files(spark, sf)
    rank = F.when(_is("transcript.md"), 0).when(_is("07. Old title.md"), 1).when(_is("transcript.parakeet.md"), 2).when(_is("transcript.remote.md"), 3)
    sources = files.withColumn("rank", rank).filter(F.col("rank").isNotNull() | _is("index.html")).groupBy(X.parent(F.col("path")).alias("dir")).agg(F.min_by("text", "rank").alias("raw"), F.max(F.when(_is("index.html"), F.col("text"))).alias("html"))
    rendered = X.frontmatter_value(F.col("raw"), "vault_schema").eqNullSafe("1")
    rows = sources.select(
        "dir",
        F.coalesce(X.transcript_body(X.strip_frontmatter(F.col("raw")), rendered), F.lit("")).alias("transcript"),
        html.markdown(F.col("html"), "content").alias("notes"),
        X.html_links(X.html_container(F.coalesce("html", F.lit("")), "resources")).alias("links"),
        F.transform(F.array("raw"), X.strip_frontmatter)[0].alias("body"),
    )
    own = N.resources(files).withColumnRenamed("resources", "names")
    beside = F.transform(F.coalesce("names", F.array().cast("array<string>")), lambda n: F.struct(n.alias("label"), F.concat(F.lit("resources/"), n).alias("href")))
    return rows.join(own, "dir", "left").withColumn("resources", F.concat("links", beside)).drop("links", "names")


def _is(name: str):
    return X.basename(F.col("path")) == name


def lesson_contents(spark: SparkSession, sf: str) -> DataFrame:
    rows = _content(spark, sf)
    shown = F.array_join(F.transform("resources", lambda r: F.concat_ws("=", r["label"], r["href"])), ";")
    whole = X.transcript_section(F.col("body"), whole_if_missing=True)
    return rows.select("dir", F.sha2("transcript", 256).alias("transcript_sha"), F.sha2("notes", 256).alias("notes_sha"), shown.alias("resources"), X.body_hash(F.col("notes"), F.col("transcript")).alias("body_sha"), F.length(F.coalesce(whole, F.lit(""))).alias("stats_chars"))


def model_inputs(spark: SparkSession, sf: str) -> DataFrame:
    rows = _lessons(spark, sf).join(_content(spark, sf).withColumnRenamed("dir", "lesson_dir"), "lesson_dir")
    hint = X.path_hint(F.col("course"), F.col("sub_course"), F.col("module_title"))
    said = X.user_message(F.col("lesson_title"), hint, X.model_input(F.col("notes"), F.col("transcript")))
    return rows.select("lesson_dir", hint.alias("hint"), F.sha2(said, 256).alias("message_sha"), F.length(said).alias("chars"))


def note_heads(spark: SparkSession, sf: str) -> DataFrame:
    """A rendered note's head by each of the three readers, and its body."""
    rows = vault.folders(spark, sf).select("doc_id", vault.rendered_transcript().alias("t"))
    rows = rows.select("doc_id", "t", N.frontmatter(F.col("t")).alias("y"), N.frontmatter(F.col("t"), lines=True).alias("l"))
    value = N.first_value
    return rows.select("doc_id", value(F.col("y"), "vault_schema").alias("version"), X.frontmatter_value(F.col("t"), "lesson_id").alias("lesson_id"), F.array_join(F.try_element_at("y", F.lit("tags")), ",").alias("tags"), F.array_join(F.try_element_at("l", F.lit("concepts")), ",").alias("concepts"), F.size(F.try_element_at("y", F.lit("aliases"))).alias("n_aliases"), value(F.col("l"), "aliases").alias("aliases_text"), F.length(X.strip_frontmatter(F.col("t"))).alias("body_chars"))


def _named_lessons(spark: SparkSession, sf: str) -> DataFrame:
    """Lessons with all that a note and a page need: path, summary, tags and concepts."""
    lessons = _lessons(spark, sf)
    made = vault.folders(spark, sf).select(F.col("dir").alias("lesson_dir"), "doc_id", "summary", F.array("tag", F.lit("it's")).alias("tags"), F.array("concept", "second", "concept").alias("concepts"))
    rows = lessons.join(made, "lesson_dir")
    return written(rows.withColumn("path", F.concat_ws("/", "lesson_dir", X.numbered_name(F.col("lesson_index"), F.col("lesson_title")))))


def _mentions(rows: DataFrame) -> DataFrame:
    return graph.mentions(rows, "doc_id", "concepts", [corpus.path_order(F.col("lesson_dir"))])


def rendered_notes(spark: SparkSession, sf: str) -> DataFrame:
    """Every lesson's whole note, with links to its neighbours, module and concepts."""
    rows = _named_lessons(spark, sf)
    shown = graph.numbered(F.col("lesson_index"), F.col("lesson_title"))
    rows = rows.withColumns({"link": X.wikilink(F.col("path"), shown), "at": corpus.path_order(F.col("lesson_dir"))})
    rows = corpus.neighbours(rows, ["course", "module_dir"], [F.col("lesson_index"), F.col("lesson_title"), F.col("at")], "link")
    canonical = graph.canonical_casing(_mentions(rows)).select("canonical", graph.concept_path(F.col("canonical")).alias("target"))
    links = _mentions(rows).join(canonical, F.col("concept") == F.col("canonical")).groupBy("doc_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", X.wikilink(F.col("target"), F.col("concept")).alias("l")))), lambda s: s["l"]).alias("related"))
    old = vault.folders(spark, sf).select(F.col("dir").alias("lesson_dir"), N.frontmatter(F.when(F.col("t2") & ~F.col("t1"), vault.rendered_transcript()).otherwise(F.lit(""))).alias("old"))
    rows = rows.join(links, "doc_id", "left").join(_content(spark, sf).withColumnRenamed("dir", "lesson_dir"), "lesson_dir").join(old, "lesson_dir")
    c = lambda n: F.col(n)
    note = {k: c(k) for k in ("course", "sub_course", "module_index", "lesson_index", "lesson_id", "summary", "tags", "notes", "transcript", "resources", "related")}
    module = graph.page_path(X.parent(F.col("lesson_dir")), F.col("module_title"))
    note |= {"title": c("lesson_title"), "aliases": F.array().cast("array<string>"), "module": c("module_title"), "concepts": F.slice("concepts", 1, 2), "body_sha": X.body_hash(c("notes"), c("transcript")), "prev": c("prev_id"), "next": c("next_id"), "module_link": X.wikilink(module, c("module_title"))}
    note |= sinks.carried(c("old"), {"ai_engine": F.when(F.col("doc_id") % 2 == 0, F.lit("local"))})
    return rows.select("path", F.sha2(sinks.rendered_note(note), 256).alias("sha"))


def notes_beside(spark: SparkSession, sf: str) -> DataFrame:
    files = vault.files(spark, sf).select("path")
    more = files.filter(_is("lesson.json")).select(F.explode(F.array(F.concat(X.parent(F.col("path")), F.lit("/_Page.md")), F.concat(X.parent(X.parent(F.col("path"))), F.lit("/stray.md")), F.concat(F.lit(".trash/"), F.col("path")))).alias("path"))
    return N.notes_beside_lessons(files.unionByName(more)).select("path")


def _noted(spark: SparkSession, sf: str) -> DataFrame:
    """Rendered notes and generated pages."""
    rows = vault.folders(spark, sf).filter("t2")
    page = F.concat(F.lit("---\nvault_schema: 1\n"), F.when(F.col("doc_id") % 2 == 0, F.lit("type: concept")).otherwise(F.lit("moc_type: module")), F.lit("\nconcepts: [x]\n---\n"))
    pages = rows.filter("doc_id % 4 < 2").select(F.concat("dir", F.lit("/_Page.md")).alias("path"), page.alias("text"))
    return rows.select(F.concat("dir", F.lit("/07. Old title.md")).alias("path"), vault.rendered_transcript().alias("text")).unionByName(pages)


def vault_inventory(spark: SparkSession, sf: str) -> DataFrame:
    return N.inventory(_noted(spark, sf)).select("path")


def _inventory(spark: SparkSession, sf: str) -> DataFrame:
    return graph.inventory_paths(N.inventory(_noted(spark, sf)))


def inventory_paths(spark: SparkSession, sf: str) -> DataFrame:
    return _inventory(spark, sf).select("kind", "name", "n", F.sha2(F.array_join("paths", "|"), 256).alias("paths_sha"))


def prompt_lines(spark: SparkSession, sf: str) -> DataFrame:
    return graph.prompt_lines(_inventory(spark, sf))


def module_pages(spark: SparkSession, sf: str) -> DataFrame:
    return _sha(graph.module_pages(_named_lessons(spark, sf)))


def _sha(pages: DataFrame) -> DataFrame:
    return pages.select("path", F.sha2("text", 256).alias("sha"))


def stub_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Pages of the module folders without lessons: a folder more in every course, and one of no course."""
    lessons = _lessons(spark, sf)
    more = table(spark, sf, "nation").select(F.explode(F.array(F.lit("Automation Tutorials"), F.lit("nowhere"))).alias("course"), F.concat("n_nationkey", F.lit("-"), "n_name").alias("module_dir"))
    return _sha(graph.stub_pages(more.unionByName(lessons.select("course", "module_dir").distinct()), lessons))


def course_pages(spark: SparkSession, sf: str) -> DataFrame:
    return _sha(graph.course_pages(_lessons(spark, sf), _ROOT))


def root_page(spark: SparkSession, sf: str) -> DataFrame:
    rows = _named_lessons(spark, sf)
    return _sha(graph.root_page(rows, graph.canonical_casing(_mentions(rows)).select(F.col("canonical").alias("concept")), _ROOT, ["src3", "src1", "Automation Tutorials"]))


def concept_pages(spark: SparkSession, sf: str) -> DataFrame:
    rows = _named_lessons(spark, sf)
    pages = graph.concept_pages(_mentions(rows), rows.drop("concepts"), "doc_id")
    return pages.select("canonical", "lesson_count", "path", F.sha2("text", 256).alias("sha"))


def concept_page_parts(spark: SparkSession, sf: str) -> DataFrame:
    """Concept pages' lines in parts of four kilobytes."""
    rows = _named_lessons(spark, sf)
    parts = graph.concept_parts(_mentions(rows), rows.drop("concepts"), "doc_id", 1 << 12)
    return parts.select("canonical", "part", F.col("at").alias("begin"), "n_lines", F.sha2("text", 256).alias("sha"))


def _five_kinds(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Pages of five kinds in each course, and those that are expected."""
    i = F.col("doc_id")
    kind = F.element_at(F.array(F.lit(f"x\n{sinks.AUTO_NOTE}\n"), F.lit("---\nmoc_type: module\n---\n"), F.lit("---\ntype: module-moc\n---\n"), F.lit("---\ntype: essay\n---\nmy own\ntype: module-moc\n"), F.lit("---\ntype: module-mocha\n---\n")), (i % 5 + 1).cast("int"))
    rows = vault.folders(spark, sf)
    pages = rows.select(F.concat("section", F.when(i % 3 == 0, F.lit("/deep")).otherwise(F.lit("")), F.lit("/_"), i.cast("string"), F.lit(".md")).alias("path"), kind.alias("text"))
    return pages, pages.filter(F.col("path").rlike("[02468]\\.md$"))


def stale_page_list(spark: SparkSession, sf: str) -> DataFrame:
    """Of pages of five kinds in each course those that are generated and expected no more."""
    return sinks.stale_pages(*_five_kinds(spark, sf))


def _vault_files(spark: SparkSession, sf: str) -> DataFrame:
    """The vault with concept pages, pages of contents and a copy of a folder in itself."""
    files = vault.files(spark, sf).select("path", "text")
    part = table(spark, sf, "part").select("p_brand").distinct()
    stubs = part.select(F.concat(F.lit("Concepts/"), X.safe_filename(F.col("p_brand")), F.lit(".md")).alias("path"), F.lit("stub").alias("text"))
    langs = table(spark, sf, "documents").select("lang").distinct().select(F.concat(F.lit("Concepts/"), "lang", F.lit(" NOTES.md")).alias("path"), F.lit("stub").alias("text"))
    folders = vault.folders(spark, sf)
    pages = folders.filter("doc_id % 3 = 0").select(F.concat("section", F.lit("/_p"), F.col("doc_id").cast("string"), F.lit(".md")).alias("path"), F.concat(F.lit("[["), "dir", F.lit("/07. Old title|t]] [["), "dir", F.lit("]] [[07. Old title]] [[gone "), F.col("doc_id").cast("string"), F.lit("]] [[a#b]]")).alias("text"))
    top = table(spark, sf, "nation").select(F.concat("n_name", F.lit(".md")).alias("path"), F.lit("[[Concepts/Brand1]] [[Brand1]] [[missing/x]]").alias("text"))
    more = spark.createDataFrame([("README.md", "[[nothing]]"), (f"{_ROOT}/copy.md", "x"), (".hidden/_x.md", "[[nothing]]")], "path string, text string")
    return files.unionByName(stubs).unionByName(langs).unionByName(pages).unionByName(top).unionByName(more)


def vault_report(spark: SparkSession, sf: str) -> DataFrame:
    mapping = spark.createDataFrame([("y", "z"), ("Same", "same")], "variant string, canonical string")
    return integrity.vault_report(_vault_files(spark, sf), _ROOT, mapping)


def vault_exit_code(spark: SparkSession, sf: str) -> DataFrame:
    got = integrity.exit_code(vault_report(spark, sf))
    return got.withColumn("gate", integrity.gate(F.col("exit_code")))


def page_link_ratio(spark: SparkSession, sf: str) -> DataFrame:
    files = _vault_files(spark, sf)
    return graph.link_ratio(graph.resolve_links(graph.page_links(integrity.content_pages(files)), files))


def stale_notes(spark: SparkSession, sf: str) -> DataFrame:
    """All notes (not the first 50 alone) whose body links to a replaced name, in any letter case."""
    i = F.col("doc_id")
    text = F.concat(F.lit("---\nx: [[Old one]]\n---\n"), F.col("text"), F.when(i % 3 == 0, F.lit(" [[Concepts/OLD One|o]]")).when(i % 3 == 1, F.lit(" [[concepts/same]] [[a/Old one]]")).otherwise(F.lit(" [[ old one ]]")))
    rows = vault.folders(spark, sf).select(F.concat("dir", F.lit("/n.md")).alias("path"), text.alias("text"))
    mapping = spark.createDataFrame([("Old One", "New One"), ("Same", "SAME")], "variant string, canonical string")
    return graph.stale_links(rows, mapping, first=None)


def _answers(spark: SparkSession, sf: str) -> DataFrame:
    pairs = F.map_from_arrays(F.collect_list(F.concat(F.lit(" "), "p_brand")), F.collect_list(F.when(F.substring("p_brand", -1, 1) == "3", F.lit("")).when(F.substring("p_brand", -1, 1) == "4", F.lit(" House ")).otherwise(F.col("p_brand"))))
    got = table(spark, sf, "part").select("p_brand").distinct().agg(pairs.alias("concepts"))
    return got.select(F.concat(F.lit("Sure:\n```json\n"), F.to_json(F.struct("concepts", F.lit("merged").alias("notes"), F.create_map(F.lit("Tag One"), F.lit("tag-one")).alias("tags"))), F.lit("\n```\n")).alias("text"))


def canon_mapping(spark: SparkSession, sf: str) -> DataFrame:
    return graph.mapping_rows(_answers(spark, sf))


def canon_kernel(spark: SparkSession, sf: str) -> DataFrame:
    """The whole way from an inventory through a model to a mapping, with a model that puts all names in lower case."""
    import json
    import re

    def model(prompt: str) -> str:
        names = [re.fullmatch(r"""\s*(["'])(.*)\1: \d+""", x) for x in prompt.split("\n")]
        return json.dumps({"concepts": {m[2].replace("\\'", "'"): m[2].replace("\\'", "'").lower() for m in names if m}})

    return kernels.canonicalise(prompt_lines(spark, sf), model)


def sample_merges(spark: SparkSession, sf: str) -> DataFrame:
    """The first twelve entries that change a name."""
    return graph.merges(canon_mapping(spark, sf).filter("kind = 'concept'"), 12)


def written_files(spark: SparkSession, sf: str) -> DataFrame:
    """Notes written one file a row into the shared folder, and read again."""
    root = scratch_folder(spark, "files")
    rows = table(spark, sf, "nation").select(F.concat("n_regionkey", F.lit("/"), "n_name", F.lit(".md")).alias("path"), F.concat(F.lit("# "), "n_name", F.lit(" é\n")).alias("text"))
    folders.write_files(rows, root)
    return N.texts(spark, root, "*.md")


def _on_disk(spark: SparkSession, files: DataFrame) -> str:
    root = f"{scratch_folder(spark, 'vault')}/{_ROOT}"
    folders.write_files(files, root, any_of=True)
    return root


def disk_lessons(spark: SparkSession, sf: str) -> DataFrame:
    """vault_lessons of a vault of files, some of them hidden."""
    files = vault.files(spark, sf)
    rows = N.scan_lessons(spark, _on_disk(spark, files.select("path", "text")))
    return rows.withColumns({c: X.basename(F.col(c)) for c in ("transcript_path", "index_html_path")})


def disk_report(spark: SparkSession, sf: str) -> DataFrame:
    """vault_report of a vault of files, with the mapping that lies in it."""
    mapping = spark.createDataFrame([(N.MAPPING, '{"y": "z", "Same": "same"}')], "path string, text string")  # without the key concepts the whole is the mapping
    return integrity.report_on_disk(spark, _on_disk(spark, _vault_files(spark, sf).unionByName(mapping)))


def disk_stale_pages(spark: SparkSession, sf: str) -> DataFrame:
    """The stale pages of a vault of files, and whether they are there after their removal."""
    pages, kept = _five_kinds(spark, sf)
    root = _on_disk(spark, pages)
    stale = written(sinks.stale_on_disk(spark, root, kept))
    folders.remove_files(stale, root)
    left = folders.tree(spark, root).select("path", F.lit(True).alias("there"))
    return stale.join(left, "path", "left").select("path", F.coalesce("there", F.lit(False)).alias("there"))


def disk_heads(spark: SparkSession, sf: str) -> DataFrame:
    """Fingerprints of files, of which a mebibyte at most is read."""
    rows = table(spark, sf, "documents").select(F.concat("source", F.lit("/v"), F.col("doc_id").cast("string"), F.lit("/video.mp4")).alias("path"), "text")
    root = _on_disk(spark, rows)
    return N.video_heads(spark, root).select("path", "source_sha256_head", "source_size", "bytes_read")


def built_pages(spark: SparkSession, sf: str) -> DataFrame:
    """All notes and pages that a run over a folder writes; of pages their digest, of notes their place."""
    made = vault.folders(spark, sf).select(F.col("dir").alias("lesson_dir"), "summary", F.array("tag").alias("tags"), F.array("concept", "second", "concept").alias("concepts"), F.array().cast("array<string>").alias("aliases"))
    root = _on_disk(spark, vault.files(spark, sf).select("path", "text"))
    settings = Settings(sparse_chars=0)
    plan = build.build_vault(spark, root, lambda rows: rows.select("lesson_dir").join(made, "lesson_dir"), settings, ["src3", "src1", "Automation Tutorials"])
    notes = folders.tree(spark, root).filter(F.col("name").endswith(".md")).select("path")
    there = folders.with_contents(notes.join(plan, "path"), root, {"text": "path"}).filter("text IS NOT NULL")  # transcripts are not read again, texts are not shuffled
    page = F.col("path").rlike(r"(^|/)_[^/]*\.md$|^Concepts/|^[^/]+\.md$")
    return there.select("path", F.when(page, F.sha2("text", 256)).alias("sha"), "action")


def failure_marks(spark: SparkSession, sf: str) -> DataFrame:
    error = F.when(F.col("doc_id") % 5 == 0, F.concat(F.lit("Error: "), F.col("source")))
    return sinks.failure_marks(vault.folders(spark, sf).select(F.concat("dir", F.lit("/out.md")).alias("path"), error.alias("error")))


def report_json(spark: SparkSession, sf: str) -> DataFrame:
    """A report as JSON, a row for each source."""
    rows = table(spark, sf, "documents").groupBy("source").agg(F.count("*").alias("n"), F.max("n_chars").alias("most"))
    return rows.select("source", F.to_json(F.struct("source", "n", F.struct("most").alias("sizes"))).alias("report"))


def flags(spark: SparkSession, sf: str) -> DataFrame:
    from ..settings import is_on

    text = F.element_at(F.array(*map(F.lit, [" No", "yes", "", "OFF ", "1", "0"]), F.lit(None)), (F.col("p_partkey") % 7 + 1).cast("int"))
    return table(spark, sf, "part").select("p_partkey", is_on(text).alias("plain"), is_on(text, True).alias("by_default"))


QUERIES = {f.__name__: f for f in (vault_lessons, vault_one_course, first_lessons, lesson_neighbours, first_seen, transcription_metadata, decoded_sources, lesson_contents, model_inputs, note_heads, rendered_notes, notes_beside, vault_inventory, inventory_paths, prompt_lines, module_pages, stub_pages, course_pages, root_page, concept_pages, concept_page_parts, stale_page_list, vault_report, vault_exit_code, page_link_ratio, stale_notes, canon_mapping, canon_kernel, sample_merges, written_files, disk_lessons, disk_report, disk_stale_pages, disk_heads, built_pages, failure_marks, report_json, flags)}

# ---- the SQL that they equal -----------------------------------------------------

_V = folders_sql()
_L = _V + LESSONS_SQL
_BAD = r"""'[\\/:*?"<>|#^\[\]]'"""
_SAFE = lambda c: f"coalesce(nullif(left(regexp_replace(rtrim(trim(regexp_replace({c}, {_BAD}, '', 'g')), '.'), '\\s+', ' ', 'g'), 180), ''), 'Untitled')"
_CLEAN = lambda c: f"trim(regexp_replace({c}, '^\\s*[0-9]+\\.\\s*', ''))"
_Q = lambda c: f"""('"' || replace(replace({c}, '\\', '\\\\'), '"', '\\"') || '"')"""
_LINK = lambda path, shown: f"(CASE WHEN {shown} = string_split({path}, '/')[-1] THEN '[[' || {path} || ']]' ELSE '[[' || {path} || '|' || {shown} || ']]' END)"
_CUT = lambda c: f"trim(regexp_extract({c}, '(?s)^(.*?)(?:\\n##\\s|\\n<!--\\s*vault:|\\z)', 1), ' ' || chr(9) || chr(10) || chr(13))"
_TRIM = lambda c: f"trim({c}, ' ' || chr(9) || chr(10) || chr(13))"

#: Contents of each folder with a source: transcript (t), Markdown (m) and resources (r).
_CONTENT = f""",
raw AS (SELECT *, CASE WHEN t1 THEN {_TRIM("text")} WHEN t2 THEN CASE WHEN schema = 1 THEN {_CUT("text")} ELSE {_TRIM("'> Summary.' || " + NL + " || " + NL + " || '## Lesson notes' || " + NL + " || " + NL + " || 'old notes' || " + NL + " || " + NL + " || '## Transcript' || " + NL + " || " + NL + " || text || " + NL + " || " + NL + " || '## Resources' || " + NL + " || " + NL + " || '- [a](b)'")} END WHEN t3 OR t4 THEN {_TRIM("text")} ELSE '' END AS t0,
  CASE WHEN page THEN '## ' || lang || {NL} || {NL} || replace(replace(trim(regexp_replace(text, '\\s+', ' ', 'g')), '*', '\\*'), '_', '\\_') ELSE '' END AS m,
  array_to_string(list_concat(CASE WHEN page THEN ['File ' || doc_id || '=/f/' || doc_id, 'two words=b.pdf'] ELSE [] END, CASE WHEN doc_id % 3 = 1 THEN ['a.pdf=resources/a.pdf', 'z.txt=resources/z.txt'] ELSE [] END), ';') AS r,
  array_to_string(list_concat(CASE WHEN page THEN ['- [File ' || doc_id || '](/f/' || doc_id || ')', '- [two words](b.pdf)'] ELSE [] END, CASE WHEN doc_id % 3 = 1 THEN ['- [a.pdf](resources/a.pdf)', '- [z.txt](resources/z.txt)'] ELSE [] END), {NL}) AS shown_resources
  FROM v WHERE t1 OR t2 OR t3 OR t4 OR page),
content AS (SELECT *, CASE WHEN NOT t1 AND t2 AND schema <> 1 THEN {_TRIM("regexp_replace(t0, '^\\s*>\\s[^\\n]*\\n+', '')")} ELSE t0 END AS t FROM raw)"""

_NAMED = f""",
named AS (SELECT *, dir || '/' || printf('%02d', lesson_index) || '. ' || {_SAFE(_CLEAN("lesson_title"))} AS bare, printf('%02d', lesson_index) || '. ' || {_CLEAN("lesson_title")} AS shown FROM lessons),
m AS (SELECT doc_id, dir, unnest([concept, second, concept]) AS concept, unnest([0, 1, 2]) AS pos FROM named),
canon AS (SELECT lower(concept) AS k, arg_min(concept, (string_split(dir, '/'), pos)) AS canonical FROM m GROUP BY 1)"""

_HEAD = lambda *lines: "'---' || " + " || ".join(f"{NL} || {x}" for x in lines) + f" || {NL} || '---' || {NL}"
_PARA = f" || {NL} || {NL} || "
_COURSE_LINK = f"'> Course: [[' || course || '/_' || {_SAFE('course')} || '|' || course || ']]'"
_MODULE_PAGE = lambda body: f"SELECT course || '/' || module_dir || '/_' || {_SAFE('title')} || '.md' AS path, sha256({_HEAD(chr(39) + 'vault_schema: 1' + chr(39), chr(39) + 'title: ' + chr(39) + ' || ' + _Q('title'), _lit('type: \"module-moc\"'), _lit('moc_type: \"module\"'), _lit('course: ') + ' || ' + _Q('course'), _lit('module: ') + ' || ' + _Q('title'))} || {NL} || '{sinks.AUTO_NOTE}'{_PARA}'# ' || title{_PARA}{_COURSE_LINK}{_PARA}{body} || {NL}) AS sha"


def _lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


_INVENTORY = _V + """,
inv AS (SELECT *, dir || '/07. Old title.md' AS path FROM v WHERE t2 AND schema = 1 QUALIFY row_number() OVER (PARTITION BY note_id ORDER BY string_split(dir, '/')) = 1),
names AS (SELECT path, 'concept' AS kind, unnest([concept, second]) AS name FROM inv UNION ALL SELECT path, 'tag', unnest([tag, 'it''s']) FROM inv),
counted AS (SELECT kind, name, count(*) AS n, list(path ORDER BY string_split(path, '/')) AS paths FROM names GROUP BY 1, 2)"""

_BROKEN = """,
nn AS (SELECT n_name FROM nation),
pg AS (SELECT * FROM v WHERE doc_id % 3 = 0),
brand1 AS (SELECT count(*) > 0 AS there FROM part WHERE p_brand = 'Brand#1'),
lk AS (SELECT (SELECT count(*) FROM pg) * 4 + (SELECT count(*) FROM nn) * 3 AS checked, (SELECT count(*) FROM pg) + (SELECT count(*) FROM nn) * CASE WHEN (SELECT there FROM brand1) THEN 1 ELSE 3 END AS broken, (SELECT count(*) FROM pg) + (SELECT count(*) FROM nn) AS pages)"""

_REPORT = _V + _BROKEN + """,
ids AS (SELECT coalesce(j_id, j_alias) AS id, count(*) AS n, min(string_split(dir || '/lesson.json', '/')) AS first_at FROM v WHERE NOT bad AND coalesce(j_id, j_alias) IS NOT NULL GROUP BY 1 HAVING count(*) > 1),
md AS (SELECT dir || '/' || unnest(list_concat(CASE WHEN t1 THEN ['transcript.md'] ELSE [] END, CASE WHEN t2 THEN ['07. Old title.md'] ELSE [] END, CASE WHEN t3 THEN ['transcript.parakeet.md'] ELSE [] END, CASE WHEN t4 THEN ['transcript.remote.md'] ELSE [] END)) AS path, schema, t2, concept FROM v),
wrong AS (SELECT path FROM md WHERE NOT (path LIKE '%/07. Old title.md' AND schema = 1)),
stub AS (SELECT DISTINCT 'Concepts/' || replace(p_brand, '#', '') AS s, replace(p_brand, '#', '') AS name FROM part UNION SELECT DISTINCT lang, lang || ' NOTES' FROM documents),
lone AS (SELECT count(*) AS n FROM stub WHERE lower(name) NOT IN (SELECT lower(concept) FROM v WHERE t2)),
r AS (
SELECT 'lesson.json parse' AS "check", 'FAIL' AS level, dir || '/lesson.json' AS message FROM v WHERE bad
UNION ALL SELECT 'duplicate lessonId', 'FAIL', id || ': ' || n || ' occurrences' FROM (SELECT * FROM ids ORDER BY first_at, id LIMIT 5)
UNION ALL SELECT 'duplicate lessonId', 'FAIL', '... +' || (n - 5) || ' more dupes' FROM (SELECT count(*) AS n FROM ids) WHERE n > 5
UNION ALL SELECT 'missing lessonId', 'WARN', n || '/' || (SELECT count(*) FROM v) || ' lesson.json files lack lessonId' FROM (SELECT count(*) AS n FROM v WHERE NOT bad AND coalesce(j_id, j_alias) IS NULL) WHERE n > 0
UNION ALL SELECT 'vault_schema missing', 'FAIL', path FROM (SELECT * FROM wrong ORDER BY string_split(path, '/') LIMIT 5)
UNION ALL SELECT 'vault_schema missing', 'FAIL', '... +' || (n - 5) || ' more' FROM (SELECT count(*) AS n FROM wrong) WHERE n > 5
UNION ALL SELECT CASE WHEN n > 0 THEN 'orphan concept stubs' ELSE 'concept stubs referenced' END, CASE WHEN n > 0 THEN 'WARN' ELSE 'OK' END, CASE WHEN n > 0 THEN n || '/' || (SELECT count(*) FROM stub) || ' stubs unreferenced' ELSE (SELECT count(*) FROM stub) || ' stubs all referenced' END FROM lone
UNION ALL SELECT 'broken MOC wikilinks', 'WARN', broken || '/' || checked || ' links unresolved across ' || pages || ' MOCs' FROM lk
UNION ALL SELECT 'nested duplicate vault', 'FAIL', 'My vault exists'
UNION ALL SELECT CASE WHEN h > 0 THEN 'body wikilinks reference canonicalized variants' ELSE 'body wikilinks clean (sample)' END, CASE WHEN h > 0 THEN 'WARN' ELSE 'OK' END, CASE WHEN h > 0 THEN h || '/' || n || ' sampled lessons' ELSE n || ' lessons sampled' END FROM (SELECT count(*) FILTER (WHERE path LIKE '%/07. Old title.md') AS h, count(*) AS n FROM (SELECT * FROM md ORDER BY string_split(path, '/') LIMIT 50)))"""

_JSON_MAP = "SELECT 'concept' AS kind, p_brand AS variant, CASE WHEN right(p_brand, 1) = '4' THEN 'House' ELSE p_brand END AS canonical FROM (SELECT DISTINCT p_brand FROM part) WHERE right(p_brand, 1) <> '3'"

SQL = {
    "vault_lessons": _L + """
SELECT lesson_id, course, CASE WHEN section = 'Automation Tutorials' THEN bare_module END AS sub_course, module_dir, module_title, module_index, lesson_index, lesson_title, coalesce(j_video, false) AS has_video, coalesce(j_rel, '') AS relative_path, dir AS lesson_dir, transcript AS transcript_path, CASE WHEN page THEN 'index.html' END AS index_html_path FROM lessons""",
    "vault_one_course": _L + " SELECT 'My vault' AS course, module_dir, CASE WHEN section = 'Automation Tutorials' THEN bare_module END AS sub_course, count(*)::BIGINT AS n FROM lessons GROUP BY 1, 2, 3",
    "first_lessons": _L + " SELECT lesson_id, dir AS lesson_dir FROM lessons ORDER BY string_split(dir, '/') LIMIT 10",
    "lesson_neighbours": _L + " SELECT dir AS lesson_dir, lag(dir) OVER w AS prev_id, lead(dir) OVER w AS next_id FROM lessons WINDOW w AS (PARTITION BY course, module_dir ORDER BY lesson_index, lesson_title, string_split(dir, '/'))",
    "first_seen": _V + " SELECT dir, coalesce(j_id, j_alias) AS key, row_number() OVER (PARTITION BY coalesce(j_id, j_alias) ORDER BY string_split(dir, '/'))::INT AS seen FROM v WHERE coalesce(j_id, j_alias) IS NOT NULL",
    "transcription_metadata": _V + r""",
w AS (SELECT *, bad OR doc_id % 19 = 0 AS gone, trim(regexp_replace(string_split(dir, '/')[-1], '^[0-9]+-', '')) AS fb FROM v WHERE doc_id % 2 = 1),
x AS (SELECT dir, CASE WHEN gone THEN fb ELSE coalesce(nullif(j_title, ''), fb) END AS title, CASE WHEN gone THEN fb ELSE coalesce(j_title, fb) END AS lesson_title, CASE WHEN gone THEN '' ELSE coalesce(j_module, '') END AS module_title, CASE WHEN gone THEN '' ELSE coalesce(j_id, '') END AS lesson_id, CASE WHEN gone THEN '' ELSE coalesce(j_rel, '') END AS relative_path FROM w)
SELECT *, regexp_replace(title, '[\\/:*?"<>|]', '-', 'g') || '.remote.md' AS output FROM x""",
    "decoded_sources": "SELECT doc_id, sha256(text || chr(65533) || '(' || chr(65533) || 'a') AS sha FROM documents",
    "lesson_contents": _V + _CONTENT + f"""
SELECT dir, sha256(t) AS transcript_sha, sha256(m) AS notes_sha, r AS resources, left(sha256('HTML::' || m || {NL} || 'TRANSCRIPT::' || t), 16) AS body_sha,
  length(CASE WHEN t1 THEN {_TRIM("'# A heading' || " + NL + " || " + NL + " || '> quoted line' || " + NL + " || " + NL + " || text")} WHEN t2 THEN {_CUT("text")} WHEN t3 OR t4 THEN {_TRIM("text")} ELSE '' END)::INT AS stats_chars FROM content""",
    "model_inputs": _L + _CONTENT + f""",
z AS (SELECT l.dir AS lesson_dir, l.course || '/' || coalesce(CASE WHEN l.section = 'Automation Tutorials' THEN l.bare_module END, l.module_title) AS hint, l.lesson_title, CASE WHEN m <> '' THEN 'LESSON NOTES:' || {NL} || m || {NL} || {NL} ELSE '' END || CASE WHEN t <> '' THEN 'TRANSCRIPT:' || {NL} || t ELSE '' END AS body FROM lessons l JOIN content c USING (doc_id)),
y AS (SELECT lesson_dir, hint, 'LESSON PATH: ' || hint || {NL} || 'TITLE: ' || lesson_title || {NL} || {NL} || 'TRANSCRIPT:' || {NL} || CASE WHEN length(body) > 16000 THEN left(body, 16000) || {NL} || {NL} || '[...truncated...]' ELSE body END AS s FROM z)
SELECT lesson_dir, hint, sha256(s) AS message_sha, length(s)::INT AS chars FROM y""",
    "note_heads": _V + f" SELECT doc_id, schema::VARCHAR AS version, note_id AS lesson_id, tag || ',it''s' AS tags, concept || ',' || second AS concepts, 0 AS n_aliases, '[]' AS aliases_text, (length(text) + length('{NL.replace(chr(39), '')}') * 0 + {len(chr(10) + '# A title' + chr(10) * 2 + '> Summary.' + chr(10) * 2 + '## Lesson notes' + chr(10) * 2 + 'old notes' + chr(10) * 2 + '## Transcript' + chr(10) * 2 + chr(10) * 2 + '## Resources' + chr(10) * 2 + '- [a](b)' + chr(10) * 2 + X.NAV_START + chr(10) + '**Nav:** ⇡ [[x]]' + chr(10) + X.NAV_END + chr(10) * 2 + X.RELATED_START + chr(10) + '## Related concepts' + chr(10) + '- [[Concepts/y|y]]' + chr(10) + X.RELATED_END + chr(10))})::INT AS body_chars FROM v",
    "rendered_notes": _L + _CONTENT + _NAMED + f""",
nx AS (SELECT *, lag({_LINK("bare", "shown")}) OVER w AS prev, lead({_LINK("bare", "shown")}) OVER w AS next FROM named WINDOW w AS (PARTITION BY course, module_dir ORDER BY lesson_index, lesson_title, string_split(dir, '/'))),
rel AS (SELECT doc_id, string_agg({_LINK("'Concepts/' || " + _SAFE("concept"), "concept")}, {NL} || '- ' ORDER BY pos) AS links FROM m JOIN canon ON concept = canonical GROUP BY 1),
f AS (SELECT nx.*, c.t, c.m, c.shown_resources, coalesce(rel.links, '') AS links, left(sha256('HTML::' || c.m || {NL} || 'TRANSCRIPT::' || c.t), 16) AS sha16, nx.t2 AND NOT nx.t1 AS old, regexp_replace(nx.dir, '/[^/]*$', '') || '/_' || {_SAFE("nx.module_title")} AS up FROM nx JOIN content c USING (doc_id) LEFT JOIN rel USING (doc_id))
SELECT bare || '.md' AS path, sha256('---' || {NL} || array_to_string(list_filter(['vault_schema: 1', 'title: ' || {_Q("lesson_title")}, 'aliases: []', 'course: ' || {_Q("course")}, CASE WHEN section = 'Automation Tutorials' THEN 'sub_course: ' || {_Q("bare_module")} END, 'module: ' || {_Q("module_title")}, 'module_index: ' || module_index, 'lesson_index: ' || lesson_index, 'lesson_id: ' || {_Q("lesson_id")}, 'summary: ' || {_Q("summary")},
  'tags:' || {NL} || '- ' || {_Q("tag")} || {NL} || '- "it''s"', 'concepts:' || {NL} || '- ' || {_Q("concept")} || {NL} || '- ' || {_Q("second")}, 'body_sha: ' || {_Q("sha16")}, CASE WHEN doc_id % 2 = 0 THEN 'ai_engine: "local"' END, CASE WHEN old THEN 'language: ' || {_Q("lang")} END, CASE WHEN old THEN 'duration_sec: ' || j_index END], lambda x: x IS NOT NULL), {NL}) || {NL} || '---' || {NL}
  || {NL} || '# ' || {_CLEAN("lesson_title")} || {NL} || CASE WHEN summary <> '' THEN {NL} || '> ' || summary || {NL} ELSE '' END || {NL}
  || CASE WHEN m = '' AND t = '' AND shown_resources = '' THEN '_No content captured for this lesson._' ELSE array_to_string(list_filter([CASE WHEN m <> '' THEN '## Lesson notes' || {NL} || {NL} || m END, CASE WHEN t <> '' THEN '## Transcript' || {NL} || {NL} || t END, CASE WHEN shown_resources <> '' THEN '## Resources' || {NL} || {NL} || shown_resources END], lambda x: x IS NOT NULL), {NL} || {NL}) END
  || {NL} || {NL} || '{X.NAV_START}' || {NL} || '**Nav:** ' || array_to_string(list_filter(['← ' || prev, '⇡ ' || {_LINK("up", "module_title")}, next || ' →'], lambda x: x IS NOT NULL), ' · ') || {NL} || '{X.NAV_END}'
  || CASE WHEN links <> '' THEN {NL} || {NL} || '{X.RELATED_START}' || {NL} || '## Related concepts' || {NL} || '- ' || links || {NL} || '{X.RELATED_END}' ELSE '' END || {NL}) AS sha FROM f""",
    "notes_beside": _V + " SELECT dir || '/' || unnest(list_concat(CASE WHEN t1 THEN ['transcript.md'] ELSE [] END, CASE WHEN t2 THEN ['07. Old title.md'] ELSE [] END, CASE WHEN t3 THEN ['transcript.parakeet.md'] ELSE [] END, CASE WHEN t4 THEN ['transcript.remote.md'] ELSE [] END)) AS path FROM v",
    "vault_inventory": _INVENTORY + " SELECT path FROM inv",
    "inventory_paths": _INVENTORY + " SELECT kind, name, n::BIGINT AS n, sha256(array_to_string(paths, '|')) AS paths_sha FROM counted",
    "prompt_lines": _INVENTORY + """ SELECT kind, row_number() OVER (PARTITION BY kind ORDER BY n DESC, name)::INT AS place, '  ' || CASE WHEN contains(name, '''') THEN '"' || name || '"' ELSE '''' || name || '''' END || ': ' || n AS line FROM counted""",
    "module_pages": _L + _NAMED + f""",
g AS (SELECT course, module_dir, arg_min(module_title, (lesson_index, lesson_title, string_split(dir, '/'))) AS title, string_agg('- ' || {_LINK("bare", "shown")} || CASE WHEN summary <> '' THEN {NL} || '    - ' || summary ELSE '' END, {NL} ORDER BY lesson_index, lesson_title, string_split(dir, '/')) AS body FROM named GROUP BY 1, 2)
""" + _MODULE_PAGE(f"'## Lessons'{_PARA}body") + " FROM g",
    "stub_pages": _L + """, o AS (SELECT DISTINCT 'Automation Tutorials' AS course, n_nationkey || '-' || n_name AS module_dir, n_name AS title FROM nation WHERE EXISTS (SELECT 1 FROM lessons WHERE course = 'Automation Tutorials'))
""" + _MODULE_PAGE(f"'_No lessons indexed for this module yet._' || {NL}") + " FROM o",
    "course_pages": _L + f""",
d AS (SELECT DISTINCT course, module_index, module_dir, module_title FROM lessons),
g AS (SELECT course, string_agg('- ' || {_LINK("course || '/' || module_dir || '/_' || " + _SAFE("module_title"), "module_title")}, {NL} ORDER BY module_index, module_dir, module_title) AS body FROM d GROUP BY 1)
SELECT course || '/_' || {_SAFE("course")} || '.md' AS path, sha256({_HEAD("'vault_schema: 1'", "'title: ' || " + _Q("course"), _lit('type: "course-moc"'), "'course: ' || " + _Q("course"))} || {NL} || '# ' || course{_PARA}'> [[My vault]] › **' || course || '**'{_PARA}'## Modules'{_PARA}body || {NL}) AS sha FROM g""",
    "root_page": _L + _NAMED + f""",
c AS (SELECT string_agg('- ' || {_LINK("course || '/_' || " + _SAFE("course"), "course")}, {NL} ORDER BY coalesce(list_position(['src3', 'src1', 'Automation Tutorials'], course), 1000), course) AS b FROM (SELECT DISTINCT course FROM lessons)),
k AS (SELECT string_agg('- ' || {_LINK("'Concepts/' || " + _SAFE("canonical"), "canonical")}, {NL} ORDER BY canonical) AS b FROM canon)
SELECT 'My vault.md' AS path, sha256({_HEAD("'vault_schema: 1'", _lit('title: "My vault"'), _lit('type: "vault-root"'))} || {NL} || '# My vault'{_PARA}'> Root of the vault. Each course section is a MOC.'{_PARA}'## Sections'{_PARA}c.b{_PARA}'## Concepts'{_PARA}k.b || {NL}) AS sha FROM c, k""",
    "concept_pages": _L + _NAMED + f""",
j AS (SELECT n.*, canonical, pos, n.course || ' › ' || n.module_title || ' › ' || {_CLEAN("n.lesson_title")} AS told FROM m JOIN canon ON lower(m.concept) = k JOIN named n USING (doc_id)),
g AS (SELECT canonical, count(*)::BIGINT AS lesson_count, string_agg('- ' || {_LINK("bare", "told")}, {NL} ORDER BY course, module_index, lesson_index, string_split(dir, '/'), pos) AS body FROM j GROUP BY 1)
SELECT canonical, lesson_count, 'Concepts/' || {_SAFE("canonical")} || '.md' AS path, sha256({_HEAD("'vault_schema: 1'", "'title: ' || " + _Q("canonical"), _lit('type: "concept"'), "'tags:' || " + NL + " || " + _lit('- "concept"'), "'lesson_count: ' || lesson_count")} || {NL} || '# ' || canonical{_PARA}'> Concept referenced in ' || lesson_count || CASE WHEN lesson_count = 1 THEN ' lesson.' ELSE ' lessons.' END{_PARA}'## Lessons'{_PARA}body || {NL}) AS sha FROM g""",
    "stale_page_list": _V + " SELECT section || '/_' || doc_id || '.md' AS path FROM v WHERE doc_id % 5 < 3 AND doc_id % 3 <> 0 AND doc_id % 2 = 1",
    "vault_report": _REPORT + ' SELECT "check", level, message FROM r',
    "vault_exit_code": _REPORT + ", x AS (SELECT count(*) FILTER (WHERE level = 'OK')::BIGINT AS n_ok, count(*) FILTER (WHERE level = 'WARN')::BIGINT AS n_warn, count(*) FILTER (WHERE level = 'FAIL')::BIGINT AS n_fail FROM r) SELECT *, CASE WHEN n_fail > 0 THEN 2 WHEN n_warn > 0 THEN 1 ELSE 0 END AS exit_code, CASE WHEN n_fail > 0 THEN 'block' WHEN n_warn > 0 THEN 'warn' ELSE 'go' END AS gate FROM x",
    "page_link_ratio": _V + _BROKEN + " SELECT checked::BIGINT AS checked, broken::BIGINT AS broken, round(broken / checked, 4) AS ratio FROM lk",
    "stale_notes": _V + " SELECT dir || '/n.md' AS path FROM v WHERE doc_id % 3 <> 1",
    "canon_mapping": _JSON_MAP + " UNION ALL SELECT 'tag', 'Tag One', 'tag-one'",
    "canon_kernel": _INVENTORY + " SELECT DISTINCT 'concept' AS kind, name AS variant, lower(name) AS canonical FROM counted",
    "sample_merges": f"WITH x AS ({_JSON_MAP}) SELECT * FROM x WHERE variant <> canonical ORDER BY variant LIMIT 12",
    "written_files": "SELECT n_regionkey || '/' || n_name || '.md' AS path, '# ' || n_name || ' é' || chr(10) AS text FROM nation",
    "failure_marks": _V + f" SELECT dir || '/out.md.FAILED' AS path, '# Transcription failed' || {NL} || {NL} || 'Error: ' || source || {NL} AS text FROM v WHERE doc_id % 5 = 0",
    "report_json": """SELECT source, '{"source":"' || source || '","n":' || count(*) || ',"sizes":{"most":' || max(n_chars) || '}}' AS report FROM documents GROUP BY 1""",
    "flags": "SELECT p_partkey, coalesce([false, true, false, false, true, false, NULL][p_partkey % 7 + 1], false) AS plain, coalesce([false, true, false, false, true, false, NULL][p_partkey % 7 + 1], true) AS by_default FROM part",
}

SQL["disk_lessons"] = SQL["vault_lessons"]
SQL["disk_report"] = SQL["vault_report"]
SQL["disk_stale_pages"] = f"SELECT path, false AS there FROM ({SQL['stale_page_list']})"
SQL["disk_heads"] = "SELECT source || '/v' || doc_id || '/video.mp4' AS path, sha256(text) AS source_sha256_head, strlen(text)::BIGINT AS source_size, strlen(text)::BIGINT AS bytes_read FROM documents"
SQL["built_pages"] = " UNION ALL ".join(f"SELECT path, sha, 'new' AS action FROM ({SQL[q]})" for q in ("module_pages", "course_pages", "root_page", "concept_pages")) + " UNION ALL SELECT bare || '.md', NULL, 'new' FROM (" + _L + _NAMED + " SELECT bare FROM named)"
SQL["concept_page_parts"] = _L + _NAMED + f""",
j AS (SELECT n.*, canonical, pos, '- ' || {_LINK("bare", "(n.course || ' › ' || n.module_title || ' › ' || " + _CLEAN("n.lesson_title") + ")")} AS line FROM m JOIN canon ON lower(m.concept) = k JOIN named n USING (doc_id)),
b AS (SELECT canonical, line, row_number() OVER w AS i, sum(strlen(line) + 1) OVER w - strlen(line) - 1 AS begin FROM j WINDOW w AS (PARTITION BY canonical ORDER BY course, module_index, lesson_index, string_split(dir, '/'), pos))
SELECT canonical, (begin // 4096)::BIGINT AS part, min(begin)::BIGINT AS begin, count(*)::BIGINT AS n_lines, sha256(string_agg(line, {NL} ORDER BY i)) AS sha FROM b GROUP BY canonical, begin // 4096"""
