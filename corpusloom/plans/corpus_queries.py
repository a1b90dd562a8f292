"""Queries over documents as a collection: sizes, duplicates, neighbours, incremental recompute, repeats."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import runs
from ..functions import text as X
from ..operators import corpus, kernels, stats
from ..session import table, written

#: doc_id = lesson, source = course, lang = module, text = transcript, quality 0 = failed.
_FAILED = "SELECT DISTINCT doc_id FROM labels WHERE quality = 0"


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents")


def _sized(spark: SparkSession, sf: str) -> DataFrame:
    failed = table(spark, sf, "labels").filter("quality = 0").select("doc_id").distinct().withColumn("failed", F.lit(True))
    return _documents(spark, sf).select("doc_id", F.length("text").alias("chars")).join(failed, "doc_id", "left").withColumn("failed", F.coalesce("failed", F.lit(False)))


def size_stats_overall(spark: SparkSession, sf: str) -> DataFrame:
    return stats.size_stats(_documents(spark, sf).select(F.length("text").alias("chars")), "chars")


def size_stats_by_failed(spark: SparkSession, sf: str) -> DataFrame:
    return stats.size_stats(_sized(spark, sf), "chars", ["failed"])


def _size_sql(by: str) -> str:
    point = lambda p: f"CASE WHEN n < 100 THEN l[n] ELSE (l[greatest(1, least({p} * (n + 1) // 100, n - 1))] * (100 - ({p} * (n + 1) - 100 * greatest(1, least({p} * (n + 1) // 100, n - 1)))) + l[greatest(1, least({p} * (n + 1) // 100, n - 1)) + 1] * ({p} * (n + 1) - 100 * greatest(1, least({p} * (n + 1) // 100, n - 1)))) // 100 END::BIGINT AS p{p}"
    keep = f"{by}, " if by else ""
    return f"""
WITH f AS ({_FAILED}), s AS (SELECT length(text) AS c, f.doc_id IS NOT NULL AS failed FROM documents d LEFT JOIN f USING (doc_id)),
g AS (SELECT {keep}list_sort(list(c)) AS l, count(*) AS n FROM s {f"GROUP BY {by}" if by else ""})
SELECT {keep}n::BIGINT AS n, l[n]::INT AS max_chars, l[1]::INT AS min_chars, ((l[(n + 1) // 2] + l[n // 2 + 1]) // 2)::BIGINT AS median_chars, {point(50)}, {point(95)}, {point(99)} FROM g"""


def size_top25(spark: SparkSession, sf: str) -> DataFrame:
    rows = _sized(spark, sf).withColumn("tokens", X.tokens_estimate(F.col("chars")))
    return stats.top_k(rows, [F.desc("chars"), F.desc("failed"), F.desc("doc_id")], 25).select("doc_id", "chars", "failed", "tokens")


def dedupe_keep_first(spark: SparkSession, sf: str) -> DataFrame:
    rows = _documents(spark, sf).select("doc_id", "source", "lang", F.sha2("text", 256).alias("sha"))
    return corpus.keep_first(rows, F.col("sha"), [F.col("doc_id")])


def dedupe_counts(spark: SparkSession, sf: str) -> DataFrame:
    return corpus.dedupe_counts(_documents(spark, sf).select(F.sha2("text", 256).alias("sha")), "sha")


def duplicate_report(spark: SparkSession, sf: str) -> DataFrame:
    rows = _documents(spark, sf).select("doc_id", F.sha2("text", 256).alias("sha"))
    return stats.duplicate_report(rows, "sha", "doc_id")


def neighbors(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "conversations").select("conv_id", "turn", "role")
    return corpus.neighbours(rows, ["conv_id"], [F.col("turn"), F.col("role")], "turn")


def body_hash(spark: SparkSession, sf: str) -> DataFrame:
    return _documents(spark, sf).select("doc_id", X.body_hash(F.col("lang"), F.col("text")).alias("body_sha"))


def incremental_skip(spark: SparkSession, sf: str) -> DataFrame:
    now = body_hash(spark, sf)
    i = F.col("doc_id")
    before = now.filter(i % 7 != 0).select(
        "doc_id",
        F.when(i % 5 == 0, F.lit("changed")).otherwise(F.col("body_sha")).alias("body_sha"),
        F.when(i % 11 == 0, F.lit(0)).otherwise(F.lit(1)).alias("schema"),
        F.when(i % 13 == 0, F.array().cast("array<string>")).otherwise(F.array(F.lit("t"))).alias("tags"),
    )
    return corpus.incremental(now, before, "doc_id")


def sparse_filter(spark: SparkSession, sf: str) -> DataFrame:
    return _documents(spark, sf).filter(corpus.is_sparse(F.lit(""), F.col("text"))).select("doc_id", F.length("text").alias("chars"))


_PLACES = ["N8N Blueprint Library", "Make Basics", "Community Calls", "Niche Packs", "Vibe Coding", "Sales", "Agentic Resource Library", "Community Exclusive", ":Intro:"]


def sparse_metadata(spark: SparkSession, sf: str) -> DataFrame:
    module = F.element_at(F.array(*map(F.lit, _PLACES)), (F.col("p_partkey") % len(_PLACES) + 1).cast("int"))
    made = corpus.sparse_metadata(F.col("p_brand"), F.lit(None).cast("string"), module, F.col("p_partkey") % 3)
    return table(spark, sf, "part").select("p_partkey", made["summary"].alias("summary"), F.array_join(made["tags"], ",").alias("tags"), made["concept"].alias("concept"))


def _sparse_sql() -> str:
    ctx = "lower(p_brand || '  ' || m)"
    tags = ", ".join("CASE WHEN " + " OR ".join(f"contains(ctx, '{w}')" for w in ws) + f" THEN '{t}' END" for t, ws in corpus.SPARSE_TAGS)
    concept = " ".join("WHEN " + " AND ".join(f"contains(ctx, '{w}')" for w in ws) + f" THEN '{c}'" for c, ws in corpus.SPARSE_CONCEPTS)
    names = ", ".join(f"'{p}'" for p in _PLACES)
    return f"""
WITH p AS (SELECT *, [{names}][p_partkey % {len(_PLACES)} + 1] AS m, p_partkey % 3 AS r FROM part), q AS (SELECT *, {ctx} AS ctx FROM p)
SELECT p_partkey, left('Reference entry in ' || p_brand || ' › ' || m || '.' || CASE WHEN r > 0 THEN ' Includes ' || r || ' downloadable resource' || CASE WHEN r <> 1 THEN 's' ELSE '' END || '.' ELSE '' END, 200) AS summary,
  array_to_string(list_filter([{tags}, 'reference'], lambda x: x IS NOT NULL)[1:5], ',') AS tags,
  CASE {concept} ELSE coalesce(nullif(trim(trim(m), ':'), ''), p_brand) END AS concept FROM q"""


def sentence_runs(spark: SparkSession, sf: str) -> DataFrame:
    return _documents(spark, sf).select("doc_id", runs.sentence_repeats("text").alias("r")).select("doc_id", F.col("r.run").alias("run"), F.col("r.text").alias("text"))


def line_runs(spark: SparkSession, sf: str) -> DataFrame:
    run = runs.sentence_run(F.split("text", "\n"))
    return _documents(spark, sf).select("doc_id", run.alias("r")).select("doc_id", F.col("r.run").alias("run"), F.col("r.text").alias("text"))


def _run_sql(parts: str) -> str:
    return f"""
WITH p AS (SELECT doc_id, {parts} AS l FROM documents),
e AS (SELECT doc_id, i, trim(l[i], ' ' || chr(9) || chr(10) || chr(13)) AS t FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i FROM p)),
c AS (SELECT *, CASE WHEN length(t) >= 20 AND t = lag(t) OVER (PARTITION BY doc_id ORDER BY i) THEN 0 ELSE 1 END AS b FROM e),
g AS (SELECT *, sum(b) OVER (PARTITION BY doc_id ORDER BY i) AS isl FROM c),
n AS (SELECT doc_id, isl, min(i) AS i, count(*) AS run, min(t) AS t FROM g WHERE length(t) >= 20 GROUP BY doc_id, isl HAVING count(*) > 1),
best AS (SELECT doc_id, arg_max({{'run': run, 't': t}}, (run, -i)) AS x FROM n GROUP BY doc_id)
SELECT d.doc_id, coalesce(x.run, 1)::INT AS run, coalesce(x.t, '') AS text FROM documents d LEFT JOIN best USING (doc_id)"""


def phrase_runs(spark: SparkSession, sf: str) -> DataFrame:
    return _documents(spark, sf).select("doc_id", runs.repeats("text").alias("p")).select("doc_id", F.col("p.phrase_run").alias("run"), F.col("p.phrase_text").alias("phrase"))


def hallucination_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Documents whose repeats reach a severity of 60: worst first, ties by path order.

    Each text is read once, by one Arrow function for both patterns; its few rows with
    a finding are written before they are sorted, since a sort samples its input and
    would have all texts read again.
    """
    rows = _documents(spark, sf).select("doc_id", runs.repeats("text").alias("r"))
    # a generator, which the optimiser neither repeats nor pushes the filter through
    out = rows.select("doc_id", F.inline(F.array("r"))).withColumn("severity", runs.severity(F.col("sent_run"), F.col("sent_text"), F.col("phrase_run"), F.col("phrase_text")).cast("long"))
    worst = runs.worst(F.col("sent_run"), F.col("sent_text"), F.col("phrase_run"), F.col("phrase_text"))
    out = out.filter("severity >= 60").select("doc_id", "severity", "sent_run", "phrase_run", F.left(worst, F.lit(70)).alias("worst"))
    return written(out).orderBy(F.desc("severity"), "doc_id")


#: The greedy scan over stretches of words that equal the word n places on: each stretch is entered at p or at its start, whichever is later.
_PHRASE_CTE = """
w AS (SELECT doc_id, list_filter(regexp_split_to_array(trim(text, ' ' || chr(9) || chr(10) || chr(13)), '\\s+'), lambda x: x <> '') AS l FROM documents),
eq AS (SELECT doc_id, n, i, l FROM (SELECT doc_id, l, n, unnest(range(1, len(l) - n + 1)) AS i FROM w, range(4, 9) t(n) WHERE len(l) >= n * 10) WHERE l[i] = l[i + n]),
isl AS (SELECT doc_id, n, min(i) AS s, max(i) AS e, any_value(l) AS l FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, n ORDER BY i) AS g FROM eq) GROUP BY doc_id, n, g HAVING count(*) >= n),
num AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY doc_id, n ORDER BY s) AS k FROM isl),
scan(doc_id, n, k, i, run, p) AS (
  SELECT doc_id, n, 0, NULL::BIGINT, 0::BIGINT, 1::BIGINT FROM num WHERE k = 1
  UNION ALL
  SELECT x.doc_id, x.n, x.k, greatest(c.p, x.s), CASE WHEN greatest(c.p, x.s) + x.n - 1 <= x.e THEN 1 + (x.e - greatest(c.p, x.s) + 1) // x.n ELSE 0 END, CASE WHEN greatest(c.p, x.s) + x.n - 1 <= x.e THEN greatest(c.p, x.s) + (1 + (x.e - greatest(c.p, x.s) + 1) // x.n) * x.n ELSE c.p END
  FROM scan c JOIN num x ON x.doc_id = c.doc_id AND x.n = c.n AND x.k = c.k + 1),
cand AS (SELECT scan.doc_id, scan.n, scan.i, scan.run, array_to_string(num.l[scan.i : scan.i + scan.n - 1], ' ') AS phrase FROM scan JOIN num USING (doc_id, n, k) WHERE scan.run >= 10),
pb AS (SELECT doc_id, arg_max({'run': run, 'phrase': phrase}, (run, -n, -i)) AS x FROM cand GROUP BY doc_id)"""


def paragraphs(spark: SparkSession, sf: str) -> DataFrame:
    said = table(spark, sf, "conversations").groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))), lambda s: s["text"]).alias("ts"))
    return said.select("conv_id", F.posexplode(runs.paragraphs(F.col("ts"))).alias("pos", "paragraph"))


def prompt_truncate(spark: SparkSession, sf: str) -> DataFrame:
    return _documents(spark, sf).select("doc_id", F.sha2(X.prompt_body(F.col("text")), 256).alias("sha"), F.length(X.prompt_body(F.col("text"))).alias("chars"))


def classification_coerce(spark: SparkSession, sf: str) -> DataFrame:
    words = X.words(F.col("text"))
    tags = F.transform(words, lambda w: F.concat(F.lit(" "), w, F.lit(" X ")))
    made = corpus.coerced(F.col("text"), F.concat(F.array(F.lit(""), F.lit(None)), tags), words, words)
    return _documents(spark, sf).select("doc_id", F.length(made["summary"]).alias("n_summary"), F.array_join(made["tags"], ",").alias("tags"), F.size(made["concepts"]).alias("n_concepts"), F.array_join(made["aliases"], ",").alias("aliases"))


def parse_llm_json(spark: SparkSession, sf: str) -> DataFrame:
    said = F.concat(F.lit("Here it is:\n```json\n"), F.col("props"), F.lit("\n``` done"))
    return table(spark, sf, "events").select("event_id", F.from_json(X.json_object(said), "k int")["k"].alias("k"))


def route_backends(spark: SparkSession, sf: str) -> DataFrame:
    place = F.concat_ws(" / ", "source", "lang", F.col("doc_id").cast("string"))
    r = corpus.route(F.col("doc_id") % 9 == 0, F.length("text") < corpus.SPARSE_CHARS, place, "hybrid", ["*src1*", "*/ fr /*"], "local", "sdk")
    return _documents(spark, sf).groupBy(r.alias("route")).agg(F.count("*").alias("n"))


def glob_matches(spark: SparkSession, sf: str) -> DataFrame:
    """Shell globs with sets of characters against the place of each document."""
    place = F.concat_ws(" / ", "source", "lang", F.col("doc_id").cast("string"))
    hit = lambda g: place.rlike(corpus.glob_pattern(g))
    return _documents(spark, sf).select("doc_id", hit("src[1-3] / [!f]?").alias("in_set"), hit("/ [ef][nr] / *7").alias("ends"), hit("*src1?").alias("one_more"), hit("[^a] /").alias("caret"), hit("[x").alias("no_set"))


def unclassified(spark: SparkSession, sf: str) -> DataFrame:
    """Rows whose answer lacks a summary, tags or concepts."""
    i = F.col("doc_id")
    some = lambda when: F.when(when, F.array(F.lit("x"))).when(i % 4 == 0, F.array().cast("array<string>"))
    empty = corpus.is_unclassified(F.when(i % 3 != 0, F.lit("s")).when(i % 2 == 0, F.lit("")), some(i % 5 != 0), some(i % 7 != 0))
    return _documents(spark, sf).select("doc_id", empty.alias("empty"))


def kernel_cascade(spark: SparkSession, sf: str) -> DataFrame:
    """Three backends in turn, the first two of which leave some rows empty; every row comes back."""
    import pandas as pd

    def some(modulus: int) -> kernels.Kernel:
        def kernel(b: pd.DataFrame) -> pd.DataFrame:
            out = kernels.stub_classify(b)
            out.loc[b["lesson_id"].to_numpy() % modulus == 0, "summary"] = ""
            return out

        return kernel

    rows = _documents(spark, sf).select(F.col("doc_id").alias("lesson_id"), "text")
    out = kernels.cascade(rows, [("first", some(2)), ("second", some(3)), ("third", some(5))], "lesson_id", kernels.CLASSIFIED)
    return out.select("lesson_id", "engine", (F.col("summary") == "").alias("empty"))


def kernel_classify_stub(spark: SparkSession, sf: str) -> DataFrame:
    rows = _documents(spark, sf).select(F.col("doc_id").alias("lesson_id"), "text")
    return kernels.apply(rows, kernels.stub_classify, kernels.CLASSIFIED)


QUERIES = {f.__name__: f for f in (size_stats_overall, size_stats_by_failed, size_top25, dedupe_keep_first, dedupe_counts, duplicate_report, neighbors, body_hash, incremental_skip, sparse_filter, sparse_metadata, sentence_runs, line_runs, phrase_runs, hallucination_scan, paragraphs, prompt_truncate, classification_coerce, parse_llm_json, route_backends, glob_matches, unclassified, kernel_cascade, kernel_classify_stub)}

_SHA16 = "left(sha256('HTML::' || coalesce(lang, '') || chr(10) || 'TRANSCRIPT::' || coalesce(text, '')), 16)"
_SENTENCES = r"string_split(regexp_replace(text, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1))"

SQL = {
    "size_stats_overall": _size_sql(""),
    "size_stats_by_failed": _size_sql("failed"),
    "size_top25": f"WITH f AS ({_FAILED}) SELECT d.doc_id, length(text)::INT AS chars, f.doc_id IS NOT NULL AS failed, floor(length(text) * 0.25)::BIGINT AS tokens FROM documents d LEFT JOIN f USING (doc_id) ORDER BY chars DESC, failed DESC, doc_id DESC LIMIT 25",
    "dedupe_keep_first": "SELECT doc_id, source, lang, sha256(text) AS sha FROM documents QUALIFY row_number() OVER (PARTITION BY sha256(text) ORDER BY doc_id) = 1",
    "dedupe_counts": "SELECT count(*)::BIGINT AS n_raw, count(DISTINCT sha256(text))::BIGINT AS n_unique, (count(*) - count(DISTINCT sha256(text)))::BIGINT AS n_skipped FROM documents",
    "duplicate_report": "SELECT sha256(text) AS sha, count(*)::BIGINT AS copies, array_to_string(list_sort(list(doc_id))[1:5], ',') AS samples, greatest(count(*) - 5, 0)::BIGINT AS more FROM documents GROUP BY 1 HAVING count(*) > 1",
    "neighbors": "SELECT conv_id, turn, role, lag(turn) OVER w AS prev_id, lead(turn) OVER w AS next_id FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role)",
    "body_hash": f"SELECT doc_id, {_SHA16} AS body_sha FROM documents",
    "incremental_skip": f"SELECT doc_id, {_SHA16} AS body_sha, doc_id % 7 <> 0 AND doc_id % 5 <> 0 AND doc_id % 11 <> 0 AND doc_id % 13 <> 0 AS cached FROM documents",
    "sparse_filter": "SELECT doc_id, length(text)::INT AS chars FROM documents WHERE length(text) < 300",
    "sparse_metadata": _sparse_sql(),
    "sentence_runs": _run_sql(_SENTENCES),
    "line_runs": _run_sql("string_split(text, chr(10))"),
    "phrase_runs": f"WITH RECURSIVE {_PHRASE_CTE} SELECT d.doc_id, coalesce(x.run, 0)::INT AS run, coalesce(x.phrase, '') AS phrase FROM documents d LEFT JOIN pb USING (doc_id)",
    "hallucination_scan": f"WITH RECURSIVE sr AS ({_run_sql(_SENTENCES)}), {_PHRASE_CTE}, a AS (SELECT sr.doc_id, sr.run AS s, sr.text AS st, coalesce(x.run, 0) AS p, coalesce(x.phrase, '') AS pt FROM sr LEFT JOIN pb USING (doc_id)) SELECT doc_id, greatest(CASE WHEN s >= 3 THEN s * length(st) ELSE 0 END, p * length(pt))::BIGINT AS severity, s::INT AS sent_run, p::INT AS phrase_run, left(CASE WHEN s >= 3 AND s * length(st) >= p * length(pt) THEN st ELSE pt END, 70) AS worst FROM a WHERE greatest(CASE WHEN s >= 3 THEN s * length(st) ELSE 0 END, p * length(pt)) >= 60 ORDER BY severity DESC, doc_id",
    "paragraphs": r"""
WITH RECURSIVE t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS i, trim(text, ' ' || chr(9) || chr(10) || chr(13)) AS s FROM conversations WHERE trim(text, ' ' || chr(9) || chr(10) || chr(13)) <> ''),
m AS (SELECT *, length(s) AS n, len(regexp_extract_all(s, '[.!?]\s')) + 1 AS e FROM t),
f(conv_id, i, pos, n, e) AS (
  SELECT conv_id, i, 0, n, e FROM m WHERE i = 1
  UNION ALL
  SELECT m.conv_id, m.i, CASE WHEN f.n + m.n > 600 OR f.e + m.e > 5 THEN f.pos + 1 ELSE f.pos END, CASE WHEN f.n + m.n > 600 OR f.e + m.e > 5 THEN m.n ELSE f.n + m.n END, CASE WHEN f.n + m.n > 600 OR f.e + m.e > 5 THEN m.e ELSE f.e + m.e END
  FROM f JOIN m ON m.conv_id = f.conv_id AND m.i = f.i + 1)
SELECT conv_id, pos::INT AS pos, string_agg(s, ' ' ORDER BY i) AS paragraph FROM f JOIN m USING (conv_id, i) GROUP BY conv_id, pos""",
    "prompt_truncate": "WITH t AS (SELECT doc_id, CASE WHEN length(text) > 16000 THEN left(text, 16000) || chr(10) || chr(10) || '[...truncated...]' ELSE text END AS b FROM documents) SELECT doc_id, sha256(b) AS sha, length(b)::INT AS chars FROM t",
    "classification_coerce": r"""
WITH w AS (SELECT doc_id, text AS s, list_filter(regexp_split_to_array(trim(text, ' ' || chr(10)), '\s+'), lambda x: x <> '') AS l FROM documents)
SELECT doc_id, length(left(s, 200))::INT AS n_summary, array_to_string(list_transform(l[1:7], lambda x: lower(x) || '-x'), ',') AS tags, len(l[1:5])::INT AS n_concepts, array_to_string(l[1:2], ',') AS aliases FROM w""",
    "glob_matches": r"SELECT doc_id, regexp_matches(p, '(?s)src[1-3] / [^f].') AS in_set, regexp_matches(p, '(?s)/ [ef][nr] / .*7') AS ends, regexp_matches(p, '(?s)src1.') AS one_more, regexp_matches(p, '[\^a] /') AS caret, contains(p, '[x') AS no_set FROM (SELECT doc_id, source || ' / ' || lang || ' / ' || doc_id AS p FROM documents)",
    "unclassified": "SELECT doc_id, doc_id % 3 = 0 OR doc_id % 5 = 0 OR doc_id % 7 = 0 AS empty FROM documents",
    "kernel_cascade": r"WITH b AS (SELECT doc_id AS lesson_id, len(list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '')) = 0 AS none FROM documents) SELECT lesson_id, CASE WHEN NOT none AND lesson_id % 2 <> 0 THEN 'first' WHEN NOT none AND lesson_id % 3 <> 0 THEN 'second' WHEN NOT none AND lesson_id % 5 <> 0 THEN 'third' END AS engine, none OR lesson_id % 30 = 0 AS empty FROM b",
    "kernel_classify_stub": r"SELECT doc_id AS lesson_id, left(array_to_string(list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '')[1:12], ' '), 200) AS summary, ['tag-' || h[1], 'tag-' || h[2]] AS tags, ['Concept ' || upper(h[3])] AS concepts, []::VARCHAR[] AS aliases, 'stub' AS engine FROM (SELECT *, sha256(text) AS h FROM documents)",
    "parse_llm_json": "SELECT event_id, (props::JSON ->> 'k')::INT AS k FROM events",
    "route_backends": "SELECT CASE WHEN doc_id % 9 = 0 THEN 'cached' WHEN length(text) < 300 THEN 'sparse' WHEN contains(p, 'src1') OR contains(p, '/ fr /') THEN 'local' ELSE 'sdk' END AS route, count(*)::BIGINT AS n FROM (SELECT *, source || ' / ' || lang || ' / ' || doc_id AS p FROM documents) GROUP BY 1",
}
