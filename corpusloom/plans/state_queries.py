"""Queries of streams, snapshots, rounds, and of order in groups of any size; and the SQL that they equal."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators import ordered, packing, rounds, state
from ..session import Scratch, scratch_folder, table
from ..streaming import attempts, snapshot
from . import media_queries as M

#: Bytes of a part of a page of lines.
PART_BYTES = 1 << 16


def _arrivals(df: DataFrame, folder: str, by: str, parts: int) -> Iterator[None]:
    """df in so many parts, one after the other, as they would come up; each is written by all tasks that make it."""
    for i in range(parts):
        yield df.filter(F.pmod(by, F.lit(parts)) == i).write.mode("append").parquet(folder)


def attempt_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The state of each key from a stream of three batches, with the server that was used last."""
    i = F.col("event_id")
    events = M.attempt_events(spark, sf).withColumn("server", F.when(i % 4 == 0, F.concat(F.lit("s"), (i % 3).cast("string"))))
    folder = scratch_folder(spark, "events")
    for _ in _arrivals(events, f"{folder}/in", "event_id", 3):  # a run takes what is there as one batch
        attempts.run_attempts(spark.readStream.schema(events.schema).parquet(f"{folder}/in"), f"{folder}/out", f"{folder}/checkpoint")
    return attempts.last_state(spark, f"{folder}/out").select("key", "status", "attempts", F.date_format("last_attempt_at", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("last_attempt_at"), "last_error", "output_file", "server_used")


def start_events(spark: SparkSession, sf: str) -> DataFrame:
    """What a run with a retry of the failed tells the state at its start."""
    videos = table(spark, sf, "events").select(F.col("user_id").alias("key")).distinct()
    return state.start_events(videos, M.attempt_table(spark, sf), videos.filter("key % 5 = 0"), "key", F.concat(F.lit("o"), F.col("key").cast("string")), retry_failed=True)


def _shown(word: str):
    return F.concat(F.lit(word), F.col("doc_id").cast("string")).alias("shown")


def snapshot_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Documents against a snapshot that lacks some, has others with another hash, and has some that are gone."""
    docs = table(spark, sf, "documents").select("doc_id", F.sha2("text", 256).alias("body_sha"))
    sha = F.when(F.col("doc_id") % 4 == 0, F.lit("other")).otherwise(F.col("body_sha")).alias("body_sha")
    before = docs.filter("doc_id % 10 <> 3").select("doc_id", sha, _shown("old ")).unionByName(docs.filter("doc_id % 10 = 1").select(F.expr("-1 - doc_id").alias("doc_id"), "body_sha", _shown("gone ")))
    return snapshot.snapshot_merge(docs, before, lambda rows: rows.select("doc_id", "body_sha", _shown("new ")), "doc_id")


def snapshot_changes(spark: SparkSession, sf: str) -> DataFrame:
    """How many rows are new, changed, the same and gone between the orders of two years."""
    orders = table(spark, sf, "orders").select(F.col("o_custkey").alias("key"), F.year("o_orderdate").alias("y"), F.col("o_orderkey").alias("o"))
    of = lambda y: orders.filter(F.col("y") == y).groupBy("key").agg(F.sha2(F.concat((F.min("o") % 3).cast("string"), F.lit("")), 256).alias("body_sha"))
    return snapshot.snapshot_diff(of(1996), of(1995), "key").groupBy("change").agg(F.count("*").alias("n"))


def snapshot_stream(spark: SparkSession, sf: str) -> DataFrame:
    """A stream of documents and then of their changes and ends, in four batches with one compaction."""
    docs, i = table(spark, sf, "documents"), F.col("doc_id")
    rows = lambda seq, sha, gone: docs.select("doc_id", sha.alias("body_sha"), gone.alias("gone"), F.lit(seq).alias("seq"))
    sha = F.sha2("text", 256)
    folder = scratch_folder(spark, "snapshots")
    first = rows(1, sha, F.lit(False))
    second = rows(2, F.when(i % 5 == 0, F.concat(F.lit("new"), sha)).otherwise(sha), i % 7 == 0).filter("doc_id % 3 = 0")
    out = StructType().add("doc_id", "long").add("body_sha", "string").add("seq", "integer")
    for part in (first, second):
        for _ in _arrivals(part, f"{folder}/in", "doc_id", 2):  # a run takes what is there as one batch
            snapshot.run_snapshots(spark, f"{folder}/in", first.schema, lambda new: new.select("doc_id", "body_sha", "seq"), out, f"{folder}/out", f"{folder}/checkpoint", key="doc_id", compact=3)
    return snapshot.now_of(spark, f"{folder}/out", out, "doc_id")


def retry_rounds(spark: SparkSession, sf: str) -> DataFrame:
    """Documents tried in rounds while a server is healthy, which ends with the fourth."""
    kinds = F.array(*map(F.lit, ["ok", "permanent", "transient", "transient", "transient"]))
    attempt = lambda rows, n: rows.withColumn("outcome", F.element_at(kinds, ((F.col("doc_id") * 7 + n * 3) % 5 + 1).cast("int")))
    got = rounds.run_rounds(table(spark, sf, "documents").select("doc_id"), "doc_id", attempt, lambda n: n < 4, 6)
    return rounds.last_attempts(got, "doc_id").select("doc_id", "outcome", "step", "attempts")


def page_parts(spark: SparkSession, sf: str) -> DataFrame:
    """All texts of a source as one page of any length, in parts of known places."""
    lines = table(spark, sf, "documents").select("source", "doc_id", "text")
    parts = ordered.assembled(lines, ["source"], ["doc_id"], "text", Scratch(spark, "parts"), PART_BYTES)
    return parts.select("source", "part", "at", "n_lines", F.sha2("text", 256).alias("sha"))


def event_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    """The event before and after each one of its user, and its place, without a task that holds a user."""
    rows = table(spark, sf, "events").select("user_id", "ts", "event_id")
    scratch = Scratch(spark, "neighbours")
    beside = ordered.neighbours(rows, ["user_id"], ["ts", "event_id"], "event_id", scratch)
    return ordered.numbered(beside, ["user_id"], ["ts", "event_id"], "place", scratch).select("event_id", "prev", "next", "place")


def role_paragraphs(spark: SparkSession, sf: str) -> DataFrame:
    """All that each role says anywhere, as one talk, in paragraphs."""
    rows = table(spark, sf, "conversations").select("role", "conv_id", "turn", "text")
    got = packing.packed_groups(rows, ["role"], ["conv_id", "turn"], "text")
    return got.select("role", "begin", "n_texts", F.sha2("paragraph", 256).alias("sha"))


def exact_quantiles(spark: SparkSession, sf: str) -> DataFrame:
    """Quantiles of all prices, by counts alone."""
    shares = [0.001, 0.25, 0.5, 0.9, 0.99]
    got = ordered.quantiles(table(spark, sf, "lineitem"), F.col("l_extendedprice"), shares)
    return spark.createDataFrame(list(zip(shares, got, strict=True)), "share double, value double").select("share", F.round("value", 4).alias("value"))


QUERIES = {f.__name__: f for f in (attempt_stream, start_events, snapshot_merge, snapshot_changes, snapshot_stream, retry_rounds, page_parts, event_neighbours, role_paragraphs, exact_quantiles)}

SQL = {
    "attempt_stream": M.STATE_SQL + " SELECT st.key, status, attempts, strftime(last_attempt_at, '%Y-%m-%dT%H:%M:%SZ') AS last_attempt_at, last_error, output_file, server_used FROM st LEFT JOIN (SELECT user_id AS key, arg_max('s' || event_id % 3, (ts, event_id)) FILTER (WHERE event_id % 4 = 0) AS server_used FROM events GROUP BY 1) s USING (key)",
    "start_events": M.STATE_SQL + ", k AS (SELECT DISTINCT user_id AS key FROM events), x AS (SELECT key, CASE WHEN key % 5 = 0 THEN CASE WHEN st.status IS DISTINCT FROM 'completed' THEN 'completed' END WHEN st.status = 'failed' THEN 'pending' END AS status, 'o' || key AS output FROM k LEFT JOIN st USING (key)) SELECT * FROM x WHERE status IS NOT NULL",
    "snapshot_merge": "SELECT doc_id, sha256(text) AS body_sha, CASE WHEN doc_id % 10 <> 3 AND doc_id % 4 <> 0 THEN 'old ' ELSE 'new ' END || doc_id AS shown, doc_id % 10 <> 3 AND doc_id % 4 <> 0 AS carried FROM documents",
    "snapshot_changes": "WITH o AS (SELECT o_custkey AS key, year(o_orderdate) AS y, min(o_orderkey) % 3 AS h FROM orders GROUP BY 1, 2), a AS (SELECT * FROM o WHERE y = 1996), b AS (SELECT * FROM o WHERE y = 1995) SELECT CASE WHEN b.key IS NULL THEN 'new' WHEN a.key IS NULL THEN 'gone' WHEN a.h = b.h THEN 'same' ELSE 'changed' END AS change, count(*)::BIGINT AS n FROM a FULL JOIN b ON a.key = b.key GROUP BY 1",
    "snapshot_stream": "SELECT doc_id, CASE WHEN doc_id % 15 = 0 THEN 'new' ELSE '' END || sha256(text) AS body_sha, CASE WHEN doc_id % 15 = 0 THEN 2 ELSE 1 END AS seq FROM documents WHERE NOT (doc_id % 3 = 0 AND doc_id % 7 = 0)",
    "retry_rounds": "WITH t AS (SELECT doc_id, unnest(range(1, 5)) AS n FROM documents), o AS (SELECT *, ['ok', 'permanent', 'transient', 'transient', 'transient'][(doc_id * 7 + n * 3) % 5 + 1] AS outcome FROM t), e AS (SELECT doc_id, coalesce(min(n) FILTER (WHERE outcome <> 'transient'), 4) AS attempts FROM o GROUP BY 1) SELECT doc_id, outcome, CASE outcome WHEN 'ok' THEN 'done' WHEN 'permanent' THEN 'give_up' ELSE 'leave' END AS step, attempts::BIGINT AS attempts FROM e JOIN o ON o.doc_id = e.doc_id AND n = attempts".replace("SELECT doc_id, outcome, CASE", "SELECT e.doc_id, outcome, CASE"),
    "page_parts": f"WITH l AS (SELECT source, doc_id, coalesce(text, '') AS t, sum(strlen(coalesce(text, '')) + 1) OVER (PARTITION BY source ORDER BY doc_id) - strlen(coalesce(text, '')) - 1 AS b FROM documents) SELECT source, (b // {PART_BYTES})::BIGINT AS part, min(b)::BIGINT AS at, count(*)::BIGINT AS n_lines, sha256(string_agg(t, chr(10) ORDER BY doc_id)) AS sha FROM l GROUP BY source, b // {PART_BYTES}",
    "event_neighbours": "SELECT event_id, lag(event_id) OVER w AS prev, lead(event_id) OVER w AS next, row_number() OVER w - 1 AS place FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)",
    "role_paragraphs": r"""WITH RECURSIVE p AS (SELECT role, conv_id, turn, trim(text, ' ' || chr(9) || chr(10) || chr(13)) AS s FROM conversations WHERE trim(text, ' ' || chr(9) || chr(10) || chr(13)) <> ''),
m AS MATERIALIZED (SELECT role, row_number() OVER (PARTITION BY role ORDER BY conv_id, turn) - 1 AS i, s, length(s) AS n, len(regexp_extract_all(s, '[.!?]\s')) + 1 AS e FROM p),
f(role, i, begin, n, e) AS (
  SELECT role, i, i, n, e FROM m WHERE i = 0
  UNION ALL SELECT m.role, m.i, CASE WHEN f.n + m.n > 600 OR f.e + m.e > 5 THEN m.i ELSE f.begin END, CASE WHEN f.n + m.n > 600 OR f.e + m.e > 5 THEN m.n ELSE f.n + m.n END, CASE WHEN f.n + m.n > 600 OR f.e + m.e > 5 THEN m.e ELSE f.e + m.e END
  FROM f JOIN m ON m.role = f.role AND m.i = f.i + 1)
SELECT role, begin, count(*)::BIGINT AS n_texts, sha256(string_agg(s, ' ' ORDER BY i)) AS sha FROM f JOIN m USING (role, i) GROUP BY 1, 2""",
    "exact_quantiles": "WITH s AS (SELECT l_extendedprice::DOUBLE AS v, row_number() OVER (ORDER BY l_extendedprice) AS r, count(*) OVER () AS n FROM lineitem), p AS (SELECT unnest([0.001, 0.25, 0.5, 0.9, 0.99])::DOUBLE AS share), q AS (SELECT share, least(greatest(share * (n + 1), 1.0), n)::DOUBLE AS pl, n FROM p, (SELECT DISTINCT n FROM s)) SELECT share, round(a.v + (b.v - a.v) * (pl - floor(pl)), 4) AS value FROM q JOIN s a ON a.r = floor(pl)::BIGINT JOIN s b ON b.r = least(floor(pl)::BIGINT + 1, q.n)",
}
