"""Queries over media and processing runs; events, part and orders stand in for segments, videos and attempts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import runs
from ..functions import text as X
from ..operators import kernels, media, state
from ..session import table
from ..sources import notes as N
from ..sources import sinks
from . import vault
from .vault import NL, folders_sql


def _segments(spark: SparkSession, sf: str) -> DataFrame:
    """Events in a row are a video, of four to ten segments; metrics come from their numbers."""
    i = F.col("event_id")
    rows = table(spark, sf, "events").select((F.floor(i / 28) * 4 + F.when(i % 28 < 4, 0).when(i % 28 < 10, 1).when(i % 28 < 17, 2).otherwise(3)).cast("long").alias("video"), "event_id", F.when(F.col("event_id") % 17 == 0, F.lit(None)).otherwise((F.col("event_id") * 7 % 40) / 10.0).alias("diff"), (F.col("event_id") * 13 % 100).cast("double").alias("edge"), (F.col("event_id") % 4 * 0.5).cast("double").alias("scenes"))
    return rows.withColumn("type", media.segment_class(F.col("diff"), F.col("edge"), F.col("scenes")))


_SEGMENTS = """
WITH s0 AS (SELECT (event_id // 28 * 4 + CASE WHEN event_id % 28 < 4 THEN 0 WHEN event_id % 28 < 10 THEN 1 WHEN event_id % 28 < 17 THEN 2 ELSE 3 END)::BIGINT AS video, event_id, CASE WHEN event_id % 17 = 0 THEN NULL ELSE (event_id * 7 % 40) / 10.0::DOUBLE END AS diff, (event_id * 13 % 100)::DOUBLE AS edge, (event_id % 4 * 0.5)::DOUBLE AS scenes FROM events),
s AS (SELECT *, CASE WHEN diff IS NULL THEN 'mixed' WHEN edge >= 75 AND diff < 1.5 THEN 'slideshow' WHEN edge >= 22 AND diff < 1.5 AND scenes < 1.0 THEN 'handson' WHEN diff >= 1.5 AND edge < 70 THEN 'talking' ELSE 'mixed' END AS type FROM s0)"""
_VOTES = _SEGMENTS + """,
v0 AS (SELECT video, count(*)::BIGINT AS n, count(*) FILTER (WHERE type = 'talking')::BIGINT AS talking, count(*) FILTER (WHERE type = 'slideshow')::BIGINT AS slideshow, count(*) FILTER (WHERE type = 'handson')::BIGINT AS handson, count(*) FILTER (WHERE type = 'mixed')::BIGINT AS mixed FROM s GROUP BY 1),
v1 AS (SELECT *, greatest(talking, slideshow, handson, mixed) AS top FROM v0),
v AS (SELECT *, round(top / n, 4) AS confidence, CASE WHEN n >= 5 AND top < 3 THEN 'mixed' WHEN talking = top THEN 'talking' WHEN slideshow = top THEN 'slideshow' WHEN handson = top THEN 'handson' ELSE 'mixed' END AS dominant_type, CASE WHEN top / n >= 0.8 THEN 'pure' ELSE 'mixed' END AS profile FROM v1)"""


def segment_classify(spark: SparkSession, sf: str) -> DataFrame:
    return _segments(spark, sf).select("event_id", "type")


def video_vote(spark: SparkSession, sf: str) -> DataFrame:
    return media.vote(_segments(spark, sf), "video")


def video_summary(spark: SparkSession, sf: str) -> DataFrame:
    return media.video_summary(video_vote(spark, sf).withColumn("error", F.when(F.col("video") % 10 == 0, F.lit("probe"))))


def _videos(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("p_partkey")
    kind = F.element_at(F.array(*map(F.lit, ["talking", "slideshow", "handson", "mixed", "unknown"])), (k % 5 + 1).cast("int"))
    rows = table(spark, sf, "part").select(k.alias("rel"), kind.alias("dominant_type"), (k % 4 * 360).cast("int").alias("height"), F.col("p_size").cast("double").alias("duration"), F.sha2(F.col("p_name"), 256).alias("source_sha256_head"), (k * 1000).alias("source_size"), F.col("p_retailprice").alias("source_mtime"))
    return rows.withColumn("classification_type", F.col("dominant_type"))


def encode_policy(spark: SparkSession, sf: str) -> DataFrame:
    rows = media.with_policy(_videos(spark, sf), "dominant_type", "height")
    return rows.select("rel", "dominant_type", "target_height", "crf", "effective_height", media.encode_timeout(F.col("duration") * 10 - 100).alias("timeout"))


def encode_todo(spark: SparkSession, sf: str) -> DataFrame:
    videos = media.with_policy(_videos(spark, sf), "dominant_type", "height").select("rel", *media.SIDECAR_KEYS)
    k = F.col("rel")
    sidecars = videos.filter(k % 3 != 0).withColumns({"crf": F.when(k % 7 == 0, F.lit(1)).otherwise(F.col("crf")), "source_size": F.when(k % 11 == 0, F.lit(1)).otherwise(F.col("source_size")), "preset": F.lit("slow")})
    return media.to_encode(videos, sidecars, videos.filter(k % 13 != 0).select("rel")).select("rel", "classification_type")


def encode_report(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("rel")
    status = F.when(k % 9 == 0, F.lit("skipped")).when(k % 10 == 0, F.lit("error")).otherwise(F.lit("encoded"))
    rows = _videos(spark, sf).select("dominant_type", status.alias("status"), "source_size", (k * 1000 * (k % 7 + 1) / 10).cast("long").alias("output_size"))
    return media.encode_report(rows)


def attempt_events(spark: SparkSession, sf: str) -> DataFrame:
    status = F.element_at(F.array(*map(F.lit, ["in_progress", "failed", "pending", "completed"])), (F.col("event_id") * 7 % 11 % 4 + 1).cast("int"))
    rows = table(spark, sf, "events").select(F.col("user_id").alias("key"), "ts", "event_id", status.alias("status"))
    i = F.col("event_id").cast("string")
    return rows.withColumns({"error": F.when(F.col("status").isin("failed", "pending") | (F.col("event_id") % 31 == 0), F.concat(F.lit("e"), i)), "output": F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("o"), i))})


_ATTEMPTS = "WITH a0 AS (SELECT user_id AS key, ts, event_id, ['in_progress', 'failed', 'pending', 'completed'][event_id * 7 % 11 % 4 + 1] AS status FROM events), a AS (SELECT *, CASE WHEN status IN ('failed', 'pending') OR event_id % 31 = 0 THEN 'e' || event_id END AS error, CASE WHEN event_id % 3 = 0 THEN 'o' || event_id END AS output FROM a0)"
STATE_SQL = _ATTEMPTS + ", st AS (SELECT key, arg_max(status, (ts, event_id)) AS status, count(*) FILTER (WHERE status <> 'pending')::BIGINT AS attempts, max(ts) FILTER (WHERE status <> 'pending') AS last_attempt_at, (list(CASE WHEN status <> 'pending' THEN error END ORDER BY ts DESC, event_id DESC) FILTER (WHERE error IS NOT NULL AND status <> 'pending' OR status IN ('completed', 'pending')))[1] AS last_error, arg_max(output, (ts, event_id)) FILTER (WHERE output IS NOT NULL) AS output_file FROM a GROUP BY key)"


def attempt_table(spark: SparkSession, sf: str) -> DataFrame:
    return state.attempt_state(attempt_events(spark, sf))


def attempt_state(spark: SparkSession, sf: str) -> DataFrame:
    return attempt_table(spark, sf).withColumn("last_attempt_at", X.timestamp_seconds(F.col("last_attempt_at")))


def _split(spark: SparkSession, sf: str, **how: bool) -> DataFrame:
    """Videos are the users of the events; outputs and marks of failure come from their numbers."""
    videos = table(spark, sf, "events").select(F.col("user_id").alias("key")).distinct()
    return state.pending_split(videos, attempt_table(spark, sf), videos.filter("key % 6 = 0"), videos.filter("key % 5 = 0"), "key", **how)


def pending_split(spark: SparkSession, sf: str) -> DataFrame:
    return _split(spark, sf)


def pending_counts(spark: SparkSession, sf: str) -> DataFrame:
    """How many are skipped, failed and pending, in a plain run, with a retry of the failed and by force."""
    runs = {"plain": {}, "retry": {"retry_failed": True}, "force": {"force": True}}
    each = [_split(spark, sf, **how).groupBy("split").agg(F.count("*").alias("n")).select(F.lit(name).alias("run"), "split", "n") for name, how in runs.items()]
    return each[0].unionByName(each[1]).unionByName(each[2])


def still_pending(spark: SparkSession, sf: str) -> DataFrame:
    """Pending ones whose output has not come up since."""
    pending = pending_split(spark, sf).filter("split = 'pending'")
    return state.still_pending(pending, table(spark, sf, "events").filter("user_id % 7 = 0").select(F.col("user_id").alias("key")), "key").select("key")


def next_steps(spark: SparkSession, sf: str) -> DataFrame:
    i = F.col("event_id")
    outcome = F.element_at(F.array(F.lit("ok"), F.lit("permanent"), F.lit("transient")), (i % 3 + 1).cast("int"))
    return table(spark, sf, "events").select(outcome.alias("outcome"), state.next_step(outcome, i % 2 == 0).alias("step")).groupBy("outcome", "step").agg(F.count("*").alias("n"))


def state_versions(spark: SparkSession, sf: str) -> DataFrame:
    """Entries of a state of an unknown version count as none."""
    return state.version_or_blank(table(spark, sf, "events").select("event_id", (F.col("event_id") % 3).cast("int").alias("version")))


def run_report(spark: SparkSession, sf: str) -> DataFrame:
    status = F.element_at(F.array(*map(F.lit, ["completed", "skipped", "failed_perm", "failed_trans", "completed"])), (F.col("event_id") % 5 + 1).cast("int"))
    return state.run_report(table(spark, sf, "events").select(status.alias("status"), (F.col("event_id") % 600).cast("double").alias("audio_sec"), (F.col("event_id") % 37 + 1).cast("double").alias("wall_sec")))


def http_failures(spark: SparkSession, sf: str) -> DataFrame:
    code = (F.col("event_id") % 4 * 100 + 300).cast("int")
    return table(spark, sf, "events").groupBy(code.alias("code"), X.http_failure(code).alias("kind")).agg(F.count("*").alias("n"))


def server_parts(spark: SparkSession, sf: str) -> DataFrame:
    """Hosts and ports of servers: named, not named, and no number."""
    i = F.col("page_id")
    port = F.when(i % 4 == 0, F.lit(":8080")).when(i % 4 == 1, F.lit(":x")).otherwise(F.lit(""))
    url = F.regexp_replace("url", "^([a-z]+://[^/]+).*$", "$1")
    url = F.concat(url, port, F.when(i % 3 == 0, F.lit("/v1/")).otherwise(F.lit("")))
    return table(spark, sf, "pages").select("page_id", X.server_host(url).alias("host"), X.server_port(url).alias("port"))


def growth_guardrail(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").withColumn("y", F.year("o_orderdate"))
    per = lambda y: orders.filter(F.col("y") <= y).agg(F.count("*").alias("md_count"), F.coalesce(F.sum(F.floor("o_totalprice").cast("long")), F.lit(0)).alias("size_kb")).select(F.explode(F.array(F.struct(F.lit("md_count").alias("metric"), F.col("md_count").alias("value")), F.struct(F.lit("size_kb").alias("metric"), F.col("size_kb").alias("value")))).alias("x")).select("x.*")
    return state.growth(per(1995), per(1996))


def word_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Words and whole seconds of a transcript: words by white space, the last segment's end."""
    rows = table(spark, sf, "conversations").groupBy("conv_id").agg(F.sum(F.size(X.words(F.col("text")))).alias("word_count"), F.max_by(F.length("text"), F.struct("turn", "role")).alias("last"))
    return rows.select("conv_id", "word_count", (F.col("last") * 0.37).cast("int").alias("duration_sec"))


def videos_listed(spark: SparkSession, sf: str) -> DataFrame:
    """Both names of a video in one listing, of each by path as text."""
    return N.named_videos(vault.files(spark, sf), ("video.mp4", "video.hevc.mp4")).select("pass", "path")


def _classified(spark: SparkSession, sf: str) -> DataFrame:
    """One report for each brand, as JSON; every tenth video failed, some have no path."""
    k = F.col("rel")
    one = F.struct(F.when(k % 8 > 0, F.concat(F.lit("v/"), k.cast("string"))).alias("path"), F.col("duration").alias("duration_s"), "dominant_type", F.when(k % 10 == 0, F.lit("probe")).alias("error"))
    rows = _videos(spark, sf).join(table(spark, sf, "part").select(F.col("p_partkey").alias("rel"), "p_brand"), "rel")
    reports = rows.groupBy("p_brand").agg(F.to_json(F.struct(F.collect_list(one).alias("videos"))).alias("text"))
    return N.classified(reports.unionByName(table(spark, sf, "nation").select(F.col("n_name").alias("p_brand"), F.lit("{no json").alias("text"))))


def classification_report(spark: SparkSession, sf: str) -> DataFrame:
    return _classified(spark, sf).select("path", "duration_s", "dominant_type")


def _typed(spark: SparkSession, sf: str) -> DataFrame:
    videos = table(spark, sf, "part").select(F.concat(F.lit("v/"), F.col("p_partkey").cast("string")).alias("rel"), (F.col("p_partkey") * 1000).alias("size"))
    return media.with_classification(videos, _classified(spark, sf))


def classified_videos(spark: SparkSession, sf: str) -> DataFrame:
    """Videos with the class at their path, of two classes alone."""
    return media.of_types(_typed(spark, sf), ["talking", "mixed"]).select("rel", "dominant_type")


def vault_header(spark: SparkSession, sf: str) -> DataFrame:
    return media.vault_header(_typed(spark, sf))


def failure_titles(spark: SparkSession, sf: str) -> DataFrame:
    """Titles of the list lines of documents whose lines are made list items by turns."""
    lines = table(spark, sf, "documents").select(F.posexplode(F.split("text", "\n")).alias("i", "x")).select(F.concat(F.when(F.col("i") % 2 == 0, F.lit("- ")).otherwise(F.lit("")), "x").alias("value"))
    return N.listed_titles(lines).select(F.sha2("title", 256).alias("title_sha"))


def _spoken(spark: SparkSession, sf: str) -> DataFrame:
    """A recogniser's answer for each conversation: turns are segments of two seconds."""
    seg = F.transform(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))), lambda t, i: F.struct(t["text"].alias("text"), (i * 2.0).alias("start"), (i * 2.0 + 1.5).alias("end")))
    rows = table(spark, sf, "conversations").groupBy("conv_id").agg(seg.alias("s"))
    whole = F.concat(F.lit(" "), F.array_join(F.transform("s", lambda x: x["text"]), " "), F.lit(" "))
    answer = F.to_json(F.struct(whole.alias("text"), F.col("s").alias("segments"), F.when(F.col("conv_id") % 2 == 0, F.lit("en")).alias("language"), F.when(F.col("conv_id") % 3 == 0, F.lit(99.9)).when(F.col("conv_id") % 3 == 1, F.lit(0.0)).alias("duration")))
    return rows.select("conv_id", N.recognised(answer).alias("r"))


def recogniser_answers(spark: SparkSession, sf: str) -> DataFrame:
    r = F.col("r")
    return _spoken(spark, sf).select("conv_id", F.size(r["segments"]).alias("n_segments"), r["language"].alias("language"), r["duration_sec"].alias("duration_sec"), F.size(X.words(r["text"])).alias("word_count"), F.sha2(r["text"], 256).alias("text_sha"))


def transcript_notes(spark: SparkSession, sf: str) -> DataFrame:
    """Whole transcripts of a remote recogniser."""
    r, i = F.col("r"), F.col("conv_id")
    url = F.lit("http://asr.example:9000")
    title = F.concat(F.lit('Talk "'), i.cast("string"), F.lit('"'))
    rows = _spoken(spark, sf).withColumn("body", F.array_join(runs.paragraphs(F.transform(r["segments"], lambda s: s["text"])), "\n\n"))
    fields = {"source": F.lit("video.mp4"), "lesson_title": title, "module_title": F.lit(""), "lesson_id": i.cast("string"), "relative_path": F.concat(F.lit("a\\b/"), i.cast("string")), "transcribed_at": X.timestamp_seconds(F.timestamp_seconds(i * 1000)), "model": F.lit("m"), "transcription_backend": F.lit("remote"), "server": F.concat_ws(":", X.server_host(url), X.server_port(url).cast("string")), "server_port": X.server_port(url), "language": r["language"], "duration_sec": r["last_end"], "word_count": F.size(X.words(r["text"])), "upload_sec": F.format_string("%.1f", (i % 7) * 0.5), "inference_sec": F.format_string("%.1f", (i % 5) * 1.0)}
    body = F.coalesce(F.nullif("body", F.lit("")), r["text"])
    return rows.select("conv_id", F.sha2(sinks.transcript_note(fields, title, body), 256).alias("sha"))


def probe_reports(spark: SparkSession, sf: str) -> DataFrame:
    """A prober's JSON for each part: the first video stream counts; sound alone has none; some numbers are none."""
    k = F.col("p_partkey")
    sound = F.struct(F.lit("audio").alias("codec_type"), F.lit("aac").alias("codec_name"), F.lit(0).alias("width"), F.lit(0).alias("height"))
    pic = lambda c: F.struct(F.lit("video").alias("codec_type"), F.lit(c).alias("codec_name"), (F.col("p_size") * 10).alias("width"), F.col("p_size").alias("height"))
    streams = F.when(k % 5 == 0, F.array(sound)).otherwise(F.array(sound, pic("h264"), pic("hevc")))
    form = F.struct(F.when(k % 7 == 0, F.lit("N/A")).otherwise(F.concat(F.col("p_size").cast("string"), F.lit(".5"))).alias("duration"), (k * 1000).cast("string").alias("size"))
    got = N.probe(F.when(k % 11 == 0, F.lit("oops")).otherwise(F.to_json(F.struct(streams.alias("streams"), form.alias("format")))))
    return table(spark, sf, "part").select("p_partkey", got.alias("x")).select("p_partkey", "x.*")


def segment_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Means of two metrics, one of which has lines that are no number, and scenes a minute, from printed lines."""
    i = F.col("event_id")
    mark = "lavfi.signalstats."
    text = F.concat(F.lit(f"frame:0\r\n  {mark}YDIF="), F.format_string("%d", i % 9), F.lit(f"\r\n{mark}YDIF="), F.format_string("%d", i % 4), F.lit(f"\n{mark}YDIF=n/a\n{mark}YAVG="), F.when(i % 5 == 0, F.lit("-")).otherwise((i % 200 / 8).cast("string")), F.lit(f"\nx{mark}YDIF=7\n"))
    scenes = F.repeat(F.lit(" pts_time:1.5\nother pts_time:2\n"), (i % 6).cast("int"))
    return table(spark, sf, "events").select("event_id", media.frame_mean(text, "YDIF").alias("diff_mean"), media.frame_mean(text, "YAVG").alias("edge_density"), media.scenes_per_minute(scenes).alias("scenes_per_min"), media.segment_end(F.col("value")).alias("end_s"))


def community_slugs(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select("page_id", X.community_slug(F.col("url"), "example.com").alias("slug"))


def rename_plan(spark: SparkSession, sf: str) -> DataFrame:
    """Legacy transcripts and their marks of failure, which a title renames unless its name is taken."""
    i = F.col("doc_id")
    dirs = vault.folders(spark, sf).select("doc_id", "dir", F.concat(F.lit("Title: "), F.col("lang")).alias("title"))
    more = dirs.filter("doc_id % 3 = 0").select("doc_id", F.explode(F.array_compact(F.array(F.concat("dir", F.lit("/transcript.remote.md.FAILED")), F.when(i % 2 == 0, F.concat("dir", F.lit("/Title- "), F.regexp_replace("title", "^Title: ", ""), F.lit(".remote.md")))))).alias("path"), F.lit("").alias("text"))
    return N.rename_plan(vault.files(spark, sf).unionByName(more), dirs)


def sibling_videos(spark: SparkSession, sf: str) -> DataFrame:
    """Videos beside the transcripts whose own text repeats itself."""
    files = vault.files(spark, sf)
    rows = files.filter(F.col("path").endswith("/transcript.md") | F.col("path").endswith("/transcript.parakeet.md")).select("path", F.inline(F.array(runs.repeats("text"))))
    flagged = rows.filter(runs.severity(F.col("sent_run"), F.col("sent_text"), F.col("phrase_run"), F.col("phrase_text")) >= 0)
    return N.sibling_videos(flagged, files)


def thread_budgets(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("p_partkey")
    got = media.thread_budget(F.col("p_size"), (k % 4 + 1).cast("int"), F.when(k % 6 == 0, (k % 5).cast("int")))
    return table(spark, sf, "part").select("p_partkey", got.alias("x")).select("p_partkey", "x.*")


def segment_starts(spark: SparkSession, sf: str) -> DataFrame:
    """Durations under and over a minute, without jitter and with one that would pass both ends."""
    d = F.col("p_size") * 2.5
    jitter = F.array(F.lit(-0.2), F.lit(0.05), F.lit(-0.05), F.lit(0.0), F.lit(0.2))
    rows = table(spark, sf, "part").select("p_partkey", media.segment_starts(d).alias("a"), media.segment_starts(d, jitter).alias("b"))
    return rows.select("p_partkey", F.posexplode(F.arrays_zip("a", "b")).alias("i", "x")).select("p_partkey", "i", F.col("x.a").alias("start_s"), F.col("x.b").alias("jittered"))


def head_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    """Digest of the first mebibyte: every hundredth document is repeated beyond it."""
    content = F.when(F.col("doc_id") % 100 == 0, F.repeat(F.rpad("text", 4096, "."), 300)).otherwise(F.col("text")).cast("binary")
    got = N.head_fingerprint(content, F.length(content), F.timestamp_seconds("doc_id"))
    return table(spark, sf, "documents").select("doc_id", got.alias("x")).select("doc_id", "x.*")


def backoff(spark: SparkSession, sf: str) -> DataFrame:
    """Waits of three posts and of five calls of a model, for each event's kind."""
    waits = [("post", X.retry_waits("post", 3)), ("model", X.retry_waits("model", 5))]
    plan = F.array(*(F.struct(F.lit(k).alias("kind"), F.array(*map(F.lit, w)).alias("waits")) for k, w in waits))
    rows = table(spark, sf, "events").select("event_type").distinct().select("event_type", F.inline(plan))
    return rows.select("event_type", "kind", F.posexplode("waits").alias("attempt", "seconds"))


def server_list(spark: SparkSession, sf: str) -> DataFrame:
    """A list of servers with blanks, slashes and repeats, for each nation."""
    n = F.col("n_name")
    urls = F.array(F.concat(F.lit(" http://"), n, F.lit("/ ")), F.lit(""), F.concat(F.lit("http://"), n), F.lit("http://b//"), F.lit(" "), F.lit("http://b"))
    return table(spark, sf, "nation").select("n_nationkey", F.array_join(X.normalized_servers(urls), ",").alias("servers"))


def healthy_servers(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "pages").select("url", F.when(F.col("page_id") % 3 == 0, 200).when(F.col("page_id") % 3 == 1, 503).alias("status"))
    return state.healthy(rows).groupBy("url").agg(F.count("*").alias("n"))


def listing_size(spark: SparkSession, sf: str) -> DataFrame:
    """Kilobytes and Markdown files of a vault, but for what stands in a .git folder."""
    size = F.octet_length("text").cast("long")
    each = F.array(*(F.struct(F.concat(F.lit(a), "dir", F.lit(b)).alias("path"), n.alias("size")) for a, b, n in (("", "/transcript.md", size), ("", "/video.mp4", F.col("doc_id")), (".git/", "/x.md", size), ("", "/.git/y.md", size))))
    return state.listing_size(vault.folders(spark, sf).select(F.inline(each)))


def transcribe_stub(spark: SparkSession, sf: str) -> DataFrame:
    """The kernel of speech recognition by its stand-in, and what is read from its answer."""
    rows = table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("key"), "text")
    got = kernels.apply(rows, kernels.stub_transcribe, kernels.TRANSCRIBED).select("key", N.recognised(F.col("answer")).alias("r"))
    return got.select("key", F.size("r.segments").alias("n_segments"), F.col("r.language").alias("language"), F.length("r.text").alias("chars"))


def measured_segments(spark: SparkSession, sf: str) -> DataFrame:
    """The kernel of video metrics by its stand-in: each segment's metrics and class."""
    videos = table(spark, sf, "part").select(F.col("p_partkey").alias("key"), (F.col("p_size") * 2.5).alias("duration"))
    return kernels.segments(videos, kernels.stub_measure)


def attention(spark: SparkSession, sf: str) -> DataFrame:
    """Audio of over twenty minutes is read in chunks."""
    got = media.attention(F.when(F.col("p_partkey") % 9 > 0, F.col("p_size") * 40.0))
    return table(spark, sf, "part").select("p_partkey", got.alias("x")).select("p_partkey", "x.*")


def timestamps(spark: SparkSession, sf: str) -> DataFrame:
    t = F.when(F.col("event_id") % 3 == 0, F.date_trunc("second", "ts")).otherwise(F.col("ts"))
    return table(spark, sf, "events").select("event_id", X.timestamp_seconds(t).alias("seconds"), X.timestamp_micros(t).alias("micros"))


def encode_times(spark: SparkSession, sf: str) -> DataFrame:
    """Elapsed time as text and the share of the source that is left."""
    k = F.col("p_partkey")
    return table(spark, sf, "part").select("p_partkey", media.elapsed(F.col("p_retailprice")).alias("elapsed"), media.compression_ratio(k % 9, F.col("p_size")).alias("ratio"))


QUERIES = {f.__name__: f for f in (segment_classify, video_vote, video_summary, encode_policy, encode_todo, encode_report, attempt_state, pending_split, run_report, http_failures, server_parts, growth_guardrail, word_counts, pending_counts, still_pending, next_steps, state_versions, videos_listed, classification_report, classified_videos, vault_header, failure_titles, recogniser_answers, transcript_notes, probe_reports, segment_metrics, community_slugs, rename_plan, sibling_videos, thread_budgets, segment_starts, head_fingerprints, backoff, server_list, healthy_servers, listing_size, transcribe_stub, measured_segments, attention, timestamps, encode_times)}

_KIND = "['talking', 'slideshow', 'handson', 'mixed', 'unknown'][p_partkey % 5 + 1]"
_POLICY = "CASE dominant_type WHEN 'talking' THEN 720 ELSE 1080 END AS target_height, CASE dominant_type WHEN 'talking' THEN 28 WHEN 'slideshow' THEN 26 WHEN 'handson' THEN 26 ELSE 27 END AS crf"

_SPLIT = "CASE WHEN k.key % 5 = 0 THEN 'skipped' WHEN k.key % 6 = 0 OR coalesce(st.status = 'failed', false) THEN 'failed' ELSE 'pending' END"

_V = folders_sql()
_TYPED = f"WITH t AS (SELECT 'v/' || p_partkey AS rel, p_partkey, CASE WHEN p_partkey % 8 > 0 AND p_partkey % 10 > 0 AND {_KIND} <> 'unknown' THEN {_KIND} ELSE '_default' END AS dominant_type FROM part)"
_SPOKEN = r"WITH RECURSIVE sp AS (SELECT conv_id, count(*) AS n, trim(string_agg(text, ' ' ORDER BY turn, role, text), ' ' || chr(9) || chr(10) || chr(13)) AS t, sum(len(list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '')))::BIGINT AS w FROM conversations GROUP BY 1)"
_PARAGRAPHS = r""",
pt AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS i, trim(text, ' ' || chr(9) || chr(10) || chr(13)) AS s FROM conversations WHERE trim(text, ' ' || chr(9) || chr(10) || chr(13)) <> ''),
pm AS (SELECT *, length(s) AS n, len(regexp_extract_all(s, '[.!?]\s')) + 1 AS e FROM pt),
pf(conv_id, i, pos, n, e) AS (
  SELECT conv_id, i, 0, n, e FROM pm WHERE i = 1
  UNION ALL
  SELECT pm.conv_id, pm.i, CASE WHEN pf.n + pm.n > 600 OR pf.e + pm.e > 5 THEN pf.pos + 1 ELSE pf.pos END, CASE WHEN pf.n + pm.n > 600 OR pf.e + pm.e > 5 THEN pm.n ELSE pf.n + pm.n END, CASE WHEN pf.n + pm.n > 600 OR pf.e + pm.e > 5 THEN pm.e ELSE pf.e + pm.e END
  FROM pf JOIN pm ON pm.conv_id = pf.conv_id AND pm.i = pf.i + 1),
pp AS (SELECT conv_id, pos, string_agg(s, ' ' ORDER BY i) AS p FROM pf JOIN pm USING (conv_id, i) GROUP BY conv_id, pos),
packed AS (SELECT conv_id, string_agg(p, chr(10) || chr(10) ORDER BY pos) AS b FROM pp GROUP BY 1)"""

SQL = {
    "segment_classify": _SEGMENTS + " SELECT event_id, type FROM s",
    "video_vote": _VOTES + " SELECT video, n, talking, slideshow, handson, mixed, dominant_type, confidence, profile, round(talking / n, 4) AS ratio_talking, round(slideshow / n, 4) AS ratio_slideshow, round(handson / n, 4) AS ratio_handson, round(mixed / n, 4) AS ratio_mixed FROM v",
    "video_summary": _VOTES + """, g AS (SELECT *, video % 10 <> 0 AS good FROM v)
SELECT count(*)::BIGINT AS total, count(*) FILTER (WHERE good)::BIGINT AS processed, count(*) FILTER (WHERE NOT good)::BIGINT AS errors, count(*) FILTER (WHERE good AND dominant_type = 'talking')::BIGINT AS n_talking, count(*) FILTER (WHERE good AND dominant_type = 'slideshow')::BIGINT AS n_slideshow, count(*) FILTER (WHERE good AND dominant_type = 'handson')::BIGINT AS n_handson, count(*) FILTER (WHERE good AND dominant_type = 'mixed')::BIGINT AS n_mixed, round(avg(CASE WHEN profile = 'pure' THEN 1.0 ELSE 0.0 END) FILTER (WHERE good), 4) AS pure_ratio FROM g""",
    "encode_policy": f"WITH v AS (SELECT p_partkey AS rel, {_KIND} AS dominant_type, (p_partkey % 4 * 360)::INT AS h, p_size::DOUBLE * 10 - 100 AS d FROM part), p AS (SELECT *, {_POLICY} FROM v) SELECT rel, dominant_type, target_height::INT AS target_height, crf::INT AS crf, (CASE WHEN h > 0 THEN least(target_height, h) ELSE target_height END)::INT AS effective_height, (CASE WHEN d > 0 THEN greatest(300, trunc(d * 4)) ELSE 3600 END)::INT AS timeout FROM p",
    "encode_todo": f"SELECT p_partkey AS rel, {_KIND} AS classification_type FROM part WHERE p_partkey % 3 = 0 OR p_partkey % 7 = 0 OR p_partkey % 11 = 0 OR p_partkey % 13 = 0",
    "encode_report": f"WITH v AS (SELECT {_KIND} AS dominant_type, p_partkey * 1000 AS s, trunc(p_partkey * 1000 * (p_partkey % 7 + 1) / 10)::BIGINT AS o FROM part WHERE p_partkey % 9 <> 0 AND p_partkey % 10 <> 0), w AS (SELECT * FROM v UNION ALL SELECT 'all', s, o FROM v) SELECT dominant_type, count(*)::BIGINT AS n, sum(s)::BIGINT AS source_bytes, sum(o)::BIGINT AS output_bytes, round(100.0::DOUBLE * (sum(s) - sum(o))::DOUBLE / sum(s)::DOUBLE, 2) AS saved_percent FROM w GROUP BY 1",
    "attempt_state": STATE_SQL + " SELECT key, status, attempts, strftime(last_attempt_at, '%Y-%m-%dT%H:%M:%SZ') AS last_attempt_at, last_error, output_file FROM st",
    "pending_split": STATE_SQL + f" SELECT k.key, {_SPLIT} AS split FROM (SELECT DISTINCT user_id AS key FROM events) k LEFT JOIN st USING (key)",
    "pending_counts": STATE_SQL + f", k AS (SELECT k.key, {_SPLIT} AS split FROM (SELECT DISTINCT user_id AS key FROM events) k LEFT JOIN st USING (key)) SELECT 'plain' AS run, split, count(*)::BIGINT AS n FROM k GROUP BY 2 UNION ALL SELECT 'retry', CASE WHEN key % 5 = 0 THEN 'skipped' ELSE 'pending' END, count(*) FROM k GROUP BY 2 UNION ALL SELECT 'force', 'pending', count(*) FROM k",
    "still_pending": STATE_SQL + f", k AS (SELECT k.key, {_SPLIT} AS split FROM (SELECT DISTINCT user_id AS key FROM events) k LEFT JOIN st USING (key)) SELECT key FROM k WHERE split = 'pending' AND key % 7 <> 0",
    "next_steps": "SELECT ['ok', 'permanent', 'transient'][event_id % 3 + 1] AS outcome, CASE event_id % 3 WHEN 0 THEN 'done' WHEN 1 THEN 'give_up' ELSE CASE WHEN event_id % 2 = 0 THEN 'requeue' ELSE 'leave' END END AS step, count(*)::BIGINT AS n FROM events GROUP BY 1, 2",
    "state_versions": "SELECT event_id FROM events WHERE event_id % 3 = 1",
    "run_report": "WITH e AS (SELECT ['completed', 'skipped', 'failed_perm', 'failed_trans', 'completed'][event_id % 5 + 1] AS s, (event_id % 600)::DOUBLE AS a, (event_id % 37 + 1)::DOUBLE AS w FROM events), t AS (SELECT count(*) FILTER (WHERE s = 'completed')::BIGINT AS completed, count(*) FILTER (WHERE s = 'skipped')::BIGINT AS skipped, count(*) FILTER (WHERE s = 'failed_perm')::BIGINT AS failed_perm, count(*) FILTER (WHERE s = 'failed_trans')::BIGINT AS failed_trans, sum(a) FILTER (WHERE s = 'completed') AS audio_sec_total, sum(w) FILTER (WHERE s = 'completed') AS wall_sec_total FROM e) SELECT *, round(audio_sec_total / greatest(wall_sec_total, 0.001), 4) AS rtf, (failed_perm > 0)::INT AS exit_code FROM t",
    "http_failures": "SELECT (event_id % 4 * 100 + 300)::INT AS code, CASE WHEN event_id % 4 * 100 + 300 BETWEEN 400 AND 499 THEN 'permanent' ELSE 'transient' END AS kind, count(*)::BIGINT AS n FROM events GROUP BY 1, 2",
    "server_parts": "SELECT page_id, regexp_extract(url, '^[a-z]+://([^/:]+)', 1) AS host, (CASE page_id % 4 WHEN 0 THEN 8080 WHEN 1 THEN 80 ELSE CASE WHEN starts_with(url, 'https') THEN 443 ELSE 80 END END)::INT AS port FROM pages",
    "growth_guardrail": "WITH b AS (SELECT count(*)::BIGINT AS md_count, sum(floor(o_totalprice))::BIGINT AS size_kb FROM orders WHERE year(o_orderdate) <= 1995), a AS (SELECT count(*)::BIGINT AS md_count, sum(floor(o_totalprice))::BIGINT AS size_kb FROM orders WHERE year(o_orderdate) <= 1996), r AS (SELECT 'md_count' AS metric, b.md_count AS before, a.md_count AS after FROM a, b UNION ALL SELECT 'size_kb', b.size_kb, a.size_kb FROM a, b) SELECT metric, before, after, before > 0 AND (after - before) / before > 0.5 AS violation FROM r",
    "word_counts": r"SELECT conv_id, sum(len(list_filter(regexp_split_to_array(trim(text, ' ' || chr(10)), '\s+'), lambda x: x <> '')))::BIGINT AS word_count, trunc(arg_max(length(text), (turn, role)) * 0.37::DOUBLE)::INT AS duration_sec FROM conversations GROUP BY 1",
    "videos_listed": _V + """ SELECT 1 AS pass, dir || '/video.mp4' AS path FROM v WHERE doc_id % 2 = 1 UNION ALL SELECT 2, dir || '/video.hevc.mp4' FROM v WHERE doc_id % 6 = 0""",
    "classification_report": f"SELECT 'v/' || p_partkey AS path, p_size::DOUBLE AS duration_s, {_KIND} AS dominant_type FROM part WHERE p_partkey % 8 > 0 AND p_partkey % 10 > 0",
    "classified_videos": _TYPED + " SELECT rel, dominant_type FROM t WHERE dominant_type IN ('talking', 'mixed')",
    "vault_header": _TYPED + " SELECT CASE WHEN dominant_type = '_default' THEN 'unknown' ELSE dominant_type END AS dominant_type, count(*)::BIGINT AS n, sum(p_partkey * 1000)::BIGINT AS bytes FROM t GROUP BY 1",
    "failure_titles": "WITH l AS (SELECT unnest(string_split(text, chr(10))) AS x, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents), y AS (SELECT CASE WHEN i % 2 = 1 THEN '- ' || x ELSE x END AS x FROM l) SELECT DISTINCT sha256(trim(x[3:])) AS title_sha FROM y WHERE starts_with(x, '- ')",
    "recogniser_answers": _SPOKEN + " SELECT conv_id, n::INT AS n_segments, CASE WHEN conv_id % 2 = 0 THEN 'en' ELSE 'unknown' END AS language, (CASE WHEN conv_id % 3 = 0 THEN 99 ELSE 2 * n - 1 END)::INT AS duration_sec, w::INT AS word_count, sha256(t) AS text_sha FROM sp",
    "transcript_notes": _SPOKEN + _PARAGRAPHS + f""" SELECT conv_id, sha256('---' || {NL} || array_to_string(['source: video.mp4', 'lesson_title: "Talk \\"' || conv_id || '\\""', 'module_title: ""', 'lesson_id: "' || conv_id || '"', 'relative_path: "a\\\\b/' || conv_id || '"', 'transcribed_at: "' || strftime(make_timestamp(conv_id * 1000000000), '%Y-%m-%dT%H:%M:%SZ') || '"', 'model: "m"', 'transcription_backend: "remote"', 'server: "asr.example:9000"', 'server_port: 9000', 'language: "' || CASE WHEN conv_id % 2 = 0 THEN 'en' ELSE 'unknown' END || '"', 'duration_sec: ' || (2 * n - 1), 'word_count: ' || w, 'upload_sec: ' || printf('%.1f', conv_id % 7 * 0.5::DOUBLE), 'inference_sec: ' || printf('%.1f', (conv_id % 5)::DOUBLE)], {NL}) || {NL} || '---' || {NL} || {NL} || '# Talk "' || conv_id || '"' || {NL} || {NL} || coalesce(b, t) || {NL}) AS sha FROM sp LEFT JOIN packed USING (conv_id)""",
    "probe_reports": "SELECT p_partkey, CASE WHEN p_partkey % 5 > 0 AND p_partkey % 11 > 0 THEN p_size * 10 END AS width, CASE WHEN p_partkey % 5 > 0 AND p_partkey % 11 > 0 THEN p_size END AS height, CASE WHEN p_partkey % 5 > 0 AND p_partkey % 11 > 0 THEN 'h264' END AS codec, CASE WHEN p_partkey % 7 > 0 AND p_partkey % 11 > 0 THEN p_size + 0.5::DOUBLE END AS duration, CASE WHEN p_partkey % 11 > 0 THEN p_partkey * 1000 END AS size FROM part",
    "segment_metrics": "SELECT event_id, round((event_id % 9 + event_id % 4) / 2, 4) AS diff_mean, CASE WHEN event_id % 5 > 0 THEN round(event_id % 200 / 8, 4) END AS edge_density, round(event_id % 6 / (10 / 60), 2) AS scenes_per_min, round(value + 10, 2) AS end_s FROM events",
    "community_slugs": "SELECT page_id, nullif(regexp_extract(url, 'example\\.com/([^/]+)(/|$)', 1), '') AS slug FROM pages",
    "rename_plan": _V + """ SELECT dir, old, new, status FROM (SELECT dir, unnest(['transcript.remote.md', 'transcript.remote.md.FAILED']) AS old, unnest(['Title- ' || lang || '.remote.md', 'Title- ' || lang || '.remote.md.FAILED']) AS new, unnest([t4, doc_id % 3 = 0]) AS there, unnest([CASE WHEN doc_id % 6 = 0 THEN 'exists' ELSE 'rename' END, 'rename']) AS status FROM v) WHERE there""",
    "sibling_videos": _V + " SELECT dir || '/video.mp4' AS video FROM v WHERE t3 AND doc_id % 2 = 1",
    "thread_budgets": "WITH b AS (SELECT p_partkey, greatest(1, CASE WHEN p_partkey % 6 = 0 THEN p_partkey % 5 ELSE (p_size - 1) // (p_partkey % 4 + 1) END)::INT AS pool FROM part) SELECT *, least(6, greatest(1, pool // 2))::INT AS frame_threads FROM b",
    "segment_starts": """
WITH d AS (SELECT p_partkey, p_size * 2.5::DOUBLE AS d, greatest(p_size * 2.5::DOUBLE - 10, 0) AS top, greatest(1, least(5, floor(p_size * 2.5::DOUBLE / 10)::INT)) AS few FROM part),
e AS (SELECT *, unnest(range(0, CASE WHEN d < 60 THEN few ELSE 5 END)) AS i FROM d)
SELECT p_partkey, i::INT AS i, CASE WHEN d < 60 THEN CASE WHEN few = 1 THEN 0 ELSE least(i * top / (few - 1), top) END ELSE round((i + 0.5::DOUBLE) / 5 * top, 2) END AS start_s,
  CASE WHEN d < 60 THEN CASE WHEN few = 1 THEN 0 ELSE least(i * top / (few - 1), top) END ELSE round(greatest(0, least(1, (i + 0.5::DOUBLE) / 5 + [-0.2::DOUBLE, 0.05, -0.05, 0.0, 0.2][i + 1])) * top, 2) END AS jittered FROM e""",
    "head_fingerprints": "WITH c AS (SELECT doc_id, encode(CASE WHEN doc_id % 100 = 0 THEN repeat(rpad(text, 4096, '.'), 300) ELSE text END) AS b FROM documents) SELECT doc_id, sha256(CASE WHEN octet_length(b) > 1048576 THEN b[1:1048576] ELSE b END) AS source_sha256_head, octet_length(b)::INT AS source_size, make_timestamp(doc_id * 1000000) AS source_mtime FROM c",
    "backoff": "SELECT event_type, kind, attempt::INT AS attempt, seconds::DOUBLE AS seconds FROM (SELECT DISTINCT event_type FROM events), (VALUES ('post', 0, 2), ('post', 1, 8), ('model', 0, 1), ('model', 1, 2.3), ('model', 2, 4.6), ('model', 3, 8.9)) t(kind, attempt, seconds)",
    "server_list": "SELECT n_nationkey, 'http://' || n_name || ',http://b' AS servers FROM nation",
    "healthy_servers": "SELECT url, count(*)::BIGINT AS n FROM pages WHERE page_id % 3 = 0 GROUP BY 1",
    "listing_size": "SELECT ceil(sum(strlen(text) + doc_id) / 1024)::BIGINT AS size_kb, count(*)::BIGINT AS md_count FROM documents",
    "transcribe_stub": "SELECT doc_id::VARCHAR AS key, len(string_split(text, chr(10)))::INT AS n_segments, 'en' AS language, length(trim(text, ' ' || chr(9) || chr(10) || chr(13)))::INT AS chars FROM documents",
    "measured_segments": """
WITH d AS (SELECT p_partkey::VARCHAR AS key, p_size * 2.5::DOUBLE AS d, greatest(p_size * 2.5::DOUBLE - 10, 0) AS top, greatest(1, least(5, floor(p_size * 2.5::DOUBLE / 10)::INT)) AS few FROM part),
e AS (SELECT *, unnest(range(0, CASE WHEN d < 60 THEN few ELSE 5 END)) AS i FROM d),
f AS (SELECT key, CASE WHEN d < 60 THEN CASE WHEN few = 1 THEN 0 ELSE least(i * top / (few - 1), top) END ELSE round((i + 0.5::DOUBLE) / 5 * top, 2) END AS start_s FROM e),
g AS (SELECT *, (length(key) + trunc(start_s)::INT) % 40 AS n FROM f),
h AS (SELECT key, start_s, CASE WHEN n <> 7 THEN round(start_s + 10, 2) END AS end_s, CASE WHEN n <> 7 THEN round(n % 3 * 6, 2)::DOUBLE END AS scenes_per_min, CASE WHEN n <> 7 THEN round(n / 10, 4) END AS diff_mean, CASE WHEN n <> 7 THEN (n * 2)::DOUBLE END AS edge_density, CASE WHEN n = 7 THEN 'timeout' END AS error FROM g)
SELECT *, CASE WHEN error IS NULL THEN CASE WHEN edge_density >= 75 AND diff_mean < 1.5 THEN 'slideshow' WHEN edge_density >= 22 AND diff_mean < 1.5 AND scenes_per_min < 1.0 THEN 'handson' WHEN diff_mean >= 1.5 AND edge_density < 70 THEN 'talking' ELSE 'mixed' END END AS type FROM h""",
    "attention": "WITH l AS (SELECT p_partkey, p_partkey % 9 > 0 AND p_size * 40 > 1200 AS local FROM part) SELECT *, CASE WHEN local THEN 120.0::DOUBLE END AS chunk_duration, CASE WHEN local THEN 15.0::DOUBLE END AS overlap_duration FROM l",
    "timestamps": "WITH e AS (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN date_trunc('second', ts) ELSE ts END AS t FROM events) SELECT event_id, strftime(t, '%Y-%m-%dT%H:%M:%SZ') AS seconds, strftime(t, '%Y-%m-%dT%H:%M:%S') || CASE WHEN strftime(t, '%f') <> '000000' THEN '.' || strftime(t, '%f') ELSE '' END || '+00:00' AS micros FROM e",
    "encode_times": "SELECT p_partkey, (trunc(p_retailprice)::INT // 60) || 'm' || (trunc(p_retailprice)::INT % 60) || 's' AS elapsed, CASE WHEN p_partkey % 9 <> 0 THEN round(p_size / (p_partkey % 9), 4) END AS ratio FROM part",
}
