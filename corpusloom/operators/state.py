"""Processing attempts: state by key, what is pending, and the run's report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Statuses that no attempt has ended.
OPEN = ("in_progress", "pending")


def attempt_state(events: DataFrame, key: str = "key", order: list[str] | None = None) -> DataFrame:
    """Last state of each key: status, attempts (one for each event but marks of "pending"), last attempt, last error, last output and server.

    events: key, ts, status, error, output, server (may be missing, and is then in no answer) and the columns of a total order. A mark of
    "pending" clears the error; a success clears it unless it brings one; other events
    without an error keep the last. All of it is aggregation, combined on the map side.
    """
    at = F.struct(*(order or ["ts", "event_id"]))
    tried = F.col("status") != "pending"
    error = F.when(tried, F.col("error"))
    sets = error.isNotNull() | F.col("status").isin("completed", "pending")
    return events.groupBy(key).agg(
        F.max_by("status", at).alias("status"),
        F.count_if(tried).alias("attempts"),
        F.max(F.when(tried, F.col("ts"))).alias("last_attempt_at"),
        F.max_by(error, F.when(sets, at)).alias("last_error"),
        *(F.max_by(c, F.when(F.col(c).isNotNull(), at)).alias(n) for c, n in (("output", "output_file"), ("server", "server_used")) if c in events.columns),
    )


def start_events(videos: DataFrame, state: DataFrame, outputs: DataFrame, key: str, output: Column, retry_failed: bool = False, force: bool = False) -> DataFrame:
    """key, status and output of the events that the start of a run makes.

    A video whose output is there and whose state does not say so is completed; with a retry
    a failed one is pending again. A forced run makes none.
    """
    there = outputs.select(key).distinct().withColumn("there", F.lit(True))
    rows = videos.select(key, output.alias("output")).join(there, key, "left").join(state.select(key, F.col("status").alias("last")), key, "left")
    made = F.when(F.col("there").isNotNull(), F.when(~F.col("last").eqNullSafe("completed"), "completed")).when(F.lit(retry_failed) & F.col("last").eqNullSafe("failed"), "pending")
    return rows.select(key, F.when(F.lit(not force), made).alias("status"), "output").filter("status IS NOT NULL")


def pending_split(videos: DataFrame, state: DataFrame, failed: DataFrame, outputs: DataFrame, key: str, retry_failed: bool = False, force: bool = False) -> DataFrame:
    """Each video as skipped (its output is there), failed (marked or so in the state, no retry asked) or pending.

    A state that says completed counts for nothing without an output.
    """
    mark = lambda df, name: df.select(key).distinct().withColumn(name, F.lit(True))
    joined = videos.join(mark(outputs, "has_output"), key, "left").join(mark(failed, "is_failed"), key, "left")
    joined = joined.join(state.select(key, F.col("status").alias("last_status")), key, "left")
    bad = (F.col("is_failed").isNotNull() | F.col("last_status").eqNullSafe("failed")) & F.lit(not retry_failed)
    split = F.when(F.lit(force), "pending").when(F.col("has_output").isNotNull(), "skipped").when(bad, "failed").otherwise("pending")
    return joined.select(*videos.columns, split.alias("split"))


def still_pending(pending: DataFrame, outputs: DataFrame, key: str) -> DataFrame:
    """Of the pending videos those whose output has not come up meanwhile: asked again at run time."""
    return pending.join(outputs.select(key).distinct(), key, "left_anti")


def next_step(outcome: Column, any_healthy: Column) -> Column:
    """After an attempt: done, give_up (a permanent failure), requeue (a passing one while a server is healthy) or leave for the next run."""
    return F.when(outcome == "ok", "done").when(outcome == "permanent", "give_up").when(any_healthy, "requeue").otherwise("leave")


def healthy(servers: DataFrame) -> DataFrame:
    """Servers (url, status) whose health page answers 200."""
    return servers.filter(F.col("status") == 200).select("url")


def version_or_blank(state: DataFrame, version: int = 1) -> DataFrame:
    """State rows of the known version; others count as if there were none."""
    return state.filter(F.col("version") == version).drop("version")


def speed(audio: Column, wall: Column, floor: float = 0.0) -> Column:
    """Seconds of audio for each second of work; 0 where there is no time."""
    if floor:
        return audio / F.greatest(wall, F.lit(floor))
    return F.when(wall > 0, audio / wall).otherwise(F.lit(0.0))


def run_report(results: DataFrame) -> DataFrame:
    """Counts by outcome, totals and the run's speed. results: status, audio_sec, wall_sec."""
    n = lambda s: F.count_if(F.col("status") == s)
    out = results.agg(
        n("completed").alias("completed"), n("skipped").alias("skipped"), n("failed_perm").alias("failed_perm"), n("failed_trans").alias("failed_trans"),
        F.coalesce(F.sum(F.when(F.col("status") == "completed", F.col("audio_sec"))), F.lit(0.0)).alias("audio_sec_total"),
        F.coalesce(F.sum(F.when(F.col("status") == "completed", F.col("wall_sec"))), F.lit(0.0)).alias("wall_sec_total"),
    )
    return out.withColumn("rtf", F.round(speed(F.col("audio_sec_total"), F.col("wall_sec_total"), 0.001), 4)).withColumn("exit_code", (F.col("failed_perm") > 0).cast("int"))


def growth(before: DataFrame, after: DataFrame, limit: float = 0.5) -> DataFrame:
    """metric, before, after, violation: grown by more than the share; a metric that began at 0 cannot be violated."""
    both = before.join(after.withColumnRenamed("value", "after"), "metric").withColumnRenamed("value", "before")
    return both.withColumn("violation", (F.col("before") > 0) & ((F.col("after") - F.col("before")) / F.col("before") > limit))


def listing_size(listing: DataFrame) -> DataFrame:
    """size_kb and md_count of a listing (path, size), but for what stands in a .git folder."""
    own = listing.filter(~F.col("path").rlike(r"(^|/)\.git/"))
    return own.agg(F.coalesce(F.ceil(F.sum("size") / 1024), F.lit(0)).cast("long").alias("size_kb"), F.count_if(F.col("path").endswith(".md")).alias("md_count"))
