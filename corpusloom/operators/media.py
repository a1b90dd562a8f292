"""Media: segment classes, majority vote, encoding policy and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X

# Thresholds of segment classes, and classes in the order that breaks ties.
EDGE_SLIDES, EDGE_SCREEN, EDGE_FACE = 75, 22, 70
DIFF_MOVING, SCENES_FEW = 1.5, 1.0
CLASSES = ("talking", "slideshow", "handson", "mixed")

#: Class, height, quality factor; "_default" is for all others.
POLICY = [("talking", 720, 28), ("slideshow", 1080, 26), ("handson", 1080, 26), ("mixed", 1080, 27), ("_default", 1080, 27)]

SEGMENT_SECONDS, SEGMENTS = 10, 5


def segment_class(diff: Column, edge: Column, scenes: Column) -> Column:
    """The first rule that holds; a missing metric makes "mixed"."""
    return (
        F.when(diff.isNull() | edge.isNull(), F.lit("mixed"))
        .when((edge >= EDGE_SLIDES) & (diff < DIFF_MOVING), F.lit("slideshow"))
        .when((edge >= EDGE_SCREEN) & (diff < DIFF_MOVING) & (scenes < SCENES_FEW), F.lit("handson"))
        .when((diff >= DIFF_MOVING) & (edge < EDGE_FACE), F.lit("talking"))
        .otherwise(F.lit("mixed"))
    )


def segment_starts(duration: Column, jitter: Column | None = None, n: int = SEGMENTS, seconds: int = SEGMENT_SECONDS) -> Column:
    """Start of each segment, never past the last one that fits.

    From a minute on: the middles of n equal parts of what a start may be, each moved
    by its jitter (an array of shares, at most 0.05 either way; none by default).
    Below: even steps, and one segment for each full length that fits, at least one.
    """
    last = F.greatest(duration - seconds, F.lit(0.0))
    moved = lambda i: F.lit(0.0) if jitter is None else F.coalesce(F.get(jitter, i), F.lit(0.0))
    far = lambda i: F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), (i + 0.5) / n + moved(i))) * last, 2)
    few = F.greatest(F.lit(1), F.least(F.lit(n), F.floor(duration / seconds).cast("int")))
    near = F.transform(F.sequence(F.lit(0), few - 1), lambda i: F.when(few == 1, F.lit(0.0)).otherwise(F.least(i * last / (few - 1), last)))
    return F.when(duration < 60, near).otherwise(F.transform(F.sequence(F.lit(0), F.lit(n - 1)), far))


def segment_end(start: Column, seconds: int = SEGMENT_SECONDS) -> Column:
    return F.round(start + seconds, 2)


def vote(segments: DataFrame, key: str, kind: str = "type") -> DataFrame:
    """One row per video: counts, dominant class, confidence, profile, shares.

    Ties go to the first of CLASSES. Of five segments or more a winner with fewer
    than three is "mixed", with the plurality's confidence. Segments without a class
    (errors) do not vote; a video without votes is mixed for certain.
    """
    each = [F.count_if(F.col(kind) == c).alias(c) for c in CLASSES]
    got = segments.groupBy(key).agg(F.count(kind).alias("n"), *each)
    top = F.greatest(*CLASSES)
    winner = F.when(F.col("n") == 0, F.lit("mixed"))
    for c in CLASSES:
        winner = winner.when(F.col(c) == top, F.lit(c))
    confidence = F.when(F.col("n") == 0, F.lit(0.0)).otherwise(top / F.col("n"))
    got = got.withColumns({"plurality": winner, "top": top, "confidence": F.round(confidence, 4)})
    dominant = F.when((F.col("n") >= 5) & (F.col("top") < 3), F.lit("mixed")).otherwise(F.col("plurality"))
    profile = F.when(F.col("n") == 0, F.lit("unknown")).when(F.col("confidence") >= 0.8, F.lit("pure")).otherwise(F.lit("mixed"))
    share = lambda c: F.when(F.col("n") == 0, F.lit(float(c == "mixed"))).otherwise(F.round(F.col(c) / F.col("n"), 4)).alias(f"ratio_{c}")
    return got.select(key, "n", *CLASSES, dominant.alias("dominant_type"), "confidence", profile.alias("profile"), *map(share, CLASSES))


def video_summary(videos: DataFrame) -> DataFrame:
    """Totals over videos; those with an error count as such and nowhere else."""
    good = F.col("error").isNull()
    by = [F.count_if(good & (F.col("dominant_type") == c)).alias(f"n_{c}") for c in CLASSES]
    share = F.round(F.coalesce(F.avg(F.when(good, (F.col("profile") == "pure").cast("double"))), F.lit(0.0)), 4)
    return videos.agg(F.count("*").alias("total"), F.count_if(good).alias("processed"), F.count_if(~good).alias("errors"), *by, share.alias("pure_ratio"))


def with_policy(rows: DataFrame, kind: str, height: str) -> DataFrame:
    """rows with target_height, crf and effective height; a class without an entry takes the default."""
    table = rows.sparkSession.createDataFrame(POLICY, "policy string, target_height int, crf int")
    named = rows.withColumn("policy", F.when(F.col(kind).isin([p[0] for p in POLICY]), F.col(kind)).otherwise(F.lit("_default")))
    out = named.join(F.broadcast(table), "policy")  # five rows
    eff = F.when(F.col(height) > 0, F.least(F.col("target_height"), F.col(height))).otherwise(F.col("target_height"))
    return out.withColumn("effective_height", eff)


def encode_timeout(duration: Column) -> Column:
    return F.when(duration > 0, F.greatest(F.lit(300), (duration * 4).cast("int"))).otherwise(F.lit(3600))


def thread_budget(cores: Column, concurrency: Column, override: Column | None = None) -> Column:
    """(pool, frame_threads) of one encoder: one core stays free, an override counts instead, frame threads are half the pool and at most 6."""
    own = F.floor((cores - 1) / concurrency).cast("int")
    pool = F.greatest(F.lit(1), own if override is None else F.coalesce(override.cast("int"), own))
    return F.struct(pool.alias("pool"), F.least(F.lit(6), F.greatest(F.lit(1), F.floor(pool / 2).cast("int"))).alias("frame_threads"))


def with_classification(videos: DataFrame, classified: DataFrame, key: str = "rel") -> DataFrame:
    """videos with dominant_type of the classification at their path; "_default" where there is none or no known one."""
    got = videos.join(classified.select(F.col("path").alias(key), F.col("dominant_type").alias("__t")), key, "left")
    return got.withColumn("dominant_type", F.when(F.col("__t").isin(*CLASSES), F.col("__t")).otherwise(F.lit("_default"))).drop("__t")


def of_types(videos: DataFrame, types: list[str] | None) -> DataFrame:
    """Videos of the asked classes; no list, or "_default" in it, asks for all."""
    return videos if not types or "_default" in types else videos.filter(F.col("dominant_type").isin(types))


def vault_header(videos: DataFrame) -> DataFrame:
    """dominant_type, n and bytes of each class; "unknown" for those without one."""
    kind = F.when(F.col("dominant_type") == "_default", F.lit("unknown")).otherwise(F.col("dominant_type"))
    return videos.groupBy(kind.alias("dominant_type")).agg(F.count("*").alias("n"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"))


SIDECAR_KEYS = ["source_sha256_head", "source_size", "source_mtime", "classification_type", "target_height", "crf"]


def to_encode(videos: DataFrame, sidecars: DataFrame, outputs: DataFrame | None = None, force: bool = False) -> DataFrame:
    """Videos to do: those without an output, or without a sidecar that agrees in all six fields; all of them if forced.

    The preset is not one of the fields. outputs: rel of the encoded files that exist.
    """
    if force:
        return videos
    have = sidecars if outputs is None else sidecars.join(outputs.select("rel").distinct(), "rel", "left_semi")
    same = F.lit(True)
    s = have.select("rel", *(F.col(k).alias(f"s_{k}") for k in SIDECAR_KEYS))
    for k in SIDECAR_KEYS:
        same = same & (F.col(k) == F.col(f"s_{k}"))
    return videos.withColumnRenamed("rel", "v_rel").join(s, (F.col("v_rel") == F.col("rel")) & same, "left_anti").withColumnRenamed("v_rel", "rel")


def _saved(source: Column, output: Column) -> Column:
    return F.when(source > 0, F.round(100.0 * (source - output) / source, 2))


def encode_report(results: DataFrame) -> DataFrame:
    """Encoded files by class, and of all classes ("all"): count, bytes before and after, share saved; null where nothing came in."""
    done = results.filter(F.col("status") == "encoded")
    got = done.rollup("dominant_type").agg(F.grouping("dominant_type").alias("__all"), F.count("*").alias("n"), F.sum("source_size").alias("source_bytes"), F.sum("output_size").alias("output_bytes"))
    kind = F.when(F.col("__all") == 1, F.lit("all")).otherwise(F.coalesce("dominant_type", F.lit("unknown")))
    return got.select(kind.alias("dominant_type"), "n", "source_bytes", "output_bytes", _saved(F.col("source_bytes"), F.col("output_bytes")).alias("saved_percent"))


def compression_ratio(source: Column, output: Column) -> Column:
    return F.when(source != 0, F.round(output / source, 4))


def elapsed(seconds: Column) -> Column:
    whole = seconds.cast("int")
    return F.format_string("%dm%ds", F.floor(whole / 60).cast("int"), whole % 60)


def frame_mean(lines: Column, key: str) -> Column:
    """Mean of the numbers on the lines that begin with lavfi.signalstats.<key>=, to four places; what is no number is passed over; null without any."""
    mark = f"lavfi.signalstats.{key}="
    own = F.filter(F.transform(F.split(lines, r"\r?\n"), X.strip), lambda x: x.startswith(mark))
    numbers = F.filter(F.transform(own, lambda x: F.substr(x, F.lit(len(mark) + 1)).try_cast("double")), lambda x: x.isNotNull())
    return F.when(F.size(numbers) > 0, F.round(F.aggregate(numbers, F.lit(0.0), lambda a, x: a + x) / F.size(numbers), 4))


def scene_frames(lines: Column) -> Column:
    return F.size(F.filter(F.split(lines, r"\r?\n"), lambda x: X.strip(x).startswith("pts_time:")))


def scenes_per_minute(lines: Column, seconds: int = SEGMENT_SECONDS) -> Column:
    return F.round(scene_frames(lines) / (seconds / 60), 2)


#: Seconds of audio from which it is read in chunks, and their length and overlap.
LONG_AUDIO, CHUNK, OVERLAP = 1200, 120.0, 15.0


def attention(duration: Column) -> Column:
    """How a recogniser reads audio of that length: (local, chunk_duration, overlap_duration); an unknown length is short."""
    far = F.coalesce(duration > LONG_AUDIO, F.lit(False))
    return F.struct(far.alias("local"), F.when(far, F.lit(CHUNK)).alias("chunk_duration"), F.when(far, F.lit(OVERLAP)).alias("overlap_duration"))
