"""Pluggable kernels (classify, transcribe, probe, canonicalise) and deterministic stand-ins.

A kernel is a function from a pandas frame to a pandas frame. It runs on the rows
that need it alone: filter first, since a Python function inside `when` sees all rows.
"""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import small_batches
from . import media
from .graph import mapping_rows

Kernel = Callable[[pd.DataFrame], pd.DataFrame]

CLASSIFIED = "lesson_id long, summary string, tags array<string>, concepts array<string>, aliases array<string>, engine string"


def apply(rows: DataFrame, kernel: Kernel, schema: str, parallel: int | None = None) -> DataFrame:
    """rows through a kernel, in small batches; `parallel` bounds how many calls run at a time."""
    small_batches(rows.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield kernel(b)

    return (rows.repartition(parallel) if parallel else rows).mapInPandas(run, schema)


def stub_classify(b: pd.DataFrame) -> pd.DataFrame:
    """Summary from the first words, tags and concepts from a digest of the text."""
    out = []
    for i, t in zip(b["lesson_id"], b["text"], strict=True):
        h = hashlib.sha256((t or "").encode()).hexdigest()
        out.append((i, " ".join((t or "").split()[:12])[:200], [f"tag-{h[0]}", f"tag-{h[1]}"], [f"Concept {h[2].upper()}"], [], "stub"))
    return pd.DataFrame(out, columns=["lesson_id", "summary", "tags", "concepts", "aliases", "engine"])


def cascade(rows: DataFrame, kernels: list[tuple[str, Kernel]], key: str, schema: str) -> DataFrame:
    """Kernels in turn, each on the rows that those before left empty (no summary, tags or concepts); rows that none fills keep the last answer."""
    left, done, got = rows, None, None
    for name, kernel in kernels:
        got = apply(left, kernel, schema).withColumn("engine", F.lit(name))
        empty = (F.coalesce("summary", F.lit("")) == "") | F.coalesce(F.size("tags") <= 0, F.lit(True)) | F.coalesce(F.size("concepts") <= 0, F.lit(True))
        full = got.filter(~empty)
        done = full if done is None else done.unionByName(full)
        left, got = left.join(full.select(key), key, "left_anti"), got.filter(empty)
    return done.unionByName(got.withColumn("engine", F.lit(None).cast("string")))


def with_retries(kernel: Kernel, waits: list[float], passing: type[Exception] = ConnectionError, sleep: Callable[[float], None] = time.sleep) -> Kernel:
    """A kernel that is called again after each passing error, after its wait; the error of the last try is raised, any other at once."""

    def run(b: pd.DataFrame) -> pd.DataFrame:
        for wait in waits:
            try:
                return kernel(b)
            except passing:
                sleep(wait)
        return kernel(b)

    return run


def canonical_prompt(lines: DataFrame) -> str:
    """The whole inventory as the text for a model that proposes canonical names. lines: graph.prompt_lines.

    It is one prompt for one call, so it is put together where the call is made.
    """
    text = {"concept": [], "tag": []}
    for r in lines.orderBy("kind", "place").toLocalIterator():
        text[r["kind"]].append(r["line"])
    return "VAULT CONCEPT INVENTORY (name: occurrences across lessons):\n" + "\n".join(text["concept"]) + "\n\nVAULT TAG INVENTORY (name: occurrences across lessons):\n" + "\n".join(text["tag"]) + "\n\nReturn the canonicalization mapping as specified in the system prompt."


def canonicalise(lines: DataFrame, model: Callable[[str], str]) -> DataFrame:
    """kind, variant, canonical that a model (prompt to answer) proposes for an inventory."""
    spark = lines.sparkSession
    return mapping_rows(spark.createDataFrame([(model(canonical_prompt(lines)),)], "text string"))


TRANSCRIBED = "key string, answer string"


def stub_transcribe(b: pd.DataFrame) -> pd.DataFrame:
    """A recogniser's JSON answer made of the row's own text: a segment a line, a second for each ten characters."""
    out = []
    for key, text in zip(b["key"], b["text"], strict=True):
        at, segments = 0.0, []
        for line in (text or "").split("\n"):
            segments.append({"text": line, "start": at, "end": at + len(line) / 10})
            at += len(line) / 10
        out.append((key, json.dumps({"text": text or "", "segments": segments, "language": "en"}, ensure_ascii=False)))
    return pd.DataFrame(out, columns=["key", "answer"])


MEASURED = "key string, start_s double, frames string, edges string, scenes string, error string"


def stub_measure(b: pd.DataFrame) -> pd.DataFrame:
    """Three passes over a segment as their printed lines, made of its key and start."""
    out = []
    for key, start in zip(b["key"], b["start_s"], strict=True):
        n = (len(key) + int(start)) % 40
        out.append((key, start, f"lavfi.signalstats.YDIF={n / 10}\n", f"lavfi.signalstats.YAVG={n * 2}\n", "pts_time:1\n" * (n % 3), "timeout" if n == 7 else None))
    return pd.DataFrame(out, columns=["key", "start_s", "frames", "edges", "scenes", "error"])


def segments(videos: DataFrame, kernel: Kernel, parallel: int | None = None) -> DataFrame:
    """Rows of media.vote from videos (key, duration): each segment's metrics and class; one with an error has no class."""
    asked = videos.select(F.col("key").cast("string").alias("key"), F.explode(media.segment_starts(F.col("duration"))).alias("start_s"))
    got = apply(asked, kernel, MEASURED, parallel)
    scenes, diff, edge = media.scenes_per_minute(F.col("scenes")), media.frame_mean(F.col("frames"), "YDIF"), media.frame_mean(F.col("edges"), "YAVG")
    good = F.col("error").isNull()
    fields = {"scenes_per_min": scenes, "diff_mean": diff, "edge_density": edge}
    rows = got.select("key", "start_s", F.when(good, media.segment_end(F.col("start_s"))).alias("end_s"), *(F.when(good, c).alias(n) for n, c in fields.items()), "error")
    return rows.withColumn("type", F.when(good, media.segment_class(F.col("diff_mean"), F.col("edge_density"), F.col("scenes_per_min"))))


_held: dict[tuple[str, bool], object] = {}


def held_model(name: str, local: bool, load: Callable[[str, bool], object]) -> object:
    """A worker's model of that name and kind of attention, loaded once."""
    if (name, local) not in _held:
        _held[name, local] = load(name, local)
    return _held[name, local]
