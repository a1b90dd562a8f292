"""Order within groups across partitions, pages in parts, and exact quantiles, against plain versions."""

import random
import statistics
from itertools import groupby

import pytest
from pyspark.sql import functions as F

from corpusloom.functions.runs import packed
from corpusloom.operators import ordered, packing
from corpusloom.session import Scratch


@pytest.fixture()
def scratch(spark):
    return Scratch(spark, "test")


def _rows(n=900, seed=1):
    rng = random.Random(seed)
    return [(rng.choice(["a", "a", "a", "b", None]), rng.choice([None, *range(40)]), rng.choice(["x", "yy", "zzz", "", None, "é"]), i) for i in range(n)]


def _sorted(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1] is not None, r[1] or 0, r[3]))


SCHEMA = "g string, o long, v string, i long"


def test_places_and_neighbours(spark, scratch):
    rows = _rows()
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    want = [(*r, k) for _, own in groupby(_sorted(rows), key=lambda r: r[0]) for k, r in enumerate(own)]
    got = ordered.numbered(df, ["g"], ["o", "i"], "at", scratch)
    assert got.columns == ["g", "o", "v", "i", "at"]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))
    beside = []
    for _, own in groupby(_sorted(rows), key=lambda r: r[0]):
        own = list(own)
        beside += [(*r, own[k - 1][2] if k else None, own[k + 1][2] if k + 1 < len(own) else None) for k, r in enumerate(own)]
    got = ordered.neighbours(df, ["g"], ["o", "i"], "v", scratch)
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, beside))


def test_one_group_uses_all_partitions(spark, scratch):
    df = spark.range(40_000).select(F.lit("g").alias("g"), (F.col("id") % 10).alias("o"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else few rows are one partition
    try:
        spread = ordered.dealt(df, ["g"], ["o"], scratch)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    sizes = [r["count"] for r in spread.groupBy("_part").count().collect()]
    assert len(sizes) == int(spark.conf.get("spark.sql.shuffle.partitions")) and max(sizes) < 2 * 40_000 / len(sizes)
    got = ordered.numbered(df, ["g"], ["o"], "at", scratch).agg(F.countDistinct("at"), F.min("at"), F.max("at"), F.count_if(F.floor(F.col("at") / 4000) != F.col("o"))).first()
    assert tuple(got) == (40_000, 0, 39_999, 0)


@pytest.mark.parametrize("down", [False, True])
def test_running_sums(spark, down):
    rows = [(g, k, random.Random(k).randint(-9, 9)) for g in ("a", None) for k in range(50 if g else 7)]
    got = ordered.running(spark.createDataFrame(rows, "g string, at long, v long"), ["g"], "at", ["v"], down, block=8).collect()
    assert len(got) == len(rows)
    for g, at, v in got:
        assert v == sum(x for h, k, x in rows if h == g and (k >= at if down else k <= at))


@pytest.mark.parametrize("part", [1, 10, 64, 1 << 20])
def test_parts_are_the_page(spark, scratch, part):
    rows = [r for r in _rows(300, 3)] + [("c", 1, "long " * 30, 1000)]
    parts = ordered.assembled(spark.createDataFrame(rows, SCHEMA).repartition(5), ["g"], ["o", "i"], "v", scratch, part).collect()
    for g, own in groupby(_sorted(rows), key=lambda r: r[0]):
        lines = [r[2] or "" for r in own]
        page = "\n".join(lines)
        mine = sorted((p for p in parts if p["g"] == g), key=lambda p: p["part"])
        assert "\n".join(p["text"] for p in mine) == page
        for p in mine:
            assert page.encode()[p["at"] : p["at"] + len(p["text"].encode())] == p["text"].encode()
            assert p["at"] // part == p["part"] and len(p["text"].encode()) < part + max(map(lambda x: len(x.encode()) + 1, lines))
        assert sum(p["n_lines"] for p in mine) == len(lines)
    sizes = {r["g"]: r["n_bytes"] for r in ordered.page_size(spark.createDataFrame(parts), ["g"]).collect()}
    assert sizes["c"] == 150


def test_quantiles_of_any_domain(spark):
    shares = [0.01, 0.25, 0.5, 0.9, 0.99, 0.999]
    for make in (lambda r: r.gauss(0, 1e6), lambda r: float(r.randint(0, 3)), lambda r: r.random() ** 9, lambda r: 10.0 ** r.randint(-200, 200)):
        rng = random.Random(7)
        data = [make(rng) for _ in range(1500)]
        got = ordered.quantiles(spark.createDataFrame([(x,) for x in data] + [(None,), (float("nan"),)], "v double").repartition(4), F.col("v"), shares, fan=16)
        s = sorted(data)
        for p, g in zip(shares, got, strict=True):
            at = min(max(p * (len(s) + 1), 1), len(s))
            k = int(at)
            want = s[k - 1] + (s[min(k, len(s) - 1)] - s[k - 1]) * (at - k)
            assert g == pytest.approx(want, rel=1e-12)
        assert got[2] == pytest.approx(statistics.quantiles(data, n=100)[49], rel=1e-9)
    assert ordered.quantiles(spark.range(0).select(F.col("id").alias("v")), F.col("v"), [0.5]) == [None]


def test_quantiles_move_counts_only(spark):
    """Ten million distinct values."""
    rows = spark.range(10_000_000).select(F.pmod(F.xxhash64("id"), F.lit(1 << 50)).cast("double").alias("v"))
    got = ordered.quantiles(rows, F.col("v"), [0.5, 0.999])
    below = rows.agg(*(F.count_if(F.col("v") <= g) for g in got)).first()
    assert [round(b / 1e7, 6) for b in below] == [0.5, 0.999]


@pytest.mark.parametrize("block", [5, 16, 1024])
def test_paragraphs_of_any_length(spark, block):
    rng = random.Random(block)
    text = lambda: rng.choice([None, " ", "a. b. c. d. e. f. g", "x" * rng.randint(1, 700), "Said. And so on", "w " * rng.randint(1, 90), "q! "])
    rows = [(rng.choice(["a", "a", "b", None]), i, text()) for i in range(400)] + [("blank", 1, " "), ("blank", 2, None)]
    got = packing.packed_groups(spark.createDataFrame(rows, "g string, o long, t string").repartition(3), ["g"], ["o"], "t", block=block).collect()
    for g in ("a", "b", None, "blank"):
        own = [r for r in rows if r[0] == g]
        mine = sorted((r for r in got if r["g"] == g), key=lambda r: r["begin"])
        assert [r["paragraph"] for r in mine] == packed([t for _, _, t in own])
        assert [r["begin"] for r in mine] == [sum(x["n_texts"] for x in mine[:k]) for k in range(len(mine))]
