"""The exact look-up of hot sets: links of made sets and components of a made hot table, against all pairs."""

import random
import struct

import pytest
from plain import components
from pyspark.sql import functions as F

from corpusloom.llm import neardup

SETS = "sig binary, label binary, n long, full binary"


def name(i):
    return struct.pack(">q", i)


def made_sets(seed):
    """Groups around common cores, of sizes on both sides of what a link allows; some values are in all sets."""
    rng, out = random.Random(seed), []
    for g in range(12):
        core = rng.sample(range(g * 1000, g * 1000 + 900), rng.choice([1, 5, 40, 120]))
        for _ in range(12):
            own = {v for v in core if rng.random() < rng.choice([0.7, 0.95, 1.0])} | {-1, -2, -3}
            own |= {rng.randrange(10**6, 10**9) for _ in range(rng.choice([0, 2, 9, 40]))}
            out.append(sorted(own))
    return out


@pytest.mark.parametrize(("seed", "percent", "block"), [(1, 80, 600), (2, 80, 1 << 20), (3, 50, 900), (4, 100, 600)])
def test_look_up_equals_all_pairs(spark, monkeypatch, seed, percent, block):
    monkeypatch.setattr(neardup, "BLOCK", block)
    sets = made_sets(seed)
    label = [i - i % 2 for i in range(len(sets))]  # two sets a component
    rows = spark.createDataFrame([(name(i), name(label[i]), len(s), struct.pack(f"<{len(s)}q", *s)) for i, s in enumerate(sets)], SETS)
    ask = {i for i in range(len(sets)) if i % 3}
    asked = rows.filter(F.col("sig").isin([bytearray(name(i)) for i in ask]))
    one = neardup.Clusters(spark.createDataFrame([], "doc_id long, text string"), 5, percent)
    got = {(bytes(r["a"]), bytes(r["b"])) for r in one.looked_up(asked, rows).collect()}
    want = set()
    for i in ask:
        for j, s in enumerate(sets):
            both = len(set(sets[i]) & set(s))
            if label[i] != label[j] and 100 * both >= percent * (len(sets[i]) + len(s) - both):
                want.add(tuple(sorted((name(label[i]), name(label[j])))))
    assert got == want and (want or percent == 100)


def test_a_made_hot_table(spark, monkeypatch):
    """Near copies of two templates, far ones that only share most of their sketch, and pairs of these; nearly all retained values are hot."""
    monkeypatch.setattr(neardup, "LIST", 6)
    monkeypatch.setattr(neardup, "BLOCK", 4000)
    looked_up, calls = neardup.Clusters.looked_up, []
    monkeypatch.setattr(neardup.Clusters, "looked_up", lambda self, *x: calls.append(1) or looked_up(self, *x))
    rng = random.Random(8)
    templates = [[f"w{t}x{i}" for i in range(160)] for t in range(2)]
    rows = []
    for t in templates:
        for _ in range(40):
            words = list(t)
            cut = rng.choice([1, 2, 2, 3, 20, 30])  # 20 and more words changed at one place are too many
            at = rng.randrange(0, 160 - cut)
            words[at : at + cut] = [f"n{rng.randrange(10**6)}" for _ in range(cut)]
            rows.append((len(rows) * 10, " ".join(words)))
            if cut >= 20 and rng.random() < 0.5:
                rows.append((len(rows) * 10, " ".join(words[:-1] + ["end"])))
    rows += [(5, None), (15, ""), (25, "a b"), (None, " ".join(templates[0]))]
    got = {r["doc_id"]: r["component_id"] for r in neardup.cluster(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = {i: least for i, _, least in components(rows, 5, 80) if i is not None}
    want |= {5: 5, 15: 15}
    assert calls and {k: v for k, v in got.items() if k is not None} == want
    assert len(set(want.values())) > 10
