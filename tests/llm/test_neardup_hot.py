"""Near-duplicates on over 50,000 documents with huge groups, against all full sets."""

import os

import numpy as np
import pyarrow.parquet as pq
import pytest

from corpusloom.llm import neardup
from corpusloom.llm.wordhash import pieces

HOT = "/root/testdata/check_h/documents.parquet"


@pytest.mark.skipif(not os.path.exists(HOT), reason="no tables")
def test_hot_groups_equal_brute_force(spark):
    """Every set counts its common values with every other one, through the whole inverted index."""
    size = 5
    t = pq.read_table(HOT, columns=["doc_id", "text"])
    ids, own, sets = t["doc_id"].to_pylist(), [], {}
    for _, run in pieces(t["text"].to_pylist()):
        for s in neardup.shingle_sets(run, size):
            own.append(neardup._signature(s))
            if own[-1] is not None:
                sets.setdefault(own[-1], s)
    place = {k: i for i, k in enumerate(sets)}
    full = list(sets.values())
    n = np.array([len(s) for s in full])
    values, owner = np.concatenate(full), np.repeat(np.arange(len(full)), n)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    up = list(range(len(full)))

    def top(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for i, s in enumerate(full):
        lo, hi = np.searchsorted(values, s, side="left"), np.searchsorted(values, s, side="right")
        many = hi - lo > 1
        met = [owner[a:b] for a, b in zip(lo[many].tolist(), hi[many].tolist(), strict=True)]
        if met:
            c = np.bincount(np.concatenate(met), minlength=len(full))
            for j in np.flatnonzero(100 * c >= 80 * (n[i] + n - c)).tolist():
                a, b = top(i), top(j)
                up[max(a, b)] = min(a, b)
    least = {}
    for i, k in zip(ids, own, strict=True):
        if k is not None:
            least[top(place[k])] = min(least.get(top(place[k]), i), i)
    want = {i: i if k is None else least[top(place[k])] for i, k in zip(ids, own, strict=True)}
    assert len(want) > 50_000
    got = {r["doc_id"]: r["component_id"] for r in neardup.cluster(spark.read.parquet(HOT), shingle=size).collect()}
    assert got == want
