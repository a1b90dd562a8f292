"""Quality classifier: a sparse ensemble of conjunctive rules over text statistics.

1. Statistics of each whole text (`STATS`), made with numpy on the UTF-8 bytes.
2. Small trees, each grown on a resample of the labelled rows; every path from a
   root to a node is a rule, a conjunction of thresholds.
3. A logistic model with an L1 penalty over the rules; most weights end at zero.
4. The rules left are compiled into one Spark column over the statistics, so that
   a plan shows what decides and no model object travels to the executors.

Fitting takes at most `max_rows` labelled rows (the first by a hash of doc_id), so
what the driver gathers has a fixed bound; scoring covers every row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .wordhash import NONSPACE, grams, pieces, words

STATS = ["log_bytes", "upper", "digit", "symbol", "bang", "pipe", "stop", "newline", "space", "wide", "word_len", "distinct_words", "distinct_grams", "top_word", "distinct_lines"]

#: Labelled rows from which the rules are learnt.
MAX_ROWS = 20_000

TREES, DEPTH, LEAST, PENALTY, SEED = 24, 3, 5, 0.002, 7

_CLASS = np.zeros(256, dtype=np.uint8)
for _i, _set in enumerate([range(65, 91), range(48, 58), b"#$%&*^~=_<>{}[]\\@+", b"!?", b"|", b".,;:", b"\n", b" \t", range(128, 256)], start=1):
    _CLASS[list(_set)] = _i
_LINE = np.ones(256, dtype=bool)
_LINE[[10, 13]] = False


def statistics(texts: pd.Series) -> pd.DataFrame:
    """STATS of each text; a null or empty text has 0 everywhere but for the shares of distinct things, 1."""
    out = {s: np.zeros(len(texts)) for s in STATS}
    for s in ("distinct_words", "distinct_grams", "distinct_lines"):
        out[s][:] = 1.0
    for at, run in pieces(texts):
        w = words(run, NONSPACE)
        lines = words(run, _LINE)
        for i, b in enumerate(run):
            n, k = len(b), at + i
            if not n:
                continue
            count = np.bincount(_CLASS[np.frombuffer(b, dtype=np.uint8)], minlength=10)
            out["log_bytes"][k] = np.log1p(n)
            for c, s in enumerate(("upper", "digit", "symbol", "bang", "pipe", "stop", "newline", "space", "wide"), start=1):
                out[s][k] = count[c] / n
            h = w.hash[w.first[i] : w.first[i + 1]]
            if len(h):
                _, times = np.unique(h, return_counts=True)
                out["word_len"][k] = float((w.end[w.first[i] : w.first[i + 1]] - w.start[w.first[i] : w.first[i + 1]]).mean())
                out["distinct_words"][k] = len(times) / len(h)
                out["top_word"][k] = times.max() / len(h)
                if len(h) >= 4:
                    g = grams(h, 4)
                    out["distinct_grams"][k] = len(np.unique(g)) / len(g)
            x = lines.hash[lines.first[i] : lines.first[i + 1]]
            if len(x):
                out["distinct_lines"][k] = len(np.unique(x)) / len(x)
    return pd.DataFrame(out)


def with_statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs, all columns as they were, and a struct column `stats`; a column of that name already there is replaced."""
    docs = docs.drop("stats")
    kind = T.StructType([T.StructField(s, T.DoubleType()) for s in STATS])

    @F.pandas_udf(kind)
    def stats(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for t in texts:
            yield statistics(t)

    return docs.withColumn("stats", stats(F.col(text_col)))


@dataclass(frozen=True)
class Rule:
    """All of (stat, is above, threshold)."""

    terms: tuple[tuple[str, bool, float], ...]

    def column(self, stats: str = "stats") -> Column:
        out = F.lit(True)
        for s, above, t in self.terms:
            x = F.col(stats)[s]
            out = out & ((x > F.lit(t)) if above else (x <= F.lit(t)))
        return out

    def holds(self, x: np.ndarray) -> np.ndarray:
        out = np.ones(len(x), dtype=bool)
        for s, above, t in self.terms:
            v = x[:, STATS.index(s)]
            out &= (v > t) if above else (v <= t)
        return out


@dataclass(frozen=True)
class Model:
    bias: float
    rules: tuple[tuple[Rule, float], ...]

    def score(self, stats: str = "stats") -> Column:
        """The score as one Spark column over the statistics."""
        z = F.lit(float(self.bias))
        for r, w in self.rules:
            z = z + F.when(r.column(stats), F.lit(float(w))).otherwise(F.lit(0.0))
        return 1.0 / (1.0 + F.exp(-z))


def _split(x: np.ndarray, y: np.ndarray, features: np.ndarray) -> tuple[float, int, float] | None:
    best: tuple[float, int, float] | None = None
    n, total = len(y), y.sum()
    for f in features:
        order = np.argsort(x[:, f], kind="stable")
        v, c = x[order, f], np.cumsum(y[order])
        at = np.flatnonzero(v[1:] > v[:-1])
        at = at[(at + 1 >= LEAST) & (n - at - 1 >= LEAST)]
        if not len(at):
            continue
        left, got = at + 1.0, c[at]
        p, q = got / left, (total - got) / (n - left)
        gini = left * p * (1 - p) + (n - left) * q * (1 - q)
        i = int(gini.argmin())
        if best is None or gini[i] < best[0] - 1e-12:
            best = (float(gini[i]), int(f), float((v[at[i]] + v[at[i] + 1]) / 2))
    return best


def _grow(x: np.ndarray, y: np.ndarray, rng: np.random.Generator, terms: tuple, depth: int, out: set[Rule]) -> None:
    if depth == 0 or len(y) < 2 * LEAST or y.min() == y.max():
        return
    features = rng.choice(len(STATS), size=max(4, len(STATS) // 2), replace=False)
    if (found := _split(x, y, features)) is None:
        return
    _, f, t = found
    for above in (False, True):
        side = (x[:, f] > t) if above else (x[:, f] <= t)
        path = (*terms, (STATS[f], above, t))
        out.add(Rule(path))
        _grow(x[side], y[side], rng, path, depth - 1, out)


def fit_rules(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, penalty: float = PENALTY, seed: int = SEED) -> Model:
    """Rules from trees, weights from an L1-penalised logistic fit (accelerated proximal steps).

    Without rows of both labels the model is a constant.
    """
    if not len(y) or y.min() == y.max():
        return Model(float(4.0 * (y.mean() - 0.5)) if len(y) else 0.0, ())
    rng, found = np.random.default_rng(seed), set()
    few = min((y == 0).sum(), (y == 1).sum())
    for _ in range(trees):
        own = np.concatenate([rng.choice(np.flatnonzero(y == c), size=min((y == c).sum(), 4 * few, 4000)) for c in (0, 1)])
        _grow(x[own], y[own], rng, (), depth, found)
    rules = sorted(found, key=lambda r: r.terms)
    a = np.stack([r.holds(x) for r in rules], axis=1).astype(np.float64) if rules else np.zeros((len(y), 0))
    kept, seen = [], set()
    for j in range(a.shape[1]):  # rules that hold for the same rows count once
        if (key := a[:, j].tobytes()) not in seen and 0 < a[:, j].mean() < 1:
            seen.add(key)
            kept.append(j)
    a, rules = a[:, kept], [rules[j] for j in kept]
    w, b, v, c, t = np.zeros(a.shape[1]), 0.0, np.zeros(a.shape[1]), 0.0, 1.0
    step = 4.0 * len(y) / (np.linalg.norm(np.hstack([a, np.ones((len(y), 1))]), 2) ** 2)
    for _ in range(600):
        e = 1.0 / (1.0 + np.exp(-(a @ v + c))) - y
        new = v - step * (a.T @ e) / len(y)
        new = np.sign(new) * np.maximum(np.abs(new) - step * penalty, 0.0)
        newb, newt = c - step * e.mean(), (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, c = new + (t - 1) / newt * (new - w), newb + (t - 1) / newt * (newb - b)
        w, b, t = new, newb, newt
    return Model(float(b), tuple((r, float(x)) for r, x in zip(rules, w, strict=True) if abs(x) > 1e-6))


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learnt from: crc32 of the id's text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> Model:
    """Learn from labelled rows that are not held out: at most max_rows, the first by a hash of doc_id."""
    own = (
        labels.select("doc_id", F.col("quality").cast("int").alias("label"))
        .filter(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    )
    # max_rows ids at most, so the broadcast has a bound; of a repeated id any one text may be learnt from
    rows = docs.select("doc_id", "text").join(F.broadcast(own), "doc_id")
    got = with_statistics(rows).select("doc_id", "label", "stats.*").limit(2 * max_rows).toPandas().sort_values(["doc_id", *STATS])
    return fit_rules(got[STATS].to_numpy(dtype=np.float64), got["label"].to_numpy(dtype=np.float64))


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """docs, all columns as they were, with quality_score (0 to 1); null and empty texts are scored too.

    A column quality_score already there is replaced.
    """
    out = with_statistics(docs, text_col)
    return out.withColumn("quality_score", model.score()).drop("stats")
