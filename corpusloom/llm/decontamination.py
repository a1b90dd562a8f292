"""Benchmark decontamination by winnowing.

Each text becomes a row of word hashes. Of every GUARANTEE - K + 1 consecutive
k-gram hashes the smallest is kept (all places that tie), for benchmark items and
documents alike, so every span of GUARANTEE words that both share has a kept hash
in common. Kept hashes of a document that the benchmark kept too are the seeds;
around each seed the windows that hold it are looked up and then compared word
for word, which extends the seed to the whole shared span. Items shorter than
GUARANTEE words have one window, the whole item; their few lengths are looked up
at every place, since the guarantee does not reach them.

The benchmark is a stated query set: it is read in blocks of at most BLOCK_BYTES
of text and each block is broadcast, so what is broadcast has a bound however
large the benchmark grows; documents are read once, and never shuffled.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keyed, unkeyed
from .wordhash import ALNUM, Words, grams, pieces, words

#: Words of a window: the length from which a shared span is always found.
GUARANTEE = 10

#: Words of a fingerprint gram; a window has GUARANTEE - K + 1 of them.
K = 6

#: Text bytes of the benchmark that are broadcast together.
BLOCK_BYTES = 16 << 20

_TOP = np.uint64(2**64 - 1)


def _within(first: np.ndarray, n: int, size: int) -> np.ndarray:
    """For each of n places: whether size words from there lie in one text."""
    stop = np.repeat(first[1:], np.diff(first))[:n]
    return np.arange(n) + size <= stop


def kept(w: Words, k: int = K, guarantee: int = GUARANTEE) -> tuple[np.ndarray, np.ndarray]:
    """(places, hashes) of the k-grams that winnowing keeps."""
    g = grams(w.hash, k)
    g[~_within(w.first, len(g), k)] = _TOP
    span = guarantee - k + 1
    n = max(0, len(g) - span + 1)
    full = _within(w.first, n, guarantee)
    least = g[:n].copy()
    for j in range(1, span):
        np.minimum(least, g[j : j + n], out=least)
    keep = np.zeros(len(g), dtype=bool)
    for j in range(span):
        keep[j : j + n] |= full & (g[j : j + n] == least)
    at = np.flatnonzero(keep)
    return at, g[at]


class Index:
    """Windows of one block of items, and the fingerprints that lead to them.

    All of it is arrays: the items' bytes, the places of their words, and, for each
    length, the windows' hashes in order with the place and item of each. So a
    worker loads a block as fast as it can copy it.
    """

    def __init__(self, items: list[tuple[object, str | None]]) -> None:
        self.names = [None if i is None else str(i) for i, _ in items]
        self.words = w = words([t.encode("utf-8", "surrogatepass") if isinstance(t, str) else b"" for _, t in items], ALNUM)
        self.seeds = np.unique(kept(w)[1])
        long = grams(w.hash, GUARANTEE)
        found: dict[int, list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = {}
        for i in range(len(items)):
            a, b = int(w.first[i]), int(w.first[i + 1])
            m = min(b - a, GUARANTEE)
            if m:
                places = np.arange(a, b - m + 1)
                found.setdefault(m, []).append((long[a : b - m + 1] if m == GUARANTEE else grams(w.hash[a:b], m), places, np.full(len(places), i, dtype=np.int32)))
        self.windows: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for m, parts in found.items():
            h, at, item = (np.concatenate(x) for x in zip(*parts, strict=True))
            order = np.argsort(h, kind="stable")
            self.windows[m] = h[order], at[order], item[order]

    def holders(self, m: int, h: np.uint64, window: bytes) -> set[int]:
        """Items with this window of m words and hash, compared word for word."""
        hashes, at, item = self.windows[m]
        lo, hi = (int(np.searchsorted(hashes, h, side=x)) for x in ("left", "right"))
        return {int(item[i]) for i in range(lo, hi) if self.words.joined(int(at[i]), int(at[i]) + m) == window}


def _known(x: np.ndarray, index: np.ndarray) -> np.ndarray:
    if not len(index):
        return np.zeros(len(x), dtype=bool)
    return index[np.minimum(np.searchsorted(index, x), len(index) - 1)] == x


def _candidates(w: Words, index: Index) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(window length, places where a window of that length may stand, their hashes)."""
    if GUARANTEE in index.windows and len(w.hash) >= GUARANTEE:
        at, g = kept(w)
        seeds = at[_known(g, index.seeds)]
        if len(seeds):
            near = np.unique((seeds[:, None] - np.arange(GUARANTEE - K + 1)[None, :]).ravel())
            near = near[(near >= 0) & (near + GUARANTEE <= len(w.hash))]
            g = grams(w.hash, GUARANTEE)
            near = near[_within(w.first, len(g), GUARANTEE)[near]]
            near = near[_known(g[near], index.windows[GUARANTEE][0])]
            yield GUARANTEE, near, g[near]
    for m, (known, _, _) in index.windows.items():
        if m < GUARANTEE and len(w.hash) >= m:
            g = grams(w.hash, m)
            at = np.flatnonzero(_known(g, known) & _within(w.first, len(g), m))
            yield m, at, g[at]


def find(w: Words, index: Index, hit: np.ndarray, items: list[set]) -> None:
    """Marks hit words in `hit` and adds the names of the items to each text's set; an item without an id has no name."""
    for m, places, hashes in _candidates(w, index):
        text, seen = np.searchsorted(w.first, places, side="right") - 1, {}
        for p, d, h in zip(places.tolist(), text.tolist(), hashes, strict=True):
            window = w.joined(p, p + m)
            if (found := seen.get(window)) is None:
                found = seen[window] = index.holders(m, h, window)
            if found:
                hit[p : p + m] = True
                items[d].update(index.names[i] for i in found if index.names[i] is not None)


def blocks(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> list:
    """Broadcast indexes, each of a bounded number of text bytes."""
    sc, out, held, size = benchmark.sparkSession.sparkContext, [], [], 0
    rows = benchmark.select(F.col(id_col).alias("i"), F.col(text_col).alias("t"))

    def close() -> None:
        if held:
            out.append(sc.broadcast(pickle.dumps(Index(held))))

    for r in rows.toLocalIterator():
        held.append((r["i"], r["t"]))
        size += len(r["t"] or "")
        if size >= block_bytes:
            close()
            held, size = [], 0
    close()
    return out


def scanner(indexes: list) -> Callable[[pd.Series], pd.DataFrame]:
    """A function from texts to (n_words, n_hit, item names)."""
    lone: list[Index] = []

    def load(b) -> Index:
        if len(indexes) > 1:  # one block in a worker's memory at a time
            index = pickle.loads(b.value)
            if hasattr(b, "_value"):
                del b._value
            return index
        if not lone:
            lone.append(pickle.loads(b.value))
        return lone[0]

    def scan(texts: pd.Series) -> pd.DataFrame:
        cut = list(pieces(texts))
        parts = [[0, np.zeros(0, dtype=np.int64), []] for _ in cut]
        n_words, n_hit, items = [np.zeros(len(texts), dtype=np.int64) for _ in range(2)] + [[set() for _ in range(len(texts))]]
        hits: list[np.ndarray | None] = [None] * len(parts)
        for index in map(load, indexes) if indexes else [None]:
            for c, (at, run) in enumerate(cut):
                w = words(run, ALNUM)
                if hits[c] is None:
                    hits[c] = np.zeros(len(w.hash), dtype=bool)
                n_words[at : at + len(run)] = np.diff(w.first)
                if index is not None and len(w.hash):
                    find(w, index, hits[c], own := items[at : at + len(run)])
                    total = np.concatenate(([0], np.cumsum(hits[c])))
                    n_hit[at : at + len(run)] = total[w.first[1:]] - total[w.first[:-1]]
                    items[at : at + len(run)] = own
        return pd.DataFrame({"n_words": n_words, "n_hit": n_hit, "items": [sorted(s) for s in items]})

    return scan


def scan(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, n_words, n_hit, n_items, items (sorted names), contaminated.

    A null or empty text has no words and is clean; items without words have no
    window; an item that stands twice is listed once; the words of an item without
    an id are hit, but it is not listed or counted; an empty benchmark leaves every
    document clean. Other columns of either table are not looked at.
    """
    work = scanner(blocks(benchmark))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            got = work(b["text"])
            yield pd.DataFrame({"doc_id": b["doc_id"], "n_words": got["n_words"].to_numpy(), "n_hit": got["n_hit"].to_numpy(), "items": got["items"].to_numpy()})

    rows = keyed(docs, id_col, F.col(text_col).alias("text"))
    out = unkeyed(rows.mapInPandas(run, "doc_id string, n_words long, n_hit long, items array<string>"), docs, id_col)
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), "items", (F.col("n_hit") > 0).alias("contaminated"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of docs without a hit, all columns as they were; decided in the one scan."""
    work = scanner(blocks(benchmark))

    @F.pandas_udf("boolean")
    def clean(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for t in texts:
            yield work(t)["n_hit"] == 0

    return docs.filter(clean(F.col(text_col)))
