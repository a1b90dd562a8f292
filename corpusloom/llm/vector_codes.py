"""Vector code compression: codebooks per part, kept exact by whole numbers and Exponion search.

Components become whole numbers, vectors are cut into equal parts, and each part position
learns a codebook of ENTRIES entries in ROUNDS rounds. A part searches from its previous
entry: let u be its distance to that entry. An entry that is as near or nearer lies within 2u
of the previous one (triangle inequality), so its neighbours, sorted by their distance
from it, are looked at only as far as 4 u^2 in squared distances, which are whole numbers,
equality included; ties go to the lower index. Nothing is rounded, so the answer is
that of a search of all entries.

Each round reads the rows of the last one and writes them with their new codes; a task adds
one row of sums a part position at the end of its file, so a round is one pass without a shuffle.
Sums are cut into limbs of 30 bits, which Spark adds; the driver sees ENTRIES sums a position.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch

#: Equal parts of a vector, entries of a codebook, rounds of learning, and the factor of a component.
PARTS, ENTRIES, ROUNDS, FACTOR = 8, 16, 6, 4096

#: Distinct labels up to which their sums are broadcast; beyond, they are joined by shuffle.
FEW_LABELS = 100_000

#: Bits of a limb; limbs of a sum (the last one signed) that hold any count of finite floats or doubles.
BITS, LIMBS = 30, {"float": 7, "double": 37}


def whole(x: np.ndarray) -> np.ndarray:
    """floor(FACTOR * x) exactly: int64 where distances fit there, Python's whole numbers elsewhere."""
    big = np.abs(x) >= 2.0**52  # a whole number already, and its product may leave double's range
    scaled = np.floor(np.where(big, 0.0, x) * float(FACTOR))
    if not big.any() and (not x.size or np.abs(scaled).max() < _safe(x.shape[1])):
        return scaled.astype(np.int64)
    out = np.array([int(v) for v in scaled.ravel()], dtype=object).reshape(x.shape)
    out[big] = [int(v) * FACTOR for v in x[big]]
    return out


def _safe(length: int) -> int:
    """Vectors of components below this keep four times their squared distance below 2^63."""
    return int((2.0**58 / max(length, 1)) ** 0.5)


class Book:
    """The entries of one part position, and each entry's neighbours by distance."""

    def __init__(self, entries: np.ndarray) -> None:
        self.entries = entries
        k = len(entries)
        gaps = ((entries[:, None, :] - entries[None, :, :]) ** 2).sum(axis=2).reshape(k, k)
        order = [sorted((j for j in range(k) if j != i), key=lambda j, i=i: (gaps[i, j], j)) for i in range(k)]
        self.order = np.array(order, dtype=np.int64).reshape(k, max(k - 1, 0))
        self.gaps = np.take_along_axis(gaps, self.order, axis=1) if k > 1 else np.zeros((k, 0), dtype=entries.dtype)

    def search(self, x: np.ndarray, previous: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(nearest entry, squared distance) of each row of x, from its previous entry."""
        best = previous.copy()
        near = ((x - self.entries[best]) ** 2).sum(axis=1)
        radius, rows = 4 * near, np.arange(len(x))
        for step in range(self.order.shape[1]):
            rows = rows[(self.gaps[previous[rows], step] <= radius[rows]).astype(bool)]  # sorted gaps: a row that stops has stopped
            if not len(rows):
                break
            at = self.order[previous[rows], step]
            d = ((x[rows] - self.entries[at]) ** 2).sum(axis=1)
            won = ((d < near[rows]) | ((d == near[rows]) & (at < best[rows]))).astype(bool)
            near[rows[won]], best[rows[won]] = d[won], at[won]
        return best, near


def _books(entries: list[list[list[int]]], wide: bool) -> list[Book]:
    return [Book(np.array(part, dtype=object if wide else np.int64).reshape(len(part), -1)) for part in entries]


def limbs(value: int, count: int) -> list[int]:
    low = [(value >> (BITS * i)) & ((1 << BITS) - 1) for i in range(count - 1)]
    return [*low, value >> (BITS * (count - 1))]


def _limbs(rows: DataFrame) -> int:
    return LIMBS[rows.schema["vector"].dataType.elementType.simpleString()]


def unlimbed(parts: list[int]) -> int:
    return sum(int(p) << (BITS * i) for i, p in enumerate(parts))


def kept_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """vec_id, label, vector of the rows whose vector is there and has finite components only."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    vector = F.col(vector_col) if df.schema[vector_col].dataType.simpleString() == "array<float>" else F.col(vector_col).cast("array<double>")
    rows = df.select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), vector.alias("vector"))
    return rows.filter(F.col("vector").isNotNull() & ~F.coalesce(F.exists("vector", bad), F.lit(False)))


def _assign(rows: DataFrame, entries: list[list[list[int]]], parts: int, width: int, summing: bool) -> DataFrame:
    """rows (vec_id, label, vector, code) with the code of the nearest entries, and error; summing: with rows of sums.

    A row of sums has `part` set: the parts' componentwise sums in limbs, and counts, a
    number for each entry.
    """
    count, most = len(entries[0]), max((abs(v) for part in entries for e in part for v in e), default=0)
    shared = rows.sparkSession.sparkContext.broadcast(entries)  # entries * length whole numbers
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    length, many = parts * width, _limbs(rows)
    schema = f"vec_id {kinds['vec_id']}, label {kinds['label']}, vector {kinds['vector']}, code binary, error bigint, part int, sums array<bigint>, counts array<bigint>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        narrow, wide = (None if most >= _safe(length) else _books(shared.value, False)), None
        sums = [[[0] * width for _ in range(count)] for _ in range(parts)]
        counts = np.zeros((parts, count), dtype=np.int64)
        names = None
        for batch in batches:
            names = names or [batch.schema.field(i) for i in range(3)]
            vectors = batch.column(2)
            fits = np.asarray(pa.compute.list_value_length(vectors)) == length
            x = np.asarray(vectors.filter(pa.array(fits)).flatten()).astype(np.float64).reshape(-1, length)
            held = whole(x)
            if held.dtype == object or narrow is None:
                wide = wide or _books(shared.value, True)
                held, books = held.astype(object), wide
            else:
                books = narrow
            before = [c.as_py() for c in batch.column(3).filter(pa.array(fits))]
            old = np.array([list(c) if c else [0] * parts for c in before], dtype=np.int64).reshape(-1, parts)
            codes, error = np.zeros((len(held), parts), dtype=np.uint8), np.zeros(len(held), dtype=held.dtype)
            for p, book in enumerate(books):
                own = held[:, p * width : (p + 1) * width]
                best, near = book.search(own, old[:, p])
                codes[:, p], error = best, error + near
                if summing:
                    counts[p] += np.bincount(best, minlength=count)
                    for e in np.unique(best):
                        for j, v in enumerate(own[best == e].sum(axis=0)):
                            sums[p][e][j] += int(v)
            place, code, lost = iter(range(len(held))), [None] * batch.num_rows, [None] * batch.num_rows
            for i in np.flatnonzero(fits):
                r = next(place)
                code[i], lost[i] = codes[r].tobytes(), int(error[r]) if error[r] < 1 << 63 else None
            none = lambda kind: pa.nulls(batch.num_rows, kind)
            cols = [*batch.columns[:3], pa.array(code, pa.binary()), pa.array(lost, pa.int64()), none(pa.int32()), none(pa.list_(pa.int64())), none(pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(cols, names=_NAMES)
        if summing and names:
            none = lambda kind: pa.nulls(parts, kind)
            flat = [[x for e in part for v in e for x in limbs(v, many)] for part in sums]
            cols = [*(none(f.type) for f in names), none(pa.binary()), none(pa.int64()), pa.array(range(parts), pa.int32()), pa.array(flat, pa.list_(pa.int64())), pa.array(counts.tolist(), pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(cols, names=_NAMES)

    return rows.select("vec_id", "label", "vector", "code").mapInArrow(run, schema)


_NAMES = ["vec_id", "label", "vector", "code", "error", "part", "sums", "counts"]


def _moved(assigned: DataFrame, entries: list[list[list[int]]], width: int) -> list[list[list[int]]]:
    """Each entry replaced by the floor of its parts' means; an unused one stays."""
    added = assigned.filter("part IS NOT NULL")
    split = lambda c: added.select("part", F.posexplode(c).alias("at", "v")).groupBy("part", "at").agg(F.sum("v").alias("v"))
    sums = {(r["part"], r["at"]): r["v"] for r in split("sums").collect()}  # a row a limb, whatever the input
    counts = {(r["part"], r["at"]): r["v"] for r in split("counts").collect()}
    out, many = [], _limbs(assigned)
    for p, part in enumerate(entries):
        new = []
        for e, old in enumerate(part):
            n = counts.get((p, e), 0)
            at = lambda j, e=e: (e * width + j) * many
            new.append([unlimbed([sums[p, at(j) + i] for i in range(many)]) // n for j in range(width)] if n else old)
        out.append(new)
    return out


def compress(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """vec_id, code (two hex digits a part), error, label_error, codebooks_sha256 of each kept row.

    The codebooks start with the parts of the smallest `entries` vec_ids (null ids last,
    equal ids by label and vector; fewer where there are fewer rows). Vectors whose length is not that of the first one, or
    not a multiple of `parts`, cannot be compared: their rows have null code and error, and
    count for nothing. An error beyond 64 bits is null, and so is the label's sum then. Ties
    go to the lower index; repeated rows count each; without rows there is no result.
    """
    scratch = Scratch(df.sparkSession, "codes")
    rows = scratch.put(kept_vectors(df, id_col, vector_col, label_col).withColumn("code", F.lit(None).cast("binary")))
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "label", "vector").limit(entries).collect()
    length = len(first[0]["vector"]) if first else 0
    width = length // parts if length % parts == 0 else 0
    if width:
        start = [[int(v) for v in whole(np.array([r["vector"]]))[0]] for r in first if len(r["vector"]) == length]
        books = [[v[p * width : (p + 1) * width] for v in start] for p in range(parts)]
        for _ in range(rounds):
            last, rows = rows, scratch.put(_assign(rows.filter("part IS NULL") if "part" in rows.columns else rows, books, parts, width, True))
            scratch.free(last)
            books = _moved(rows, books, width)
        last, rows = rows, scratch.put(_assign(rows.filter("part IS NULL"), books, parts, width, False).select("vec_id", "label", "code", "error"))
        scratch.free(last)
    else:
        books, rows = [], rows.select("vec_id", "label", "code", F.lit(None).cast("long").alias("error"))
    sha = hashlib.sha256(",".join(str(v) for part in books for e in part for v in e).encode()).hexdigest()
    total = F.sum(F.col("error").cast("decimal(38,0)"))
    lost = F.max(F.col("code").isNotNull() & F.col("error").isNull())
    sums = scratch.put(rows.groupBy("label").agg(F.when(~lost, total.try_cast("long")).alias("label_error")))
    small = sums.limit(FEW_LABELS + 1).count() <= FEW_LABELS
    sums = sums.withColumnRenamed("label", "own")
    out = rows.join(F.broadcast(sums) if small else sums, F.col("label").eqNullSafe(F.col("own")), "left")
    return out.select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(sha).alias("codebooks_sha256"))


def _sql(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> str:
    """Every part against every entry, in every round."""
    assign = lambda r: (
        f"a{r} AS MATERIALIZED (SELECT v, p, arg_min(e, d * 1000 + e) AS e, min(d) AS d FROM (SELECT x.v, x.p, b.e, list_sum(list_transform(range(1, len(x.c) + 1), lambda i: (x.c[i] - b.c[i]) * (x.c[i] - b.c[i])))::BIGINT AS d FROM x JOIN b{r} b USING (p)) GROUP BY v, p)"
    )
    move = lambda r: (
        f"m{r} AS (SELECT p, e, list(q ORDER BY i) AS c FROM (SELECT p, e, i, (s - ((s % n) + n) % n) // n AS q FROM (SELECT p, e, i, sum(c[i])::BIGINT AS s, count(*) AS n FROM (SELECT p, a.e, x.c, unnest(range(1, len(x.c) + 1)) AS i FROM x JOIN a{r} a USING (v, p)) GROUP BY p, e, i)) GROUP BY p, e),\n"
        f"b{r + 1} AS MATERIALIZED (SELECT p, e, coalesce(m.c, b.c) AS c FROM b{r} b LEFT JOIN m{r} m USING (p, e))"
    )
    steps = ",\n".join(f"{assign(r)},\n{move(r)}" for r in range(rounds))
    return f"""
WITH k AS (SELECT row_number() OVER (ORDER BY vec_id) - 1 AS v, * FROM embeddings WHERE embedding IS NOT NULL AND NOT coalesce(list_bool_or(list_transform(embedding, lambda c: c IS NULL OR NOT isfinite(c))), false)),
x AS MATERIALIZED (SELECT v, p, list_transform(embedding[p * len(embedding) // {parts} + 1 : (p + 1) * len(embedding) // {parts}], lambda c: floor({FACTOR}::DOUBLE * c::DOUBLE)::BIGINT) AS c FROM k, range({parts}) AS r(p)),
b0 AS MATERIALIZED (SELECT p, v AS e, c FROM x WHERE v < {entries}),
{steps},
{assign(rounds)},
t AS (SELECT v, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM a{rounds} GROUP BY v),
s AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM b{rounds})
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256 FROM k JOIN t USING (v), s"""


SQL = _sql()
