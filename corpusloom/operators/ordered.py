"""Order within groups of any size: places, neighbours, running sums, pages in parts.

No task holds a group. Rows are dealt to range partitions of (group, order), each is
numbered or summed for itself, and what a group has in earlier partitions or blocks comes
from one row for each of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import Scratch

#: Places that one window of a running sum covers.
BLOCK = 1024

#: Bytes of one part of a page.
PART_BYTES = 1 << 20


def dealt(rows: DataFrame, group: list[str], order: list[str], scratch: Scratch) -> DataFrame:
    """rows in range partitions of (group, order): _part and _row (parts equal rows, so that they spread too)."""
    spread = rows.withColumn("_row", F.monotonically_increasing_id())
    return scratch.put(spread.repartitionByRange(*group, *order, "_row").withColumn("_part", F.spark_partition_id()))


def _same(a: DataFrame, b: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Join where keys are equal, null ones too; b's other columns are added."""
    there = b.select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)), *(c for c in b.columns if c not in keys))
    on = None
    for i, k in enumerate(keys):
        one = F.col(k).eqNullSafe(F.col(f"_k{i}"))
        on = one if on is None else on & one
    return a.join(there, on, how).drop(*(f"_k{i}" for i in range(len(keys))))


def numbered(rows: DataFrame, group: list[str], order: list[str], name: str, scratch: Scratch) -> DataFrame:
    """rows with the place (from 0) of each in its group by `order`, nulls first; equal rows in any order."""
    spread = dealt(rows, group, order, scratch)
    earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = spread.groupBy(*group, "_part").agg(F.count("*").alias("_n"))
    before = counts.select(*group, "_part", F.sum("_n").over(earlier).alias("_before")).filter("_before IS NOT NULL")  # none for groups in one partition
    within = F.row_number().over(Window.partitionBy(*group, "_part").orderBy(*order, "_row")) - 1
    placed = _same(spread.withColumn("_at", within), before, [*group, "_part"])
    return placed.withColumn(name, (F.col("_at") + F.coalesce("_before", F.lit(0))).cast("long")).drop("_at", "_before", "_part", "_row")


def neighbours(rows: DataFrame, group: list[str], order: list[str], value: str, scratch: Scratch) -> DataFrame:
    """rows with prev and next: the value of the row before and after in its group.

    Each partition hands its first and last row of a group on to the next ones; a null
    value is a neighbour like any other.
    """
    spread = dealt(rows, group, order, scratch)
    keys, at = [*group, "_part"], F.struct(*order, "_row")
    within = Window.partitionBy(*keys).orderBy(*order, "_row")
    ends = spread.groupBy(*keys).agg(F.min_by(F.struct(value), at).alias("_first"), F.max_by(F.struct(value), at).alias("_last"))
    beside = Window.partitionBy(*group).orderBy("_part")
    borders = ends.select(*keys, F.lag("_last").over(beside).alias("_before"), F.lead("_first").over(beside).alias("_after")).filter("_before IS NOT NULL OR _after IS NOT NULL")
    own = spread.withColumns({"_p": F.lag(F.struct(value)).over(within), "_n": F.lead(F.struct(value)).over(within)})
    out = _same(own, borders, keys).withColumns({"prev": F.coalesce("_p", "_before")[value], "next": F.coalesce("_n", "_after")[value]})
    return out.drop("_p", "_n", "_before", "_after", "_part", "_row")


def running(rows: DataFrame, group: list[str], place: str, values: list[str], down: bool = False, block: int = BLOCK) -> DataFrame:
    """rows with each value replaced by its sum from the group's first place (down: last place) to this one.

    Places are whole numbers, each once in a group. Values are not null.
    """
    held = rows.withColumn("_block", F.floor(F.col(place) / block).cast("long"))
    turn = (lambda c: F.col(c).desc()) if down else F.col
    earlier = Window.partitionBy(*group).orderBy(turn("_block")).rowsBetween(Window.unboundedPreceding, -1)
    sums = held.groupBy(*group, "_block").agg(*(F.sum(v).alias(v) for v in values))
    before = sums.select(*group, "_block", *(F.sum(v).over(earlier).alias(f"_{v}") for v in values)).filter(F.col(f"_{values[0]}").isNotNull())  # none for groups of one block
    within = Window.partitionBy(*group, "_block").orderBy(turn(place)).rowsBetween(Window.unboundedPreceding, 0)
    summed = _same(held.withColumns({v: F.sum(v).over(within) for v in values}), before, [*group, "_block"])
    return summed.withColumns({v: F.col(v) + F.coalesce(f"_{v}", F.lit(0)) for v in values}).drop("_block", *(f"_{v}" for v in values))


def assembled(lines: DataFrame, page: list[str], order: list[str], line: str, scratch: Scratch, part_bytes: int = PART_BYTES) -> DataFrame:
    """page, part, at, n_lines, text: each page's lines in order, joined by line feeds, in parts of known places.

    `at` is the byte of the page at which the part begins; a line stands in the part that
    holds its first byte, counted in part_bytes, so a part holds fewer than part_bytes and
    one line. Parts follow one another without gaps: the page is its parts, joined by line feeds.
    Null lines are empty ones.
    """
    rows = numbered(lines.select(*page, *order, F.coalesce(line, F.lit("")).alias("_line")), page, order, "_place", scratch)
    rows = rows.select(*page, "_place", "_line", (F.octet_length("_line") + 1).cast("long").alias("_end"))
    ends = running(rows, page, "_place", ["_end"])
    begin = F.col("_end") - F.octet_length("_line") - 1
    parts = ends.withColumns({"_at": begin, "part": F.floor(begin / part_bytes).cast("long")})
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_place", "_line"))), lambda s: s["_line"]), "\n")
    return parts.groupBy(*page, "part").agg(F.min("_at").alias("at"), F.count("*").alias("n_lines"), text.alias("text"))


def page_size(parts: DataFrame, page: list[str]) -> DataFrame:
    """page, n_parts and n_bytes of each page's parts."""
    return parts.groupBy(*page).agg(F.count("*").alias("n_parts"), F.max(F.col("at") + F.octet_length("text")).alias("n_bytes"))


def quantiles(rows: DataFrame, value: Column, shares: list[float], fan: int = 256) -> list[float | None]:
    """Exact quantiles of a numeric value: for each share p the values at place p * (n + 1), between neighbours in proportion; nulls are left out.

    Every pass counts values in `fan` equal bins of the intervals that still hold a wanted place, and
    keeps the bins that do, until an interval holds one value; so only counts move, whatever the
    number of distinct values. Places below 1 and above n are the first and last value.
    """
    held = rows.select(value.cast("double").alias("v")).filter("v IS NOT NULL AND NOT isnan(v)")
    n, low, high = held.agg(F.count("*"), F.min("v"), F.max("v")).first()
    if not n:
        return [None] * len(shares)
    wanted = sorted({k for p in shares for k in (_place(p, n), min(_place(p, n) + 1, n))})
    found = _selected(held, wanted, low, high, fan)
    out = []
    for p in shares:
        at = min(max(p * (n + 1), 1.0), float(n))
        a, b = found[_place(p, n)], found[min(_place(p, n) + 1, n)]
        out.append(a + (b - a) * (at - _place(p, n)))
    return out


def _place(p: float, n: int) -> int:
    return int(min(max(p * (n + 1), 1.0), float(n)))


def _selected(held: DataFrame, places: list[int], low: float, high: float, fan: int) -> dict[int, float]:
    """The value at each place (from 1) in ascending order."""
    found: dict[int, float] = {}
    open_at = [(low, high, 0, places)]  # the interval, how many values lie below it, and the places wanted in it
    while open_at:
        bins = []
        for i, (a, b, _, _) in enumerate(open_at):
            width = (b - a) / fan
            bin_of = F.lit(0) if width <= 0 else F.least(F.floor((F.col("v") - a) / width), F.lit(fan - 1)).cast("int")
            bins.append(F.when(F.col("v").between(a, b), F.struct(F.lit(i).alias("i"), bin_of.alias("bin"))))
        which = F.coalesce(*bins)
        counted = held.select(which.alias("w"), "v").filter("w IS NOT NULL").groupBy("w").agg(F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
        rows = sorted((r["w"]["i"], r["w"]["bin"], r["n"], r["low"], r["high"]) for r in counted.collect())  # fan rows for each wanted place at most
        nxt = []
        for i, (_, _, below, want) in enumerate(open_at):
            for _, _, count, lo, hi in (r for r in rows if r[0] == i):
                own = [p for p in want if below < p <= below + count]
                if own and lo == hi:
                    found |= dict.fromkeys(own, lo)
                elif own:
                    nxt.append((lo, hi, below, own))
                below += count
        open_at = nxt
    return found
