"""Greedy paragraphs of groups of any length, in parallel.

Where a paragraph ends depends on where it began, so a plain scan is one task a group. But
a paragraph has `sentences` texts at most, so it can enter a block of BLOCK places at that many
offsets only. Each block works out, for every offset at which a paragraph may begin, the offset at
which one begins in the next block; those few numbers a block are followed along the group, and then every
block packs its own texts from the offset that is known by then.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.runs import breaks
from ..functions.text import strip
from ..session import Scratch
from .ordered import numbered

#: Places of one block.
BLOCK = 1024


def packed_groups(rows: DataFrame, group: list[str], order: list[str], text: str, chars: int = 600, sentences: int = 5, block: int = BLOCK) -> DataFrame:
    """group, begin, n_texts, paragraph: the texts of each group in order, packed as functions.runs.packed does.

    begin is the place of a paragraph's first text among those of its group that are not blank.
    Null and blank texts are left out; equal rows stand in any order; a group without texts gives no rows.
    """
    if block < sentences:
        raise ValueError("a paragraph spans two blocks at most")
    scratch = Scratch(rows.sparkSession, "packing")
    full = rows.select(*group, *order, strip(F.coalesce(text, F.lit(""))).alias("_t")).filter("_t <> ''")
    placed = numbered(full, group, order, "_pl", scratch)
    own = F.floor(F.col("_pl") / block).cast("long")
    sized = placed.select(*group, "_pl", "_t", F.length("_t").alias("_n"), (F.size(F.regexp_extract_all("_t", F.lit(r"[.!?]\s"), 0)) + 1).alias("_e"))
    # a block has the first texts of the next one too, since its last paragraph may reach there
    both = F.when((F.col("_pl") % block < sentences) & (own > 0), F.array(own, own - 1)).otherwise(F.array(own))
    dealt = scratch.put(sized.withColumn("_block", F.explode(both)))
    keys = [*group, "_block"]
    kinds = {f.name: f.dataType.simpleString() for f in dealt.schema}
    named = ", ".join(f"`{k}` {kinds[k]}" for k in keys)

    def after(b: pd.DataFrame) -> np.ndarray:
        return breaks(b["_n"].to_numpy(), b["_e"].to_numpy(), chars, sentences)

    def walk(nxt: np.ndarray, at: int) -> list[int]:
        """Begins from `at` on, up to the first at or behind the block's end."""
        out = [at]
        while out[-1] < min(block, len(nxt)):
            out.append(int(nxt[out[-1]]))
        return out

    def through(b: pd.DataFrame) -> pd.DataFrame:
        b = b.sort_values("_pl")
        nxt = after(b)
        exits = [max(walk(nxt, i)[-1] - block, 0) for i in range(sentences)]
        return b.iloc[:1][keys].assign(exits=[exits])

    def follow(b: pd.DataFrame) -> pd.DataFrame:
        b, at, entries = b.sort_values("_block"), 0, []
        for exits in b["exits"]:
            entries.append(at)
            at = int(exits[at])
        return b[keys].assign(entry=entries)

    def pack(b: pd.DataFrame) -> pd.DataFrame:
        b = b.sort_values("_pl")
        begins = walk(after(b), int(b["entry"].iloc[0]))
        texts, first = b["_t"].tolist(), int(b["_pl"].iloc[0])
        made = [(first + i, j - i, " ".join(texts[i:j])) for i, j in zip(begins, begins[1:], strict=False)]
        out = pd.DataFrame(made, columns=["begin", "n_texts", "paragraph"])
        for k in group:
            out[k] = b[k].iloc[0] if len(out) else None
        return out[[*group, "begin", "n_texts", "paragraph"]]

    exits = dealt.drop("_t").groupBy(*keys).applyInPandas(through, f"{named}, exits array<int>")
    entries = exits.groupBy(*group).applyInPandas(follow, f"{named}, entry int")  # a row a block
    on = None
    there = entries.select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)), "entry")
    for i, k in enumerate(keys):
        one = F.col(k).eqNullSafe(F.col(f"_k{i}"))
        on = one if on is None else on & one
    held = dealt.join(there, on).drop(*(f"_k{i}" for i in range(len(keys))))
    shown = ", ".join(f"`{k}` {kinds[k]}" for k in group)
    return held.groupBy(*keys).applyInPandas(pack, f"{shown}, begin long, n_texts long, paragraph string")
