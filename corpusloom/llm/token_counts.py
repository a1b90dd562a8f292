"""Token counts by a dynamic program over a trie of distinct pre-tokens.

Pieces have unigram scores, from their places in a published vocabulary by Zipf's
law: -log(place + SHIFT). The count of a pre-token is the number of pieces of its
best segmentation. best[i], the score of the first i letters, depends on those
letters only, so pre-tokens that share a prefix share it: the distinct ones are put
into a trie whose nodes hold (score, pieces), each worked out once from the nodes
above it, and the node where a pre-token ends holds its count.

A worker keeps its trie from batch to batch up to a bounded number of nodes.
Counts of a text add up, so no text meets another and nothing is shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keyed, unkeyed

#: Added to a piece's place before the logarithm.
SHIFT = 100.0

#: Score of a letter that no piece has; it counts as one token for each UTF-8 byte.
UNKNOWN = -30.0

#: Nodes of a worker's trie; a full trie is dropped and grown anew.
NODES = 600_000

#: Letters of a pre-token that are looked at by the trie; longer ones are worked out alone, outside it.
LONG = 200

#: Stands before each pre-token, as in the vocabulary.
MARK = "▁"


def vocabulary(path: str) -> dict[str, float]:
    """Piece -> score, of a sentencepiece file; control, unknown and byte pieces are left out."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    kept = [i for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
    return {sp.id_to_piece(i): -math.log(n + SHIFT) for n, i in enumerate(kept)}


class Trie:
    """Nodes are [score, pieces, children or None]; a path from the root spells a prefix."""

    def __init__(self, pieces: dict[str, float]) -> None:
        self.pieces, self.longest = pieces, max(map(len, pieces), default=1)
        # every end of a piece: its score, or None where the end alone is no piece
        self.ends: dict[str, float | None] = {p[i:]: None for p in pieces for i in range(len(p))}
        self.ends.update(pieces)
        self.root: list = [0.0, 0, {}]
        self.nodes, self.worked = 1, 0

    def _next(self, text: str, i: int, above: list[list]) -> list:
        """The node after letter i, from the nodes of the prefixes before it; of equal scores the fewer pieces."""
        best, count = -math.inf, 0
        ends = self.ends
        for n in range(1, len(above) + 1):
            last = text[i + 1 - n : i + 1]
            if last not in ends:
                break  # nor does any longer one end a piece
            score = ends[last]
            if score is None:
                continue
            before = above[-n]
            s, c = before[0] + score, before[1] + 1
            if s > best or (s == best and c < count):
                best, count = s, c
        if best == -math.inf:
            before = above[-1]
            best, count = before[0] + UNKNOWN, before[1] + len(text[i].encode("utf-8", "surrogatepass"))
        self.worked += 1
        return [best, count, None]

    def count(self, token: str) -> int:
        """Pieces of the best segmentation of a pre-token (with its mark)."""
        node, above = self.root, [self.root]
        alone = len(token) > LONG
        for i, c in enumerate(token):
            below = node[2]
            child = None if alone or below is None else below.get(c)
            if child is None:
                child = self._next(token, i, above)
                if not alone:
                    if below is None:
                        node[2] = {c: child}
                    else:
                        below[c] = child
                    self.nodes += 1
            node = child
            above.append(node)
            if len(above) > self.longest + 1:
                del above[0]
        return node[1]


_trie: dict[int, Trie] = {}


def count_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, n_pretokens, n_tokens.

    Pre-tokens are runs without white space. Null, empty and blank texts have 0 of
    both. Other columns are not looked at; an empty table gives no rows.
    """
    pieces = docs.sparkSession.sparkContext.broadcast(vocabulary(path))  # one entry a piece of a fixed file

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        terminal: dict[str, int] = {}
        for b in batches:
            sizes, totals = [], []
            for t in b["text"]:
                words = (t or "").split()
                total = 0
                for w in words:
                    n = terminal.get(w)
                    if n is None:
                        trie = _trie.get(0)
                        if trie is None or trie.nodes > NODES or trie.pieces is not pieces.value:
                            terminal.clear()
                            trie = _trie[0] = Trie(pieces.value)
                        n = trie.count(MARK + w)
                        if len(w) <= LONG:
                            terminal[w] = n
                    total += n
                sizes.append(len(words))
                totals.append(total)
            yield pd.DataFrame({"doc_id": b["doc_id"], "n_pretokens": sizes, "n_tokens": totals})

    rows = keyed(docs, id_col, F.col(text_col).alias("text"))
    return unkeyed(rows.mapInPandas(run, "doc_id string, n_pretokens long, n_tokens long"), docs, id_col)
