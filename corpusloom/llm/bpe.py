"""BPE encoding and decoding with forced boundaries.

A merge can only make a token of the vocabulary. So two bytes that stand side by
side in no token never come together, and every such place inside a word is a
certain cut: the fragments between cuts are merged alone and their ids
concatenated, which gives exactly what merging the whole word gives. Fragments are
short and recur far more often than words, so both are kept in bounded tables.

The vocabulary is a tokenizers file of the kind BPE with end-of-word suffix; its
path is a parameter and its content is broadcast (a file of fixed size). The library's
Unicode tables are of another age than those of Python and `regex`, so it is asked once,
over all code points, what it takes for a letter or a number and how it normalises; texts
with a code point on which the two differ are normalised by the library itself and split
by its own ranges.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import pairwise
from operator import add

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Entries of each half of a worker's tables; when the young half is full it becomes the old one.
TABLE = 200_000

#: Letters up to which a fragment's pairs are held in one list.
FEW = 48

#: Rows that leave a worker together.
ROWS = 512

#: White space as the vocabulary's own normaliser has it (fixed values of Unicode's White_Space).
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def byte_chars() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, spare = {b: chr(b) for b in shown}, 256
    for b in range(256):
        if b not in out:
            out[b] = chr(spare)
            spare += 1
    return [out[b] for b in range(256)]


class Table(dict):
    """A bounded table that keeps what was asked for lately: young entries here, older ones in `old`."""

    def __init__(self) -> None:
        self.old: dict = {}

    def put(self, key, value) -> None:
        if len(self) >= TABLE:
            self.old = self.copy()
            self.clear()
        self[key] = value

    def __missing__(self, key):
        value = self.old.get(key)
        if value is not None:
            self.put(key, value)
        return value


Ranges = tuple[tuple[int, int], ...]


def normal(text: str) -> str:
    """NFC, then lower case letter by letter (so no final sigma)."""
    if not text.isascii():
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
    return text.lower()


def _joined(points: list[int]) -> Ranges:
    """First and last of each run of consecutive numbers."""
    p = np.array(points, dtype=np.int64)
    ends = np.flatnonzero(np.diff(p) != 1)
    return tuple(zip(p[np.r_[0, ends + 1]].tolist(), p[np.r_[ends, len(p) - 1]].tolist(), strict=True)) if len(p) else ()


@lru_cache(maxsize=1)
def library_tables() -> dict[str, Ranges]:
    """Ranges of code points: what the library takes for a letter (L) and a number (N), and where it departs from Python or regex (odd)."""
    from tokenizers import Regex
    from tokenizers.normalizers import NFC, Lowercase, Sequence
    from tokenizers.pre_tokenizers import Split

    # planes 4 to 13 have no characters, 15 and 16 are for private use
    points = [c for c in [*range(0x40000), *range(0xE0000, 0xE1000)] if not 0xD800 <= c < 0xE000]
    everything = "".join(map(chr, points))
    out, odd = {}, set()
    for name in "LN":
        # what the pattern matches is removed, so its runs lie between the pieces
        at, own = 0, []
        for _, (lo, hi) in [*Split(Regex(rf"\p{{{name}}}+"), "removed").pre_tokenize_str(everything), ("", (len(points), 0))]:
            own += points[at:lo]
            at = hi
        out[name] = _joined(own)
        odd |= set(own) ^ {ord(c) for c in regex.findall(rf"\p{{{name}}}", everything)}
    # alone, and between marks of the two commonest classes, which shows where it stands among marks
    theirs = Sequence([NFC(), Lowercase()])
    for around in ("a{}\u0301b", "a\u0316{}b", "a\u0301{}b"):
        left, right = around.split("{}")
        for k in range(0, len(points), 1 << 16):
            some = [c for c in points[k : k + (1 << 16)] if c != 10]
            asked = "\n".join(left + chr(c) + right for c in some)
            odd.update(c for c, x, y in zip(some, theirs.normalize_str(asked).split("\n"), normal(asked).split("\n"), strict=True) if x != y)
    out["odd"] = _joined(sorted(odd))
    return out


def _class(ranges: Ranges) -> str:
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in ranges)


class WordBpe:
    def __init__(self, spec: str, tables: dict[str, Ranges] | None = None) -> None:
        data = json.loads(spec)
        model = data["model"]
        self.end = model["end_of_word_suffix"] or ""
        self.vocab: dict[str, int] = model["vocab"]
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.rank = {p: i for i, p in enumerate(pairs)}
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.token = {i: t for t, i in self.vocab.items()} | {i: t for t, i in self.special.items()}
        self.chars = byte_chars()
        # Two neighbours that some token has side by side; all other neighbours are certain cuts.
        self.joined = {a + b for t in self.vocab for a, b in pairwise(t.removesuffix(self.end) or t)}
        (split,) = (p for p in data["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        plain = split["pattern"]["Regex"].replace(r"\s", SPACE)
        self.pattern = regex.compile(plain)
        # for texts with a code point on which the library departs: its own ranges and its own normaliser
        tables = tables or library_tables()
        self.odd = re.compile(f"[{_class(tables['odd'])}]") if tables["odd"] else re.compile("(?!)")
        # nearly all texts lie below the first of them, which one range tells sooner
        self.far = re.compile(f"[{_class(((tables['odd'][0][0], 0x10FFFF),))}]") if tables["odd"] else self.odd
        for name in "LN":
            plain = plain.replace(rf"\p{{{name}}}", f"[{_class(tables[name])}]")
        self.exact = regex.compile(plain, regex.V1)
        self.theirs = None
        self.specials = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.words, self.fragments = Table(), Table()

    def merge(self, fragment: str, last: bool) -> tuple[int, ...]:
        """Ids of one fragment; the lowest rank first, the leftmost of equals."""
        sym = list(fragment)
        if last:
            sym[-1] += self.end
        return tuple(map(self.vocab.__getitem__, self._few(sym) if len(sym) <= FEW else self._many(sym)))

    def _few(self, sym: list[str]) -> list[str]:
        """The merges of a short fragment: the ranks of all pairs in one list, of which the smallest goes."""
        rank, none = self.rank.get, len(self.rank)
        ranks = [rank(p, none) for p in pairwise(sym)]
        while ranks:
            r = min(ranks)
            if r == none:
                break
            i = ranks.index(r)
            sym[i : i + 2] = [sym[i] + sym[i + 1]]
            del ranks[i]
            if i:
                ranks[i - 1] = rank((sym[i - 1], sym[i]), none)
            if i < len(ranks):
                ranks[i] = rank((sym[i], sym[i + 1]), none)
        return sym

    def _many(self, whole: list[str]) -> list[str]:
        """The merges of a fragment of any length, by a heap of pairs, so time grows as n log n."""
        sym: list[str | None] = list(whole)
        n = len(sym)
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        heap = [(r, i, p) for i, p in enumerate(pairwise(sym)) if (r := self.rank.get(p)) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, (a, b) = heapq.heappop(heap)
            j = after[i]
            if sym[i] != a or j < 0 or sym[j] != b:
                continue  # one of the two has been merged since
            sym[i], sym[j] = a + b, None
            k = after[i] = after[j]
            if k >= 0:
                before[k] = i
                if (r := self.rank.get((sym[i], sym[k]))) is not None:
                    heapq.heappush(heap, (r, i, (sym[i], sym[k])))
            h = before[i]
            if h >= 0 and (r := self.rank.get((sym[h], sym[i]))) is not None:
                heapq.heappush(heap, (r, h, (sym[h], sym[i])))
        return [s for s in sym if s is not None]

    def cut(self, chars: str) -> list[str]:
        """The word's fragments between certain cuts."""
        joined = self.joined
        cuts = [i for i, p in enumerate(map(add, chars, chars[1:]), 1) if p not in joined]
        if not cuts:
            return [chars]
        return [chars[a:b] for a, b in pairwise([0, *cuts, len(chars)])]

    def word(self, text: str) -> tuple[bytes, str]:
        """(ids as int32 bytes, decoded text) of one pre-token."""
        chars = text if text.isascii() and text.isalnum() else "".join([self.chars[b] for b in text.encode("utf-8", "surrogatepass")])
        ids: list[int] = []
        parts = self.cut(chars)
        final = len(parts) - 1
        for k, fragment in enumerate(parts):
            key = fragment + self.end if k == final else fragment
            got = self.fragments[key]
            if got is None:
                got = self.merge(fragment, k == final)
                if len(key) < 64:
                    self.fragments.put(key, got)
            ids.extend(got)
        out = (array("i", ids).tobytes(), self.decode(ids))
        if len(text) < 64:
            self.words.put(text, out)
        return out

    def decode(self, ids) -> str:
        """Token texts joined by one space, which is what a vocabulary without a decoder gives."""
        token = self.token
        return " ".join([token[i] for i in ids])

    def split(self, text: str) -> list[str]:
        """The pre-tokens of a text without special tokens."""
        if text.isascii() or not self.far.search(text) or not self.odd.search(text):
            return self.pattern.findall(normal(text))
        if self.theirs is None:
            from tokenizers.normalizers import NFC, Lowercase, Sequence

            self.theirs = Sequence([NFC(), Lowercase()])
        return self.exact.findall(self.theirs.normalize_str(text))

    def parts(self, text: str) -> list[tuple[bytes, str]]:
        """(ids, decoded) of each pre-token and special token of a text, in order."""
        out: list[tuple[bytes, str]] = []
        pieces = self.specials.split(text) if self.specials and "<" in text else [text]
        known = self.words
        for i, piece in enumerate(pieces):
            if i % 2:
                out.append((np.int32(self.special[piece]).tobytes(), piece))
            else:
                out.extend([known[w] or self.word(w) for w in self.split(piece)])
        return out


_model: dict[int, WordBpe] = {}


def _load(spec) -> WordBpe:
    """The worker's model, made once for each broadcast file."""
    key = hash(spec.value[0])
    if key not in _model:
        _model.clear()
        _model[key] = WordBpe(*spec.value)
    return _model[key]


def _spec(docs: DataFrame, path: str):
    with open(path, encoding="utf-8") as f:
        return docs.sparkSession.sparkContext.broadcast((f.read(), library_tables()))


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", decoded: bool = True) -> DataFrame:
    """One row per row of docs: doc_id, ids (array of int), and decoded (the text of those ids).

    A null or empty text has no ids and decodes to the empty text. A special
    token's own text is that token, as the library has it. Other columns are not
    looked at; an empty table gives no rows.
    """
    spec = _spec(docs, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _load(spec)
        for batch in (b.slice(i, ROWS) for b in batches for i in range(0, b.num_rows, ROWS)):
            blobs, texts = [], []
            for t in batch.column(1):
                parts = model.parts(t.as_py() or "")
                blobs.append(b"".join([p[0] for p in parts]))
                if decoded:
                    texts.append(" ".join([p[1] for p in parts]))
            offsets = np.zeros(len(blobs) + 1, dtype=np.int32)
            offsets[1:] = np.cumsum([len(b) // 4 for b in blobs])
            ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(blobs), dtype=np.int32)))
            cols = [batch.column(0), ids] + ([pa.array(texts, pa.string())] if decoded else [])
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "ids", "decoded"][: len(cols)])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, ids array<int>" + (", decoded string" if decoded else ""))


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ids of each text."""
    return round_trip(docs, path, id_col, text_col, decoded=False)


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id and the text of each row's ids (null ids: the empty text)."""
    spec = _spec(encoded, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            model = _load(spec)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([model.decode(x.as_py() or []) for x in batch.column(1)], pa.string())], names=["doc_id", "decoded"])

    rows = encoded.select(F.col(id_col).alias("doc_id"), F.col(ids_col).alias("ids"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, decoded string")
