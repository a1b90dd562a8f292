"""Language by compression: the language whose dictionary makes a text smallest.

Each learned language has a raw-content zstandard dictionary, pieces of its own texts.
A text is brought to lower case, everything but letters and marks becomes one space, and
it is compressed in blocks of BLOCK bytes with each dictionary in turn, so that every
part of a long text counts alike and a text never serves as its own dictionary. The
smallest sum of sizes wins. Where the margin to the next language is narrow the answer
is marked as rejected; the language is told all the same.

Learning: a bounded sample, TEXTS distinct texts a language, the first by a hash of the
text (a copy counts once), one piece of PIECE characters of each at a place given by that
hash. What is collected and broadcast is TEXTS * PIECE characters a language at most.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Distinct texts that each language's dictionary is learnt from, and the characters taken of each.
TEXTS, PIECE = 1024, 256

#: Bytes that are compressed at once, and zstandard's level.
BLOCK, LEVEL = 1024, 9

#: A margin is narrow under so many bytes, or under this share of the next language's size.
LEAST_BYTES, LEAST_SHARE = 3, 0.01

#: Sampled texts up to which their hashes are broadcast; beyond (hundreds of languages) they are joined by shuffle.
FEW = 100_000

#: The language of a text without letters.
NONE = "und"


@dataclass(frozen=True)
class Language:
    """A learned language; count is the number of distinct texts that had it."""

    name: str
    count: int
    content: bytes


def letters(text: Column) -> Column:
    """Lower-case words of letters and marks, parted by one space; the empty text where there is no letter."""
    plain = F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{M}]+", " "))
    return F.when(plain.rlike(r"\p{L}"), plain).otherwise("")


def held_out(doc_id: Column) -> Column:
    """Rows that are never learnt from: crc32 of the id's text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def learn(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", texts: int = TEXTS, piece: int = PIECE) -> list[Language]:
    """The languages of docs, the commonest first (then by name).

    Rows without a language or without letters teach nothing; without any such row the
    list is empty. Repeated texts count once. Only narrow rows of hashes are shuffled, and
    each task hands on no more than `texts` of a language, however common it is.
    """
    rows = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text")).filter("lang IS NOT NULL AND text IS NOT NULL")
    hashed = rows.withColumn("h", F.xxhash64("text"))
    names = hashed.filter(F.col("text").rlike(r"\p{L}")).select("lang", "h").distinct()
    counts = {r["lang"]: r["n"] for r in names.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # a row a language
    first = names.withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy("h"))).filter(F.col("place") <= texts).drop("place")
    if sum(min(n, texts) for n in counts.values()) <= FEW:
        first = F.broadcast(first)
    whole = hashed.join(first, ["lang", "h"], "left_semi").select("lang", "h", letters(F.col("text")).alias("t"))
    at = F.pmod(F.col("h"), F.ceil(F.length("t") / piece)) * piece + 1
    pieces = whole.select("lang", "h", F.substring(F.col("t"), at.cast("int"), F.lit(piece)).alias("part")).groupBy("lang", "h").agg(F.min("part").alias("part"))
    got: dict[str, list[tuple[int, str]]] = {}
    for r in pieces.collect():  # at most `texts` pieces a language
        got.setdefault(r["lang"], []).append((r["h"], r["part"]))
    made = [Language(lang, counts[lang], " ".join(p for _, p in sorted(own)).encode("utf-8")) for lang, own in got.items()]
    return sorted(made, key=lambda x: (-x.count, x.name))


class Coders:
    """One compressor a language."""

    def __init__(self, languages: list[Language], level: int = LEVEL, block: int = BLOCK) -> None:
        self.block, self.coders = block, []
        for x in languages:
            held = zstandard.ZstdCompressionDict(x.content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            held.precompute_compress(level=level)
            self.coders.append(zstandard.ZstdCompressor(level=level, dict_data=held, write_content_size=False, write_checksum=False, write_dict_id=False))

    def sizes(self, text: str) -> list[int]:
        data = text.encode("utf-8", "replace")
        blocks = [data[i : i + self.block] for i in range(0, len(data), self.block)]
        return [sum(len(c.compress(b)) for b in blocks) for c in self.coders]


def decide(sizes: list[int]) -> tuple[int, float, int, bool]:
    """(place of the smallest, score, margin in bytes, whether the margin is narrow).

    Ties go to the first. The score takes each byte more as half as likely, and is the
    winner's share; a single language has the score 1 and no margin to be narrow.
    """
    best = min(sizes)
    won, rest = sizes.index(best), sorted(sizes)[1:]
    score = 1.0 / sum(2.0 ** -min(s - best, 1000) for s in sizes)
    margin = rest[0] - best if rest else best
    return won, score, margin, bool(rest) and (margin < LEAST_BYTES or margin < LEAST_SHARE * rest[0])


def classify(docs: DataFrame, languages: list[Language], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, lang_pred, score (0 to 1), margin (bytes), rejected.

    A null text and one without letters is `und` with the score 0, rejected; so is every
    text where no language was learnt. Whole texts of any length are compressed, repeated rows
    get equal answers, an empty table gives no rows, and other columns are not looked at.
    """
    shared = docs.sparkSession.sparkContext.broadcast(languages)  # TEXTS * PIECE characters a language at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.name for x in shared.value]
        coders = Coders(shared.value)
        for batch in batches:
            out = []
            for t in batch.column(1):
                text = t.as_py()
                if not text or not names:
                    out.append((NONE, 0.0, 0, True))
                else:
                    won, score, margin, narrow = decide(coders.sizes(text))
                    out.append((names[won], score, margin, narrow))
            cols = list(zip(*out, strict=True)) or [[]] * 4
            kinds = [pa.string(), pa.float64(), pa.int64(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))], names=["doc_id", "lang_pred", "score", "margin", "rejected"])

    rows = docs.select(F.col(id_col).alias("doc_id"), letters(F.coalesce(F.col(text_col), F.lit(""))).alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double, margin bigint, rejected boolean")
