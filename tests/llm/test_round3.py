"""Language by compression, the prefix trie and vector codes against plain versions."""

import hashlib
import math
import os
import random
import zlib
from collections import Counter, defaultdict

import pytest
import regex
import zstandard
from pyspark.sql import functions as F

from corpusloom.llm import langid, prefix_trie, vector_codes
from corpusloom.llm.common import Scratch

SF = "/root/testdata/sf0.01"
tables = pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")

# language by compression

WORDS = {"aa": ["kalu", "mira", "tovan", "selk", "ornu", "bial"], "bb": ["pfest", "grunz", "achter", "wolm", "zirk", "ums"], "cc": ["èlou", "ñandi", "çasse", "ûvre", "oie", "lô"]}
DOCS = "doc_id long, text string, lang string, stats string, h long, margin string"


def _docs(n=60, seed=5):
    rng = random.Random(seed)
    return [(i, " ".join(rng.choice(WORDS[lang]) for _ in range(rng.randint(3, 60))), lang, "s", 1, "m") for i, lang in enumerate(rng.choices(sorted(WORDS), [6, 3, 1], k=n))]


def _plain_sizes(languages, text):
    """Each block's size by a compressor made anew."""
    t = " ".join(regex.findall(r"[\p{L}\p{M}]+", text.lower())).encode()
    make = lambda x: zstandard.ZstdCompressor(level=langid.LEVEL, dict_data=zstandard.ZstdCompressionDict(x.content, dict_type=zstandard.DICT_TYPE_RAWCONTENT), write_content_size=False, write_checksum=False, write_dict_id=False)
    return [sum(len(make(x).compress(t[i : i + langid.BLOCK])) for i in range(0, len(t), langid.BLOCK)) for x in languages]


def test_languages_are_the_smallest_sizes(spark):
    rows = _docs()
    docs = spark.createDataFrame(rows, DOCS)
    languages = langid.learn(docs)
    assert [(x.name, x.count) for x in languages] == sorted(((k, len({t for _, t, lang, *_ in rows if lang == k})) for k in WORDS), key=lambda x: (-x[1], x[0]))
    odd = [(100, None), (101, ""), (102, "12 34 -- !!"), (103, "KALU!! mira 7 Tovan"), (104, "x"), (105, "kalu grunz " * 20000), (None, "pfest achter"), (106, "pfest achter"), (106, "pfest achter")]
    got = langid.classify(spark.createDataFrame(rows + [(i, t, None, "", 0, "") for i, t in odd], DOCS), languages).collect()
    assert len(got) == len(rows) + len(odd) and got[0].asDict().keys() == {"doc_id", "lang_pred", "score", "margin", "rejected"}
    want = []
    for i, t in [r[:2] for r in rows] + odd:
        if not t or not regex.search(r"\p{L}", t):
            want.append((i, "und", 0.0, 0, True))
            continue
        s = _plain_sizes(languages, t)
        a, b = sorted(s)[:2]
        want.append((i, languages[s.index(a)].name, 1 / sum(2.0 ** -min(x - a, 1000) for x in s), b - a, b - a < 3 or b - a < 0.01 * b))
    key = lambda r: (r[0] is None, r)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_nothing_to_learn_from(spark):
    rows = [(1, "kalu", None, "", 0, ""), (2, None, "aa", "", 0, ""), (3, "12", "aa", "", 0, "")]
    docs = spark.createDataFrame(rows, DOCS)
    assert langid.learn(docs) == []
    assert [tuple(r) for r in langid.classify(docs, []).orderBy("doc_id").collect()] == [(i, "und", 0.0, 0, True) for i in (1, 2, 3)]
    one = langid.learn(docs.withColumn("lang", F.lit("aa")))
    assert [(r["lang_pred"], r["score"], r["rejected"]) for r in langid.classify(docs.filter("doc_id = 1"), one).collect()] == [("aa", 1.0, False)]
    assert langid.classify(docs.filter("false"), one).count() == 0


def test_copies_do_not_fill_a_dictionary(spark):
    rows = [(i, "kalu mira", "aa", "", 0, "") for i in range(300)] + [(1000 + i, f"tovan selk {chr(97 + i)}", "aa", "", 0, "") for i in range(20)]
    (language,) = langid.learn(spark.createDataFrame(rows, DOCS), texts=21)
    assert language.count == 21 and language.content.count(b"tovan") == 20 and language.content.count(b"kalu") == 1


@tables
def test_held_out_languages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = langid.classify(docs, langid.learn(docs.filter(~langid.held_out(F.col("doc_id")))))
    rows = out.join(docs.select("doc_id", "lang", "text"), "doc_id").collect()
    held = [r for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2 and r["lang_pred"] != "und"]
    assert len(held) > 200 and sum(r["lang"] == r["lang_pred"] for r in held) >= 0.98 * len(held)
    sure = [r for r in held if not r["rejected"]]
    assert len(sure) > 0.95 * len(held) and sum(r["lang"] == r["lang_pred"] for r in sure) >= 0.99 * len(sure)


# prefix trie

TURNS = "conv_id long, turn long, role string, text string, depth string, size string"


def _plain_trie(rows):
    md5 = lambda r: hashlib.md5(f"{len(r[0])}:{r[0]}{r[1]}".encode()).hexdigest()
    own = defaultdict(list)
    for c, t, role, text, *_ in rows:
        if c is not None:
            own[c].append((t is not None, t or 0, (role or "", text or "")))
    own = {c: [x[2] for x in sorted(v, key=lambda x: (x[0], x[1], md5(x[2])))] for c, v in own.items()}
    built = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = tuple(own.get(c - int(math.fmod(c, 20)), [])[:h] + v[h:])
    members = defaultdict(list)
    for c, v in built.items():
        for d in range(len(v) + 1):
            members[v[:d]].append(c)
    out = []
    for node, own_members in members.items():
        below = [n for n in members if n[: len(node)] == node]
        child = lambda n: sum(1 for m in members if len(m) == len(n) + 1 and m[: len(n)] == n)
        words = lambda n: len(regex.findall(r"[^\x20\x09-\x0D]+", n[-1][1])) if n else 0
        ends = ",".join(map(str, sorted(c for c in own_members if len(built[c]) == len(node))))
        parent = min(members[node[:-1]]) if node else None
        out.append((min(own_members), len(node), parent, len(own_members), child(node), sum(child(n) == 0 for n in below), sum((len(members[n]) - 1) * words(n) for n in below), hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out)


def _conversations(seed, convs=70, longest=7):
    rng, rows = random.Random(seed), []
    for _ in range(convs):
        c = rng.choice([*range(-5, 45), *range(60, 130)])
        for t in range(rng.randint(1, longest)):
            rows.append((c, rng.choice([t, t, t, None, 0]), rng.choice(["user", "assistant", None]) if rng.random() < 0.2 else ("user", "assistant")[t % 2], rng.choice(["a b", "a", "", None, " \t", "c  d e"]) if rng.random() < 0.3 else "a b", "x", "y"))
    return rows + rows[:5] + [(None, 1, "user", "lost", "x", "y")]


@pytest.mark.parametrize("seed", range(4))
def test_trie_equals_plain(spark, seed, monkeypatch):
    if seed % 2:  # blocks and id texts of two, so that every sum crosses them
        monkeypatch.setattr(prefix_trie, "IDS", 2)
        monkeypatch.setattr(prefix_trie.running, "__defaults__", (False, 2))
    rows = _conversations(seed)
    got = prefix_trie.prefix_trie(spark.createDataFrame(rows, TURNS))
    assert sorted(map(tuple, got.collect()), key=lambda r: r[:2]) == _plain_trie(rows)


def test_trie_of_snapshots(spark):
    """Each conversation goes on where the last one ended, so chains hang on chains: 40 levels."""
    rows = [(1000 + 20 * c, t, "u", f"t{t}", "", "") for c in range(40) for t in range(c + 1)]
    assert sorted(map(tuple, prefix_trie.prefix_trie(spark.createDataFrame(rows, TURNS)).collect()), key=lambda r: r[:2]) == _plain_trie(rows)


def test_trie_of_copies_and_none(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "IDS", 16)
    rows = [(20 * c, t, "u", f"t{t}", "", "") for c in range(150) for t in range(3)]
    assert sorted(map(tuple, prefix_trie.prefix_trie(spark.createDataFrame(rows, TURNS)).collect()), key=lambda r: r[:2]) == _plain_trie(rows)
    assert prefix_trie.prefix_trie(spark.createDataFrame([], TURNS)).count() == 0
    assert prefix_trie.prefix_trie(spark.createDataFrame([(None, 1, "u", "x", "", "")], TURNS)).count() == 0


def test_one_conversation_with_all_turns(spark):
    """Places and running sums cross partitions and blocks."""
    rows = spark.range(5000).select(F.lit(7).cast("long").alias("g"), (F.col("id") % 1000).alias("t"))
    got = prefix_trie.numbered(rows, ["g"], ["t"], "at", Scratch(spark, "test")).withColumn("one", F.lit(1).cast("long")).collect()
    assert sorted(r["at"] for r in got) == list(range(5000)) and all(r["at"] // 5 == r["t"] for r in got)
    summed = prefix_trie.running(spark.createDataFrame(got), ["g"], "at", ["one"]).collect()
    assert all(r["one"] == r["at"] + 1 for r in summed)


# vector codes

VECTORS = "vec_id long, embedding array<float>, label int, code string, part int"


def _plain_codes(rows):
    kept = [(i, v, label) for i, v, label, *_ in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    number = {k: [math.floor(4096 * x) if abs(x) < 1e30 else int(x) * 4096 for x in v] for k, (_, v, _) in enumerate(kept)}
    first = sorted(number, key=lambda k: (kept[k][0] is None, kept[k][0]))[:16]
    w = len(number[first[0]]) // 8
    cut = {k: [v[p * w : (p + 1) * w] for p in range(8)] for k, v in number.items() if len(v) == 8 * w}
    books = [[cut[k][p] for k in first if k in cut] for p in range(8)]
    gap = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    near = lambda: {k: [min((gap(x, e), j) for j, e in enumerate(books[p])) for p, x in enumerate(v)] for k, v in cut.items()}
    for _ in range(6):
        got = near()
        for p in range(8):
            for j in range(len(books[p])):
                own = [cut[k][p] for k in cut if got[k][p][1] == j]
                if own:
                    books[p][j] = [sum(c) // len(own) for c in zip(*own, strict=True)]
    got, sums = near(), Counter()
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    error = {k: sum(d for d, _ in v) for k, v in got.items()}
    for k, e in error.items():
        sums[kept[k][2]] += e
    return [(kept[k][0], "".join(f"{j:02x}" for _, j in got[k]), error[k], sums[kept[k][2]], sha) for k in cut]


@pytest.mark.parametrize("scale", [0.05, 1.0, 300.0])
def test_codes_equal_a_search_of_all_entries(spark, scale):
    rng = random.Random(int(scale))
    draw = lambda: float(rng.choice([rng.gauss(0, scale), rng.randint(-2, 2) * scale]))
    rows = [(i, [round(draw() * 64) / 64 for _ in range(16)], rng.choice([1, 2, None]), "c", 1) for i in range(150)]
    rows += rows[:40] + [(1000 + i, rows[3][1], 2, "c", 1) for i in range(60)]
    rows += [(None, rows[9][1], None, "", 0), (2000, None, 1, "", 0), (2001, [None] * 16, 1, "", 0), (2002, [math.nan] * 16, 1, "", 0), (2003, [math.inf] * 16, 1, "", 0)]
    got = vector_codes.compress(spark.createDataFrame(rows, VECTORS).repartition(5)).collect()
    key = lambda r: (r[0] is None, r)
    assert sorted(map(tuple, got), key=key) == sorted(_plain_codes(rows), key=key)


def test_codes_of_few_odd_and_huge_vectors(spark):
    few = [(i, [float(i)] * 8, 1, "", 0) for i in range(3)]
    assert sorted(map(tuple, vector_codes.compress(spark.createDataFrame(few, VECTORS)).collect())) == sorted(_plain_codes(few))
    odd = [*few, (7, [1.0] * 9, 1, "", 0), (8, [], 2, "", 0)]
    assert sorted((r["vec_id"], r["code"], r["error"], r["label_error"]) for r in vector_codes.compress(spark.createDataFrame(odd, VECTORS)).collect() if r["code"] is None) == [(7, None, None, 0), (8, None, None, None)]
    assert vector_codes.compress(spark.createDataFrame([], VECTORS)).count() == 0
    huge = [(i, [float((i * 37 + j * 11) % 23 - 11) * 2.0**120 for j in range(16)], 1, "", 0) for i in range(40)]
    got = {r["vec_id"]: (r["code"], r["codebooks_sha256"]) for r in vector_codes.compress(spark.createDataFrame(huge, VECTORS)).collect()}
    assert got == {r[0]: (r[1], r[4]) for r in _plain_codes(huge)}
