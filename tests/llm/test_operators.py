"""Training-data operators against brute-force versions, on small frames with odd rows."""

import hashlib
import random
import re
import unicodedata
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import bpe, chat, decontamination, html_extract, neardup, pii, quality, sharding, syncmers, token_counts, wordhash
from tests.llm import plain

WORD_BPE, PIECE_BPE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("piece_bpe_32k.model")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n long, sig string, stats string, label long, ids string, bin int, shard int, rng int"


def frame(spark, rows):
    """Documents with extra columns whose names clash with inner ones."""
    return spark.createDataFrame([(i, t, None, "s", None, 1, "x", "y", 2, "z", 3, 4, 5) for i, t in rows], SCHEMA)


def vocabulary(rng, n):
    return ["".join(rng.choice("abcdeéßABC") for _ in range(rng.randint(1, 7))) for _ in range(n)]


@pytest.fixture(scope="module")
def texts():
    """Prose with copies, near copies, a passage that many share, and odd texts."""
    rng = random.Random(8)
    v = vocabulary(rng, 400)
    say = lambda n: " ".join(rng.choice(v) for _ in range(n))
    passage = say(60)
    out = [say(rng.randint(1, 200)) for _ in range(60)]
    out += [out[3]] * 4 + [out[4] + " tail"]
    base = say(150).split()
    for _ in range(45):  # a group of near copies
        w = list(base)
        for _ in range(rng.randint(0, 4)):
            w[rng.randrange(len(w))] = rng.choice(v)
        out.append(" ".join(w))
    out += [say(rng.randint(5, 40)) + "\n" + passage + "\t" + say(rng.randint(5, 40)) for _ in range(45)]
    out += [None, "", " \n\t", "one", "one two", "One  two", "x" * 50_000, "long " * 30_000, "…", " ", "a\x00b", "😀 😀"]
    return list(enumerate(out))


def all_rows(texts):
    return [*texts, (7, texts[7][1]), (None, "no id here at all"), (2**62 + 1, "a large id")]


def test_sharding(spark, texts):
    rows = [*texts, (None, "x"), (5, texts[5][1])]
    got = sharding.assign(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    by = defaultdict(list)
    sizes = defaultdict(list)
    for i, t in rows:
        sizes[i].append((len((t or "").encode()) + 1, zlib.crc32((t or "").encode())))
    for r in got:
        assert (r["size"], r["text_crc32"]) in sizes[r["doc_id"]] and r["law"] == "key"
        assert r["grown_shard"] in (r["shard"], 8)
        by[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in by.values()) and set(by) <= set(range(8))
    assert {r["doc_id"]: r["shard"] for r in got} == {r["doc_id"]: r["shard"] for r in sharding.assign(frame(spark, rows[::-1])).collect()}
    assert sharding.assign(frame(spark, [])).count() == 0
    with pytest.raises(ValueError):
        sharding.fleet(7)


def test_tree_moves_keys_only_where_weights_change(spark):
    def tree(w):
        return sharding.branch("", [sharding.branch("a", [sharding.Node("0", 1.0, (), 0), sharding.Node("1", w, (), 1)]), sharding.branch("b", [sharding.Node("2", 2.0, (), 2), sharding.Node("3", 1.0, (), 3)])])

    ids = spark.range(20_000).select(F.col("id").cast("string").alias("k"))
    got = ids.select("k", sharding.shard_of(F.col("k"), tree(1.0)).alias("x"), sharding.shard_of(F.col("k"), tree(3.0)).alias("y")).toPandas()
    assert not ((got.x < 2) & (got.y >= 2)).any() and not ((got.x >= 2) & (got.y >= 2) & (got.x != got.y)).any()
    share = got.y.value_counts(normalize=True)
    assert abs(share[1] - 3 / 7) < 0.02 and abs(share[2] - 2 / 7) < 0.02
    grown = ids.select(sharding.shard_of(F.col("k"), sharding.fleet(11)).alias("x"), sharding.shard_of(F.col("k"), sharding.fleet(12)).alias("y")).toPandas()
    assert set(grown[grown.x != grown.y].y) == {11}


PAGES = [
    ("https://a.example/1", "<html><body><nav><a href=/>Home</a></nav><div class='c12 x'><h1>T &amp; t</h1><p>First <b>bold<br> text of some length that counts as prose.<p>Second &lt;p&gt;\n  wide space, and again some length of prose.</div><div class=sidebar>Side</div><footer>F</footer></body></html>", "T & t\nFirst bold text of some length that counts as prose.\nSecond <p> wide space, and again some length of prose."),
    ("https://a.example/2", "<html><body><nav>n</nav><div class='x c7'><p>Short.</div><div class='z'><p>A much longer paragraph which is not where this host keeps its text, so it should stay out of it.</div><footer>F</footer></body></html>", "Short."),
    ("https://a.example/3", "<body><div class='c1 x'><p>Kept one, which is prose of a fair length indeed.<form><input>gone</form><div class='comments'>gone</div><aside>gone</aside><script>var a='</p>'</script><ul><li>i<li>ii</ul></div>", "Kept one, which is prose of a fair length indeed.\ni\nii"),
    ("https://b.example/", "<article><p>Cut off in a tag, but its text is all here and long enough.<p", "Cut off in a tag, but its text is all here and long enough."),
    ("nowhere", "<main><p>No host, so its own best container counts here.</p></main><div class=ad>x</div>", "No host, so its own best container counts here."),
    (None, "<p>", ""),
    ("https://c.example/", None, ""),
    ("https://c.example/", "", ""),
    ("https://d.example/", "plain &#x41;&hellip; < b", "plain A… < b"),
    ("https://e.example/", "<table><tr><td>one cell of text<td>two cells of text</table>", "one cell of text\ntwo cells of text"),
    ("https://f.example/", "<body>İ<script>var x='İ'</SCRIPT><p>All of this text comes after the script, and is long enough.</body>", "İ\nAll of this text comes after the script, and is long enough."),
    ("https://g.example/", "<body><form id=f><div><p>A page whose body is wrapped in a form; its prose is here and is long enough.</p><input></div></form></body>", "A page whose body is wrapped in a form; its prose is here and is long enough."),
    ("https://h.example/", "<body><div class='post share-layout'><h1>T</h1><p>The wrapper's class shares a word with boilerplate, but holds all the prose.</p><div class='share'>tweet</div></div></body>", "T\nThe wrapper's class shares a word with boilerplate, but holds all the prose."),
    ("https://i.example/", "<body><header>Site</header><article><header><h1>Title of it</h1></header><p>The text of the article is here, and long enough to be prose.</p></article></body>", "Title of it\nThe text of the article is here, and long enough to be prose."),
    ("https://j.example/", "<body><article><p>Short article text that is long enough to be prose here.</p></article><div class=comments>" + "<p>What a reader says about it at length, again and again, and more.</p>" * 9 + "</div></body>", "Short article text that is long enough to be prose here."),
    ("https://k.example/", "<div class=a>" * 300 + "<p>Deep inside of it all there is a text of a fair length.</p>" + "</div>" * 300 + "<nav>n</nav>", "Deep inside of it all there is a text of a fair length."),
]


def test_html(spark):
    rows = [(i, u, h, "path", "host") for i, (u, h, _) in enumerate(PAGES)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, path string, paths string")
    got = {r["page_id"]: r["text"] for r in html_extract.extract(df).collect()}
    for i, (_, _, want) in enumerate(PAGES):
        assert got[i] == want, i
    assert html_extract.extract(df.limit(0)).count() == 0
    twice = html_extract.extract(df.union(df)).collect()
    assert len(twice) == 2 * len(PAGES)


def test_html_votes(spark):
    """Votes and second reading against plain counting, with nulls and repeated pages."""
    rng = random.Random(5)
    prose = lambda: " ".join("".join(rng.choice("aeinorst") for _ in range(rng.randint(2, 9))) for _ in range(rng.randint(8, 40))) + "."
    pages = []
    for i in range(300):
        main, side = rng.choice([("article", "div class='x3 y'"), ("div class='x7 y'", "section"), ("div id=q class=z", "div class='x1 y'")])
        html = f"<body><nav>menu</nav><{main}>{''.join(f'<p>{prose()}' for _ in range(rng.randint(1, 4)))}</{main.split()[0]}><{side}><p>{prose()}</{side.split()[0]}></body>"
        pages.append((rng.choice([i, i, 7, None]), f"http://h{rng.randrange(3)}.example/{i}" if rng.random() < 0.9 else None, html))
    pages += pages[:20] + [(None, None, None), (1, "http://h1.example/", "")]
    votes, worth, depth = defaultdict(Counter), Counter(), {}
    for _, url, html in pages:
        if url and html:
            path, deep, score = html_extract.Page(html).ranked()[0]
            host = url.split("/")[2]
            votes[host][path] += 1
            worth[host, path] += round(score)
            depth[host, path] = min(deep, depth.get((host, path), deep))
    won = {h: sorted((p for p in v if v[p] * 20 >= sum(v.values())), key=lambda p: (-v[p], -worth[h, p], depth[h, p], p)) for h, v in votes.items()}
    want = [(i, u, html_extract.Page(h).main_text(won[u.split("/")[2]] if u else []) if h else "") for i, u, h in pages]
    got = html_extract.extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert any(len(v) > 1 for v in won.values())


def test_html_keeps_articles(spark):
    """A winning path that holds nothing on a page, and boilerplate that is never closed, cost no article."""
    prose = lambda n: " ".join(f"Sentence number {i} of the article is here." for i in range(n))
    post = lambda a, b="": f"<html><body><div class=post>{a}</div>{b}</body></html>"
    pages = [post(f"<p>{prose(8)}</p>"), post(f"<p>{prose(9)}</p>"), post("<p> </p><nav>More</nav>", f"<div class=story><p>{prose(10)}</p></div>"), post("", f"<div class=body><p>{prose(6)}</p></div>")]
    pages += [f"<body><nav><a href=x>Home</a><article><p>{prose(7)}</p></article></body>", f"<body><header><h2>Site name</h2><main><p>{prose(5)}</p></main></body>"]
    df = spark.createDataFrame([(i, "http://one.example/" + str(i), h) for i, h in enumerate(pages)], "page_id long, url string, html string")
    got = [r["text"] for r in html_extract.extract(df).orderBy("page_id").collect()]
    assert got == [prose(8), prose(9), prose(10), prose(6), prose(7), prose(5)]
    closed = f"<body><aside><article><p>{prose(3)}</p></article></aside><article><p>{prose(9)}</p></article></body>"
    assert html_extract.Page(closed).main_text([]) == prose(9)


def test_html_reader_is_linear():
    import time

    for unit in ("<div>", "<p><b>", "<a href='", "<!--", "&lt;", "<script>", "</p>", "<li>", "<x y=\"", "a < b "):
        began = time.time()
        html_extract.Page(unit * 20_000).main_text([])
        assert time.time() - began < 20, unit


@pytest.mark.parametrize("block", [1 << 20, 400])
def test_decontamination(spark, texts, block, monkeypatch):
    monkeypatch.setattr(decontamination.blocks, "__defaults__", ("item_id", "text", block))
    rng = random.Random(2)
    v = vocabulary(rng, 40)
    say = lambda n: [rng.choice(v) for _ in range(n)]
    items = [(i, " ".join(say(rng.randint(1, 60)))) for i in range(30)] + [(30, None), (31, ""), (32, "?!"), (33, "the the the the the the the the the the the the"), (0, "x y z"), (None, "q w e r t y u i o p")]
    docs = [(i, " ".join(say(rng.randint(0, 120)))) for i in range(80)]
    for i in range(40):
        src = items[rng.randrange(30)][1].upper().split()
        a = rng.randrange(len(src))
        docs.append((100 + i, " ".join(say(9) + src[a : a + rng.randint(1, 25)] + say(9)).replace(" ", rng.choice([" ", "-", ".\n"]))))
    docs += [(200, "the " * 40), (201, None), (202, ""), (203, "Q w, e r t y u i o p!"), (None, "x y z"), (203, "Q w, e r t y u i o p!")]
    bench = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc_id long")
    got = sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in decontamination.scan(frame(spark, docs), bench).collect()), key=repr)
    assert got == sorted(plain.windows(docs, items), key=repr)
    clean = {r["doc_id"] for r in decontamination.drop_contaminated(frame(spark, docs), bench).collect()}
    assert clean == {i for i, _, n, _ in plain.windows(docs, items) if not n}
    assert decontamination.scan(frame(spark, docs), bench.limit(0)).filter("contaminated").count() == 0
    assert decontamination.scan(frame(spark, []), bench).count() == 0


def test_every_shared_span_has_a_common_fingerprint():
    rng = random.Random(4)
    for _ in range(200):
        w = [rng.choice("abc") for _ in range(rng.randint(10, 14))]
        a = wordhash.words([" ".join(["x1", *w, "x2"]).encode()], wordhash.ALNUM)
        b = wordhash.words([" ".join(["y1", "y2", *w]).encode()], wordhash.ALNUM)
        assert set(decontamination.kept(a)[1].tolist()) & set(decontamination.kept(b)[1].tolist())


def test_words_of_long_texts_are_cut_at_word_ends(monkeypatch):
    rng = random.Random(6)
    text = " ".join("w" * rng.randint(1, 30) + str(rng.random()) for _ in range(3000)).encode()
    whole = wordhash.words([text, b"", b"a b"], wordhash.NONSPACE)
    monkeypatch.setattr(wordhash, "PIECE", 64)
    parts = wordhash.words([text, b"", b"a b"], wordhash.NONSPACE)
    assert (whole.hash == parts.hash).all() and (whole.first == parts.first).all() and whole.first.tolist()[-2:] == [3000, 3002]


def slow_base(t):
    out = [(m.start(), "email", m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(m.start(), "ip", m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[ -]", "", m[0])
        if 14 <= len(d) <= 19 and pii.luhn(d):
            out.append((m.start(), "card", m.end()))
    out += [(m.start(), "phone", m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 10 <= len(re.findall("[0-9]", m[0])) <= 15]
    return sorted(out, key=lambda s: (s[0], pii.KINDS.index(s[1]), s[2]))


def test_base_spans():
    rng = random.Random(3)
    fixed = ["a@b.c", "a@b@c.de", "@x.y", "1.2.3.4.5.6.7.8", "256.1.1.1", "0001.02.3.4", "4111 1111 1111 1111", "4111-1111-1111-1111-2", "+1 (555) 010-9999", "+1 55", "é1.2.3.4", "1" * 3000, "a" * 3000 + "@", "a@" * 500, "+1 2" * 500, "1 " * 3000]
    for t in fixed + ["".join(rng.choice("0123456789012345+@. -()abA_%é\n") for _ in range(rng.randint(0, 70))) for _ in range(20_000)]:
        assert pii.base_spans(t) == slow_base(t), t


def letters_to_readers(n, seed):
    """Sentences of another kind than the field is trained on: whole prose with names, and data in forms of their own."""
    rng = random.Random(seed)
    some = lambda k: "".join(rng.choice("0123456789") for _ in range(k))
    names = ["maria", "jonas.weber", "l_olsen", "Petra", "k-tanaka", "amadou.diallo", "sven99"]
    places = ["northwind", "blue-harbour", "uni-kiel", "lakeside", "quarry", "mail.example"]

    def card():
        d = rng.choice(["4", "51", "6011"])
        d += some(15 - len(d))
        d += next(c for c in "0123456789" if pii.luhn(d + c))
        return rng.choice([" ", "-", ".", ""]).join(d[x : x + 4] for x in range(0, 16, 4))

    def phone():
        return rng.choice([f"({rng.randint(201, 989)}) {some(3)}-{some(4)}", f"{rng.randint(201, 989)}-{some(3)}-{some(4)}", f"{rng.randint(201, 989)} {some(3)} {some(4)}", f"+44 {some(4)} {some(6)}", f"0{some(2)} {some(4)} {some(4)}", f"+33 {some(1)} {some(2)} {some(2)} {some(2)} {some(2)}", f"0049 {some(3)} {some(4)} {some(3)}"])

    def email():
        a, b, c = rng.choice(names), rng.choice(places), rng.choice(["org", "com", "de", "net", "fr"])
        return rng.choice([f"{a}@{b}.{c}", f"{a} (at) {b} (dot) {c}", f"{a} [at] {b} [dot] {c}", f"{a} at {b} dot {c}", f"{a}[at]{b}.{c}", f"{a}(at){b}(dot){c}"])

    def ip():
        return rng.choice([".", "[.]", " dot ", "(.)"]).join(str(rng.randint(1, 254)) for _ in range(4))

    frames = {
        "phone": ["If the ferry is late, ring the office on {} before noon.", "Her new telephone is {}, he said.", "Reach us under {} at any hour!", "Ask for Mrs Lindqvist ({})."],
        "email": ["Manuscripts go to {} by the end of May.", "You may write to {}, and we shall answer.", "The editor, {}, sends regards.", "Contact: {}"],
        "card": ["They charged it to {} twice.", "The stolen card, {}, was blocked.", "Pay with Visa {} at the desk."],
        "ip": ["The server at {} went down in the storm.", "Every packet came from {}; nobody knew why.", "Our gateway is {}."],
    }
    plain = ["The bridge of 1887 was 2.450 metres long and cost 14,300 crowns.", "On 12.04.1931 some 300 people met at 7:30.", "See pages 114-118 of volume 3.", "Order 20240117-3381 left the yard at 16:05.", "Meet me at the dot on the map.", "Version 10.4.2 came out in 2019."]
    make = {"phone": phone, "email": email, "card": card, "ip": ip}
    for _ in range(n):
        text, spans = rng.choice(plain), []
        for kind in rng.sample(sorted(make), rng.randint(0, 2)):
            left, right = rng.choice(frames[kind]).split("{}")
            value = make[kind]()
            at = len(text) + 1 + len(left)
            text += " " + left + value + right
            spans.append((at, kind, at + len(value)))
        yield text + " " + rng.choice(plain), spans


def test_field_finds_what_patterns_miss(spark, texts):
    field = pii.trained()
    for made in ([(t, [(a, k, b) for a, b, k in s]) for t, s in pii.examples(300, 77)], list(letters_to_readers(1500, 3))):
        good, missed, bad = Counter(), Counter(), Counter()
        for text, want in made:
            base, got = pii.find_spans(text, field)
            assert set(base) <= set(got)
            good.update(k for _, k, _ in set(want) & set(got))
            missed.update(k for _, k, _ in set(want) - set(got))
            bad.update(k for _, k, _ in set(got) - set(want) - set(base))
        for k in pii.KINDS:
            assert good[k] >= 0.9 * (good[k] + missed[k]) and bad[k] <= 0.05 * (good[k] + bad[k]), (k, good, missed, bad)
    # formats that training sentences lack (but for the card in dots), and numbers that are none
    for kind, value in (("phone", "(415)555-0132"), ("phone", "07911 123456"), ("phone", "0121/4960123"), ("card", "4111/1111/1111/1111"), ("card", "4111  1111  1111  1111"), ("card", "3782.822463.10005"), ("card", "41111111/11111111")):
        t = f"the old record says {value} before noon"
        assert (20, kind, 20 + len(value)) in pii.find_spans(t, field)[1], value
    for t in ("IBAN DE89 3704 0044 0532 0130 00 now", "Order 4711-2023-0099-1234 came", "pages 120-135, 140-150", "in 1914-1918 and 1939-1945", "ISBN 978-3-16-148410-0"):
        assert pii.find_spans(t, field)[1] == [], t
    # a long run of triggers is one stretch, and the last one is found
    for n in (400, 401, 5000):
        t = "12 " * n + "call (415) 555-0132"
        assert (3 * n + 5, "phone", len(t)) in pii.find_spans(t, field)[1]
    t = "call (415) 555-0132 or write joe [at] example [dot] com now"
    assert any(k == "phone" for _, k, _ in pii.find_spans(t, field)[1])
    rows = [(1, t), (2, None), (3, ""), (4, "mail a@b.co"), (4, "mail a@b.co"), (5, "x" * 100_000), (None, "é 1.2.3.4")]
    got = sorted(((r["doc_id"], [tuple(s) for s in r["base"]]) for r in pii.detect(frame(spark, rows)).collect()), key=repr)
    assert got == sorted(((i, slow_base(x or "")) for i, x in rows), key=repr)
    clean = sorted(((r["doc_id"], r["text"]) for r in pii.redact(frame(spark, rows)).collect()), key=repr)
    assert (4, "mail <EMAIL>") in clean and (2, None) in clean and (3, "") in clean and (None, "é <IP>") in clean
    assert pii.detect(frame(spark, [])).count() == 0


def test_best_labelling_is_the_best_of_all():
    rng = np.random.default_rng(5)
    for _ in range(40):
        n = int(rng.integers(1, 7))
        cands = [(i, j, [int(rng.integers(0, len(pii.FEATURES)))]) for i in range(n) for j in range(i + 1, n + 1) if rng.random() < 0.5]
        field = pii.Field(rng.normal(0, 2, (4, len(pii.FEATURES))), rng.normal(0, 1, (5, 5)))
        place = {(i, j): on for i, j, on in cands}

        def all_ways(at, state):
            if at == n:
                yield 0.0, []
                return
            for s, rest in all_ways(at + 1, 0):
                yield s, rest
            for j in range(at + 1, n + 1):
                if (at, j) in place:
                    for k in range(4):
                        gain = field.w[k, place[at, j]].sum() - pii.MARGIN + field.t[state, k + 1]
                        for s, rest in all_ways(j, k + 1):
                            yield s + gain, [(at, j, k), *rest]

        ways = list(all_ways(0, 0))
        most = max(s for s, _ in ways)
        assert field.best(n, [[(j, on) for x, j, on in cands if x == i] for i in range(n)]) in [w for s, w in ways if s > most - 1e-9]


def test_syncmers(spark, texts):
    rows = all_rows(texts)
    got = sorted(((r["doc_id"], r["anchors"], r["fingerprint"]) for r in syncmers.fingerprint(frame(spark, rows)).collect()), key=repr)
    want = [(i, a, plain.fingerprint(a)) for i, t in rows for a in [plain.anchors(t)]]
    assert got == sorted(want, key=repr)
    assert len({p for i, t in texts for p in [plain.fingerprint(plain.anchors(t))] if t == texts[3][1]}) == 1


def test_ids_may_be_text(spark):
    rng = random.Random(6)
    v = vocabulary(rng, 60)
    rows = [(rng.choice(["a", "B", "é", "10", "9", "x y"]) + str(i), " ".join(rng.choice(v) for _ in range(rng.randint(0, 60)))) for i in range(120)]
    rows += [("copy" + str(i), rows[i][1]) for i in range(9)] + [(None, "no id")]
    df = spark.createDataFrame(rows, "doc_id string, text string")
    got = {r["doc_id"]: r for r in syncmers.compare_edited(df).collect()}
    order = sorted(rows, key=lambda r: (r[0] is not None, (r[0] or "").encode()))
    for (i, t), (_, after) in zip(order, [*order[1:], order[0]], strict=True):
        edited = t[: len(t) - len(t) // 2] + after[: len(t) // 2]
        r, a, e = got[i], plain.anchors(t), plain.anchors(edited)
        assert (r["edited_sha256"], r["fingerprint"], r["edited_fingerprint"]) == (hashlib.sha256(edited.encode()).hexdigest(), plain.fingerprint(a), plain.fingerprint(e)), i
        assert r["near_edited"] == pytest.approx(plain.alike(a, e)) and r["near_next"] == pytest.approx(plain.alike(a, plain.anchors(after)))
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in neardup.cluster(df, shingle=4).collect()), key=repr)
    assert got == sorted(plain.components(rows, 4, 80), key=repr)
    df.sparkSession.createDataFrame([("q", "no id")], "item_id string, text string").createOrReplaceTempView("one_item")
    assert [r["doc_id"] for r in decontamination.scan(df, spark.table("one_item")).filter("contaminated").collect()] == [None]
    assert pii.detect(df).count() == bpe.encode(df, WORD_BPE).count() == len(rows)


def test_every_text_with_words_has_an_anchor(spark):
    rng = random.Random(31)
    v = vocabulary(rng, 500)
    rows = [(i, " ".join(rng.choice(v) for _ in range(9 + i % 6))) for i in range(120)] + [(200, None), (201, ""), (202, " \n")]
    got = {r["doc_id"]: r for r in syncmers.fingerprint(frame(spark, rows)).collect()}
    assert all(bool(got[i]["anchors"]) == (i < 200) for i, _ in rows)
    out = syncmers.compare_edited(frame(spark, rows[:120])).collect()
    assert all(r["near_next"] < 1 for r in out) and len({r["fingerprint"] for r in out}) == 120


@pytest.mark.parametrize("range_rows", [4, 512])
def test_edited_texts(spark, texts, range_rows, monkeypatch):
    monkeypatch.setattr(syncmers, "RANGE_ROWS", range_rows)
    rows = [(i * 3 - 50, t) for i, t in texts] + [(None, "first of all")]
    out = syncmers.compare_edited(frame(spark, random.Random(1).sample(rows, len(rows)))).collect()
    order = [rows[-1], *rows[:-1]]
    after = {i: order[(k + 1) % len(order)][1] or "" for k, (i, _) in enumerate(order)}
    by = {r["doc_id"]: r for r in out}
    assert len(out) == len(rows)
    for i, t in rows:
        t = t or ""
        half = len(t) // 2
        edited = t[: len(t) - half] + after[i][:half]
        r = by[i]
        assert (r["n_chars"], r["edited_sha256"]) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        if edited == t:
            assert r["near_edited"] == 1.0 and r["fingerprint"] == r["edited_fingerprint"]
        if after[i] == t:
            assert r["near_next"] == 1.0
    lone = syncmers.compare_edited(frame(spark, [(1, "a b c d")])).collect()
    assert lone[0]["near_next"] == 1.0
    assert syncmers.compare_edited(frame(spark, [])).count() == 0


def test_bpe_equals_the_library(spark, texts):
    from tokenizers import Tokenizer

    path = WORD_BPE
    lib = Tokenizer.from_file(path)
    lib.no_truncation()
    lib.no_padding()
    rng = random.Random(9)
    alpha = "abcdefgh'strevmld  \n\t\x1c\x85\xa0​ÀÉéßẞİΣσςǅﬁ½²٣日本語🎉é<|>0123!?.,;İ"
    rows = all_rows(texts) + [(1000 + i, "".join(rng.choice(alpha) for _ in range(rng.randint(0, 60)))) for i in range(3000)]
    rows += [(9000, "<|endoftext|> a<|startoftext|>b <|endoftext|"), (9001, "ΑΣ ΣΑΣ."), (9002, "don't I'LL we've"), (9003, "a" * 5000)]
    want = sorted(((i, (e := lib.encode(t or "", add_special_tokens=False).ids), lib.decode(e, skip_special_tokens=False)) for i, t in rows), key=repr)
    out = bpe.round_trip(frame(spark, rows), path)
    assert sorted(((r["doc_id"], r["ids"], r["decoded"]) for r in out.collect()), key=repr) == want
    assert sorted((r["doc_id"], r["decoded"]) for r in bpe.decode(bpe.encode(frame(spark, rows[:50]), path), path).collect()) == sorted((r["doc_id"], r["decoded"]) for r in bpe.round_trip(frame(spark, rows[:50]), path).collect())
    assert bpe.encode(frame(spark, []), path).count() == 0


def test_bpe_knows_every_code_point_as_the_library_does():
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(WORD_BPE)
    lib.no_truncation()
    lib.no_padding()
    with open(WORD_BPE, encoding="utf-8") as f:
        m = bpe.WordBpe(f.read())
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    # one text per code point where characters are, and many of the empty and private planes in one text
    texts = [f"a{chr(c)}b 1{chr(c)}_!" for c in points if c < 0x40000 or 0xE0000 <= c < 0xE1000]
    rest = [c for c in points if c >= 0x40000 and not 0xE0000 <= c < 0xE1000]
    texts += [" ".join(f"a{chr(c)}b 1{chr(c)}_!" for c in rest[k : k + 4096]) for k in range(0, len(rest), 4096)]
    rng = random.Random(3)
    named = [c for c in points if unicodedata.category(chr(c)) not in ("Cn", "Co")]
    texts += ["".join(chr(rng.choice(named)) if rng.random() < 0.7 else rng.choice(" a'sB1") for _ in range(rng.randint(1, 30))) for _ in range(20_000)]
    for k in range(0, len(texts), 20_000):
        for t, e in zip(texts[k : k + 20_000], lib.encode_batch(texts[k : k + 20_000], add_special_tokens=False), strict=True):
            assert b"".join([x[0] for x in m.parts(t)]) == np.array(e.ids, dtype=np.int32).tobytes(), t


def test_cuts_change_nothing():
    with open(WORD_BPE, encoding="utf-8") as f:
        m = bpe.WordBpe(f.read())
    rng = random.Random(2)
    cut = 0
    for _ in range(3000):
        chars = "".join(m.chars[rng.choice(b"thequickbrownzxqjv'!%\xc3\xa9\xe6")] for _ in range(rng.randint(1, 24)))
        *rest, last = m.cut(chars)
        cut += bool(rest)
        ids = [x for f in rest for x in m.merge(f, False)] + list(m.merge(last, True))
        assert ids == list(m.merge(chars, True))
    assert cut > 500


def test_token_counts(spark, texts):
    v = token_counts.vocabulary(PIECE_BPE)

    def slow(w):
        b = [(0.0, 0)]
        for j in range(1, len(w) + 1):
            ways = [(-(b[i][0] + v[w[i:j]]), b[i][1] + 1) for i in range(max(0, j - 40), j) if w[i:j] in v]
            s, c = min(ways) if ways else (-(b[j - 1][0] + token_counts.UNKNOWN), b[j - 1][1] + len(w[j - 1].encode()))
            b.append((-s, c))
        return b[-1][1]

    rows = [(i, t) for i, t in all_rows(texts) if t is None or len(t) < 40_000] + [(500, "日本語 🎉🎉a"), (501, "é" * 300)]
    got = sorted(((r["doc_id"], r["n_pretokens"], r["n_tokens"]) for r in token_counts.count_tokens(frame(spark, rows), PIECE_BPE).collect()), key=repr)
    assert got == sorted(((i, len((t or "").split()), sum(slow(token_counts.MARK + w) for w in (t or "").split())) for i, t in rows), key=repr)
    trie = token_counts.Trie(v)
    trie.count("▁prefixes")
    before = trie.worked
    trie.count("▁prefixed")
    assert trie.worked == before + 1


@pytest.mark.parametrize("hot", [False, True])
def test_neardup(spark, texts, hot, monkeypatch):
    if hot:  # small lists and blocks, so that pivots and the last look-up have work
        monkeypatch.setattr(neardup, "LIST", 6)
        monkeypatch.setattr(neardup, "K", 24)
        monkeypatch.setattr(neardup, "FEW", 16)
        monkeypatch.setattr(neardup, "PIVOTS", 1)
        monkeypatch.setattr(neardup, "ROUNDS", 1)
        monkeypatch.setattr(neardup, "BLOCK", 20_000)
        monkeypatch.setattr(neardup, "ONE_TASK", 0)
    rows = [(500 - i, t) for i, t in texts] + [(7, texts[7][1]), (None, texts[3][1]), (2**62 + 1, "a large id")]
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in neardup.cluster(frame(spark, rows), shingle=4).collect()), key=repr)
    assert got == sorted(plain.components(rows, 4, 80), key=repr)
    kept = neardup.cluster(frame(spark, rows), shingle=4).filter("kept").collect()
    assert all(r["doc_id"] == r["component_id"] for r in kept)


def test_neardup_of_excerpts(spark):
    """Two near copies whose lists turn hot only by the deep values of longer texts."""
    rng = random.Random(21)
    v = vocabulary(rng, 4000)
    say = lambda n: [rng.choice(v) for _ in range(n)]
    passage = say(203)
    texts = [say(58) + passage + say(59) for _ in range(40)]
    for first in (20, 100):
        texts += [passage[first : first + 93], [*passage[first : first + 92], "other"]]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in neardup.cluster(frame(spark, rows), shingle=4).collect())
    assert got == plain.components(rows, 4, 80) and got[41][2] == 40 and got[43][2] == 42


def test_neardup_of_nothing(spark):
    assert neardup.cluster(frame(spark, [])).count() == 0
    got = neardup.cluster(frame(spark, [(1, None), (2, ""), (3, " ")])).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in got) == [(1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True)]


@pytest.mark.parametrize("one_task", [0, 200_000])
def test_components(spark, one_task, monkeypatch):
    monkeypatch.setattr(neardup, "ONE_TASK", one_task)
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(60)]
    df = spark.createDataFrame([(a.to_bytes(2, "big"), b.to_bytes(2, "big")) for a, b in edges], "a binary, b binary")
    up = {}

    def top(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    want = {x: top(x) for e in edges if e[0] != e[1] for x in e}
    assert {int.from_bytes(r["node"], "big"): int.from_bytes(r["label"], "big") for r in neardup.Clusters(df, 5, 80).components(df).collect()} == want


def test_quality(spark, texts):
    rng = random.Random(12)
    v = vocabulary(rng, 300)
    docs, labels = [], []
    for i in range(400):
        w = [rng.choice(v) for _ in range(rng.randint(10, 120))]
        bad = i % 4 == 0
        if bad:
            w = [x.upper() + "!!" for x in w] if i % 8 else [x + "***" for x in w]
        docs.append((i, " ".join(w)))
        labels.append((i, int(not bad), 0))
    df, lab = frame(spark, docs), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = quality.fit(df, lab)
    assert 0 < len(model.rules) < 60
    got = {r["doc_id"]: r["quality_score"] for r in quality.score(df, model).collect()}
    held = {r["doc_id"] for r in df.filter(quality.held_out(F.col("doc_id"))).collect()}
    assert held == {i for i, _ in docs if zlib.crc32(str(i).encode()) % 3 == 1}
    assert sum((got[i] >= 0.5) == (i % 4 != 0) for i in held) / len(held) > 0.95
    flipped = lab.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert quality.fit(df, flipped) == model  # held-out labels are not looked at
    odd = quality.score(frame(spark, all_rows(texts)), model)
    assert "stats" not in odd.columns and odd.filter("quality_score BETWEEN 0 AND 1").count() == len(all_rows(texts))
    assert quality.fit(df, lab.limit(0)).rules == () and quality.score(frame(spark, []), model).count() == 0
    stats = quality.statistics(pd.Series(["AB cd", None, ""]))
    assert stats.loc[0, "upper"] == 0.4 and stats.loc[1, "upper"] == 0 and stats.loc[2, "distinct_words"] == 1
    x = stats[quality.STATS].to_numpy()
    rule = quality.Rule((("upper", True, 0.1), ("log_bytes", False, 9.0)))
    assert rule.holds(x).tolist() == [True, False, False]


def test_statistics_and_scores_by_hand(spark, texts):
    """Every statistic letter by letter, and the compiled column against the rules one by one."""
    rows = all_rows(texts)[:-30] + [(900, "A line\nA line\r\nthird | line!?"), (901, "Ünï 123 *** <b> #x"), (902, "x")]
    got = quality.statistics(pd.Series([t for _, t in rows]))
    for k, (_, t) in enumerate(rows):
        assert {s: pytest.approx(got[s][k]) for s in quality.STATS} == plain.statistics(t), t
    rules = [(quality.Rule((("upper", True, 0.01), ("log_bytes", False, 6.0))), 1.5), (quality.Rule((("top_word", True, 0.2),)), -2.0), (quality.Rule((("distinct_lines", False, 0.9),)), 0.7)]
    model = quality.Model(0.3, tuple(rules))
    scored = {r["doc_id"]: r["quality_score"] for r in quality.score(frame(spark, rows), model).collect()}
    for i, t in rows:
        assert scored[i] == pytest.approx(plain.score(model, t))


def test_statistics_do_not_depend_on_neighbours():
    texts = ["A\nA", "A", "A\nA\nA", "b c\r\nA", "", None, "A\nb\nA", "A\n", "A\nA"]
    alone = pd.concat([quality.statistics(pd.Series([t])) for t in texts], ignore_index=True)
    assert quality.statistics(pd.Series(texts)).equals(alone)
    assert alone["distinct_lines"].tolist() == [1 / 2, 1, 1 / 3, 1, 1, 1, 2 / 3, 1, 1 / 2]


def slow_rotation(rows):
    """Turn by turn, with a running text."""
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        convs[conv].append(((turn is not None, turn or 0), role or "unknown", (text or "").replace("<|", "< |")))
    named = lambda role: role if re.fullmatch("[A-Za-z0-9_-]+", role) else re.sub("[^A-Za-z0-9_-]", "_", role) + "_" + hashlib.md5(role.encode()).hexdigest()[:16]
    out = {}
    for conv, turns in convs.items():
        turns.sort(key=lambda t: (*t[:2], hashlib.md5(t[2].encode()).hexdigest()))
        for seat in {r for _, r, _ in turns} - {"system"}:
            text, mask = "", []
            for _, role, said in turns:
                text += "<|system|>\n" if role == "system" else "<|assistant|>\n" if role == seat else f"<|user name={named(role)}|>\n"
                start = len(text)
                text += said + "<|end|>\n"
                if role == seat:
                    mask.append((start, len(text)))
            out[conv, seat] = (text, mask, len(turns))
    return out


def test_chat_of_sparse_numbers_and_like_names(spark):
    """Turn numbers may be times; roles that differ in signs only stay apart; rows without a conversation spread."""
    rows = [(1, 0, "system", "Be."), (1, 0, "a b", "one"), (1, 10_000, "a_b", "two"), (1, 1_700_000_000, "a-b", "three")]
    got = {r["participant"]: r for r in chat.rotate(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert set(got) == {"a b", "a_b", "a-b"} and all(r["n_turns"] == 4 and r["part"] == 0 for r in got.values())
    assert len(set(re.findall("user name=([^|]*)", got["a-b"]["rendered"]))) == 2
    many = spark.range(20_000).select(F.lit(None).cast("long").alias("conv_id"), F.lit(None).cast("long").alias("turn"), F.lit("u").alias("role"), F.col("id").cast("string").alias("text"))
    parts = chat.rotate(many).select("part", "n_turns").collect()
    assert sorted(map(tuple, parts)) == [(0, 4096), (1, 4096), (2, 4096), (3, 4096), (4, 3616)]


def test_chat(spark):
    rows = [(1, 0, "system", "Be."), (1, 1, "ann", "hi <|end|>"), (1, 2, "bob x", None), (1, 2, "bob x", None), (1, 3, "ann", "bye"), (1, 300, "bob x", "late"), (2, 0, "system", "alone"), (None, None, None, "lost"), (None, 3, "é日", "né")]
    rng = random.Random(8)
    rows += [(3, i, rng.choice(["a", "b", "c.d", "system"]), f"turn {i} " * rng.randrange(4)) for i in range(1000)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, part string, participant long")
    want = slow_rotation(rows)
    got = {(r["conv_id"], r["participant"]): r for r in chat.rotate(df).collect()}
    assert set(got) == set(want) and (1, "bob x") in got and (2, "system") not in got
    for key, (text, mask, n) in want.items():
        assert (got[key]["rendered"], [(m["start"], m["end"]) for m in got[key]["mask"]], got[key]["n_turns"], got[key]["part"]) == (text, mask, n, 0)
        assert got[key]["n_masked"] == sum(b - a for a, b in mask)
    # in small parts every participant has a row for every part, and the rows together are the dialogue
    rows += [(1, 7, "ann", str(i)) for i in range(30)]
    whole, parts = slow_rotation(rows), defaultdict(list)
    for r in chat.rotate(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), part=8).collect():
        parts[r["conv_id"], r["participant"]].append((r["part"], r["rendered"], [r["rendered"][m["start"] : m["end"]] for m in r["mask"]]))
    for key, (text, mask, _) in whole.items():
        own = sorted(parts[key])
        assert "".join(x[1] for x in own) == text and [s for x in own for s in x[2]] == [text[a:b] for a, b in mask], key
    assert chat.rotate(df.limit(0)).count() == 0
