"""Operators of the collection on small frames; expected rows are worked out by hand."""

import random
import re
import statistics
from itertools import takewhile

from pyspark.sql import functions as F

from corpusloom.functions import html, runs
from corpusloom.functions import text as X
from corpusloom.operators import corpus, graph, integrity, kernels, media, state, stats
from corpusloom.sources import folders, sinks
from corpusloom.sources import notes as N


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {'string' if isinstance(v, str) or v is None else 'long'}" for k, v in values.items()))
    return row.select(column).first()[0]


def test_keep_first_in_path_order_and_rows_without_a_key(spark):
    rows = spark.createDataFrame([("A", "a b/x"), ("A", "a/x"), ("B", "c/x"), (None, "d"), ("", "e"), (None, "f")], "id string, path string")
    got = {tuple(r) for r in corpus.keep_first(rows, F.col("id"), [corpus.path_order(F.col("path"))]).collect()}
    assert got == {("A", "a/x"), ("B", "c/x"), (None, "d"), ("", "e"), (None, "f")}
    assert {r["id"] for r in corpus.keep_first(rows, F.col("id"), [F.col("path")], null_keys="drop").collect()} == {"A", "B"}
    counts = corpus.dedupe_counts(rows, "id").first()
    assert tuple(counts) == (6, 5, 1)


def test_neighbours(spark):
    rows = spark.createDataFrame([("m", 2, "b"), ("m", 1, "a"), ("n", 1, "c")], "module string, i int, id string")
    got = {r["id"]: (r["prev_id"], r["next_id"]) for r in corpus.neighbours(rows, ["module"], [F.col("i")], "id").collect()}
    assert got == {"a": (None, "b"), "b": ("a", None), "c": (None, None)}


def test_quantiles_are_exclusive_and_small_samples_give_the_largest(spark):
    rng = random.Random(5)
    for n in (1, 2, 99, 100, 101, 200, 357):
        values = [rng.randint(0, 500) for _ in range(n)]
        r = stats.size_stats(spark.createDataFrame([(v,) for v in values], "chars long"), "chars").first()
        assert (r["n"], r["max_chars"], r["min_chars"]) == (n, max(values), min(values))
        assert r["median_chars"] == int(statistics.median(values))
        want = [int(statistics.quantiles(values, n=100)[p - 1]) if n >= 100 else max(values) for p in (50, 95, 99)]
        assert [r["p50"], r["p95"], r["p99"]] == want, n
    assert stats.size_stats(spark.createDataFrame([], "chars long"), "chars").first()["n"] is None


def test_sentence_run(spark):
    a, b = "This sentence is long enough.", "Another sentence, long enough."
    cases = [([a, a], (2, a)), ([a, a, a, b, b], (3, a)), ([a, "short", a], (1, "")), (["x" * 19] * 4, (1, "")), (["x" * 20] * 4, (4, "x" * 20)), ([], (1, ""))]
    for parts, want in cases:
        df = spark.createDataFrame([(parts,)], "p array<string>")
        assert tuple(df.select(runs.sentence_run(F.col("p"))).first()[0]) == want


def slow_phrase(words, sizes=range(4, 9), least=10):
    """Copies by recounting at every place; a repeat of any length is passed as a whole."""
    found = [(0, "")]
    for n in (n for n in sizes if len(words) >= n * least):
        told = lambda i, n=n: words[i : i + n]
        copies = lambda i, n=n, told=told: 1 + sum(1 for _ in takewhile(lambda at: told(at) == told(i), range(i + n, len(words), n)))
        place = 0
        while place < len(words) - n:
            c = copies(place)
            found.append((c, " ".join(told(place))) if c >= least else found[0])
            place += c * n if c > 1 else 1
    return max(found, key=lambda f: f[0])


def slow_sentence(text, least=20):
    parts, best, said = [p.strip() for p in re.split(r"(?<=[.!?])\s+", text)], 1, ""
    for i in range(len(parts)):
        k = 1
        while len(parts[i]) >= least and i + k < len(parts) and parts[i + k] == parts[i]:
            k += 1
        if k > best:
            best, said = k, parts[i]
    return best, said


def test_phrase_run(spark):
    w = "a b c d".split()
    assert runs.longest_phrase(w * 9) == (0, "")
    assert runs.longest_phrase(w * 10) == (10, "a b c d")
    assert runs.longest_phrase(w * 10 + ["e"] + "p q r s t".split() * 11) == (11, "p q r s t")
    # "p q r s p" twice comes first, so the next try is out of step and finds nine copies alone
    assert runs.longest_phrase("p q r s p p q r s p".split() + "q r s t".split() * 10, sizes=range(5, 6)) == slow_phrase("p q r s p p q r s p".split() + "q r s t".split() * 10, range(5, 6))
    assert runs.longest_phrase("p q r s p".split() + "q r s t".split() * 10) == slow_phrase("p q r s p".split() + "q r s t".split() * 10)
    rng = random.Random(3)
    out_of_step = 0
    for _ in range(600):
        words = []
        for _ in range(rng.randint(1, 5)):
            unit = [rng.choice("abc") for _ in range(rng.randint(1, 9))]
            words += unit * rng.randint(1, 14)
        assert runs.longest_phrase(words) == slow_phrase(words)
        out_of_step += slow_phrase(words)[0] > 0
    assert out_of_step > 50
    rows = [(1, " ".join(w * 12)), (2, None), (3, ""), (4, "A sentence that is long enough. " * 4 + "x"), (5, "Short. Short. Short.")]
    df = spark.createDataFrame(rows, "i int, t string")
    got = {r["i"]: tuple(r["r"]) for r in df.select("i", runs.repeats("t").alias("r")).collect()}
    assert got == {1: (1, "", 12, "a b c d"), 2: (1, "", 0, ""), 3: (1, "", 0, ""), 4: (4, "A sentence that is long enough.", 0, ""), 5: (1, "", 0, "")}
    for _ in range(200):
        t = " ".join(rng.choice(["This one is a long sentence!", "Another long sentence here.", "No.", "Is this a long sentence, too?"]) for _ in range(rng.randint(0, 12)))
        assert runs.longest_sentence(t) == slow_sentence(t)


def test_severity(spark):
    df = spark.createDataFrame([(2, "x" * 40, 9, "y" * 40), (3, "x" * 20, 0, ""), (3, "x" * 20, 10, "y" * 7), (1, "", 0, "")], "s int, st string, p int, pt string")
    assert [r[0] for r in df.select(runs.severity(F.col("s"), F.col("st"), F.col("p"), F.col("pt"))).collect()] == [0, 60, 70, 0]


def slow_paragraphs(texts, limit=600, ends=5):
    """The longest beginning within both limits (one text at least) is a paragraph; the rest is packed alike."""
    left = [t for t in map(str.strip, texts) if t]
    if not left:
        return []
    fits = lambda k: sum(map(len, left[:k])) <= limit and sum(len(re.findall(r"[.!?]\s", t)) + 1 for t in left[:k]) <= ends
    k = max((k for k in range(1, len(left) + 1) if fits(k)), default=1)
    return [" ".join(left[:k]), *slow_paragraphs(left[k:], limit, ends)]


def test_paragraphs(spark):
    rng = random.Random(1)
    cases = [[], [""], ["x" * 600, "y"], ["x" * 700, "y"], ["a."] * 6, ["a. b. c. d. e. f."]] + [[rng.choice(["Hi. ", "x" * rng.randint(1, 400), " ", "One. Two? Three!"]) for _ in range(rng.randint(0, 12))] for _ in range(60)]
    got = spark.createDataFrame([(c,) for c in cases], "t array<string>").select(runs.paragraphs(F.col("t"))).collect()
    assert [r[0] for r in got] == [slow_paragraphs(c) for c in cases]


def test_names(spark):
    assert one(spark, X.safe_filename(F.col("t")), t="  Hello:  world?... ") == "Hello world"
    assert one(spark, X.safe_filename(F.col("t")), t="???") == "Untitled"
    assert len(one(spark, X.safe_filename(F.col("t")), t="é" * 300)) == 180
    assert one(spark, X.sanitize_title(F.col("t")), t=" a/b:c  d. ") == "a-b-c d"
    assert one(spark, X.sanitize_title(F.col("t")), t=" .. ") == "untitled"
    assert one(spark, X.clean_title(F.col("t")), t=" 12.  Title ") == "Title"
    assert one(spark, X.strip_index(F.col("t")), t="12-name-3") == "name-3"
    assert one(spark, X.numbered_name(F.col("i"), F.col("t")), i=7, t="07. A?") == "07. A.md"
    assert one(spark, X.numbered_name(F.col("i"), F.col("t")), i=123, t="A") == "123. A.md"
    assert one(spark, X.yaml_quoted(F.col("t")), t='a"b\\c') == '"a\\"b\\\\c"'
    assert one(spark, X.wikilink(F.col("t"), F.lit("x")), t="a/x.md") == "[[a/x]]"
    assert one(spark, X.wikilink(F.col("t"), F.lit("y")), t="a/x.md") == "[[a/x|y]]"
    assert one(spark, X.wikilinks(F.col("t")), t="[[a|b]] [[c#d]] [[e/f]]") == ["a", "e/f"]


def test_note_parts(spark):
    note = "---\ntitle: T\nlesson_id: 'x1'\n---\n\n# Head\n\n> quote\n\n## Transcript\n\nSaid so.\n\n## Next\nno"
    assert one(spark, X.frontmatter_value(F.col("t"), "lesson_id"), t=note) == "x1"
    assert one(spark, X.frontmatter_value(F.col("t"), "absent"), t=note) is None
    assert one(spark, X.transcript_section(F.col("t")), t=note) == "Said so."
    assert one(spark, X.transcript_section(F.col("t")), t="no such part") == ""
    assert one(spark, X.transcript_section(F.col("t"), True), t="whole") == "whole"
    assert one(spark, X.strip_heading(X.strip_frontmatter(F.col("t"))), t=note).startswith("> quote")
    assert one(spark, X.strip_blocks(F.col("t")), t=f"a\n{X.NAV_START}x\ny{X.NAV_END}\n\nb \n") == "a\nb\n"
    assert N.parse_lines("---\na: b\nl:\n- x\n- 'y'\ne: []\n---\nbody") == {"a": ["b"], "l": ["x", "y"], "e": ["[]"]}
    assert N.parse_lines("no head") == {}
    assert N.parse_lines("---\na: b\n- x\n c: d\nk:\n---\n") == {"a": ["b"], "k": []}
    assert N.parse_yaml("---\na: 'it''s'\nn: 3\nl: [x, y]\nt: >-\n  one\n  two\nm: {k: 1}\nz:\n---\nbody") == {"a": ["it's"], "n": ["3"], "l": ["x", "y"], "t": ["one two"], "m": ['{"k": 1}'], "z": []}
    assert N.parse_yaml("---\n: [\n---\n") == {} and N.parse_yaml("---\n- a\n---\n") == {}


def test_page_parts(spark):
    page = '<div class="content"><p>One <b>two</b></p><div>in</div> after</div><a href="/x">L</a><a href="/y"></a><a>z</a>'
    assert one(spark, X.html_text_length(F.col("t")), t=page) == len("One two in")
    assert one(spark, X.html_text_length(F.col("t")), t="<div class='content'>x</div>") == 0
    assert [tuple(r) for r in one(spark, X.html_links(F.col("t")), t=page)] == [("L", "/x")]
    assert html.to_markdown("<h1>A</h1><p>b <b>c</b> <a href='/u'>d</a></p><ul><li>x<li>y</ul><script>no</script>") == "# A\n\nb **c** [d](/u)\n\n* x\n* y"
    assert html.to_markdown(None) == "" and html.to_markdown("<p>x</p>", "content") == ""
    nested = "<div class='nav'>no</div><div class='a content'><div><p>a*b_c <code>d_e</code></p></div><ol><li>x</li><li>y</li></ol></div><p>after</p>"
    assert html.to_markdown(nested, "content") == "a\\*b\\_c `d_e`\n\n1. x\n2. y"
    inside = one(spark, X.html_container(F.col("t"), "resources"), t="<div class=x><a href=1>n</a></div><DIV id='r' class='resources wide'><div><a href='2'>m</a></div></DIV><a href=3>o</a>")
    assert inside.startswith("<DIV") and inside.endswith("</DIV>") and "3" not in inside
    assert one(spark, X.html_container(F.col("t"), "resources"), t="<div class='my-resources'>x</div>") == ""


def test_incremental_and_sparse(spark):
    now = spark.createDataFrame([(i, f"h{i}") for i in range(1, 7)], "id long, body_sha string")
    prev = spark.createDataFrame([(1, 1, "h1", ["t"]), (2, 1, "old", ["t"]), (3, 0, "h3", ["t"]), (4, 1, "h4", []), (5, None, "h5", ["t"])], "id long, schema int, body_sha string, tags array<string>")
    assert {r["id"] for r in corpus.incremental(now, prev, "id").filter("cached").collect()} == {1}
    assert corpus.incremental(now, prev, "id", force=True).filter("cached").count() == 0
    made = corpus.sparse_metadata(F.lit("Maker"), F.lit(None).cast("string"), F.lit("Call of the Niche Pack"), F.col("n"))
    for n, tail in ((0, ""), (1, " Includes 1 downloadable resource."), (2, " Includes 2 downloadable resources.")):
        assert one(spark, made["summary"], n=n) == "Reference entry in Maker › Call of the Niche Pack." + tail
    assert one(spark, made["tags"], n=0) == ["make", "community-call", "niche-pack", "reference"]
    assert one(spark, made["concept"], n=0) == "Niche Packs"


def test_coercion_and_answers(spark):
    df = spark.createDataFrame([(" s " * 200, [" A b ", None, " "] + [f"t{i}" for i in range(9)], None)], "s string, t array<string>, c array<string>")
    made = corpus.coerced(F.col("s"), F.col("t"), F.col("c"), F.col("t"))
    r = df.select(*(v.alias(k) for k, v in made.items())).first()
    assert len(r["summary"]) == 200 and r["tags"] == ["a-b", ""] + [f"t{i}" for i in range(5)] and r["concepts"] == [] and r["aliases"] == ["A b", ""]
    assert one(spark, X.json_object(F.col("t")), t='so:\n```json\n{"a": {"b": 1}}\n```') == '{"a": {"b": 1}}'


def test_segments_votes_and_policy(spark):
    rows = [(None, 80.0, 0.0, "mixed"), (1.0, None, 0.0, "mixed"), (1.49, 75.0, 6.0, "slideshow"), (1.0, 22.0, 0.5, "handson"), (1.0, 22.0, 1.0, "mixed"), (1.5, 69.0, 9.0, "talking"), (1.5, 70.0, 0.0, "mixed"), (1.0, 21.0, 0.0, "mixed")]
    df = spark.createDataFrame(rows, "d double, e double, s double, want string")
    assert df.filter(media.segment_class(F.col("d"), F.col("e"), F.col("s")) != F.col("want")).count() == 0
    votes = {"f": ["talking"] * 3 + ["mixed"] * 2 + ["handson"] * 2, "g": ["handson"] * 3 + ["mixed"] * 3, "h": ["slideshow"] * 4 + ["talking"] * 3 + ["handson"] * 3, "a": ["talking"] * 2 + ["slideshow"] * 2 + ["mixed"], "b": ["talking"] * 3 + ["handson"] * 2, "c": ["handson"] * 4 + ["mixed"], "d": ["slideshow", "talking"], "e": [None]}
    df = spark.createDataFrame([(k, t) for k, ts in votes.items() for t in ts], "v string, type string")
    got = {r["v"]: (r["dominant_type"], r["confidence"], r["profile"]) for r in media.vote(df, "v").collect()}
    assert got == {"f": ("talking", 0.4286, "mixed"), "g": ("handson", 0.5, "mixed"), "h": ("slideshow", 0.4, "mixed"), "a": ("mixed", 0.4, "mixed"), "b": ("talking", 0.6, "mixed"), "c": ("handson", 0.8, "pure"), "d": ("talking", 0.5, "mixed"), "e": ("mixed", 0.0, "unknown")}
    df = spark.createDataFrame([("talking", 480), ("other", 0), ("mixed", 2000)], "k string, h int")
    assert sorted((r["k"], r["target_height"], r["crf"], r["effective_height"]) for r in media.with_policy(df, "k", "h").collect()) == [("mixed", 1080, 27, 1080), ("other", 1080, 27, 1080), ("talking", 720, 28, 480)]
    budget = lambda cores, at_once, own=None: tuple(one(spark, media.thread_budget(F.col("c"), F.lit(at_once), None if own is None else F.lit(own)), c=cores))
    assert [budget(16, 4), budget(2, 4), budget(9, 2), budget(64, 1), budget(64, 4, 20), budget(8, 2, 0)] == [(3, 1), (1, 1), (4, 2), (63, 6), (20, 6), (1, 1)]
    lines = "x lavfi.signalstats.YDIF=9\nlavfi.signalstats.YDIF=1.5\r\n lavfi.signalstats.YDIF=2.5\nlavfi.signalstats.YDIF=-\n"
    assert one(spark, media.frame_mean(F.col("t"), "YDIF"), t=lines) == 2.0 and one(spark, media.frame_mean(F.col("t"), "YAVG"), t=lines) is None
    starts = lambda d: one(spark, media.segment_starts(F.col("d").cast("double")), d=d)
    assert [starts(30), starts(5), starts(59), starts(60)] == [[0.0, 10.0, 20.0], [0.0], [0.0, 12.25, 24.5, 36.75, 49.0], [5.0, 15.0, 25.0, 35.0, 45.0]]
    assert one(spark, media.scenes_per_minute(F.col("t")), t="pts_time:1\nx\npts_time:2") == 12.0


def test_attempts(spark):
    rows = [("k", "in_progress", None, 1), ("k", "failed", "boom", 2), ("k", "pending", None, 3), ("k", "in_progress", None, 4), ("j", "failed", "x", 1), ("j", "completed", None, 2), ("i", "failed", "y", 1), ("i", "in_progress", None, 2), ("h", "completed", "odd", 1)]
    df = spark.createDataFrame([(*r, 0, f"o{r[3]}" if r[3] < 3 else None) for r in rows], "key string, status string, error string, ts int, event_id int, output string")
    got = {r["key"]: tuple(r)[1:] for r in state.attempt_state(df).collect()}
    assert got == {"k": ("in_progress", 3, 4, None, "o2"), "j": ("completed", 2, 2, None, "o2"), "i": ("in_progress", 2, 2, "y", "o2"), "h": ("completed", 1, 1, "odd", "o1")}
    # a state that says completed is pending without an output
    keys = lambda *k: spark.createDataFrame([(x,) for x in k], "key string")
    split = lambda **how: {r["key"]: r["split"] for r in state.pending_split(keys(*"abcde"), spark.createDataFrame([("a", "completed"), ("b", "failed"), ("c", "failed")], "key string, status string"), keys("d"), keys("c"), "key", **how).collect()}
    assert split() == {"a": "pending", "b": "failed", "c": "skipped", "d": "failed", "e": "pending"}
    assert split(retry_failed=True) == {"a": "pending", "b": "pending", "c": "skipped", "d": "pending", "e": "pending"}
    assert set(split(force=True).values()) == {"pending"}


def test_growth(spark):
    rows = lambda *v: spark.createDataFrame(list(zip(["md", "kb"], v, strict=True)), "metric string, value long")
    bad = lambda a, b: {r["metric"] for r in state.growth(a, b).filter("violation").collect()}
    assert bad(rows(4, 100), rows(8, 110)) == {"md"}
    assert bad(rows(4, 100), rows(5, 150)) == set()
    assert bad(rows(0, 100), rows(9, 151)) == {"kb"}


def test_graph(spark):
    notes = spark.createDataFrame([(1, ["Simplicity As Value", "b"]), (2, ["Simplicity as Value", "simplicity as value"])], "id long, concepts array<string>")
    m = graph.mentions(notes, "id", "concepts", [F.col("id")])
    assert {(r["canonical"], r["lesson_count"], r["lessons"]) for r in graph.concept_index(m, "id").collect()} == {("Simplicity As Value", 3, "1,2,2"), ("b", 1, "1")}
    mapping = spark.createDataFrame([("x", "X"), ("y", "X"), ("z", "")], "variant string, canonical string")
    rows = spark.createDataFrame([(1, ["y", "q", "x", "z"]), (2, ["q"]), (3, [])], "id long, l array<string>")
    got = {r["id"]: (r["new"], r["n_replaced"], r["changed"]) for r in graph.apply_canonical(rows, "id", "l", mapping).collect()}
    assert got == {1: (["X", "q"], 3, True), 2: (["q"], 0, False), 3: ([], 0, False)}
    links = spark.createDataFrame([("p", "a/x"), ("p", "x"), ("p", "b/x"), ("p", "none")], "page string, target string")
    files = spark.createDataFrame([("a/x.md",)], "path string")
    assert graph.link_report(graph.resolve_links(links, files)).first() == ("p", 4, 2)


def test_modules_without_lessons_and_pages(spark):
    rows = [("Month 1", "1-Day 1", "Day 1", 1, "A", "Month 1/1-Day 1/01. A.md", None, 1), ("Month 1", "1-Day 1", "Day 1", 2, "B", "Month 1/1-Day 1/02. B.md", "Sum", 1), ("Month 1", "2-Day 2", "Day 2", 1, "C", "Month 1/2-Day 2/01. C.md", None, 2)]
    lessons = spark.createDataFrame(rows, "course string, module_dir string, module_title string, lesson_index int, lesson_title string, path string, summary string, module_index int").withColumn("lesson_dir", F.col("path"))
    pages = {r["path"]: r["text"] for r in graph.module_pages(lessons).collect()}
    assert pages["Month 1/1-Day 1/_Day 1.md"] == f'---\nvault_schema: 1\ntitle: "Day 1"\ntype: "module-moc"\nmoc_type: "module"\ncourse: "Month 1"\nmodule: "Day 1"\n---\n\n{sinks.AUTO_NOTE}\n\n# Day 1\n\n> Course: [[Month 1/_Month 1|Month 1]]\n\n## Lessons\n\n- [[Month 1/1-Day 1/01. A]]\n- [[Month 1/1-Day 1/02. B]]\n    - Sum\n'
    dirs = spark.createDataFrame([("Month 1", d) for d in ("1-Day 1", "2-Day 2", "3-Day 3")] + [("Month 9", "1-x")], "course string, module_dir string")
    stubs = graph.stub_pages(dirs, lessons).collect()
    assert [r["path"] for r in stubs] == ["Month 1/3-Day 3/_Day 3.md"] and "# Day 3\n" in stubs[0]["text"] and "_No lessons indexed for this module yet._" in stubs[0]["text"]
    course = graph.course_pages(lessons, "All").first()["text"]
    assert course.endswith("# Month 1\n\n> [[All]] › **Month 1**\n\n## Modules\n\n- [[Month 1/1-Day 1/_Day 1|Day 1]]\n- [[Month 1/2-Day 2/_Day 2|Day 2]]\n")


def test_checks(spark):
    note = lambda i, v, *more: "---\n" + "\n".join([f"vault_schema: {v}", f"lesson_id: {i}", *more]) + "\n---\n[[Concepts/old NAME]]"
    files = [("c/m/a/lesson.json", '{"lessonId": "a"}'), ("c/m/b/lesson.json", '{"lesson_id": "a"}'), ("c/m/d/lesson.json", "{}"), ("c/m/e/lesson.json", "{no"), ("c/m/a/n.md", note("a", 1, "body_sha:", "tags:", "concepts:", "- X?")), ("c/m/b/n.md", note("b", 2)), ("c/m/d/n.md", note("d", 1)), ("c/m/_m.md", "[[nowhere]]"), ("c/_m.md", "[[c/m/a/n]] [[n]] [[c/m]] [[nowhere]] [[c/nowhere]]"), ("Concepts/x.md", ""), ("Concepts/y.md", ""), ("README.md", "[[nowhere]]")]
    df = spark.createDataFrame(files, "path string, text string")
    got = {(r["check"], r["level"], r["message"]) for r in integrity.vault_report(df, "v", spark.createDataFrame([("Old Name", "New")], "variant string, canonical string")).collect()}
    assert got == {("duplicate lessonId", "FAIL", "a: 2 occurrences"), ("lesson.json parse", "FAIL", "c/m/e/lesson.json"), ("missing lessonId", "WARN", "1/4 lesson.json files lack lessonId"), ("vault_schema missing", "FAIL", "c/m/b/n.md"), ("missing field `body_sha`", "WARN", "1 lessons"), ("missing field `tags`", "WARN", "1 lessons"), ("missing field `concepts`", "WARN", "1 lessons"), ("orphan concept stubs", "WARN", "1/2 stubs unreferenced"), ("broken MOC wikilinks", "WARN", "2/5 links unresolved across 1 MOCs"), ("body wikilinks reference canonicalized variants", "WARN", "3/3 sampled lessons"), ("no nested duplicate vault", "OK", "")}
    clean = spark.createDataFrame([("c/m/a/lesson.json", '{"lessonId": "a"}'), ("v/x.md", "x")], "path string, text string")
    got = {(r["check"], r["level"]) for r in integrity.vault_report(clean, "v").collect()}
    assert got == {("lesson_id unique", "OK"), ("schema valid", "OK"), ("no Concepts/ folder", "WARN"), ("MOC wikilinks resolve", "OK"), ("no canonicalize-mapping.json", "WARN"), ("nested duplicate vault", "FAIL")}
    assert integrity.exit_code(spark.createDataFrame([("a", "OK"), ("b", "WARN")], "check string, level string")).first()["exit_code"] == 1
    assert integrity.nested_copy(spark.createDataFrame([("v/x",), ("w/v/x",), ("v",)], "path string"), "v").count() == 1


def test_scan_lessons(spark, tmp_path):
    root = tmp_path / "coll"
    def lesson(path, body, page=True):
        (root / path).mkdir(parents=True)
        (root / path / "lesson.json").write_text(body)
        if page:
            (root / path / "index.html").write_text("<html/>")
    lesson("Month 1/1-Day 1/01-foo", '{"lessonId": "A", "title": "Foo", "lessonIndex": 1, "moduleIndex": 1, "moduleTitle": "Day 1"}')
    lesson("Month 1/1-Day 1/02-dup", '{"lessonId": "A", "title": "Dup", "lessonIndex": 2}')
    lesson("Month 1/1-Day 1/03-bar", '{"lesson_id": "B"}')
    lesson("Month 1/1-Day 1/04-none", '{"lessonId": "C"}', page=False)
    lesson("Month 1/1-Day 1/05-noid", "{}")
    got = {r["lesson_id"]: r for r in N.scan_lessons(spark, str(root)).collect()}
    assert set(got) == {"A", ""}  # the other spelling of the key is no lesson_id
    got["B"] = got[""]
    assert (got["A"]["lesson_title"], got["A"]["course"], got["A"]["module_title"]) == ("Foo", "Month 1", "Day 1")
    assert (got["B"]["lesson_title"], got["B"]["module_title"], got["B"]["lesson_index"]) == ("03-bar", "Day 1", 0)
    assert N.scan_lessons(spark, str(root), course_from_section=False).first()["course"] == "coll"


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([("a/x.md", "one"), ("b.md", "two")], "path string, text string")
    folders.write_files(rows, str(tmp_path))
    assert (tmp_path / "a/x.md").read_text() == "one"
    pages = spark.createDataFrame([("_a.md", sinks.AUTO_NOTE), ("_b.md", "type: module-moc"), ("_c.md", "by hand"), ("_d.md", sinks.AUTO_NOTE)], "path string, text string").withColumn("path", F.concat(F.lit("c/"), "path"))
    assert {r["path"] for r in sinks.stale_pages(pages, spark.createDataFrame([("c/_d.md",)], "path string")).collect()} == {"c/_a.md"}


def test_settings(spark):
    from corpusloom.settings import Settings

    assert Settings.of(spark) == Settings()
    try:
        spark.conf.set("spark.corpusloom.force", " Yes")
        spark.conf.set("spark.corpusloom.limit", "5")
        spark.conf.set("spark.corpusloom.fallbacks", "a, ,b")
        assert Settings.of(spark) == Settings(force=True, limit=5, fallbacks=("a", "b"))
    finally:
        for n in ("force", "limit", "fallbacks"):
            spark.conf.unset(f"spark.corpusloom.{n}")


def test_kernels(spark):
    rows = spark.createDataFrame([(1, "some words here"), (2, "")], "lesson_id long, text string")
    got = kernels.apply(rows, kernels.stub_classify, kernels.CLASSIFIED).collect()
    assert len(got) == 2 and all(len(r["tags"]) == 2 for r in got)
    empty = lambda b: kernels.stub_classify(b).assign(summary="")
    out = kernels.cascade(rows, [("first", empty), ("second", kernels.stub_classify)], "lesson_id", kernels.CLASSIFIED).collect()
    assert sorted((r["lesson_id"], r["engine"]) for r in out) == [(1, "second"), (2, None)]
    tries = []

    def flaky(b):
        tries.append(len(b))
        if len(tries) < 3:
            raise ConnectionError
        return b

    waited = []
    assert kernels.with_retries(flaky, [1.0, 2.3, 4.6], sleep=waited.append)([1]) == [1] and waited == [1.0, 2.3]
    loads = []
    load = lambda name, local: loads.append((name, local)) or object()
    assert kernels.held_model("m", True, load) is kernels.held_model("m", True, load) and kernels.held_model("m", False, load) and loads == [("m", True), ("m", False)]
