"""The rows of each stage of the pipeline against plain versions."""

import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from corpusloom.llm import pii, quality
from tests.llm import plain


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Documents of every kind the stages decide on, their labels, and a benchmark."""
    rng = random.Random(31)
    words = ["".join(rng.choice("aeiouknrst") for _ in range(rng.randint(2, 8))) for _ in range(400)]
    said = lambda n: [rng.choice(words) for _ in range(n)]
    items = [(f"q{i}", " ".join(said(14))) for i in range(4)] + [("short", " ".join(said(5))), (None, " ".join(said(12))), ("none", None)]
    texts: list[str | None] = []
    for _ in range(60):
        texts.append(" ".join(said(rng.randint(20, 120))))
    for base in texts[:12]:
        w = base.split()
        for _ in range(3):  # near copies: some words changed, some too many
            c = [*w]
            for _ in range(rng.choice([1, 1, 2, 6])):
                c[rng.randrange(len(c))] = rng.choice(words)
            texts.append(" ".join(c))
    texts += texts[3:8] + [texts[1].upper(), texts[2].replace(" ", "\t\n")]
    texts += [texts[i] + " " + t + " " + " ".join(said(5)) for i, (_, t) in enumerate(items[:6], start=20)]
    texts += [" ".join(said(30)) + f" mail ann{i}@mail.example.org or call +49 30 1234 567{i}, host 10.0.0.{i}" for i in range(4)]
    texts += ["BAD!!! " * rng.randint(9, 40) + "###" * i for i in range(30)] + ["", None, " ", "one", "日本 語 é " * 9]
    rng.shuffle(texts)
    docs = [(i * 7 % 1000, t, rng.choice(["en", None]), rng.choice(["src0", "src1", None]), None if t is None else len(t)) for i, t in enumerate(texts)]
    docs += [docs[5], (None, "a text without an id, which is there all the same and long enough to be kept", "en", "s", 5)]
    labels = [(d[0], 0 if (d[1] or "").startswith("BAD") else 1, 0) for d in docs if d[0] is not None and d[0] % 5]
    folder = str(tmp_path_factory.mktemp("sf"))
    for name, rows, kind in (("documents", docs, "doc_id long, text string, lang string, source string, n_chars long"), ("labels", labels, "doc_id long, quality int, toxic int"), ("benchmark", items, "item_id string, text string")):
        spark.createDataFrame(rows, kind).write.parquet(f"{folder}/{name}.parquet")
    return folder, docs, items


def test_each_stage_equals_its_plain_version(spark, tables):
    from tokenizers import Tokenizer

    folder, rows, items = tables
    schema = spark.read.parquet(f"{folder}/documents.parquet").schema
    stages = dict(corpus_pipeline.STAGES)

    def run(name, rows):
        return sorted(map(tuple, stages[name](spark, spark.createDataFrame(rows, schema), folder).collect()), key=repr)

    same = lambda got, want: (got == sorted(want, key=repr), got, sorted(want, key=repr))
    model = quality.fit(spark.createDataFrame(rows, schema), spark.read.parquet(f"{folder}/labels.parquet"))
    assert model.rules
    want = [r for r in rows if plain.score(model, r[1]) >= 0.5]
    assert 0 < len(want) < len(rows)
    ok, *both = same(run("quality", rows), want)
    assert ok, both
    rows, before = want, want
    firsts = {i for i, _, c in plain.components([r[:2] for r in rows], 5, 80) if i == c}
    rows = [r for r, (i, _, c) in zip(rows, plain.components([r[:2] for r in rows], 5, 80), strict=True) if i == c or (i in firsts and i is not None)]
    assert len(rows) < len(before)
    ok, *both = same(run("neardup", before), rows)
    assert ok, both
    before = rows
    rows = [r for r, (_, _, hit, _) in zip(rows, plain.windows([r[:2] for r in rows], items), strict=True) if not hit]
    assert 0 < len(rows) < len(before)
    ok, *both = same(run("decontamination", before), rows)
    assert ok, both
    field, before = pii.trained(), rows
    rows = []
    for r in before:
        t = r[1]
        if t:
            for a, kind, b in sorted(pii.find_spans(t, field)[1], reverse=True):
                t = t[:a] + f"<{kind.upper()}>" + t[b:]
        rows.append((r[0], t, *r[2:4], None if t is None else len(t)))
    assert any("<EMAIL>" in (r[1] or "") for r in rows)
    ok, *both = same(run("pii", before), rows)
    assert ok, both
    lib = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    lib.no_truncation()
    lib.no_padding()
    want = [(r[0], len(e), e) for r in rows for e in [lib.encode(r[1] or "", add_special_tokens=False).ids]]
    assert run("bpe", rows) == sorted(want, key=repr)
    whole = corpus_pipeline.run(spark, folder)
    assert sorted(map(tuple, whole.collect()), key=repr) == sorted(want, key=repr)


def test_stages_on_empty_tables(spark, tables):
    folder, _, _ = tables
    none = spark.read.parquet(f"{folder}/documents.parquet").filter(F.lit(False))
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, folder).count() == 0


def test_stages_keep_columns_of_any_name(spark, tables):
    folder, _, _ = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(60)
    names = ["stats", "quality_score", "kept_id", "kept_id_", "guest", "rng", "row", "kept", "doc", "ids", "spans", "n_words", "label", "h", "a.b"]
    more = docs.withColumns({n: F.concat(F.lit(f"{n}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))) for n in names})
    for name, stage in corpus_pipeline.STAGES:
        plain_rows, rows = stage(spark, docs, folder).collect(), stage(spark, more, folder).collect()
        assert len(rows) == len(plain_rows) > 0, name
        if name != "bpe":
            assert rows[0].asDict().keys() == more.first().asDict().keys(), name
            assert all(r[n] == f"{n}:{'null' if r['doc_id'] is None else r['doc_id']}" for r in rows for n in names), name
