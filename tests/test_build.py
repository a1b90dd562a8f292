"""A run over a folder on disk: files, second runs, changes, limits, dry runs, stale pages, mappings."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import integrity
from corpusloom.plans.build import build_vault
from corpusloom.settings import Settings
from corpusloom.sources import notes as N


def _lesson(root: Path, path: str, meta: dict, transcript: str = "", page: str = "") -> None:
    (root / path).mkdir(parents=True)
    (root / path / "lesson.json").write_text(json.dumps(meta))
    if transcript:
        (root / path / "transcript.md").write_text(transcript)
    if page:
        (root / path / "index.html").write_text(page)


@pytest.fixture()
def root(tmp_path):
    r = tmp_path / "My course vault"
    _lesson(r, "Month 1/1-Intro/01-a", {"lessonId": "A", "title": "01. Alpha", "lessonIndex": 1, "moduleIndex": 1, "moduleTitle": "Intro"}, "Spoken words of alpha. " * 30)
    _lesson(r, "Month 1/1-Intro/02-b", {"lessonId": "B", "title": "Beta", "lessonIndex": 2, "moduleIndex": 1, "moduleTitle": "Intro"}, page='<div class="content"><h2>Head</h2><p>' + "Written words of beta. " * 30 + "</p></div>")
    _lesson(r, "Month 2/1-Deep/01-c", {"lessonId": "C", "title": "Gamma", "lessonIndex": 1, "moduleTitle": "Deep"}, "Short.")
    (r / "Month 1" / "_Old module.md").write_text("---\nmoc_type: module\n---\n")
    (r / "Month 1" / "_My own.md").write_text("by hand")
    (r / ".trash/x").mkdir(parents=True)
    (r / ".trash/x/lesson.json").write_text('{"lessonId": "T"}')
    return r


def _classify(asked=None):
    def run(rows):
        if asked is not None:
            asked.extend(sorted(r["lesson_id"] for r in rows.collect()))
        return rows.select("lesson_dir", F.concat(F.lit("About "), "lesson_title").alias("summary"), F.array(F.lit("Tag One")).alias("tags"), F.array(F.lit("Agents"), "lesson_id").alias("concepts"), F.array(F.lit("Other name")).alias("aliases"))

    return run


def _actions(df) -> dict:
    return {r["path"]: r["action"] for r in df.collect()}


def test_runs(spark, root):
    asked: list = []
    dry = _actions(build_vault(spark, str(root), _classify(), Settings(dry_run=True)))
    before = sorted(p for p in root.rglob("*") if p.is_file())
    assert len(before) == 9 and set(dry.values()) == {"new", "stale"}
    got = _actions(build_vault(spark, str(root), _classify(asked), Settings()))
    assert got == dry and asked == ["A", "B"]  # C is sparse
    assert [p for p, a in got.items() if a == "stale"] == ["Month 1/_Old module.md"]
    assert not (root / "Month 1/_Old module.md").exists() and (root / "Month 1/_My own.md").exists() and not (root / ".staging").exists()
    note = root / "Month 1/1-Intro/01-a/01. Alpha.md"
    text = note.read_text()
    assert 'summary: "About 01. Alpha"' in text and "tag-one" in text and 'ai_engine: "classified"' in text and "02. Beta" in text and "Spoken words of alpha." in text
    assert "Reference entry in Month 2" in (root / "Month 2/1-Deep/01-c/01. Gamma.md").read_text()
    assert {"Concepts/Agents.md", "My course vault.md", "Month 1/_Month 1.md", "Month 1/1-Intro/_Intro.md"} <= set(got)
    assert "[[Concepts/Agents]]" in text and "Alpha" in (root / "Concepts/Agents.md").read_text()

    again: list = []
    second = _actions(build_vault(spark, str(root), _classify(again), Settings()))
    assert set(second.values()) == {"same"} and again == [] and note.read_text() == text

    (root / "Month 1/1-Intro/01-a/transcript.md").write_text("Other words of alpha. " * 30)
    third = _actions(build_vault(spark, str(root), _classify(again), Settings()))
    assert again == ["A"] and [p for p, a in third.items() if a != "same"] == ["Month 1/1-Intro/01-a/01. Alpha.md"]


def test_settings_of_the_session(spark, root):
    """A limit leaves the other pages alone."""
    for k, v in (("limit", "1"), ("course_from_section", "no")):
        spark.conf.set(f"spark.corpusloom.{k}", v)
    try:
        settings = Settings.of(spark)
    finally:
        for k in ("limit", "course_from_section"):
            spark.conf.unset(f"spark.corpusloom.{k}")
    got = _actions(build_vault(spark, str(root), _classify(), settings))
    assert "stale" not in got.values() and [p for p in got if p.endswith("Alpha.md")] and not [p for p in got if p.endswith("Beta.md")]
    assert 'course: "My course vault"' in (root / "Month 1/1-Intro/01-a/01. Alpha.md").read_text()


@pytest.mark.parametrize(("text", "want"), [(None, "no canonicalize-mapping.json"), ("{nope", "mapping parse"), ('{"Agents": "Agent"}', "body wikilinks reference canonicalized variants")])
def test_mapping_of_a_vault(spark, root, text, want):
    note = root / "Month 1/1-Intro/01-a/note.md"
    note.write_text("---\nvault_schema: 1\n---\n\n[[Concepts/Agents|x]]\n")
    if text is not None:
        (root / N.MAPPING).parent.mkdir()
        (root / N.MAPPING).write_text(text)
    checks = [r["check"] for r in integrity.report_on_disk(spark, str(root)).collect()]
    assert want in checks
    assert sum(c in checks for c in ("no canonicalize-mapping.json", "mapping parse", "body wikilinks reference canonicalized variants", "no canonicalized concepts to check", "body wikilinks clean (sample)")) == 1


def test_mappings(spark):
    texts = ['{"concepts": {"A": "B", "C": 7}}', '{"A": "B"}', '{"concepts": null, "A": "B"}', "[1]", "{nope", '{"concepts": {"D": null}}']
    got = [sorted(map(tuple, N.replaced(spark.createDataFrame([(N.MAPPING, t)], "path string, text string")).collect())) for t in texts]
    assert got == [[("A", "B"), ("C", "7")], [("A", "B")], [], [], [], [("D", "None")]]


def test_heads_are_parsed_once_and_texts_stay(spark, root):
    """Former notes: no plan that a table is read from parses a head, or holds a text; files behind a join are read by all tasks."""
    from corpusloom.plans import build
    from corpusloom.sources import folders

    listing = folders.tree(spark, str(root))
    note = root / "Month 1/1-Intro/01-a/note.md"
    note.write_text('---\nvault_schema: 1\nlesson_id: "A"\nbody_sha: "x"\nsummary: "S"\ntags:\n- t\n---\n' + "body " * 100)
    former = build.former_notes(listing, str(root))
    plan = former._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" not in plan and "MapInArrow" not in plan and "text" not in plan
    assert [(r["lesson_id"], r["schema"], r["summary"], r["tags"]) for r in former.collect()] == [("A", 1, "S", ["t"])]
    joined = listing.join(listing.select("path"), "path", "left_semi")
    read = folders.contents(joined, str(root))
    assert read.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism and read.count() == listing.count()


def test_white_space_is_collapsed_as_a_pattern_does():
    import re

    from corpusloom.functions import html

    signs = ["", " ", "a", "\n", "\x1c", "\x85", "\xa0", "\u2003", "\u200b", "é "]
    for text in (x + y + z + w for x in signs for y in signs for z in signs for w in signs):
        assert html._collapsed(text) == re.sub(r"\s+", " ", text)
        assert html._run(text) == "  \n".join(re.sub(" +", " ", line).strip(" ") for line in text.split("\n")).strip(" \n")


def test_a_run_leaves_no_texts_outside_its_files(spark, root):
    """Files meet their lessons without a shuffle; when a run has ended no table has a text, and no shuffle a file."""
    from pathlib import Path as P

    from corpusloom.plans import build
    from corpusloom.session import shared_folder
    from corpusloom.sources import folders

    def shuffles():
        manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        return {p.name for d in manager.localDirs() for p in P(d.getPath()).rglob("shuffle_*")}

    def tables():
        return {p.parent for p in P(shared_folder(spark).removeprefix("file:")).rglob("*.parquet")}

    listing = folders.tree(spark, str(root))
    lessons = N.lessons_of(folders.contents(listing.filter(F.col("name") == "lesson.json"), str(root)), listing)
    bodies = build.lesson_bodies(lessons, listing, str(root))
    assert {r["lesson_id"]: ("alpha" in r["transcript"], "beta" in (r["notes"] or "")) for r in bodies.collect()} == {"A": (True, False), "B": (False, True), "C": (False, False)}
    plan = bodies._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan[: plan.index("MapInArrow")]

    held, before = shuffles(), tables()
    got = build_vault(spark, str(root), _classify(), Settings())
    assert shuffles() <= held
    assert _actions(got)["Month 1/1-Intro/01-a/01. Alpha.md"] == "new"
    left = {c for t in tables() - before for c in spark.read.parquet(str(t)).columns}
    assert "action" in left and not left & {"text", "raw", "html", "notes", "transcript"}


def test_digests_of_built_pages_are_made_where_files_are_read(spark):
    from corpusloom.plans import vault_queries as V

    plan = V.built_pages(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "Exchange" not in plan[: plan.index("MapInArrow")]
