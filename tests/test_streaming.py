"""Streams against batch folds, and runs that were killed and started again against one run."""

import datetime as dt
import random
import time

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import rounds, state
from corpusloom.streaming import attempts, snapshot

EVENTS = "key long, ts timestamp, event_id long, status string, error string, output string, server string"


def _events(n=200, seed=3):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        status = rng.choice(["completed", "failed", "in_progress", "pending"])
        rows.append((rng.randint(0, 20), dt.datetime(2024, 1, 1) + dt.timedelta(seconds=rng.randint(0, 500), microseconds=rng.choice([0, 7])), i, status, rng.choice([None, "e1", "e2"]), rng.choice([None, "o1", "o2"]), rng.choice([None, "s1", "s2"])))
    return rows


def _write(spark, rows, schema, path, splits, seed):
    rng = random.Random(seed)
    for part in range(splits):
        own = [r for r in rows if rng.random() < 0.5 or part == splits - 1] if splits > 1 else rows
        rows = [r for r in rows if r not in own]
        if own:
            spark.createDataFrame(own, schema).coalesce(1).write.mode("append").parquet(path)


@pytest.mark.parametrize("splits", [1, 3])
def test_any_split_of_events_gives_the_batch_state(spark, tmp_path, splits):
    rows = _events()
    random.Random(splits).shuffle(rows)  # out of order
    _write(spark, rows, EVENTS, str(tmp_path / "in"), splits, splits)
    stream = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    attempts.run_attempts(stream, str(tmp_path / "out"), str(tmp_path / "ck"))
    got = attempts.last_state(spark, str(tmp_path / "out"))
    want = state.attempt_state(spark.createDataFrame(rows, EVENTS))
    cols = sorted(want.columns)
    assert sorted(got.columns) == cols
    assert sorted(map(repr, got.select(*cols).collect())) == sorted(map(repr, want.select(*cols).collect()))
    assert spark.read.parquet(str(tmp_path / "out")).filter("kind = 'stalled'").count() == 0


def test_open_attempts_stall(spark, tmp_path):
    at = lambda s: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s)
    first = [(1, at(0), 1, "in_progress", "e", None, "s1"), (2, at(0), 2, "in_progress", None, None, None), (3, at(0), 3, "completed", None, "o", None)]
    second = [(2, at(5), 4, "completed", None, "o", None), (4, at(100), 5, "in_progress", None, None, None)]
    for part in (first, second):
        spark.createDataFrame(part, EVENTS).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(EVENTS).parquet(str(tmp_path / "in"))
        attempts.run_attempts(stream, str(tmp_path / "out"), str(tmp_path / "ck"), patience_s=30)
    assert [(r["key"], r["status"]) for r in spark.read.parquet(str(tmp_path / "out")).filter("kind = 'stalled'").collect()] == [(1, "in_progress")]


def test_start_events(spark):
    videos = spark.createDataFrame([(i,) for i in range(6)], "key long")
    have = spark.createDataFrame([(0, "completed"), (1, "failed"), (2, "failed"), (3, "pending")], "key long, status string")
    outputs = spark.createDataFrame([(0,), (1,), (5,)], "key long")
    made = lambda **how: sorted((r["key"], r["status"], r["output"]) for r in state.start_events(videos, have, outputs, "key", F.concat(F.lit("o"), F.col("key").cast("string")), **how).collect())
    assert made() == [(1, "completed", "o1"), (5, "completed", "o5")]
    assert made(retry_failed=True) == [(1, "completed", "o1"), (2, "pending", "o2"), (5, "completed", "o5")]
    assert made(force=True) == []


SOURCE = "lesson_id long, body_sha string, gone boolean, seq long, words string"
OUT = "lesson_id long, body_sha string, shown string"


def _files(spark, path):
    """Four files, a micro-batch each: keys come up, change, stay, go and come back."""
    files = [
        [(1, "a", False, 1, "one"), (2, "b", False, 1, "two"), (None, "n", False, 1, "null"), (2, "b0", False, 0, "older")],
        [(1, "a", False, 2, "one"), (2, "b2", False, 2, "two two"), (3, "c", None, 2, "three")],
        [(2, None, True, 3, None), (3, "c", False, 3, "three"), (9, None, True, 3, None)],
        [(2, "b2", False, 4, "back"), (4, None, False, 4, "no hash"), (None, "n", False, 4, "null")],
    ]
    for f in files:
        spark.createDataFrame(f, SOURCE).coalesce(1).write.mode("append").parquet(path)
        time.sleep(0.01)  # batches take files by their time


WANT = [(None, "n", "NULL"), (1, "a", "ONE"), (2, "b2", "BACK"), (3, "c", "THREE"), (4, None, "NO HASH")]


def _schema(text):
    from pyspark.sql.types import _parse_datatype_string

    return _parse_datatype_string(text)


@pytest.mark.parametrize(("killed", "compact"), [(None, 0), ((1, "before"), 2), ((3, "after"), 2)])
def test_killed_runs_equal_whole_ones(spark, tmp_path, killed, compact, monkeypatch):
    src, root, ck = (str(tmp_path / d) for d in ("src", "root", "ck"))
    seen: list = []

    def process(rows):
        seen.append(sorted((r["lesson_id"] if r["lesson_id"] is not None else -1) for r in rows.collect()))
        return rows.select("lesson_id", "body_sha", F.upper("words").alias("shown"))

    run = lambda: snapshot.run_snapshots(spark, src, _schema(SOURCE), process, _schema(OUT), root, ck, files=1, compact=compact)
    real, left = snapshot.Epochs.put, [killed]

    def lost(self, epoch, rows, compact):
        if left[0] and epoch == left[0][0]:
            if left[0][1] == "after":
                real(self, epoch, rows, compact)
            left[0] = None
            raise RuntimeError("lost")
        real(self, epoch, rows, compact)

    monkeypatch.setattr(snapshot.Epochs, "put", lost)
    _files(spark, src)
    try:
        run()
    except Exception as e:
        assert "lost" in str(e)
        run()
    key = lambda r: (r[0] is not None, r[0] or 0)
    got = snapshot.now_of(spark, root, _schema(OUT)).collect()
    assert sorted(map(tuple, got), key=key) == WANT
    once = [[-1, 1, 2], [2, 3], [], [2, 4]]
    assert seen == (once if killed is None else once[: killed[0] + 1] + once[killed[0] :])


def test_snapshot_merge_is_three_ways(spark):
    before = spark.createDataFrame([(1, "a", "ONE"), (2, "b", "TWO"), (3, "c", "GONE"), (None, None, "NULL")], OUT)
    now = spark.createDataFrame([(1, "a", False, 0, "x"), (2, "b2", False, 0, "new two"), (4, "d", False, 0, "four"), (None, None, False, 0, "y")], SOURCE)
    diff = snapshot.snapshot_diff(now, before, "lesson_id").collect()
    assert {r["lesson_id"]: r["change"] for r in diff} == {1: "same", 2: "changed", 3: "gone", 4: "new", None: "same"}
    process = lambda rows: rows.select("lesson_id", "body_sha", F.upper("words").alias("shown"))
    got = {r["lesson_id"]: (r["shown"], r["carried"]) for r in snapshot.snapshot_merge(now, before, process, "lesson_id").collect()}
    assert got == {1: ("ONE", True), 2: ("NEW TWO", False), 4: ("FOUR", False), None: ("NULL", True)}
    assert {r["shown"] for r in snapshot.snapshot_merge(now, before, process, "lesson_id", force=True).collect()} == {"X", "NEW TWO", "FOUR", "Y"}


@pytest.mark.parametrize("seed", range(2))
def test_rounds_equal_a_plain_queue(spark, seed):
    rng = random.Random(seed)
    keys, most = list(range(30)), 4
    plan = {(k, n): rng.choice(["ok", "permanent", "transient", "transient"]) for k in keys for n in range(1, most + 1)}
    health = {n: rng.random() < 0.8 for n in range(1, most + 1)}
    want, queue = {}, [(k, 1) for k in keys]
    while queue:
        k, n = queue.pop(0)
        outcome = plan[k, n]
        want.setdefault(k, []).append(outcome)
        if outcome == "transient" and health[n] and n < most:
            queue.append((k, n + 1))
    table = spark.createDataFrame([(k, n, o) for (k, n), o in plan.items()], "key long, n int, outcome string")
    waits: list = []
    got = rounds.run_rounds(spark.createDataFrame([(k,) for k in keys], "key long"), "key", lambda rows, n: rows.join(table.filter(F.col("n") == n).drop("n"), "key"), health.get, most, waits.append)
    rows = got.collect()
    assert {k: [r["outcome"] for r in sorted(rows, key=lambda r: r["round"]) if r["key"] == k] for k in keys} == want
    assert waits == list(range(1, max(map(len, want.values()))))
    last = {r["key"]: (r["outcome"], r["step"], r["attempts"]) for r in rounds.last_attempts(got, "key").collect()}
    assert last == {k: (v[-1], {"ok": "done", "permanent": "give_up", "transient": "leave"}[v[-1]], len(v)) for k, v in want.items()}
    events = rounds.attempt_events(got, "key").filter("status = 'completed'").collect()
    assert {r["key"] for r in events} == {k for k, v in want.items() if v[-1] == "ok"} and all(r["error"] is None for r in events)
    assert rounds.run_rounds(spark.createDataFrame([], "key long"), "key", lambda rows, n: rows.withColumn("outcome", F.lit("ok")), lambda n: True).count() == 0


def test_parts_that_come_up_are_written_by_all_tasks(spark, tmp_path):
    from corpusloom.plans import state_queries

    rows = spark.range(40, numPartitions=4)
    seen = [len(list((tmp_path / "in").glob("*.parquet"))) for _ in state_queries._arrivals(rows, str(tmp_path / "in"), "id", 2)]
    assert seen == [4, 8] and sorted(r["id"] for r in spark.read.parquet(str(tmp_path / "in")).collect()) == list(range(40))


def test_texts_go_to_python_in_small_batches(spark):
    from corpusloom import session
    from corpusloom.functions import html
    from corpusloom.operators import kernels

    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    rows = spark.range(2000, numPartitions=1).selectExpr("id AS lesson_id", "'a' AS text")
    try:
        spark.conf.set(name, "10000")
        sizes = kernels.apply(rows, lambda b: b.assign(n=len(b))[["n"]], "n long")
        assert max(r["n"] for r in sizes.collect()) == session.BATCH_ROWS
        spark.conf.set(name, "10000")
        html.markdown(rows["text"])
        assert spark.conf.get(name) == str(session.BATCH_ROWS)
        spark.conf.set(name, "77")
        assert max(r["n"] for r in kernels.apply(rows, lambda b: b.assign(n=len(b))[["n"]], "n long").collect()) == 77  # the session's own number stays
    finally:
        spark.conf.set(name, before)
