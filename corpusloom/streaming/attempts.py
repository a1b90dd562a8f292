"""Attempt state as a stream: one keyed state, events in any order, timers for attempts that nothing ends.

Every column of the state is the value of the last event, in a total order, that sets it; so
the state keeps each value with its place, and events fold in any order and any split
into batches to what attempt_state makes of all of them at once.
"""

from __future__ import annotations

import contextlib
from collections.abc import Iterator
from typing import Any

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.state import OPEN

_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

#: Each kept column as (micros, event_id, value) of the event that set it, then the last try, tries, and batches.
_KEPT = ("status", "error", "output", "server")
_STATE = ", ".join(f"{c}_at bigint, {c}_id bigint, {c} string" for c in _KEPT) + ", tried bigint, attempts bigint, version bigint"

#: What the stream gives: `kind` is state, or stalled for a key whose open attempt nothing has ended in time.
OUT = "key bigint, kind string, status string, attempts bigint, last_attempt_at timestamp, last_error string, output_file string, server_used string, version bigint"


_UNSET = (None, None, None)


def _later(held: tuple, at: int, event: int, value: str | None) -> tuple:
    """The later of what is held and (at, event, value)."""
    return (at, event, value) if held[0] is None or held[:2] < (at, event) else held


def _folded(held: Any) -> list:
    """The state's placed columns, last try, tries and batches."""
    if held is None:
        return [_UNSET] * len(_KEPT) + [None, 0, 0]
    flat = tuple(held)
    return [flat[3 * i : 3 * i + 3] for i in range(len(_KEPT))] + list(flat[3 * len(_KEPT) :])


class Attempts(StatefulProcessor):
    """Folds events (key, at in microseconds, event_id, status, error, output, server) into the state of their key."""

    def __init__(self, patience_s: float) -> None:
        self.patience_ms = int(patience_s * 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.fold = handle.getValueState("fold", _STATE)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        status, error, output, server, tried, attempts, version = _folded(self.fold.get())
        for r in rows:
            status = _later(status, r["at"], r["event_id"], r["status"])
            if r["status"] != "pending":
                attempts, tried = attempts + 1, r["at"] if tried is None else max(tried, r["at"])
            said = r["error"] if r["status"] != "pending" else None
            if said is not None or r["status"] in ("completed", "pending"):
                error = _later(error, r["at"], r["event_id"], said)
            if r["output"] is not None:
                output = _later(output, r["at"], r["event_id"], r["output"])
            if r["server"] is not None:
                server = _later(server, r["at"], r["event_id"], r["server"])
        version += 1
        self.fold.update((*status, *error, *output, *server, tried, attempts, version))
        if self.patience_ms:  # else there are no timers, and none may be asked for
            for t in list(self.handle.listTimers()):
                self.handle.deleteTimer(t)
            if status[2] in OPEN:
                self.handle.registerTimer(status[0] // 1000 + self.patience_ms)
        yield self._row(key, "state", (status, error, output, server, tried, attempts, version))

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        held = self.fold.get()
        if held is not None:
            yield self._row(key, "stalled", _folded(held))

    def close(self) -> None:
        pass

    def _row(self, key: Any, kind: str, held: list | tuple) -> Row:
        import datetime

        status, error, output, server, tried, attempts, version = held
        at = None if tried is None else datetime.datetime.fromtimestamp(tried // 1_000_000, datetime.UTC).replace(microsecond=tried % 1_000_000)
        return Row(key=key[0], kind=kind, status=status[2], attempts=attempts, last_attempt_at=at, last_error=error[2], output_file=output[2], server_used=server[2], version=version)


@contextlib.contextmanager
def _rocks(spark: SparkSession) -> Iterator[None]:
    """Keyed state with timers needs this store; the session's own choice comes back."""
    before = spark.conf.get(_STORE, None)
    spark.conf.set(_STORE, _ROCKS)
    try:
        yield
    finally:
        spark.conf.unset(_STORE) if before is None else spark.conf.set(_STORE, before)


def attempt_stream(events: DataFrame, patience_s: float = 0.0, lateness: str = "0 seconds") -> DataFrame:
    """OUT rows of a stream of events (key, ts, event_id, status, error, output, server): the state of each key that a batch has touched.

    A key whose last event leaves it open gives a `stalled` row when the watermark (the latest ts less
    `lateness`) passes that event by patience_s seconds; 0: never. No event is too late.
    """
    typed = events.select(F.col("key").cast("bigint").alias("key"), F.col("ts").cast("timestamp").alias("ts"), F.unix_micros(F.col("ts").cast("timestamp")).alias("at"), F.col("event_id").cast("bigint").alias("event_id"), "status", "error", "output", "server")
    mode = "EventTime" if patience_s else "None"
    if patience_s:
        typed = typed.withWatermark("ts", lateness)
    return typed.groupBy("key").transformWithState(Attempts(patience_s), OUT, "Update", mode)


def run_attempts(events: DataFrame, out: str, checkpoint: str, patience_s: float = 0.0) -> None:
    """Fold all that is there into the table `out`, one folder a batch, which a batch that runs again replaces."""
    spark = events.sparkSession

    def put(rows: DataFrame, epoch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{out}/epoch={epoch}")

    with _rocks(spark):
        query = attempt_stream(events, patience_s).writeStream.foreachBatch(put).outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()


def last_state(spark: SparkSession, out: str) -> DataFrame:
    """The newest state of each key in the table of run_attempts."""
    rows = spark.read.parquet(out).filter("kind = 'state'")
    cols = ["status", "attempts", "last_attempt_at", "last_error", "output_file", "server_used"]
    return rows.groupBy("key").agg(F.max_by(F.struct(*cols), "version").alias("s")).select("key", "s.*")
