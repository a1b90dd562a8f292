"""Attempts in rounds: what failed in passing is tried again while a server is healthy.

Each round is one job over the rows that are still open; its outcomes are a written table, and
the state that later rounds and runs see is folded from those. Waits are the driver's, between
rounds, so no task sleeps.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import Scratch
from .state import next_step

#: Rounds after which open rows are left for the next run.
ROUNDS = 5

#: (rows, round) to rows with `outcome` (ok, permanent or transient) beside what else they say.
Attempt = Callable[[DataFrame, int], DataFrame]


def run_rounds(pending: DataFrame, key: str, attempt: Attempt, any_healthy: Callable[[int], bool], rounds: int = ROUNDS, wait: Callable[[int], None] | None = None) -> DataFrame:
    """All attempts: key, round (from 1), step (done, give_up, requeue, leave) and the attempt's columns.

    A row is tried in round 1, and again in each next one as long as it fails in passing while a
    server is healthy, which is asked after each round; in the last round such a row is left.
    Each key is there once; a table without rows makes no attempts.
    """
    scratch = Scratch(pending.sparkSession, "rounds")
    todo, done = scratch.put(pending), []
    for n in range(1, rounds + 1):
        got = scratch.put(attempt(todo, n).withColumn("round", F.lit(n)))
        healthy = any_healthy(n) and n < rounds
        told = got.withColumn("step", next_step(F.col("outcome"), F.lit(healthy)))
        done.append(told)
        if not healthy:
            break
        again = told.filter("step = 'requeue'").select(F.col(key).alias("_k"))
        todo = scratch.put(todo.join(again, F.col(key).eqNullSafe(F.col("_k")), "left_semi"))
        if todo.isEmpty():
            break
        if wait:
            wait(n)
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def last_attempts(attempts: DataFrame, key: str) -> DataFrame:
    """Each key's last attempt, and how many there were."""
    cols = [c for c in attempts.columns if c != key]
    rows = attempts.groupBy(key).agg(F.max_by(F.struct(*cols), "round").alias("_r"), F.count("*").alias("attempts"))
    return rows.select(key, "_r.*", "attempts")


#: A step's status in the state.
STATUS = {"done": "completed", "give_up": "failed", "requeue": "in_progress", "leave": "in_progress"}


def attempt_events(attempts: DataFrame, key: str) -> DataFrame:
    """key, round, status and error of each attempt as the state's events; error is null where an attempt is done."""
    status = F.coalesce(*(F.when(F.col("step") == s, F.lit(v)) for s, v in STATUS.items()))
    return attempts.select(key, "round", status.alias("status"), F.when(F.col("step") != "done", F.col("outcome")).alias("error"))
