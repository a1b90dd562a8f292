"""Chat formatting by multi-party perspective rotation.

A dialogue is rendered once for every participant. In each rendering that speaker
is the assistant and the others are named users; the mask covers what the speaker
says, so a model learns every voice of the dialogue, each from its own seat.
System turns set the scene: they stay system turns in all renderings and are no
participant.

A row has a bound: a dialogue of more than PART turns is rendered in consecutive parts of
PART turns, counted, whatever the turn numbers are. Every participant of the whole dialogue
has a row for every part, silent or not, so the rows of one participant, put together in
order, are the whole dialogue and lose nothing. Turns are counted across range partitions, so
no task holds a dialogue, not even all rows without a conversation id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ordered import numbered
from .common import Scratch

#: Turns of one part.
PART = 4096

SYSTEM = "system"
_ASSISTANT, _END = "<|assistant|>\n", "<|end|>\n"


def clean(text: Column) -> Column:
    """Text that cannot be taken for a control mark: a space comes between < and |."""
    return F.replace(F.coalesce(text, F.lit("")), F.lit("<|"), F.lit("< |"))


def _head(role: Column) -> Column:
    """The mark line of a turn in the eyes of others; roles with other signs get a digest too, so that two speakers never share a name."""
    plain = F.concat(F.regexp_replace(role, "[^A-Za-z0-9_-]", "_"), F.lit("_"), F.left(F.md5(role), F.lit(16)))
    name = F.when(role.rlike("^[A-Za-z0-9_-]+\\z"), role).otherwise(plain)
    return F.when(role == SYSTEM, F.lit("<|system|>\n")).otherwise(F.concat(F.lit("<|user name="), name, F.lit("|>\n")))


def rotate(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", part: int = PART) -> DataFrame:
    """One row per conversation, part and participant: conv_id, part, participant, n_turns, rendered, mask, n_masked.

    rendered has, per turn in order of (turn, role, digest of the text), a mark line (<|system|>,
    <|assistant|> or <|user name=...|>), the text and <|end|>. mask lists start and
    end (code points of this row's rendering, end exclusive) of the speaker's texts
    with their end marks; n_masked is their length. A null role speaks as "unknown",
    a null text is empty, null turns come first; names keep letters,
    digits, - and _, a name with others has them as _ and ends with a digest. Repeated rows are turns that were said
    repeatedly. A conversation of system turns alone gives no row, nor does an empty
    table; null conversation ids are one conversation. Other columns are not looked at.
    """
    rows = turns.select(
        F.col(conv_col).alias("conv_id"),
        F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col), F.lit("unknown")).alias("role"),
        clean(F.col(text_col)).alias("text"),
    )
    rows = numbered(rows.withColumn("digest", F.md5("text")), ["conv_id"], ["turn", "role", "digest"], "place", Scratch(turns.sparkSession, "chat"))
    rows = rows.select("conv_id", "place", "role", "text", F.floor(F.col("place") / part).cast("long").alias("part"))
    seats = rows.filter(F.col("role") != SYSTEM).select(F.col("conv_id").alias("seat_of"), F.col("role").alias("participant")).distinct()

    rows = rows.withColumn("head", _head(F.col("role"))).withColumn("body", F.concat("text", F.lit(_END)))
    w = Window.partitionBy("conv_id", "part").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # upto: code points before the turn's body where every speaker is a user
    rows = rows.withColumn("upto", F.sum(F.length("head") + F.length("body")).over(w) - F.length("body"))
    held = F.struct("place", "role", "head", "body", "upto")
    whole = rows.groupBy("conv_id", "part").agg(F.array_sort(F.collect_list(held)).alias("turns"))

    out = whole.join(seats, F.col("conv_id").eqNullSafe(F.col("seat_of")))
    longer = F.length(_head(F.col("participant"))) - len(_ASSISTANT)  # what each of the speaker's own mark lines saves
    mine = F.filter("turns", lambda t: t["role"] == F.col("participant"))

    def span(t: Column, i: Column) -> Column:
        start = (t["upto"] - (i + 1) * longer).cast("long")
        return F.struct(start.alias("start"), (start + F.length(t["body"])).cast("long").alias("end"))

    said = F.transform("turns", lambda t: F.concat(F.when(t["role"] == F.col("participant"), F.lit(_ASSISTANT)).otherwise(t["head"]), t["body"]))
    out = out.select("conv_id", "part", "participant", F.size("turns").cast("long").alias("n_turns"), F.array_join(said, "").alias("rendered"), F.transform(mine, span).alias("mask"))
    return out.withColumn("n_masked", F.aggregate("mask", F.lit(0).cast("long"), lambda n, m: n + m["end"] - m["start"]))


SQL = {
    "op10_chat": f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, 'unknown') AS role, replace(coalesce(text, ''), '<|', '< |') AS text FROM conversations),
p AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) - 1 AS place FROM t),
s AS (SELECT DISTINCT conv_id, role AS participant FROM p WHERE role <> 'system'),
r AS (
  SELECT s.conv_id, p.place // {PART} AS part, s.participant, p.place, p.role,
    CASE WHEN p.role = 'system' THEN '<|system|>' WHEN p.role = s.participant THEN '<|assistant|>'
      WHEN regexp_full_match(p.role, '[A-Za-z0-9_-]+') THEN '<|user name=' || p.role || '|>'
      ELSE '<|user name=' || regexp_replace(p.role, '[^A-Za-z0-9_-]', '_', 'g') || '_' || left(md5(p.role), 16) || '|>' END || chr(10) AS head,
    p.text || '<|end|>' || chr(10) AS body
  FROM s JOIN p ON p.conv_id IS NOT DISTINCT FROM s.conv_id),
o AS (
  SELECT *, sum(length(head) + length(body)) OVER (PARTITION BY conv_id, part, participant ORDER BY place) AS stop
  FROM r)
SELECT conv_id, part, participant, count(*)::BIGINT AS n_turns,
  string_agg(head || body, '' ORDER BY place) AS rendered,
  coalesce(string_agg((stop - length(body))::BIGINT || ':' || stop::BIGINT, ',' ORDER BY place) FILTER (WHERE role = participant), '') AS mask,
  coalesce((sum(length(body)) FILTER (WHERE role = participant))::BIGINT, 0) AS n_masked
FROM o GROUP BY ALL
""",
}
