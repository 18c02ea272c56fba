"""Multi-party chats rendered from every participant's point of view, in DataFrame functions alone.

Every speaker of a conversation but ``system`` is a participant. For each of them the dialogue is rendered with this
speaker as ``assistant`` and every other one as a user with a name; system turns stay system turns. A turn reads::

    <|im_start|>assistant            <|im_start|>user name=alice
    text<|im_end|>                   text<|im_end|>

and the mask lists the places (code points, end exclusive) that a model learns: the text of the assistant's turns with
the end mark after it. ``<|`` inside a text or a name becomes ``<\\|``, so that no text can pass for a mark.

A rendering is cut into segments of ``SEGMENT`` consecutive turn numbers, so that a conversation of any length is
put together in pieces; ``start`` is the place of a segment in the whole rendering and the mask counts from there.
Turns are ordered by turn number, then speaker, then text; equal rows are each rendered. A turn number that very many
different rows share stays one segment.

Nulls: a null text is empty, a null speaker is a participant named ``unknown``, a null turn number comes
before all others in a segment of its own, a null conversation is a conversation of its own. A conversation without participants
has no rendering. An empty table gives no rows. Extra columns are left out and may have any names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluicegate.llm.common import table

SEGMENT = 64


def _plain(text: Column) -> Column:
    return F.replace(text, F.lit("<|"), F.lit("<\\|"))


def perspectives(
    turns: DataFrame, conversation: str = "conv_id", turn: str = "turn", speaker: str = "role", text: str = "text", segment: int = SEGMENT
) -> DataFrame:
    """(conv_id, perspective, segment, start, rendered, mask, turns) with one row per participant and segment."""
    rows = turns.select(
        F.col(conversation).alias("conv_id"),
        F.col(turn).cast("bigint").alias("_turn"),
        F.coalesce(F.col(speaker).cast("string"), F.lit("unknown")).alias("_who"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_text"),
    )
    cut = rows.withColumn("segment", F.coalesce(F.floor(F.col("_turn") / segment), F.lit(-1)).cast("bigint"))
    people = rows.filter("_who != 'system'").groupBy("conv_id").agg(F.collect_set("_who").alias("_people"))
    pieces = cut.groupBy("conv_id", "segment").agg(F.array_sort(F.collect_list(F.struct("_turn", "_who", "_text"))).alias("_turns"))
    seen = pieces.join(people.withColumnRenamed("conv_id", "_conv"), F.col("conv_id").eqNullSafe(F.col("_conv"))).select(
        "conv_id", "segment", "_turns", F.explode("_people").alias("perspective")
    )

    def head(t: Column) -> Column:
        name = F.concat(F.lit("user name="), _plain(t["_who"]))
        who = F.when(t["_who"] == F.col("perspective"), "assistant").when(t["_who"] == "system", "system").otherwise(name)
        return F.concat(F.lit("<|im_start|>"), who, F.lit("\n"))

    parts = F.transform("_turns", lambda t: F.struct(head(t).alias("head"), F.concat(_plain(t["_text"]), F.lit("<|im_end|>")).alias("body"), (t["_who"] == F.col("perspective")).alias("own")))
    rendered = seen.withColumn("_parts", parts).select(
        "conv_id",
        "perspective",
        "segment",
        F.size("_turns").cast("bigint").alias("turns"),
        F.array_join(F.transform("_parts", lambda p: F.concat(p["head"], p["body"], F.lit("\n"))), "").alias("rendered"),
        _mask(F.col("_parts")).alias("mask"),
    )
    before = Window.partitionBy("conv_id", "perspective").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    sizes = rendered.select("conv_id", "perspective", "segment", F.char_length("rendered").cast("bigint").alias("_n"))
    if segment <= 0:
        raise ValueError("a segment needs at least one turn number")
    starts = sizes.withColumn("start", F.coalesce(F.sum("_n").over(before), F.lit(0)).cast("bigint"))
    return rendered.join(
        starts.select(F.col("conv_id").alias("_c"), F.col("perspective").alias("_p"), F.col("segment").alias("_s"), "start"),
        F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("perspective") == F.col("_p")) & (F.col("segment") == F.col("_s")),
    ).select("conv_id", "perspective", "segment", "start", "rendered", "mask", "turns")


def _mask(parts: Column) -> Column:
    """(start, end) of the bodies of own turns."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("out"))

    def step(acc: Column, part: Column) -> Column:
        begin = acc["at"] + F.char_length(part["head"])
        end = begin + F.char_length(part["body"])
        one = F.array(F.struct(begin.alias("start"), end.alias("end")))
        return F.struct((end + 1).alias("at"), F.when(part["own"], F.concat(acc["out"], one)).otherwise(acc["out"]).alias("out"))

    return F.aggregate(parts, start, step, lambda acc: acc["out"])


def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = perspectives(table(spark, sf_dir, "conversations"))
    places = F.array_join(F.transform("mask", lambda m: F.concat_ws(":", m["start"], m["end"])), ",")
    return found.withColumn("mask", places)


OP5_SQL = f"""
WITH t AS (
  SELECT row_number() OVER () AS number, conv_id, turn, coalesce(role, 'unknown') AS who, coalesce(text, '') AS body,
         CAST(coalesce(floor(turn / {SEGMENT}), -1) AS BIGINT) AS segment
  FROM conversations
), people AS (
  SELECT DISTINCT conv_id, who AS perspective FROM t WHERE who <> 'system'
), parts AS (
  SELECT number, t.conv_id, perspective, segment, turn, who, body, who = perspective AS own,
         '<|im_start|>' || CASE WHEN who = perspective THEN 'assistant' WHEN who = 'system' THEN 'system'
           ELSE 'user name=' || replace(who, '<|', '<\\|') END || chr(10) AS head,
         replace(body, '<|', '<\\|') || '<|im_end|>' AS tail
  FROM t JOIN people ON t.conv_id IS NOT DISTINCT FROM people.conv_id
), placed AS (
  SELECT *, sum(length(head) + length(tail) + 1) OVER (PARTITION BY conv_id, perspective, segment
              ORDER BY turn NULLS FIRST, who, body, number) - length(head) - length(tail) - 1 AS pos
  FROM parts
), whole AS (
  SELECT conv_id, perspective, segment, count(*) AS turns,
         string_agg(head || tail || chr(10), '' ORDER BY turn NULLS FIRST, who, body, number) AS rendered,
         coalesce(string_agg((pos + length(head)) || ':' || (pos + length(head) + length(tail)), ',' ORDER BY pos) FILTER (own), '') AS mask
  FROM placed GROUP BY conv_id, perspective, segment
)
SELECT conv_id, perspective, segment, rendered, mask, turns,
       CAST(coalesce(sum(length(rendered)) OVER (PARTITION BY conv_id, perspective ORDER BY segment
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start
FROM whole
"""
