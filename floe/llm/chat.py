"""Chat formatting by multi-party perspective rotation.

Native: DataFrame functions only.

For every participant of a dialogue, the dialogue is rendered with that
speaker as the assistant and the others as named users.  A rendered dialogue
is its segments (one per turn) in order; each comes with its character range
in the whole and the range to train on, so a dialogue of any length needs no
single row, group or task.

Turns are dealt in even ranges of (dialogue, turn); running lengths are summed
inside a range, and the ranges before it are added from a small table of
totals per (dialogue, range, speaker).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from floe.llm.common import stored

# Markers (fixed values).
ASSISTANT, USER, SYSTEM, CLOSE, END = "<|assistant|>\n", "<|user:", "<|system|>\n", "|>\n", "<|end|>\n"
#: Roles that frame a dialogue without taking part: rendered for all, never the assistant.
NARRATORS = ("system",)


def _name(role: Column) -> Column:
    """Speaker names without marker characters; null: unknown."""
    return F.translate(F.coalesce(role.cast("string"), F.lit("unknown")), "<|>", "   ")


def perspectives(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """One row per (dialogue, participant, turn):

    conv_id, speaker (the assistant), pos (turns before it), turn, role,
    segment (its text with markers), start and stop (its characters in the
    rendered dialogue), train_start and train_stop (the characters the loss
    covers: body and end marker of the speaker's own turns, else empty at stop).

    Turns are ordered by turn (null first), role and text; repeated rows are
    repeated turns.  Null texts are empty turns, null roles the speaker
    ``unknown``; ``<|`` inside a text becomes ``< |``.  Rows without a
    dialogue id belong to none and are left out; a dialogue of narrators only
    has no participants and no rows.  Empty table: empty result.  Other
    columns are never looked at.
    """
    t = turns.select(
        F.col(conv_col).alias("conv_id"),
        F.col(turn_col).alias("turn"),
        _name(F.col(role_col)).alias("role"),
        F.replace(F.coalesce(F.col(text_col).cast("string"), F.lit("")), F.lit("<|"), F.lit("< |")).alias("body"),
    ).where("conv_id IS NOT NULL")
    keys = ["conv_id", "turn", "role", "body", "tie"]
    dealt = t.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(*keys)
    dealt = stored(dealt.withColumn("part", F.spark_partition_id()), "chat-turns")
    ordered = Window.partitionBy("conv_id", "part").orderBy("turn", "role", "body", "tie")
    dealt = dealt.withColumn("local", F.row_number().over(ordered))

    speakers = t.where(~F.col("role").isin(*NARRATORS)).groupBy("conv_id", F.col("role").alias("speaker")).agg(F.lit(1).alias("_one"))
    views = dealt.join(speakers.drop("_one"), "conv_id")
    own = F.col("role") == F.col("speaker")
    header = (
        F.when(own, F.lit(ASSISTANT)).when(F.col("role").isin(*NARRATORS), F.lit(SYSTEM)).otherwise(F.concat(F.lit(USER), F.col("role"), F.lit(CLOSE)))
    )
    views = views.withColumn("header", header).withColumn("segment", F.concat("header", "body", F.lit(END)))
    views = views.withColumn("size", F.length("segment").cast("long"))
    upto = Window.partitionBy("conv_id", "part", "speaker").orderBy("local").rowsBetween(Window.unboundedPreceding, 0)
    views = views.withColumn("upto", F.sum("size").over(upto))

    totals = views.groupBy("conv_id", "speaker", "part").agg(F.sum("size").alias("chars"), F.count("*").alias("turns"))
    before = Window.partitionBy("conv_id", "speaker").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "conv_id",
        "speaker",
        "part",
        F.coalesce(F.sum("chars").over(before), F.lit(0)).alias("chars_before"),
        F.coalesce(F.sum("turns").over(before), F.lit(0)).alias("turns_before"),
    )
    placed = views.join(offsets, ["conv_id", "speaker", "part"])
    stop = F.col("chars_before") + F.col("upto")
    start = stop - F.col("size")
    return placed.select(
        "conv_id",
        "speaker",
        (F.col("turns_before") + F.col("local") - 1).cast("long").alias("pos"),
        "turn",
        "role",
        "segment",
        start.alias("start"),
        stop.alias("stop"),
        F.when(own, start + F.length("header")).otherwise(stop).alias("train_start"),
        stop.alias("train_stop"),
    )


ORACLE_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, translate(coalesce(role, 'unknown'), '<|>', '   ') AS role,
         replace(coalesce(text, ''), '<|', '< |') AS body
  FROM conversations WHERE conv_id IS NOT NULL),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, body) - 1 AS pos FROM t),
speakers AS (SELECT DISTINCT conv_id, role AS speaker FROM t WHERE role <> 'system'),
views AS (
  SELECT n.*, s.speaker,
         CASE WHEN role = speaker THEN '<|assistant|>' || chr(10) WHEN role = 'system' THEN '<|system|>' || chr(10)
              ELSE '<|user:' || role || '|>' || chr(10) END AS header
  FROM numbered n JOIN speakers s USING (conv_id)),
sized AS (SELECT *, header || body || '<|end|>' || chr(10) AS segment FROM views),
placed AS (SELECT *, sum(length(segment)) OVER (PARTITION BY conv_id, speaker ORDER BY pos) AS stop FROM sized)
SELECT conv_id, speaker, pos::BIGINT AS pos, turn, role, segment, (stop - length(segment))::BIGINT AS start, stop::BIGINT AS stop,
       (CASE WHEN role = speaker THEN stop - length(segment) + length(header) ELSE stop END)::BIGINT AS train_start,
       stop::BIGINT AS train_stop
FROM placed
"""
