"""Operator 6: multi-party perspective rotation of dialogues. DataFrame operations only.

For every participant of a conversation the dialogue is rendered with that speaker as the assistant, all
others as users named after themselves, and system turns as they are. The mask marks what is trained on: the
assistant's words and the end mark behind them, as runs of characters ("22:0 130:1 ...").

A conversation is rendered in segments of ``SEGMENT`` turn numbers; a usual one is one segment. Where a
segment would hold more than ``SEGMENT`` rows (repeated or null turn numbers, null conversation ids), its
conversation is cut by row position instead, into segments 0, 1, ... of ``SEGMENT`` rows. So no row holds more
turns than that, whatever the turn numbers. ``ORACLE`` states the first rule only: where the second holds, its
texts are those of the segments joined. Turns are grouped once, not once per participant.

Row positions come from one sort of the cut conversations by ranges of whole rows: equal rows may be parted, so
one conversation or one repeated row is dealt to many tasks; a task's offset is the rows of the tasks before it.

Defined results: a null text is empty; a null speaker is ``unknown``; turns are ordered by turn, speaker, text
with its end mark (null turns first, in segment 0 of a conversation cut by turn numbers), repeats stay; rows with a null conversation
id are one conversation;
a conversation of system turns only has no perspective; marks of the template inside a text are broken up by
a space; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import once, shuffle_parts

SEGMENT = 1024
RANGE_ROWS = 100_000             # rows of a range of the sort
SMALL_ROWS = 1_000_000           # conversations cut by position are broadcast up to so many
SYSTEM = "system"
END = "<|im_end|>\n"


def _row_segments(rows: DataFrame, n: int) -> DataFrame:
    """The ``n`` rows with ``segment`` set to their position in their conversation, by ``SEGMENT``."""
    order = ["conv_id", "turn", "speaker", "rest"]
    dealt = rows.withColumn("salt", F.xxhash64(F.monotonically_increasing_id()))
    dealt = dealt.repartitionByRange(shuffle_parts(rows, -(-n // RANGE_ROWS)), *order, "salt").sortWithinPartitions(*order)
    at = once(dealt.select(*order, F.monotonically_increasing_id().alias("at")))
    at = at.withColumn("part", F.shiftright("at", 33))
    parts = at.groupBy(F.col("conv_id").alias("c"), F.col("part").alias("p")).agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("c").orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0)))
    found = at.join(parts, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("part") == F.col("p")))
    position = F.col("offset") + F.col("at") - F.col("first")
    return found.select(*order, F.floor(position / SEGMENT).cast("long").alias("segment"))


def _segments(rows: DataFrame) -> DataFrame:
    """The rows with their segment: by turn number, or by position where that gives too many rows."""
    segment = F.floor(F.coalesce("turn", F.lit(0)) / SEGMENT).cast("long")
    rows = rows.withColumn("segment", segment)
    sizes = rows.groupBy("conv_id", "segment").count().groupBy(F.col("conv_id").alias("c")) \
        .agg(F.max("count").alias("most"), F.sum("count").alias("n"))
    cut = once(sizes.where(F.col("most") > SEGMENT).select("c", "n"))
    count, n = cut.agg(F.count(F.lit(1)), F.sum("n")).first()
    if not count:
        return rows
    cut = F.broadcast(cut) if count <= SMALL_ROWS else cut
    same = F.col("conv_id").eqNullSafe(F.col("c"))
    return rows.join(cut, same, "left_anti").unionByName(_row_segments(rows.join(cut, same, "left_semi").drop("segment"), n))


def rotate_perspectives(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", speaker_col: str = "role",
                        text_col: str = "text") -> DataFrame:
    """(conv_id, perspective, segment, n_turns, n_chars, trained_chars, text, mask)."""
    clean = F.replace(F.coalesce(F.col(text_col), F.lit("")), F.lit("<|"), F.lit("< |"))
    rows = turns.select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
        F.translate(F.replace(F.coalesce(F.col(speaker_col), F.lit("unknown")), F.lit("<|"), F.lit("< |")), "\n\r", "  ").alias("speaker"),
        F.concat(clean, F.lit(END)).alias("rest"))
    dialogue = (_segments(rows).groupBy("conv_id", "segment")
                .agg(F.sort_array(F.collect_list(F.struct("turn", "speaker", "rest"))).alias("turns")))
    people = (rows.where(F.col("speaker") != SYSTEM).groupBy(F.col("conv_id").alias("c"))
              .agg(F.collect_set("speaker").alias("people")))
    seen = dialogue.join(people, F.col("conv_id").eqNullSafe(F.col("c"))).withColumn("perspective", F.explode("people"))

    def head(t):
        return (F.when(t["speaker"] == SYSTEM, F.lit("<|im_start|>system\n"))
                .when(t["speaker"] == F.col("perspective"), F.lit("<|im_start|>assistant\n"))
                .otherwise(F.concat(F.lit("<|im_start|>user name="), t["speaker"], F.lit("\n"))))

    parts = F.transform("turns", lambda t: F.struct(
        head(t).alias("head"), t["rest"].alias("rest"), (t["speaker"] == F.col("perspective")).alias("trained")))
    runs = F.transform("parts", lambda p: F.concat(F.length(p["head"]).cast("string"), F.lit(":0 "), F.length(p["rest"]).cast("string"),
                                                   F.when(p["trained"], F.lit(":1")).otherwise(F.lit(":0"))))
    text = F.array_join(F.transform("parts", lambda p: F.concat(p["head"], p["rest"])), "")
    trained = F.aggregate("parts", F.lit(0).cast("long"),
                          lambda n, p: n + F.when(p["trained"], F.length(p["rest"]).cast("long")).otherwise(F.lit(0).cast("long")))
    return (seen.withColumn("parts", parts)
            .select(F.col("conv_id").alias(conv_col), "perspective", "segment", F.size("parts").cast("long").alias("n_turns"),
                    text.alias("text"), F.array_join(runs, " ").alias("mask"), trained.alias("trained_chars"))
            .withColumn("n_chars", F.length("text").cast("long")))


ORACLE = f"""
WITH rows AS (
  SELECT conv_id, turn, translate(replace(coalesce(role, 'unknown'), '<|', '< |'), chr(10) || chr(13), '  ') AS speaker,
         replace(coalesce(text, ''), '<|', '< |') || '<|im_end|>' || chr(10) AS rest,
         CAST(floor(coalesce(turn, 0) / {SEGMENT}.0) AS BIGINT) AS segment
  FROM conversations),
people AS (SELECT DISTINCT conv_id, speaker AS perspective FROM rows WHERE speaker <> 'system'),
parts AS (
  SELECT r.*, p.perspective, r.speaker = p.perspective AS trained,
         CASE WHEN r.speaker = 'system' THEN '<|im_start|>system' || chr(10)
              WHEN r.speaker = p.perspective THEN '<|im_start|>assistant' || chr(10)
              ELSE '<|im_start|>user name=' || r.speaker || chr(10) END AS head
  FROM rows r JOIN people p ON r.conv_id IS NOT DISTINCT FROM p.conv_id)
SELECT conv_id, perspective, segment, count(*) AS n_turns,
       string_agg(head || rest, '' ORDER BY turn NULLS FIRST, speaker, rest) AS text,
       string_agg(length(head) || ':0 ' || length(rest) || CASE WHEN trained THEN ':1' ELSE ':0' END, ' '
                  ORDER BY turn NULLS FIRST, speaker, rest) AS mask,
       CAST(sum(CASE WHEN trained THEN length(rest) ELSE 0 END) AS BIGINT) AS trained_chars,
       CAST(sum(length(head) + length(rest)) AS BIGINT) AS n_chars
FROM parts GROUP BY conv_id, perspective, segment
"""
