"""Multi-party perspective rotation of dialogues, in DataFrame functions only.

Every speaker of a conversation in turn is the assistant: the whole dialogue is rendered from
that speaker's side, the others appear as named users, and only the assistant's own words are
marked for training.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

BLOCK = 256
#: Repetitions of a turn that one array holds.
COPIES = 4096


def rotate(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    speaker_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """One row per conversation, perspective and turn; the segments in order are the rendered dialogue.

    Columns: conv_id, perspective (the speaker who is the assistant), turn, copy (tells equal
    turns apart), speaker, segment, start (characters of the dialogue before the segment),
    mask_start and mask_end (the characters of the dialogue that train; null for the others'
    turns). A segment is `<|assistant|>` or `<|user name=SPEAKER|>`, a line feed, the text and
    `<|end|>` with a line feed; mask covers text and `<|end|>`.

    The dialogue stays one row a turn, so a conversation of any length is never gathered; its
    offsets are sums over blocks of BLOCK turns and then over the blocks. The rows are as many
    as turns times speakers, which is what the method returns. A null speaker is called
    `unknown`, a null text is empty, null conversations form one conversation, null turns come
    first; repeated turns are ordered by speaker and text. Marks within a text or a speaker's
    name are kept as they are: start and mask tell them from the segment's own. Turns that have
    one number in one conversation meet in one window. Extra columns are ignored; an empty
    table gives no rows.
    """
    t = turns.select(
        F.col(conv_col).alias("conv_id"),
        F.col(turn_col).alias("turn"),
        F.coalesce(F.col(speaker_col), F.lit("unknown")).alias("speaker"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    # equal turns are one row with a count until they are told apart, so repetitions meet as counts
    t = t.groupBy("conv_id", "turn", "speaker", "text").agg(F.count("*").alias("copies"))
    t = t.withColumn("first", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("copies") - 1, F.lit(COPIES).cast("bigint"))))
    last = F.least(F.col("first") + COPIES, F.col("copies")) - 1
    t = t.select("conv_id", "turn", "speaker", "text", F.explode(F.sequence("first", last)).alias("copy"))
    sides = t.groupBy("conv_id", F.col("speaker").alias("perspective")).agg(F.lit(1).alias("one")).drop("one")
    sides = sides.select(F.col("conv_id").alias("c"), "perspective")
    own = F.col("speaker") == F.col("perspective")
    head = F.when(own, F.lit("<|assistant|>\n")).otherwise(F.concat(F.lit("<|user name="), F.col("speaker"), F.lit("|>\n")))
    seen = t.join(sides, F.col("conv_id").eqNullSafe(F.col("c"))).select(
        "conv_id", "perspective", "turn", "copy", "speaker", F.concat(head, "text", F.lit("<|end|>\n")).alias("segment"), F.length(head).alias("head"), own.alias("own")
    )
    seen = seen.withColumn("block", F.expr(f"turn div {BLOCK}")).withColumn("n", F.length("segment").cast("bigint"))
    per = seen.groupBy("conv_id", "perspective", "block").agg(F.sum("n").alias("m"))
    before = Window.partitionBy("conv_id", "perspective").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("bigint")
    per = per.select(F.col("conv_id").alias("c"), F.col("perspective").alias("p"), F.col("block").alias("b"), F.coalesce(F.sum("m").over(before), zero).alias("earlier"))
    inside = Window.partitionBy("conv_id", "perspective", "block").orderBy("turn", "speaker", "segment", "copy").rowsBetween(Window.unboundedPreceding, -1)
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("perspective") == F.col("p")) & F.col("block").eqNullSafe(F.col("b"))
    placed = seen.withColumn("within", F.coalesce(F.sum("n").over(inside), zero)).join(per, same).withColumn("start", F.col("earlier") + F.col("within"))
    return placed.select(
        "conv_id",
        "perspective",
        "turn",
        "copy",
        "speaker",
        "segment",
        "start",
        F.when(F.col("own"), F.col("start") + F.col("head")).alias("mask_start"),
        F.when(F.col("own"), F.col("start") + F.col("n") - 1).alias("mask_end"),
    )
