"""Preference formatting: shared prompt once, two masked completions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import running

#: Turns per chunk when the turns of a conversation are numbered.
CHUNK_TURNS = 1024


def rendered(role: Column, text: Column) -> Column:
    return F.concat(F.lit("<|"), role, F.lit("|>\n"), text, F.lit("<|end|>\n"))


def preference_pairs(turns: DataFrame, pair: Column, side: Column, conv: str = "conv_id",
                     turn: str = "turn", role: str = "role", text: str = "text",
                     trained_role: str = "assistant") -> DataFrame:
    """One row per rendered turn of each pair of conversations.

    ``pair`` and ``side`` ("chosen" or "rejected") are functions of the conversation.
    The longest common prefix of turns (equal role and text) comes once, as part "prompt"; what
    follows comes as "chosen" and "rejected". Columns: pair_id, part, position (in the
    conversation, from 0), role, segment, char_start (in its part), n_chars, trained
    (part of a completion and spoken by ``trained_role``). The texts are the segments of a part
    in order; the mask is ``trained`` over [char_start, char_start + n_chars).

    Turns stay rows, so a conversation of any length needs no single task. Null role
    or text counts as empty; a null turn number comes first; rows that repeat conversation,
    turn, role and text are one turn; turns of equal number follow role, then text. A
    conversation without its other side, or without an id, has no prompt and trains
    nothing: its part is "unpaired". Other columns are ignored.
    """
    rows = turns.select(
        F.col(conv).alias("conv"), pair.alias("pair_id"), side.alias("side"), F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.dropDuplicates(["conv", "turn", "role", "text"])
    rows = rows.withColumn("segment", rendered(F.col("role"), F.col("text")))
    rows = rows.withColumn("n_chars", F.length("segment").cast("long"))
    placed = running(rows, ["conv"], F.floor(F.col("turn") / CHUNK_TURNS),
                     [F.col("turn").asc_nulls_first(), "role", "text"],
                     {"position": F.lit(1), "before": F.col("n_chars")})
    level = placed.where("pair_id is not null").groupBy("pair_id", "position").agg(
        F.count("*").alias("n"), F.countDistinct("side").alias("sides"),
        F.min("role").alias("r0"), F.max("role").alias("r1"), F.min("text").alias("t0"),
        F.max("text").alias("t1"), F.max("n_chars").alias("n_chars"))
    same = (F.col("sides") == 2) & (F.col("r0") == F.col("r1")) & (F.col("t0") == F.col("t1"))
    splits = level.groupBy("pair_id").agg(
        F.coalesce(F.min(F.when(~same, F.col("position"))), F.max("position") + 1).alias("shared"),
        (F.max("sides") == 2).alias("paired"))
    lengths = level.join(splits.select(F.col("pair_id").alias("_p"), "shared"), F.col("pair_id") == F.col("_p")).where(
        F.col("position") < F.col("shared")).groupBy("pair_id").agg(F.sum("n_chars").alias("prompt_chars"))
    pairs = splits.join(lengths, "pair_id", "left").withColumnRenamed("pair_id", "_p")
    out = placed.join(pairs, F.col("pair_id") == F.col("_p"), "left")
    paired = F.coalesce(F.col("paired"), F.lit(False))
    inside = F.col("position") < F.col("shared")
    part = F.when(~paired, F.lit("unpaired")).when(inside, F.lit("prompt")).otherwise(F.col("side"))
    skip = F.when(paired & ~inside, F.coalesce(F.col("prompt_chars"), F.lit(0))).otherwise(F.lit(0))
    # The prompt is written from the chosen side alone.
    return out.where(~paired | ~inside | (F.col("side") == "chosen")).select(
        "pair_id", part.alias("part"), "position", "role", "segment",
        (F.col("before") - skip).cast("long").alias("char_start"), "n_chars",
        (paired & ~inside & (F.col("role") == trained_role)).alias("trained"))


def neighbours(conv: str = "conv_id") -> tuple[Column, Column]:
    """The pairing of the sample table, which names none: conversation 2k is the
    chosen, 2k + 1 the rejected answer of pair k."""
    number = F.col(conv)
    return (F.floor(number / 2).cast("long"),
            F.when(F.pmod(number, F.lit(2)) == 0, F.lit("chosen")).otherwise(F.lit("rejected")))
