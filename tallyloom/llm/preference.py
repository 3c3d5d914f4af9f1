"""Preference pairs as prompt and masked completions, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

OPEN, CLOSE, END = "<|", "|>\n", "<|end|>\n"
LEARNED = "assistant"


def turns(conversations: DataFrame, pair: Column, side: Column) -> DataFrame:
    """``pair_id, side, turns``: each side's turns in order, as array of (role, text).

    Order is turn number, then role and text, so repeated turn numbers have one
    result; null turn numbers come first.  A null role is ``unknown``, a null
    text is empty.  Rows without a pair are left out.
    """
    turn = F.struct(F.col("turn").alias("turn"), F.coalesce("role", F.lit("unknown")).alias("role"),
                    F.coalesce("text", F.lit("")).alias("text"))
    return (
        conversations.select(pair.alias("pair_id"), side.alias("side"), turn.alias("t"))
        .where(F.col("pair_id").isNotNull())
        .groupBy("pair_id", "side").agg(F.sort_array(F.collect_list("t")).alias("ts"))
        .select("pair_id", "side", F.transform("ts", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))
    )


def _rendered(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), turn["role"], F.lit(CLOSE), turn["text"], F.lit(END))


def _render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, _rendered), "")


def _spans(turns: Column) -> Column:
    """Array of (start, stop) character places of the learned texts in the rendering of ``turns``."""
    zero = F.struct(F.lit(0).cast("bigint").alias("at"),
                    F.array().cast("array<struct<start:bigint,stop:bigint>>").alias("spans"))

    def step(acc: Column, turn: Column) -> Column:
        start = acc["at"] + F.length(turn["role"]) + F.lit(len(OPEN) + len(CLOSE))
        stop = start + F.length(turn["text"])
        own = F.struct(start.cast("bigint").alias("start"), stop.cast("bigint").alias("stop"))
        return F.struct(
            (stop + F.lit(len(END))).cast("bigint").alias("at"),
            F.when(turn["role"] == LEARNED, F.concat(acc["spans"], F.array(own))).otherwise(acc["spans"]).alias("spans"))

    return F.aggregate(turns, zero, step, lambda acc: acc["spans"])


def preference_pairs(sided: DataFrame) -> DataFrame:
    """One row per pair: the longest common turn prefix rendered once, and what follows on either side.

    Input ``pair_id, side, turns`` with side ``chosen`` or ``rejected``.  Returns
    ``pair_id, n_prompt_turns, prompt, chosen, rejected, chosen_spans,
    rejected_spans``; spans are the character ranges of the completion that count
    for the loss (assistant texts), everything else is masked.  Turns are common
    if role and text are equal.  A missing side has no turns, so nothing is common.
    """
    empty = F.array().cast("array<struct<role:string,text:string>>")
    both = sided.groupBy("pair_id").agg(
        F.coalesce(F.first(F.when(F.col("side") == "chosen", F.col("turns")), ignorenulls=True), empty).alias("c"),
        F.coalesce(F.first(F.when(F.col("side") == "rejected", F.col("turns")), ignorenulls=True), empty).alias("r"))
    shorter = F.least(F.size("c"), F.size("r"))
    # place of the first turn that differs, from 0; the shorter side's length if none does
    differs = F.array_position(F.transform(F.arrays_zip("c", "r"), lambda z: z["c"] == z["r"]), False)
    cut = both.withColumn("n", F.when(differs > 0, F.least(differs - 1, shorter)).otherwise(shorter).cast("int"))
    cut = cut.withColumns({"_c": F.slice("c", F.col("n") + 1, F.size("c")), "_r": F.slice("r", F.col("n") + 1, F.size("r"))})
    return cut.select(
        "pair_id", F.col("n").alias("n_prompt_turns"), _render(F.slice("c", F.lit(1), F.col("n"))).alias("prompt"),
        _render(F.col("_c")).alias("chosen"), _render(F.col("_r")).alias("rejected"),
        _spans(F.col("_c")).alias("chosen_spans"), _spans(F.col("_r")).alias("rejected_spans"))
