"""Preference pairs for training.

A pair is a chosen and a rejected conversation. The longest common prefix of
their turns, equal in role and text, is rendered once as the prompt; what
follows in each is its completion, with a mask of the characters to train on,
those of the assistant's turns.

Pairs stay distributed by pair: turns are aligned by an equi-join on (pair,
place), the prefix ends at the first place that differs, and each side's turns
are gathered per pair. No pair is gathered with another.

Defined cases: turns are numbered by their order, then role and text, so gaps
and repeated turn numbers are settled; a null role or text equals only null and
renders as empty; equal conversations leave empty completions; a side without
turns gives an empty completion; rows with a null pair are left out; an empty
table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN, ROLE_END, CLOSE = "<|", "|>\n", "\n<|end|>\n"
TRAINED = "assistant"


def rendered(role: Column, text: Column) -> Column:
    """A turn as text: its head, its text, its close."""
    return F.concat(F.lit(OPEN), F.coalesce(role, F.lit("")), F.lit(ROLE_END), F.coalesce(text, F.lit("")), F.lit(CLOSE))


def placed(turns: DataFrame) -> DataFrame:
    """(pair, side, turn, role, text) with a gapless ``place`` in each conversation."""
    order = Window.partitionBy("pair", "side").orderBy(F.col("turn").asc_nulls_last(), "role", "text")
    return turns.where(F.col("pair").isNotNull()).select("pair", "side", "role", "text", F.row_number().over(order).alias("place"))


def preference_pairs(turns: DataFrame) -> DataFrame:
    """One row per pair from (pair, side, turn, role, text), side "chosen" or "rejected".

    pair, prefix_turns, prompt, chosen, chosen_mask, rejected, rejected_mask;
    a mask is an array of (start, end) in characters of its completion.
    """
    at = placed(turns)
    same = lambda c: F.max(F.when(F.col("side") == "chosen", F.struct(c))).eqNullSafe(F.max(F.when(F.col("side") == "rejected", F.struct(c))))
    aligned = at.groupBy("pair", "place").agg((same("role") & same("text") & (F.countDistinct("side") == 2)).alias("same"))
    prefix = aligned.groupBy("pair").agg((F.coalesce(F.min(F.when(~F.col("same"), F.col("place"))), F.max("place") + 1) - 1).alias("prefix_turns"))
    known = at.join(prefix.withColumnRenamed("pair", "p_pair"), F.col("pair") == F.col("p_pair")).drop("p_pair")
    text = rendered(F.col("role"), F.col("text"))
    turn = F.struct("place", text.alias("text"), F.coalesce(F.col("role") == TRAINED, F.lit(False)).alias("trained"), F.char_length(F.coalesce("text", F.lit(""))).alias("inner"), F.char_length(F.coalesce("role", F.lit(""))).alias("head"))
    part = lambda c: F.array_sort(F.collect_list(F.when(c, turn)))
    later = F.col("place") > F.col("prefix_turns")
    gathered = known.groupBy("pair").agg(
        F.max("prefix_turns").alias("prefix_turns"),
        part(~later & (F.col("side") == "chosen")).alias("shared"),
        part(later & (F.col("side") == "chosen")).alias("chosen"),
        part(later & (F.col("side") == "rejected")).alias("rejected"),
    )
    whole = lambda c: F.array_join(F.transform(c, lambda x: x["text"]), "")

    def mask(c: str) -> Column:
        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

        def add(acc: Column, x: Column) -> Column:
            first = acc["at"] + len(OPEN) + x["head"] + len(ROLE_END)
            span = F.struct(first.cast("int").alias("start"), (first + x["inner"] + len(CLOSE)).cast("int").alias("end"))
            return F.struct((acc["at"] + F.char_length(x["text"])).cast("int").alias("at"), F.when(x["trained"], F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"]).alias("spans"))

        return F.aggregate(c, start, add, lambda acc: acc["spans"])

    return gathered.select("pair", F.col("prefix_turns").cast("long").alias("prefix_turns"), whole("shared").alias("prompt"), whole("chosen").alias("chosen"), mask("chosen").alias("chosen_mask"), whole("rejected").alias("rejected"), mask("rejected").alias("rejected_mask"))


def swapped_answers(conversations: DataFrame) -> DataFrame:
    """Pairs from conversations alone: the rejected side of each ends in its neighbour's last answer.

    Neighbours are the ids 2k and 2k + 1. A conversation is cut after its last
    assistant turn; one without such a turn, or without a neighbour that has
    one, makes no pair.
    """
    talk = conversations.select(F.col("conv_id").alias("pair"), "turn", "role", "text").where(F.col("pair").isNotNull())
    last = talk.where(F.col("role") == TRAINED).groupBy("pair").agg(F.max(F.struct("turn", "text")).alias("last"))
    other = last.select(F.col("pair").bitwiseXOR(F.lit(1).cast("long")).alias("o_pair"), F.col("last.text").alias("other"))
    ends = last.join(other, F.col("pair") == F.col("o_pair")).select(F.col("pair").alias("e_pair"), F.col("last.turn").alias("e_turn"), "other")
    cut = talk.join(ends, (F.col("pair") == F.col("e_pair")) & (F.col("turn") <= F.col("e_turn")))
    answer = F.when((F.col("turn") == F.col("e_turn")) & (F.col("role") == TRAINED), F.col("other")).otherwise(F.col("text"))
    side = F.explode(F.array(F.lit("chosen"), F.lit("rejected"))).alias("side")
    both = cut.select("pair", "turn", "role", "text", answer.alias("answer"), side)
    return both.select("pair", "side", "turn", "role", F.when(F.col("side") == "chosen", F.col("text")).otherwise(F.col("answer")).alias("text"))
