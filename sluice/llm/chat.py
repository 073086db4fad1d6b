"""Preference formatting of paired conversations (DataFrame functions only).

A chosen and a rejected conversation share their longest common turn prefix, which is rendered once
as the prompt.  What follows is rendered for each side as a completion with a mask: the character
spans of the assistant's words, which are the ones to train on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, MIDDLE, CLOSE = "<|im_start|>", "\n", "<|im_end|>\n"
TRAINED_ROLE = "assistant"


def _role(t: Column) -> Column:
    return F.coalesce(t["role"], F.lit(""))


def _text(t: Column) -> Column:
    return F.coalesce(t["text"], F.lit(""))


def render(turns: Column) -> Column:
    """Turns (array of struct with role and text) as one string."""
    return F.array_join(F.transform(turns, lambda t: F.concat(F.lit(OPEN), _role(t), F.lit(MIDDLE), _text(t), F.lit(CLOSE))), "")


def trained_spans(turns: Column) -> Column:
    """Character spans (0-based start, end exclusive) of ``render(turns)`` that count for training:
    the text of assistant turns and the marker that closes it."""
    long = lambda n: F.lit(n).cast("long")
    start = F.struct(long(0).alias("at"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans"))

    def step(acc: Column, t: Column) -> Column:
        body = acc["at"] + long(len(OPEN) + len(MIDDLE)) + F.length(_role(t))
        end = body + F.length(_text(t)) + long(len(CLOSE))
        spans = F.when(_role(t) == TRAINED_ROLE, F.array_append(acc["spans"], F.struct(body.alias("start"), end.alias("end")))).otherwise(acc["spans"])
        return F.struct(end.alias("at"), spans.alias("spans"))

    return F.aggregate(turns, start, step, lambda acc: acc["spans"])


def preference_pairs(conversations: DataFrame, pairs: DataFrame) -> DataFrame:
    """One row per pair: pair_id, chosen_id, rejected_id, prompt_turns, prompt, chosen, rejected,
    chosen_spans, rejected_spans, usable.

    ``conversations`` has conv_id, turn, role, text; ``pairs`` has a unique pair_id, chosen_id and
    rejected_id (null, or unknown to ``conversations``: that side has no turns).  Turns go by turn
    number, nulls last, ties by role and text; repeated rows are repeated turns.  Two turns are
    equal if role and text are, nulls included; null role and text are rendered empty, and a null
    role is never trained.  Empty sides and identical conversations give empty completions; usable
    is true where both completions hold a trained span.  Pairs without any turn give a row with an
    empty prompt.  Rows of ``conversations`` with a null conv_id belong to no pair.  Columns other
    than those named are ignored.  All turns of a pair meet in one row, as its output does.
    """
    turn = F.struct(F.col("turn").isNull().alias("late"), F.col("turn").alias("turn"), F.col("role").alias("role"), F.col("text").alias("text"))
    turns = conversations.select(F.col("conv_id").alias("_conv"), turn.alias("_turn"))
    both = F.array(F.struct(F.lit(True).alias("chosen"), F.col("chosen_id").alias("conv")),
                   F.struct(F.lit(False).alias("chosen"), F.col("rejected_id").alias("conv")))
    sides = pairs.select("pair_id", "chosen_id", "rejected_id", F.explode(both).alias("s"))
    joined = sides.join(turns, F.col("s.conv") == F.col("_conv"), "left")
    ordered = lambda chosen: F.array_sort(F.collect_list(F.when((F.col("s.chosen") == chosen) & F.col("_conv").isNotNull(), F.col("_turn"))))
    rows = joined.groupBy("pair_id", "chosen_id", "rejected_id").agg(ordered(True).alias("a"), ordered(False).alias("b"))
    m = F.least(F.size("a"), F.size("b"))
    alike = F.zip_with(F.slice("a", F.lit(1), m), F.slice("b", F.lit(1), m),
                       lambda x, y: x["role"].eqNullSafe(y["role"]) & x["text"].eqNullSafe(y["text"]))
    first_odd = F.array_position(alike, F.lit(False))
    rows = rows.withColumn("p", F.when(first_odd == 0, m).otherwise(first_odd - 1).cast("int"))
    rest = lambda c: F.slice(c, F.col("p") + 1, F.greatest(F.size(c) - F.col("p"), F.lit(0)))
    out = rows.select("pair_id", "chosen_id", "rejected_id", F.col("p").cast("long").alias("prompt_turns"),
                      render(F.slice("a", F.lit(1), F.col("p"))).alias("prompt"),
                      render(rest("a")).alias("chosen"), render(rest("b")).alias("rejected"),
                      trained_spans(rest("a")).alias("chosen_spans"), trained_spans(rest("b")).alias("rejected_spans"))
    return out.withColumn("usable", (F.size("chosen_spans") > 0) & (F.size("rejected_spans") > 0))
