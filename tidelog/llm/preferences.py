"""Preference formatting of paired conversations (operator 7).

The longest common prefix of turns of a chosen and a rejected conversation is
rendered once, as prompt; the rest of either is a completion, in which the
assistant's turns are marked for training. The result has one row per rendered
turn, so no conversation is gathered in one task: the end of the prompt is the
least turn at which the sides differ, a partial aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def answer_pairs(conversations: DataFrame) -> DataFrame:
    """Turns of a pair for each conversation: pair_id (its conv_id), side, turn, role, text.

    The chosen side is the whole conversation. The rejected one shares all
    turns before the last answer (the last turn of an assistant) and then has
    the last answer of another conversation, 2k for 2k + 1 and the reverse.
    Without an answer of its own a conversation is its chosen side only;
    without one of the other the rejected side ends before it. Null turns come
    before all others; a null conv_id is in no pair. Rows that repeat stay.
    """
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("pair_id"), "turn", "role", "text"
    )
    answered = F.col("role") == "assistant"
    ends = (
        rows.filter(answered & F.col("turn").isNotNull() & F.col("pair_id").isNotNull())
        .groupBy(F.col("pair_id").alias("conversation"))
        .agg(F.max("turn").alias("end"))
    )
    others = ends.select(
        F.expr("conversation ^ 1").alias("conversation"), F.col("end").alias("other_end")
    )
    both = ends.join(others, "conversation", "full")
    own = rows.join(both, F.col("pair_id") == F.col("conversation"), "left")

    def place(pair, side: str, turn):
        return F.struct(pair.alias("pair_id"), F.lit(side).alias("side"), turn.alias("turn"))

    pair, turn, end = F.col("pair_id"), F.col("turn"), F.col("end")
    shared = end.isNotNull() & (turn.isNull() | (turn < end))
    answer = answered & (turn == end) & F.col("other_end").isNotNull()
    places = F.array(
        place(pair, "chosen", turn),
        F.when(shared, place(pair, "rejected", turn)),
        F.when(answer, place(F.expr("pair_id ^ 1"), "rejected", F.col("other_end"))),
    )
    return own.select(F.explode(F.array_compact(places)).alias("at"), "role", "text").select(
        "at.pair_id", "at.side", "at.turn", "role", "text"
    )


def format_pairs(turns: DataFrame, trained_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """pair_id, part (prompt, chosen or rejected), turn, role, rendered, trained.

    ``turns`` has pair_id, side (chosen or rejected), turn, role and text. The
    rows of a part in order of turn, role and rendered text make its text.
    Turns are alike if both sides have the same rows at that number; a missing
    turn differs. Prompt rows are those of the chosen side. Null roles and
    texts are rendered as empty, null turn numbers come first and are -1. A pair
    with one side has no prompt; equal sides are all prompt. Rows that repeat
    are rendered as often as the side has them. Rows with a null pair_id or
    another side belong to no pair: their part is null and nothing of them is
    trained on. An empty table gives no rows.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = turns.select(
        "pair_id",
        F.when(
            F.col("pair_id").isNotNull() & F.col("side").isin("chosen", "rejected"), F.col("side")
        ).alias("side"),
        F.coalesce("turn", F.lit(-1)).cast("long").alias("turn"),
        role.alias("role"),
        F.concat(F.lit("<|"), role, F.lit("|>\n"), text, F.lit("<|end|>\n")).alias("rendered"),
    )

    def of(side: str, number: int):
        value = F.xxhash64("role", "rendered", F.lit(number)).cast("decimal(38,0)")
        return F.coalesce(F.sum(F.when(F.col("side") == side, value)), F.lit(0))

    alike = (of("chosen", 1) == of("rejected", 1)) & (of("chosen", 2) == of("rejected", 2))
    both = F.count_if(F.col("side") == "chosen") == F.count_if(F.col("side") == "rejected")
    ends = (
        rows.filter("side is not null")
        .groupBy("pair_id", "turn")
        .agg((alike & both).alias("alike"))
        .groupBy(F.col("pair_id").alias("pair"))
        .agg(F.min(F.when(~F.col("alike"), F.col("turn"))).alias("end"))
    )
    in_prompt = F.col("end").isNull() | (F.col("turn") < F.col("end"))
    part = F.when(F.col("side").isNotNull() & in_prompt, F.lit("prompt")).otherwise(F.col("side"))
    return (
        rows.join(ends, rows["pair_id"] == ends["pair"], "left")
        .withColumn("part", part)
        .filter((F.col("side") != "rejected") | (F.col("part") != "prompt") | F.col("side").isNull())
        .select(
            "pair_id",
            "part",
            "turn",
            "role",
            "rendered",
            F.coalesce(
                F.col("part").isin("chosen", "rejected") & F.col("role").isin(*trained_roles),
                F.lit(False),
            ).alias("trained"),
        )
    )
