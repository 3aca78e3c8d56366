"""Preference formatting, in DataFrame operations only.

The longest common prefix of turns of a chosen and a rejected conversation is rendered
once as the prompt; what follows in either is its completion, in segments of text with a
mask: what the assistant says is trained on, role headers and other roles are not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ASSISTANT = "assistant"


def turns_of(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, turns): each conversation's turns (role, text) in order; a null role or text
    is empty, turns of one number are ordered by role and text. Rows without id are left
    out. A conversation is one row, as a document is."""
    own = rows.filter(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).alias("conv_id"),
        F.struct(
            F.col(turn).alias("turn"), F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text")
        ).alias("t"),
    )
    turns = F.sort_array(F.collect_list("t"))
    return own.groupBy("conv_id").agg(F.transform(turns, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))


def common_turns(a: Column, b: Column) -> Column:
    """Length of the longest common prefix."""
    n = F.least(F.size(a), F.size(b))
    differ = F.filter(F.sequence(F.lit(1), n), lambda i: F.element_at(a, i) != F.element_at(b, i))
    return F.when(n <= 0, F.lit(0)).otherwise(F.coalesce(F.get(differ, F.lit(0)) - 1, n))


def _header(t: Column) -> Column:
    return F.concat(F.lit("<|"), t["role"], F.lit("|>\n"))


def _body(t: Column) -> Column:
    return F.concat(t["text"], F.lit("<|end|>\n"))


def _segments(turns: Column) -> Column:
    def of(t: Column) -> Column:
        head = F.struct(_header(t).alias("text"), F.lit(False).alias("train"))
        body = F.struct(_body(t).alias("text"), (t["role"] == ASSISTANT).alias("train"))
        return F.array(head, body)

    return F.flatten(F.transform(turns, of))


def preference_pairs(pairs: DataFrame) -> DataFrame:
    """(pair_id, chosen, rejected: arrays of (role, text)) as training rows: n_prompt_turns,
    prompt, chosen and rejected (arrays of (text, train)); other columns stay.

    A side without turns, or null, is an empty conversation: the prompt is then empty and the
    other side all completion. Equal conversations have an empty completion on both sides.
    Repeated rows stay, an empty table gives an empty one, texts are rendered whole.
    """
    none = "array<struct<role:string,text:string>>"
    a, b = (F.coalesce(c, F.array().cast(none)) for c in ("chosen", "rejected"))
    sides = pairs.withColumns({"chosen": a, "rejected": b})
    sides = sides.withColumn("n_prompt_turns", common_turns(F.col("chosen"), F.col("rejected")))
    k = F.col("n_prompt_turns")
    prompt = F.array_join(F.transform(F.slice("chosen", F.lit(1), k), lambda t: F.concat(_header(t), _body(t))), "")

    def rest(c: str) -> Column:
        return _segments(F.slice(c, k + 1, F.size(c)))

    return sides.withColumns({"prompt": prompt, "chosen": rest("chosen"), "rejected": rest("rejected")})


def neighbours(conversations: DataFrame) -> DataFrame:
    """(pair_id, chosen_id, chosen, rejected_id, rejected): the conversations 2k (chosen) and
    2k + 1 (rejected); one without neighbour stands alone, its other side null."""
    side = conversations.withColumn("pair_id", F.floor(F.col("conv_id") / 2))
    even = F.pmod("conv_id", F.lit(2)) == 0
    a = side.filter(even).select("pair_id", F.col("conv_id").alias("chosen_id"), F.col("turns").alias("chosen"))
    b = side.filter(~even).select("pair_id", F.col("conv_id").alias("rejected_id"), F.col("turns").alias("rejected"))
    return a.join(b, "pair_id", "full")


def other_answers(conversations: DataFrame) -> DataFrame:
    """(pair_id, chosen, rejected, answer_id) of every conversation (conv_id, turns): as it is,
    and with the text of its last assistant turn taken from the last one of conversation
    ``answer_id``, its neighbour (2k and 2k + 1 are neighbours). Where either has no assistant
    turn, or there is no neighbour, the rejected side is null."""
    said = F.filter("turns", lambda t: t["role"] == ASSISTANT)
    answers = conversations.select(
        F.col("conv_id").bitwiseXOR(F.lit(1).cast("long")).alias("pair_id"),
        F.col("conv_id").alias("answer_id"),
        F.try_element_at(said, F.lit(-1))["text"].alias("_answer"),
    )
    own = conversations.select(F.col("conv_id").cast("long").alias("pair_id"), F.col("turns").alias("chosen"))
    # Counted from the end; 0 where there is none.
    back = F.array_position(F.reverse(F.transform("chosen", lambda t: t["role"])), ASSISTANT)
    at = F.size("chosen") - back

    def changed(t: Column, i: Column) -> Column:
        return F.struct(t["role"].alias("role"), F.when(i == at, F.col("_answer")).otherwise(t["text"]).alias("text"))

    rejected = F.when((back > 0) & F.col("_answer").isNotNull(), F.transform("chosen", changed))
    return own.join(answers, "pair_id", "left").select("pair_id", "chosen", rejected.alias("rejected"), "answer_id")
