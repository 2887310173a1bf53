"""Multi-party perspective rotation of conversations.

For every participant of a conversation the dialogue is rendered once: that speaker's turns as ``assistant``, the
others' as ``user`` with their name, and a mask of the spans to be learnt, which are the contents and end marks of
the speaker's own turns.  A participant is a distinct value of ``role``.

Turns come in order of number, then role, then text; turns without a number come first.  A long conversation is
rendered in parts of ``PART_TURNS`` turn numbers, so that no task holds a whole one; spans count within a part.
Null texts are empty contents, a null role is the participant ``unknown``, and rows without a conversation are
left aside.  Repeated rows are turns of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PART_TURNS = 128
# The marks of the ChatML layout.
BEGIN, END = "<|im_start|>", "<|im_end|>"


def _turn(turn: Column, speaker: Column) -> tuple[Column, Column]:
    """Head and content of a rendered turn."""
    named = F.concat(F.lit(f"{BEGIN}user name="), turn["role"], F.lit("\n"))
    head = F.when(turn["role"] == speaker, F.lit(f"{BEGIN}assistant\n")).otherwise(named)
    return head, F.concat(turn["text"], F.lit(END))


def rotate(turns: DataFrame, conversation: str = "conv_id", number: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, speaker, part, n_turns, n_own, text, mask): one row per conversation part and participant.

    ``mask`` is an array of structs (start, end) in code points, ends exclusive.
    """
    rows = turns.where(F.col(conversation).isNotNull()).select(
        F.col(conversation).alias("conv_id"),
        F.col(number).alias("turn"),
        F.coalesce(F.col(role), F.lit("unknown")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    people = rows.select("conv_id", F.col("role").alias("speaker")).distinct()
    part = F.coalesce(F.floor(F.col("turn") / PART_TURNS), F.lit(-1)).cast("bigint").alias("part")
    parts = rows.groupBy("conv_id", part).agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    seen = parts.join(people, "conv_id")
    speaker = F.col("speaker")
    own = F.filter("turns", lambda t: t["role"] == speaker)
    shown = F.array_join(F.transform("turns", lambda t: F.concat(*_turn(t, speaker))), "\n")
    empty = F.array().cast("array<struct<start:int,end:int>>")

    def step(acc: Column, t: Column) -> Column:
        head, body = _turn(t, speaker)
        begin = acc["at"] + F.length(head)
        end = begin + F.length(body)
        mask = F.when(t["role"] == speaker, F.concat(acc["mask"], F.array(F.struct(begin.alias("start"), end.alias("end"))))).otherwise(acc["mask"])
        return F.struct((end + 1).alias("at"), mask.alias("mask"))

    mask = F.aggregate("turns", F.struct(F.lit(0).alias("at"), empty.alias("mask")), step)["mask"]
    return seen.select(
        "conv_id", "speaker", "part", F.size("turns").cast("bigint").alias("n_turns"), F.size(own).cast("bigint").alias("n_own"), shown.alias("text"), mask.alias("mask")
    )
