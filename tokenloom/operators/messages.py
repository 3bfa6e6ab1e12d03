"""Conversations stored one row per turn."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tokenloom.functions.text import PART_SEPARATOR, message_part
from tokenloom.operators.ordering import div

TURNS_PER_PART = 256


def flatten_turns(
    turns: DataFrame, conversation: str, turn: str, content: str, turns_per_part: int = TURNS_PER_PART
) -> DataFrame:
    """One text per conversation: its non-empty turns in order, stripped, a blank line between.

    Joining is associative, so stretches of turns are joined first, spread over tasks, and a
    long conversation reaches its last task as a few strings. Conversations without any
    non-empty turn become the empty text.
    """
    position = F.col(turn).cast("bigint")
    parts = turns.select(
        conversation,
        div(position, turns_per_part).alias("stretch"),
        position.alias("position"),
        message_part(F.col(content)).alias("part"),
    )

    def joined(position: str):
        ordered = F.sort_array(F.collect_list(F.struct(position, "part")))
        return F.array_join(F.transform(ordered, lambda x: x["part"]), PART_SEPARATOR)

    stretches = parts.groupBy(conversation, "stretch").agg(
        F.when(F.count("part") > 0, joined("position")).alias("part")
    )
    return stretches.groupBy(conversation).agg(joined("stretch").alias("text"))
