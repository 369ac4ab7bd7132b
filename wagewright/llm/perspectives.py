"""Render a conversation once for each participant."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SYSTEM = "system"


def turn_text(role: Column, name: Column, content: Column) -> Column:
    """``<|role|>`` or ``<|role:name|>``, the words of the turn and an end mark."""
    head = F.concat(F.lit("<|"), role, F.when(name.isNotNull(), F.concat(F.lit(":"), name)).otherwise(""), F.lit("|>\n"))
    return F.concat(head, content, F.lit("<|end|>\n"))


def perspectives(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", speaker_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """One row for each participant of a conversation and each of its turns, as that participant sees it.

    The participant's own turns become ``assistant`` and are trained on; other speakers become ``user`` with their name;
    ``system`` turns stay and belong to nobody. ``rendered`` is the text of the turn and ``train_from``,
    ``train_to`` the trained code points in it (equal: none). A turn whose speaker is null is a user called "unknown";
    a null text is empty and not trained on. A null conversation is a conversation of its own. Repeated rows are
    rendered each. A conversation without participants has no rows, as has an empty table. Rows stay turn by turn, so a
    conversation of any length spreads over tasks; ``dialogues`` joins them.
    """
    own = turns.select(
        F.col(conv_col).alias("conv_id"),
        F.col(turn_col).alias("turn"),
        F.col(speaker_col).alias("speaker"),
        F.coalesce(F.col(text_col), F.lit("")).alias("content"),
    )
    people = (
        own.filter(F.col("speaker").isNotNull() & (F.col("speaker") != SYSTEM))
        .select(F.col("conv_id").alias("with_id"), F.col("speaker").alias("perspective"))
        .distinct()
    )
    mine = F.coalesce(F.col("speaker") == F.col("perspective"), F.lit(False))
    role = F.when(mine, "assistant").when(F.col("speaker") == SYSTEM, SYSTEM).otherwise("user")
    seen = own.join(people, own.conv_id.eqNullSafe(people.with_id)).select(
        "conv_id",
        "perspective",
        "turn",
        role.alias("role"),
        F.when(role == "user", F.coalesce("speaker", F.lit("unknown"))).alias("name"),
        "content",
        (mine & (F.col("content") != "")).alias("train"),
    )
    head = F.char_length(turn_text(F.col("role"), F.col("name"), F.lit(""))) - F.char_length(F.lit("<|end|>\n"))
    # The end mark is trained on with the turn, its line feed is not.
    till = head + F.when(F.col("train"), F.char_length("content") + F.char_length(F.lit("<|end|>"))).otherwise(0)
    return seen.select(
        "*",
        turn_text(F.col("role"), F.col("name"), F.col("content")).alias("rendered"),
        head.cast("long").alias("train_from"),
        till.cast("long").alias("train_to"),
    )


def dialogues(turns: DataFrame, turns_per_row: int = 64, **columns: str) -> DataFrame:
    """Whole renderings: one row per conversation, participant and stretch of turn numbers, turns in order.

    ``mask`` lists the trained spans of ``text``. A conversation longer than ``turns_per_row`` goes on in the next
    stretch, so that no row grows with the conversation. Turns that share a number are ordered by role and text.
    """
    seen = perspectives(turns, **columns)
    turn = F.struct("turn", "role", "name", "rendered", "train", "train_from", "train_to")
    lists = (
        seen.withColumn("stretch", F.floor(F.coalesce("turn", F.lit(0)) / turns_per_row))
        .groupBy("conv_id", "perspective", "stretch")
        .agg(F.sort_array(F.collect_list(turn)).alias("all"))
    )
    empty = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans"))
    spans = F.aggregate(
        "all",
        empty,
        lambda acc, t: F.struct(
            (acc.at + F.char_length(t.rendered)).cast("long").alias("at"),
            F.concat(
                acc.spans,
                F.when(
                    t.train, F.array(F.struct((acc.at + t.train_from).alias("start"), (acc.at + t.train_to).alias("end")))
                ).otherwise(F.array().cast("array<struct<start:bigint,end:bigint>>")),
            ).alias("spans"),
        ),
        lambda acc: acc.spans,
    )
    return lists.select(
        "conv_id",
        "perspective",
        "stretch",
        F.array_join(F.transform("all", lambda t: t.rendered), "").alias("text"),
        spans.alias("mask"),
    )
