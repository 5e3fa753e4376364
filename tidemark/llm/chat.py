"""Multi-party chat formatting by rotating the perspective (operator 10).

Every participant of a conversation is the assistant once: their turns are rendered as the assistant's and
are the ones to learn from, all others speak as named users. System turns are context in every rendering.
The result has a row per turn and perspective with its place in the rendering, so a conversation of any
length is never gathered. Built from SQL functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SYSTEM = "system"
UNNAMED = "unknown"
END = "<|end|>\n"
#: Turn numbers that are laid out together; places of later ones follow from the sums of the earlier.
SPAN = 64


def _plain(text: Column) -> Column:
    """Text that cannot be taken for a marker."""
    return F.replace(F.coalesce(text, F.lit("")), F.lit("<|"), F.lit("< |"))


def _turns(chats: DataFrame, speaker: str) -> DataFrame:
    who = F.coalesce(F.nullif(F.col(speaker), F.lit("")), F.lit(UNNAMED))
    return chats.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), who.alias("speaker"),
        F.col("text").alias("text"),
    )


def rotate(chats: DataFrame, speaker: str = "role") -> DataFrame:
    """(conv_id, perspective, turn, role, name, content, start, stop, learn_start, learn_stop) by turn.

    ``content`` is the rendered turn, [start, stop) its code points in the rendering of (conv_id,
    perspective), [learn_start, learn_stop) those to learn from: text and end mark of the assistant's turns,
    empty elsewhere. Turns follow by number, null first; equal numbers by speaker and text. Null text is
    empty, a null or empty speaker is ``unknown``. Null conv_ids are one conversation. One with system turns
    only is rendered once, with null perspective. Repeated rows are repeated turns.
    """
    turns = _turns(chats, speaker)
    people = turns.filter(F.col("speaker") != SYSTEM).select("conv_id", F.col("speaker").alias("perspective")).distinct()
    p = people.withColumnRenamed("conv_id", "of")
    rows = turns.join(p, F.col("conv_id").eqNullSafe(F.col("of")), "left").drop("of")
    role = (
        F.when(F.col("speaker") == SYSTEM, SYSTEM)
        .when(F.col("speaker") == F.col("perspective"), "assistant")
        .otherwise("user")
    )
    rows = rows.withColumn("role", role).withColumn("name", F.when(F.col("role") == "user", _plain(F.col("speaker"))))
    header = F.concat(
        F.lit("<|"), "role", F.coalesce(F.concat(F.lit(" name="), "name"), F.lit("")), F.lit("|>\n")
    )
    rows = rows.withColumn("header", F.length(header).cast("long")).withColumn(
        "content", F.concat(header, _plain(F.col("text")), F.lit("\n" + END))
    )
    # Places: sums by span of turn numbers, then inside the span.
    span = F.coalesce(F.floor(F.col("turn") / SPAN), F.lit(-(2**62)))
    rows = rows.withColumns({"span": span, "size": F.length("content").cast("long")})
    key = ["conv_id", "perspective"]
    sums = rows.groupBy(*key, "span").agg(F.sum("size").alias("size"))
    earlier = Window.partitionBy(*key).orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select(
        F.col("conv_id").alias("c"), F.col("perspective").alias("v"), F.col("span").alias("s"),
        F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("base"),
    )
    within = Window.partitionBy(*key, "span").orderBy("turn", "speaker", F.coalesce("text", F.lit(""))).rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("before", F.coalesce(F.sum("size").over(within), F.lit(0)))
    same = F.col("conv_id").eqNullSafe(F.col("c")) & F.col("perspective").eqNullSafe(F.col("v")) & (F.col("span") == F.col("s"))
    start, learn = F.col("base") + F.col("before"), F.col("role") == "assistant"
    placed = placed.join(bases, same).withColumn("start", start).withColumn("stop", F.col("start") + F.col("size"))
    return placed.select(
        *key, "turn", "role", "name", "content", "start", "stop",
        F.when(learn, F.col("start") + F.col("header")).otherwise(F.col("stop")).alias("learn_start"),
        F.col("stop").alias("learn_stop"),
    )
