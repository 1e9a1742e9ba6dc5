"""Multi-party perspective rotation of dialogues."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import sums_before

# fixed values: the marks around a message, and what stands for a mark's start inside a text
OPEN, CLOSE, ESCAPED = "<|im_start|>", "<|im_end|>", "<​|"
UNNAMED = "unknown"
# Turn numbers that are placed together in one task.
TURNS_PER_BLOCK = 256


def speaker_name(role: Column) -> Column:
    """The role with everything but letters, digits, ``_``, ``.`` and ``-`` replaced; null and blank are unnamed."""
    name = F.regexp_replace(F.trim(F.coalesce(role, F.lit(""))), r"[^\p{L}\p{N}_.-]", "_")
    return F.when(name == "", UNNAMED).otherwise(name)


def rotate(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text", system_roles: Sequence[str] = ("system",)) -> DataFrame:
    """Every dialogue once from the side of each of its speakers, a row per message:

    conv_id, perspective, turn, role, name, segment, start, length, mask_start, mask_length.

    The messages of the perspective's speaker are the assistant's, those of others a user's with their name, system
    messages stay system messages and have no side. The segments of a (conv_id, perspective) in the order of ``start``
    make the rendered dialogue; positions count characters in it. The loss mask covers the assistant's text with its end mark
    (``mask_length`` 0 elsewhere). Rows rather than one text per dialogue, since a dialogue may be of any
    length; places come from sums over blocks of turns.

    Turns are ordered by number, null numbers last, ties by speaker and text; repeated rows are repeated messages.
    A null conversation is a conversation of its own, null or blank roles are the speaker "unknown", a null text is
    empty. Marks inside texts are defused. A dialogue without speakers gives no rows, nor does an empty table.
    """
    conv = F.when(F.col(conv_col).isNull(), "").otherwise(F.concat(F.lit("="), F.col(conv_col).cast("string")))
    body = F.replace(F.coalesce(text_col, F.lit("")), F.lit("<|"), F.lit(ESCAPED))
    said = turns.select(conv.alias("conv"), F.col(conv_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
                        speaker_name(F.col(role_col)).alias("speaker"), body.alias("body"))
    said = said.withColumn("block", F.coalesce(F.floor(F.col("turn") / TURNS_PER_BLOCK), F.lit(2**62)))
    sides = (said.where(~F.col("speaker").isin(*system_roles)).select("conv", F.col("speaker").alias("perspective"))
             .distinct())
    seen = said.join(sides, "conv")
    own, system = F.col("speaker") == F.col("perspective"), F.col("speaker").isin(*system_roles)
    role = F.when(own, "assistant").when(system, "system").otherwise("user")
    name = F.when(~own & ~system, F.col("speaker"))
    head = F.concat(F.lit(OPEN), F.col("role"), F.when(F.col("name").isNull(), "").otherwise(
        F.concat(F.lit(" name="), F.col("name"))), F.lit("\n"))
    seen = seen.withColumns({"role": role, "name": name}).withColumn("head", head)
    seen = seen.withColumn("length", F.length("head") + F.length("body") + len(CLOSE) + 1)
    placed = sums_before(seen, ["conv", "perspective"], "block", ["turn", "speaker", "body"], "length", "start", many=True)
    answer = F.col("role") == "assistant"
    return placed.select(
        "conv_id", "perspective", "turn", "role", "name", F.concat("head", "body", F.lit(CLOSE + "\n")).alias("segment"),
        F.col("start").cast("long").alias("start"), F.col("length").cast("long").alias("length"),
        F.when(answer, F.col("start") + F.length("head")).cast("long").alias("mask_start"),
        F.when(answer, F.length("body") + len(CLOSE)).otherwise(0).cast("long").alias("mask_length"))
