"""Chat text by multi-party perspective rotation.

Every speaker of a dialogue is in turn the assistant: the dialogue is rendered with that speaker's
turns under "assistant", all others as named users, and the mask marks the code points of the
assistant's contents and turn ends. Instructions (`DIRECTING` roles) have no perspective of their own.

A dialogue of more than `PART` turns is rendered in parts that begin at multiples of `PART` turn
numbers, each with a mask of its own, so that a long dialogue is never gathered in one row.

Defined cases: a null text is empty; a null speaker is the user "unknown" and a perspective of its own;
a null turn comes first, in part -1; equal rows count once; turns of one number go by speaker, then text;
a dialogue of instructions only has no rows; an empty table gives an empty result. The signs
<| in contents are written < |, so contents cannot forge a turn. Only the four named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PART = 256
DIRECTING = ("system",)
UNKNOWN = "unknown"
START, STOP = "<|im_start|>", "<|im_end|>\n"


def _plain(text: Column) -> Column:
    return F.replace(F.coalesce(text, F.lit("")), F.lit("<|"), F.lit("< |"))


def rotate(
    turns: DataFrame, dialogue: str = "conv_id", turn: str = "turn", speaker: str = "role", text: str = "text"
) -> DataFrame:
    """One row per dialogue, perspective and part: n_turns, text, mask (array of from, to) and n_masked."""
    rows = turns.select(
        F.col(dialogue).alias("_d"),
        F.coalesce(F.floor(F.col(turn) / PART), F.lit(-1)).cast("bigint").alias("part"),
        F.col(turn).alias("_t"),
        F.coalesce(F.col(speaker), F.lit(UNKNOWN)).alias("_s"),
        _plain(F.col(text)).alias("_x"),
    ).distinct()
    parts = rows.groupBy("_d", "part").agg(F.sort_array(F.collect_list(F.struct("_t", "_s", "_x"))).alias("_turns"))
    voices = rows.where(~F.col("_s").isin(*DIRECTING)).select(F.col("_d").alias("_e"), F.col("_s").alias("perspective")).distinct()
    seen = parts.join(voices, F.col("_d").eqNullSafe(F.col("_e")))

    def head(s: Column) -> Column:
        role = (
            F.when(s == F.col("perspective"), F.lit("assistant"))
            .when(s.isin(*DIRECTING), s)
            .otherwise(F.concat(F.lit("user name="), _plain(s)))
        )
        return F.concat(F.lit(START), role, F.lit("\n"))

    pieces = F.transform(
        "_turns",
        lambda t: F.struct(
            head(t["_s"]).alias("head"),
            F.concat(t["_x"], F.lit(STOP)).alias("body"),
            (t["_s"] == F.col("perspective")).alias("own"),
        ),
    )
    cut = seen.select("_d", "perspective", "part", pieces.alias("_p"))
    none = F.array().cast("array<struct<from:bigint,to:bigint>>")

    def step(state: Column, p: Column) -> Column:
        begin = (state["at"] + F.length(p["head"])).cast("bigint")
        end = (begin + F.length(p["body"])).cast("bigint")
        span = F.array(F.struct(begin.alias("from"), end.alias("to")))
        return F.struct(end.alias("at"), F.when(p["own"], F.concat(state["mask"], span)).otherwise(state["mask"]).alias("mask"))

    start = F.struct(F.lit(0).cast("bigint").alias("at"), none.alias("mask"))
    mask = F.aggregate("_p", start, step, lambda s: s["mask"])
    full = F.array_join(F.transform("_p", lambda p: F.concat(p["head"], p["body"])), "")
    length = F.aggregate("mask", F.lit(0).cast("bigint"), lambda n, m: n + m["to"] - m["from"])
    shown = cut.select(
        F.col("_d").alias(dialogue), "perspective", "part", F.size("_p").cast("bigint").alias("n_turns"),
        full.alias("text"), mask.alias("mask"),
    )
    return shown.withColumn("n_masked", length)


def listed(rotated: DataFrame) -> DataFrame:
    """The mask as text: from-to pairs, comma-joined."""
    pair = F.transform("mask", lambda m: F.concat_ws("-", m["from"].cast("string"), m["to"].cast("string")))
    return rotated.withColumn("mask", F.array_join(pair, ","))
