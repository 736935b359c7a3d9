"""Chat formatting: every dialogue from the perspective of each of its speakers.

DataFrame functions only; no Python runs on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from layerflow.llm.training import stored

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
TURNS_PER_PART = 256
SYSTEM = "system"


def numbered(turns: DataFrame, partitions: int | None = None) -> DataFrame:
    """``conv, speaker, text, position``: rows numbered from 0 within their conversation.

    Turns go by their number, nulls last, then speaker and text; equal rows are turns of their
    own. Rows are sorted over all partitions by range and numbered per partition, and each
    partition's share of a conversation is moved by what lies before it. So a conversation with
    a great part of all rows is the work of many tasks.
    """
    spark = turns.sparkSession
    rows = turns.select(
        F.col("conv_id").alias("conv"),
        F.col("turn").isNull().alias("no_turn"),
        "turn",
        F.coalesce("role", F.lit("")).alias("speaker"),
        F.coalesce("text", F.lit("")).alias("text"),
        # equal rows and equal prefixes of a range's key still spread
        F.monotonically_increasing_id().alias("row"),
    )
    order = ["no_turn", "turn", "speaker", "text", "row"]
    rows = stored(rows, "chat-rows")
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.repartitionByRange(n, "conv", *order)
    ranged = stored(ranged.withColumn("range", F.spark_partition_id()), "chat-ranges")
    local = F.row_number().over(Window.partitionBy("conv", "range").orderBy(*order)) - 1
    sizes = ranged.groupBy("conv", "range").agg(F.count("*").alias("n"))
    ahead = Window.partitionBy("conv").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select(
        "conv", "range", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("before")
    )
    counted = ranged.withColumn("local", local)
    same = counted["conv"].eqNullSafe(before["conv"]) & (counted["range"] == before["range"])
    return counted.join(before, same).select(
        counted["conv"], "speaker", "text", (F.col("local") + F.col("before")).alias("position")
    )


def _clean(text: Column) -> Column:
    """Control marks inside texts are broken up, so that a text cannot open or close a turn."""
    return F.replace(text, F.lit("<|"), F.lit("< |"))


def _name(speaker: Column) -> Column:
    """A name stands on the opening line: white space and marks in it become underscores."""
    name = F.regexp_replace(_clean(speaker), r"[\s<>|]+", "_")
    return F.when(name == "", "unknown").otherwise(name)


def _header(speaker: Column, me: Column) -> Column:
    return (
        F.when(speaker == me, F.lit(f"{OPEN}assistant\n"))
        .when(speaker == SYSTEM, F.lit(f"{OPEN}system\n"))
        .otherwise(F.concat(F.lit(f"{OPEN}user name="), _name(speaker), F.lit("\n")))
    )


def rotate_perspectives(turns: DataFrame, *, turns_per_part: int = TURNS_PER_PART) -> DataFrame:
    """One row per conversation, speaker and part: the dialogue as that speaker lives it.

    Input ``conv_id, turn, role, text``; other columns play no part. Every distinct role but
    ``system`` is a participant. In its row its turns are the assistant's, the others are users
    under their own names, and system turns stay. ``mask`` lists the ranges of ``rendered`` to
    learn from, in code points: what the participant says, with the closing mark. Dialogues of
    over ``turns_per_part`` turns come in parts, numbered from 0, which make up the whole one
    after another; ranges count from the part's beginning.

    A null role and an empty one are the participant ``unknown``; null texts are empty; null
    turns go last; rows with a null ``conv_id`` are one conversation of that id. A conversation
    with system turns only has no participant and gives no row. Repeated rows are repeated turns.
    """
    rows = stored(numbered(turns), "chat-turns")
    part = F.floor(F.col("position") / turns_per_part).cast("long")
    turn = F.struct("position", "speaker", "text")
    parts = rows.groupBy("conv", part.alias("part")).agg(
        F.sort_array(F.collect_list(turn)).alias("turns")  # at most turns_per_part of them
    )
    speakers = rows.where(F.col("speaker") != SYSTEM).select("conv", "speaker").distinct()
    speakers = speakers.select(F.col("conv").alias("own"), F.col("speaker").alias("me"))
    pairs = parts.join(speakers, parts["conv"].eqNullSafe(speakers["own"]))
    me = F.col("me")
    pieces = F.transform(
        "turns",
        lambda t: F.struct(
            _header(t["speaker"], me).alias("header"),
            F.concat(_clean(t["text"]), F.lit(CLOSE)).alias("body"),
            (t["speaker"] == me).alias("learn"),
        ),
    )
    pairs = pairs.select("conv", "me", "part", pieces.alias("pieces"))
    empty = F.array().cast("array<struct<start:int,end:int>>")

    def add(state, piece):
        start = state["at"] + F.length(piece["header"])
        end = start + F.length(piece["body"])
        span = F.struct(start.alias("start"), end.alias("end"))
        return F.struct(
            (end + 1).alias("at"),  # a line feed closes each turn
            F.when(piece["learn"], F.array_append(state["mask"], span))
            .otherwise(state["mask"])
            .alias("mask"),
        )

    folded = F.aggregate("pieces", F.struct(F.lit(0).alias("at"), empty.alias("mask")), add)
    rendered = F.array_join(
        F.transform("pieces", lambda p: F.concat(p["header"], p["body"], F.lit("\n"))), ""
    )
    return pairs.select(
        F.col("conv").alias("conv_id"),
        F.when(me == "", "unknown").otherwise(me).alias("perspective"),
        "part",
        F.size("pieces").cast("long").alias("n_turns"),
        F.size(F.filter("pieces", lambda p: p["learn"])).cast("long").alias("n_learned"),
        rendered.alias("rendered"),
        folded["mask"].alias("mask"),
    )
