"""Multi-party perspective rotation of dialogues.

For every participant of a conversation, the dialogue is rendered with that speaker as the assistant, the
others as named users and system turns as they are; the loss mask covers what the assistant says and
the mark of its end. The result has one row per participant and turn, with the turn's place in the
rendered text, so a conversation of any length needs no row, group or task that holds all of it: rows are
sorted by ranges that split a conversation, and offsets are running sums within a range plus the sums
of the ranges before it.

Turns are ordered by turn (null first), speaker and the SHA-256 of the text; equal rows stay, each in its own place. A null
or blank speaker is named ``unknown``; null text is empty; null conversation ids form one conversation;
a conversation of system turns only has no participant and no rows. Template marks within a text
are broken by a space, so that they mark nothing. An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch

# The marks of the rendered text.
BEGIN, END = "<|im_start|>", "<|im_end|>"
SYSTEM, UNKNOWN = "system", "unknown"


def _segment(role: Column, name: Column, content: Column) -> Column:
    head = F.when(name.isNull(), role).otherwise(F.concat(role, F.lit(" name="), name))
    return F.concat(F.lit(BEGIN), head, F.lit("\n"), content, F.lit(END + "\n"))


def rotate(turns: DataFrame, conversation: str = "conv_id", turn: str = "turn", speaker: str = "role", text: str = "text") -> DataFrame:
    """``conv_id, perspective, position, turn, role, name, segment, start, mask_start, mask_end``.

    ``start`` and the masks count characters of the text that the conversation's segments make in
    the order of ``position``; masks are null where nothing is learnt.
    """
    scratch = Scratch(turns.sparkSession, "rotate")
    spoken = F.trim(F.col(speaker).cast("string"))
    rows = turns.select(
        F.col(conversation).alias("conv_id"), F.col(turn).alias("turn"),
        F.when(spoken.isNull() | (spoken == ""), F.lit(UNKNOWN)).otherwise(spoken).alias("speaker"),
        F.replace(F.coalesce(F.col(text).cast("string"), F.lit("")), F.lit("<|im_"), F.lit("<| im_")).alias("content"))
    people = scratch.keep(rows.filter(F.col("speaker") != SYSTEM).select(F.col("conv_id").alias("c"), F.col("speaker").alias("perspective")).distinct(), "people")
    seen = rows.join(people, F.col("conv_id").eqNullSafe(F.col("c"))).drop("c")
    own = F.col("speaker") == F.col("perspective")
    role = F.when(F.col("speaker") == SYSTEM, SYSTEM).when(own, "assistant").otherwise("user")
    seen = seen.withColumns({"role": role, "name": F.when(role == "user", F.col("speaker"))})
    seen = seen.withColumn("segment", _segment(F.col("role"), F.col("name"), F.col("content")))
    order = ["conv_id", "perspective", "turn", "speaker", "hash", "uid"]
    spread = seen.withColumns({"hash": F.sha2("content", 256), "uid": F.monotonically_increasing_id()})
    placed = scratch.keep(
        spread.repartitionByRange(*order).sortWithinPartitions(*order)
        .select(*order, F.spark_partition_id().alias("part"), "role", "name", "segment",
                F.length("segment").cast("long").alias("size"), F.length("content").cast("long").alias("inner")), "placed")
    inside = Window.partitionBy("conv_id", "perspective", "part").orderBy("turn", "speaker", "hash", "uid").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy("conv_id", "perspective").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ranges = placed.groupBy("conv_id", "perspective", "part").agg(F.sum("size").alias("s"), F.count(F.lit(1)).alias("n"))
    zero = lambda c: F.coalesce(c, F.lit(0))
    carried = scratch.keep(ranges.select(
        F.col("conv_id").alias("c"), F.col("perspective").alias("p"), F.col("part").alias("k"),
        zero(F.sum("s").over(before)).alias("s"), zero(F.sum("n").over(before)).alias("n")), "carried")
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("perspective") == F.col("p")) & (F.col("part") == F.col("k"))
    local = placed.select("*", zero(F.sum("size").over(inside)).alias("at"), zero(F.count(F.lit(1)).over(inside)).alias("nth"))
    full = local.join(carried, same).withColumn("start", F.col("at") + F.col("s"))
    learnt = F.col("role") == "assistant"
    mask_end = F.col("start") + F.col("size") - 1  # without the line feed after the mark
    return full.select(
        "conv_id", "perspective", (F.col("nth") + F.col("n") + 1).alias("position"), "turn", "role", "name", "segment", "start",
        F.when(learnt, mask_end - len(END) - F.col("inner")).alias("mask_start"), F.when(learnt, mask_end).alias("mask_end"))


def op3_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rotate(spark.read.parquet(f"{sf_dir.rstrip('/')}/conversations.parquet"))
