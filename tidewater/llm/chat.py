"""Cumulative-snapshot collapse for logged conversations, in DataFrame operations only.

A chat service that logs the whole history with every reply stores each conversation many
times, every copy a prefix of the next. Each turn gets the hash of all turns up to it;
a conversation whose last hash occurs inside a longer one, or at the end of an equal
one with a smaller id, is a snapshot and goes. The rest is rendered.

The rolling hash is the exclusive-or of the hashes of (position, role, text), twice with
different salts (128 bits), so it is a running aggregate that a conversation's blocks of
turns can be joined by: no task holds more than one block of one conversation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import materialise

#: Turn numbers in one block of the running hash.
BLOCK = 4096
#: Turns in one row of rendered text.
PART = 1024
TURN = "<|{role}|>\n{text}\n"


def positions(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id, turn, role, text, pos``: turns in order, numbered from 0 without gaps.

    Rows that repeat a turn whole count once. Ties of ``turn`` are ordered by role, then
    text; null turns come first. Null role and text are empty.
    """
    t = turns.select(F.col(conv).alias("conv_id"), F.col(turn).cast("long").alias("turn"),
                     F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    t = t.where(F.col("conv_id").isNotNull()).dropDuplicates(["conv_id", "turn", "role", "text"])
    t = t.withColumn("blk", F.coalesce(F.floor(F.col("turn") / BLOCK), F.lit(-1 << 60)))
    sizes = t.groupBy("conv_id", "blk").agg(F.count("*").alias("n"))
    before = Window.partitionBy("conv_id").orderBy("blk").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("conv_id", "blk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("conv_id", "blk").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    numbered = t.withColumn("at", F.row_number().over(inside) - 1)
    return numbered.join(sizes, ["conv_id", "blk"]).select("conv_id", "blk", "turn", "role", "text", (F.col("base") + F.col("at")).alias("pos"))


def prefix_hashes(placed: DataFrame) -> DataFrame:
    """``conv_id, pos, h1, h2, last``: hashes of all turns up to ``pos``; ``last`` marks the end."""
    one = placed.select("conv_id", "blk", "pos", F.xxhash64(F.lit("a"), "pos", "role", "text").alias("x1"),
                        F.xxhash64(F.lit("b"), "text", "role", "pos").alias("x2"))
    sums = one.groupBy("conv_id", "blk").agg(F.bit_xor("x1").alias("s1"), F.bit_xor("x2").alias("s2"), F.max("pos").alias("top"))
    before = Window.partitionBy("conv_id").orderBy("blk").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("conv_id", "blk", F.coalesce(F.bit_xor("s1").over(before), F.lit(0)).alias("b1"),
                       F.coalesce(F.bit_xor("s2").over(before), F.lit(0)).alias("b2"),
                       F.max("top").over(Window.partitionBy("conv_id")).alias("top"))
    upto = Window.partitionBy("conv_id", "blk").orderBy("pos")
    rolled = one.select("conv_id", "blk", "pos", F.bit_xor("x1").over(upto).alias("r1"), F.bit_xor("x2").over(upto).alias("r2"))
    return rolled.join(sums, ["conv_id", "blk"]).select(
        "conv_id", "pos", F.col("r1").bitwiseXOR(F.col("b1")).alias("h1"), F.col("r2").bitwiseXOR(F.col("b2")).alias("h2"),
        (F.col("pos") == F.col("top")).alias("last"))


def maximal(hashes: DataFrame) -> DataFrame:
    """``conv_id, n_turns, n_copies``: conversations that are no snapshot of another.

    ``n_copies`` counts the conversations equal to this one, itself included; the
    smallest id of them stays. Keys are grouped before the join, so an opening that every
    conversation shares is one row."""
    ends = (hashes.where("last").groupBy("pos", "h1", "h2")
            .agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_copies")))
    inner = hashes.where("NOT last").groupBy("pos", "h1", "h2").agg(F.lit(1).alias("_inner")).drop("_inner")
    return ends.join(inner, ["pos", "h1", "h2"], "left_anti").select(
        "conv_id", (F.col("pos") + 1).alias("n_turns"), "n_copies")


def render_turn(role: Column, text: Column) -> Column:
    head, middle, tail = TURN.replace("{text}", "{role}").split("{role}")
    return F.concat(F.lit(head), role, F.lit(middle), text, F.lit(tail))


def collapse(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rendered maximal conversations: ``conv_id, part, n_turns, n_copies, rendered``.

    A row holds up to ``PART`` consecutive turns, so the text of one row is bounded by
    turns, not by the conversation; part 0 comes first. Rows with a null conversation id
    belong to no conversation and are left out. Empty tables give no rows. Other columns
    are ignored, whatever their names. See :func:`positions` for order, ties and nulls.
    """
    placed = materialise(turns.sparkSession, positions(turns, conv, turn, role, text), "turns")
    keep = maximal(prefix_hashes(placed))
    line = F.struct("pos", render_turn(F.col("role"), F.col("text")).alias("line"))
    parts = placed.join(keep, "conv_id").groupBy(
        "conv_id", F.floor(F.col("pos") / PART).alias("part"), "n_turns", "n_copies").agg(
        F.array_sort(F.collect_list(line)).alias("lines"))
    return parts.select("conv_id", "part", "n_turns", "n_copies",
                        F.array_join(F.transform("lines", lambda x: x["line"]), "").alias("rendered"))
