"""Chat formatting: snapshots of one conversation collapse into the longest, which is rendered.

A log may hold a conversation several times, each time with more turns. Every turn is hashed
with its position, role and text, and the rolling xor of these hashes (128 bits) names the prefix
that ends there. A conversation goes if its last prefix is an inner prefix of another one, or the last
prefix of one with a smaller id. What remains is rendered turn by turn and joined.

All steps are DataFrame operations. Positions and rolling hashes are made in blocks of ``BLOCK`` turn
numbers and then shifted by the sums of the blocks before, so one endless conversation is spread over
tasks; it is rendered in parts of ``BLOCK`` turns, ordinary conversations are one part, number 0. Texts
are hashed where they are read and move only to be rendered.

Defined cases: turns without a conversation id belong to none and are left out. A turn that is repeated
with the same number, role and text counts once. Turns are ordered by number, null numbers first; turns
of one number by the hash of role and text. Null roles and texts are rendered as empty ones, and an empty
text is a turn. Other columns are not read. An empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.llm.common import narrow

BLOCK = 1024

# The marks of the chat template.
START, STOP = "<|im_start|>", "<|im_end|>"


def _before(column: str, by: str, combine) -> Column:
    """``combine`` of ``column`` over the blocks before this one; 0 for the first."""
    window = Window.partitionBy("conv_id").orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(combine(column).over(window), F.lit(0).cast("long"))


def _hashed(turns: DataFrame) -> DataFrame:
    """Turns with two hashes of their content and the number of their block."""
    return (
        turns.where("conv_id is not null")
        .withColumn("role", F.coalesce("role", F.lit("")))
        .withColumn("text", F.coalesce("text", F.lit("")))
        .withColumn("h", F.xxhash64("role", "text"))
        .withColumn("g", F.xxhash64(F.lit(1), "text", "role"))
        .withColumn("block", F.coalesce(F.floor(F.col("turn") / BLOCK), F.lit(-(2**62))))
    )


def prefixes(turns: DataFrame) -> DataFrame:
    """``(conv_id, turn, h, g, position, p, q, length)``: the prefix hashes (p, q) of every distinct turn.

    ``turns`` are rows of ``_hashed``; positions begin at 1, ``length`` is the number of turns of the whole.
    """
    own = turns.select("conv_id", "block", "turn", "h", "g").distinct()
    counted = own.groupBy("conv_id", "block").agg(F.count("*").alias("n"))
    offsets = counted.select("conv_id", "block", _before("n", "block", F.sum).alias("offset"))
    lengths = counted.groupBy("conv_id").agg(F.sum("n").alias("length"))
    in_block = Window.partitionBy("conv_id", "block").orderBy("turn", "h", "g")
    placed = own.withColumn("rank", F.row_number().over(in_block)).join(offsets, ["conv_id", "block"])
    placed = placed.withColumn("position", (F.col("offset") + F.col("rank")).cast("long"))
    placed = placed.withColumn("x", F.xxhash64("position", "h", "g")).withColumn("y", F.xxhash64("g", "position", "h"))
    totals = placed.groupBy("conv_id", "block").agg(F.bit_xor("x").alias("bx"), F.bit_xor("y").alias("by"))
    totals = totals.select(
        "conv_id", "block", _before("bx", "block", F.bit_xor).alias("px"), _before("by", "block", F.bit_xor).alias("py")
    )
    rolling = Window.partitionBy("conv_id", "block").orderBy("position").rowsBetween(Window.unboundedPreceding, 0)
    rolled = placed.withColumn("x", F.bit_xor("x").over(rolling)).withColumn("y", F.bit_xor("y").over(rolling))
    return (
        rolled.join(totals, ["conv_id", "block"])
        .join(lengths, "conv_id")
        .select(
            "conv_id", "turn", "h", "g", "position",
            F.col("x").bitwiseXOR(F.col("px")).alias("p"), F.col("y").bitwiseXOR(F.col("py")).alias("q"), "length",
        )
    )


def maximal(prefixed: DataFrame) -> DataFrame:
    """``(conv_id)`` of the conversations that are no prefix of a longer one and no copy of an earlier id."""
    whole = prefixed.where("position = length").groupBy("length", "p", "q").agg(F.min("conv_id").alias("conv_id"))
    inner = prefixed.where("position < length").select(F.col("position").alias("length"), "p", "q").distinct()
    return whole.join(inner, ["length", "p", "q"], "left_anti").select("conv_id")


def render(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``(conv_id, part, n_turns, text)`` of the maximal conversations."""
    turns = _hashed(narrow(conversations, conv_id=conv, turn=turn, role=role, text=text))
    prefixed = prefixes(turns)
    kept = prefixed.join(maximal(prefixed), "conv_id", "left_semi").select("conv_id", "turn", "h", "g", "position")
    kept = kept.select(*[F.col(c).alias(f"_{c}") for c in ("conv_id", "turn", "h", "g")], "position")
    same = F.expr("conv_id = _conv_id AND h = _h AND g = _g AND turn <=> _turn")
    found = turns.join(kept, same).select("conv_id", "position", "role", "text").dropDuplicates(["conv_id", "position"])
    piece = F.concat(F.lit(START), "role", F.lit("\n"), "text", F.lit(STOP + "\n"))
    parts = (
        found.select("conv_id", F.floor((F.col("position") - 1) / BLOCK).cast("int").alias("part"), "position", piece.alias("piece"))
        .groupBy("conv_id", "part")
        .agg(F.array_sort(F.collect_list(F.struct("position", "piece"))).alias("pieces"))
    )
    return parts.select(
        "conv_id", "part", F.size("pieces").cast("long").alias("n_turns"), F.array_join(F.col("pieces.piece"), "").alias("text")
    )
