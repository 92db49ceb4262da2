"""Chat formatting after collapsing cumulative snapshots of logged conversations.

A conversation that is logged after every turn appears as a chain of snapshots,
each a prefix of the next. Every turn gets a rolling hash of the turns up to it;
a conversation whose whole hash is a proper prefix's hash of another goes (an
anti-join on length and hash), equal conversations leave the one with the
smallest conv_id, and what stays is rendered turn by turn.

DataFrame functions only. Skew: one range sort numbers the turns of a conversation, and
they are dealt by (conversation, ``CHUNK`` places), so a conversation with most rows is
many groups of at most ``CHUNK`` rows, whatever its turn numbers are; what stands before
a chunk comes from a table with one row a chunk. The rolling hash is a running sum of hashes that
hold the place, the role and the text, in four sums of 32-bit parts of two 64-bit
hashes, so sums of chunks add up. Prefixes and conversations are made distinct by
partial aggregates before they meet. A rendered conversation comes in parts of
``CHUNK`` turns, most in one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tiffin.llm.common import null_safe, stored
from tiffin.llm.mixing import numbered

CHUNK = 256
_SUMS = ["_s0", "_s1", "_s2", "_s3"]


def _content(seed: int) -> Column:
    return F.xxhash64(F.lit(seed), F.isnull("role"), "role", F.isnull("text"), "text")


def _turn_key() -> list[Column]:
    """128 bits of hash over a turn's conversation, number and content."""
    marked = [F.isnull("conv_id"), "conv_id", F.isnull("turn"), "turn", "_h0", "_h1"]
    return [F.xxhash64(F.lit(5), *marked).alias("_r0"), F.xxhash64(F.lit(6), *marked).alias("_r1")]


def _halves(seed: int) -> list[Column]:
    h = F.xxhash64(F.lit(seed), "place", "_h0", "_h1")
    return [F.shiftrightunsigned(h, 32), h.bitwiseAND(F.lit((1 << 32) - 1))]


def _with_earlier(rows: DataFrame, sums: dict[str, Column]) -> DataFrame:
    """``rows`` with, for each new column, the sum over its conversation's chunks before its own."""
    by_chunk = rows.groupBy("conv_id", "chunk").agg(*[e.alias(c) for c, e in sums.items()])
    earlier = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    before = by_chunk.select(
        F.col("conv_id").alias("_conv"),
        F.col("chunk").alias("_chunk"),
        *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(c) for c in sums],
    )
    joined = rows.join(before, null_safe(rows, before, [("conv_id", "_conv"), ("chunk", "_chunk")]))
    return joined.drop("_conv", "_chunk")


def placed(turns: DataFrame) -> DataFrame:
    """One narrow row a distinct turn, stored: conv_id, turn, the hashes of what is said, place (from 1) and chunk.

    The chunk is the place among the conversation's numbered turns // ``CHUNK``; turns
    without a number come first, in chunks that end at -1.
    """
    narrow = turns.select("conv_id", "turn", _content(1).alias("_h0"), _content(2).alias("_h1")).distinct()
    rows = numbered(stored(narrow, "turns"), ["conv_id"], ["turn", "_h0", "_h1"], "_place", "turn-places")
    nulls = rows.filter("turn is null").groupBy("conv_id").agg(F.count(F.lit(1)).alias("_nulls"))
    nulls = nulls.withColumnRenamed("conv_id", "_conv")
    rows = rows.join(nulls, rows["conv_id"].eqNullSafe(nulls["_conv"]), "left").drop("_conv")
    numbers = F.col("_place") - F.coalesce("_nulls", F.lit(0))  # below 0 without a turn number
    chunk = F.floor(numbers / F.lit(CHUNK)).cast("long")
    return stored(rows.select("conv_id", "turn", "_h0", "_h1", (F.col("_place") + 1).alias("place"), chunk.alias("chunk")), "placed")


def prefixes(rows: DataFrame) -> DataFrame:
    """One row a turn of :func:`placed`: conv_id, place and the rolling hash of the turns up to it; narrow and stored."""
    in_chunk = Window.partitionBy("conv_id", "chunk").orderBy("place")
    rows = rows.withColumns(dict(zip(_SUMS, [*_halves(3), *_halves(4)], strict=True)))
    running = in_chunk.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumns({f"{c}r": F.sum(c).over(running) for c in _SUMS})
    rows = _with_earlier(rows, {f"{c}e": F.sum(c) for c in _SUMS})
    return stored(rows.select("conv_id", "place", *[(F.col(f"{c}r") + F.col(f"{c}e")).alias(c) for c in _SUMS]), "prefixes")


def maximal(rows: DataFrame) -> DataFrame:
    """(conv_id, copies) of the conversations that no longer one continues; copies counts equal ones."""
    rolled = prefixes(rows)
    whole = rolled.groupBy("conv_id").agg(F.max(F.struct("place", *_SUMS)).alias("_w")).select("conv_id", "_w.*")
    kept = whole.groupBy("place", *_SUMS).agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("copies"))
    # A conversation's whole is a proper prefix of another's if more conversations pass its hash than end there.
    passing = rolled.groupBy("place", *_SUMS).agg(F.count(F.lit(1)).alias("_passing"))
    ending = kept.select("place", *_SUMS, F.col("copies").alias("_ending"))
    continued = passing.join(ending, ["place", *_SUMS]).filter("_passing > _ending").select("place", *_SUMS)
    return kept.join(continued, ["place", *_SUMS], "left_anti").select("conv_id", "copies")


def render(turns: DataFrame, rows: DataFrame, kept: DataFrame) -> DataFrame:
    """The turns of ``kept`` conversations as text: conv_id, part, n_turns, copies, text."""
    ids = kept.select(F.col("conv_id").alias("_conv"), "copies")
    at = rows.join(ids, rows["conv_id"].eqNullSafe(ids["_conv"]))
    at = at.select("conv_id", F.col("chunk").alias("part"), "place", "copies", *_turn_key())
    texts = turns.join(ids, turns["conv_id"].eqNullSafe(ids["_conv"]), "left_semi")
    texts = texts.select("role", "text", "conv_id", "turn", _content(1).alias("_h0"), _content(2).alias("_h1"))
    # Repeats of a turn become one row, and meet its place by the same key.
    texts = texts.select("role", "text", *_turn_key()).groupBy("_r0", "_r1").agg(F.first("role").alias("role"), F.first("text").alias("text"))
    said_at = texts.join(at, ["_r0", "_r1"])
    said = F.sort_array(F.collect_list(F.struct("place", "role", "text")))
    line = F.transform(
        F.col("_said"),
        lambda t: F.concat(
            F.lit("<|im_start|>"), F.coalesce(t["role"], F.lit("")), F.lit("\n"), F.coalesce(t["text"], F.lit("")), F.lit("<|im_end|>\n")
        ),
    )
    return (
        said_at.groupBy("conv_id", "part")
        .agg(F.first("copies").alias("copies"), said.alias("_said"))
        .select("conv_id", "part", F.size("_said").cast("long").alias("n_turns"), "copies", F.array_join(line, "").alias("text"))
    )


def format_chats(turns: DataFrame) -> DataFrame:
    """Maximal conversations of ``turns`` (conv_id, turn, role, text), rendered.

    A row a conversation and ``CHUNK`` places: conv_id, part, n_turns, copies, text.

    Repeated rows count once; different rows with one turn number stand in the order of
    their hashes. Null turns come first (in parts below 0), a null role or text is empty but
    differs from an empty one in the hash, and all rows with a null conv_id are one
    conversation. An empty table gives no rows. Other columns are ignored.
    """
    rows = placed(turns)
    return render(turns, rows, maximal(rows))
