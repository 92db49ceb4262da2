"""Mixing sources to target weights by systematic sampling.

Targets: sources in code-point order (null last) weigh 5, 2, 1, repeating, and
share the size of all documents by weight; a target stops at ``most`` times its
source's size, and the excess goes to the others by weight. Each document of a
source expects target / size copies; the running sum of expected copies, started
at one random offset for the source, emits a copy at each integer it passes. In a
source the documents stand in the order of size, so that each step of the sum
passes over documents of like size and the words taken come near the target. The
offset is, of a few drawn for the source, the one whose words come closest to it:
in a small source one long document more or less decides that.

Plan: sizes are stored narrow; sources are summed and numbered from a range sort;
the cut of the targets is a short loop that fetches three sums a round; places
within sources come from one range sort by (source, size, document) and the
counts of (source, slice), so that a source with most rows is spread over many
tasks. The running sum over equal expectations is place x expectation, so the
words that each drawn offset takes are plain sums by source and draw, one partial aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tiffin.llm.common import matched, null_safe, row_number_column, sorted_slices, stored, with_row_keys, word_count

WEIGHTS = (5, 2, 1)
MOST = 3
DRAWS = 32


def source_offset(source: Column, seed: str, draw: int = 0) -> Column:
    """An offset of the source in [0, 1), the same on every run of a seed: 32 bits of an MD5."""
    digest = F.md5(F.concat(F.lit(f"{seed}:{draw}:"), F.coalesce(source, F.lit("\x00")).cast("string")).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") / F.lit(float(1 << 32))


def passed(place: Column, offset: Column) -> Column:
    """Copies of the document at ``place``: the integers that its step of the running sum passes."""
    return (F.floor((place + 1) * F.col("_rate") + offset) - F.floor(place * F.col("_rate") + offset)).cast("long")


def numbered(df: DataFrame, group: list[str], order: list[str], out: str, label: str) -> DataFrame:
    """``df`` with each row's place from 0 within ``group`` in ``order``, which should identify a row.

    A group is spread over the slices of one range sort; what stands before is the
    rows that a group has in earlier slices, from a table of a row for each group
    and slice.
    """
    ranged = sorted_slices(df, [*group, *order], label)
    counts = ranged.groupBy(*group, "slice").agg(F.min("pos").alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*group).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select(
        *[F.col(c).alias(f"_g{i}") for i, c in enumerate(group)],
        F.col("slice").alias("_slice"),
        (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).alias("_base"),
    )
    pairs = [*[(c, f"_g{i}") for i, c in enumerate(group)], ("slice", "_slice")]
    joined = ranged.join(base, null_safe(ranged, base, pairs))
    return joined.withColumn(out, F.col("pos") + F.col("_base")).drop("slice", "pos", "_base", *[b for _, b in pairs])


def source_targets(by_source: DataFrame, weights: tuple = WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, source_size, target) of a stored (source, source_size) table with one row a source."""
    weigh = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("_place") % len(weights) + 1).cast("int"))
    ordered = numbered(by_source.withColumn("_last", F.col("source").isNull()), [], ["_last", "source"], "_place", "sources")
    weighed = stored(ordered.withColumn("_weight", weigh).drop("_last", "_place"), "weights")
    total = weighed.agg(F.sum("source_size")).first()[0] or 0
    top = F.col("source_size") * F.lit(most)
    share, stopped = None, -1
    while True:
        over = F.lit(False) if share is None else F.col("_weight") * F.lit(share) > top
        held, kept, free = weighed.agg(
            F.count_if(over), F.sum(F.when(over, top)), F.sum(F.when(~over, F.col("_weight")))
        ).first()
        if held == stopped or not free:
            break
        share, stopped = (total - (kept or 0)) / free, held
    target = F.least(F.col("_weight") * F.lit(share or 0.0), top.cast("double"))
    return weighed.select("source", "source_size", target.alias("target"))


def mix(
    docs: DataFrame, keep: tuple = (), weights: tuple = WEIGHTS, most: int = MOST, seed: str = "mix-1", draws: int = DRAWS
) -> DataFrame:
    """Copies of each document (``doc_id``, ``text``, ``source``) in the mix.

    One row a document: doc_id, source, size (words), source_size, target,
    copies, taken (copies x size), and the narrow ``keep`` columns. No document has more than ``most`` copies,
    and reruns agree.

    A null text has no words; a source without words has target 0 and no copies. A
    null source is a source of its own, weighed last. Repeated doc_ids are separate
    documents. An empty table gives no rows. Other columns are ignored.
    """
    sized = stored(
        docs.select("doc_id", "source", *keep, word_count(F.col("text")).alias("size")).withColumn("rid", row_number_column()),
        "sizes",
    )
    by_source = stored(sized.groupBy("source").agg(F.sum("size").alias("source_size")), "by_source")
    targets = source_targets(by_source, weights, most)
    rate = F.coalesce(F.try_divide("target", "source_size"), F.lit(0.0))
    offsets = F.array(*[source_offset(F.col("source"), seed, draw) for draw in range(draws)])
    rates = stored(targets.withColumns({"_rate": rate, "_offsets": offsets}), "rates")
    placed = stored(numbered(sized, ["source"], ["size", "doc_id", "rid"], "_place", "places"), "placed")
    by_place = placed.join(rates.withColumnRenamed("source", "_source"), placed["source"].eqNullSafe(F.col("_source")))
    tried = by_place.select("_source", "target", "size", "_place", "_rate", F.posexplode("_offsets").alias("_draw", "_tried"))
    taken = tried.groupBy("_source", "target", "_draw", "_tried").agg(
        F.sum(F.col("size") * passed(F.col("_place"), F.col("_tried"))).alias("_words")
    )
    missed = F.struct(F.abs(F.col("_words") - F.col("target")), "_draw")
    chosen = taken.groupBy(F.col("_source").alias("_from")).agg(F.min_by("_tried", missed).alias("_offset"))
    joined = by_place.join(chosen, F.col("_source").eqNullSafe(F.col("_from")))
    copies = passed(F.col("_place"), F.col("_offset"))
    return joined.withColumn("copies", copies).select(
        "doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"), *keep
    )


def mixed(docs: DataFrame, weights: tuple = WEIGHTS, most: int = MOST, seed: str = "mix-1") -> DataFrame:
    """``docs`` with each row as often as the mix takes it."""
    keyed = with_row_keys(docs, ["doc_id", "source", "text"])
    copies = mix(keyed, ("_k0", "_k1"), weights, most, seed).groupBy("_k0", "_k1")
    chosen = stored(copies.agg(F.count(F.lit(1)).alias("rows"), F.sum("copies").alias("_copies")), "copies")
    taken = matched(keyed, chosen).filter("_copies > 0")
    return taken.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select("_row.*")
