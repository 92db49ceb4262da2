"""Exact top-k search by inner product, in three phases with one uniform threshold.

A score is the sum of the inner products over a few slices of the dimensions, and
each slice is a list of local scores. With m lists and a known lower bound t of
the k-th best score, whatever reaches t has a local score of t / m or more in
some list.

1. Gather: each list gives its ``k`` best local scores, their objects' scores are
   added up, and each cell (below) sends its best, several times ``k`` over all cells;
   the k-th best of a query among these is its safe cutoff t.
2. Collect: with the cutoffs sent back, each list gives every entry of at least
   t / m. What is missing in a list counts less than t / m there, which bounds
   the score from above; objects whose bound is under t go.
3. Resolve: the missing local scores of the remaining objects are computed, and
   the ``k`` best scores are kept, ties to the smaller id.

Queries and vectors are dealt to cells of a grid of bounded blocks, so a cell
holds at most ``query_block`` queries (on average) and ``row_block`` vectors; the
lists of a cell share its task, and what is shuffled for a query is a few entries a
cell in phase 1 and those that reach its cutoff in phase 3.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tiffin.llm.common import row_number_column, stored

SCALE = 64


def whole_components(embedding: Column, scale: int = SCALE) -> Column:
    """floor(``scale`` * x) of each component x as double, as long; null where the vector takes no part."""
    wide = embedding.cast("array<double>")
    usable = F.forall(wide, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    return F.when(usable, F.transform(wide, lambda x: F.floor(x * F.lit(float(scale)))))


def _matrix(rows: pd.Series, dims: int) -> np.ndarray:
    """Vectors as rows of longs; a shorter vector has zeros for what it lacks."""
    out = np.zeros((len(rows), dims), dtype=np.int64)
    for i, row in enumerate(rows):
        out[i, : len(row)] = row
    return out


def _exact(a: np.ndarray, b: np.ndarray) -> type:
    """The fastest number type in which inner products of rows of ``a`` and ``b`` are exact."""
    top = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    return np.float32 if top < 1 << 24 else np.float64 if top < 1 << 53 else np.int64


def _lists(queries: np.ndarray, rows: np.ndarray, lists: int) -> list[np.ndarray]:
    """The local scores of each list: queries x rows."""
    kind = _exact(queries, rows)
    a, b = queries.astype(kind), rows.astype(kind)
    return [a[:, part] @ b[:, part].T for part in np.array_split(np.arange(a.shape[1]), lists)]


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` best scores, ties to the smaller id; ``scores`` holds candidates only."""
    if len(scores) > 4 * k:
        bound = np.partition(scores, len(scores) - k)[len(scores) - k]
        kept = np.flatnonzero(scores >= bound)
        return kept[np.lexsort((ids[kept], -scores[kept]))[:k]]
    return np.lexsort((ids, -scores))[:k]


def _cell(k: int, sent: int, lists: int, resolve: bool):
    """Phase 1 (gather) or phases 2 and 3 (collect, resolve) in one cell, which sends ``sent`` entries a query."""

    def run(rows: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        made: list[tuple[np.ndarray, ...]] = []
        if len(rows) and len(queries):
            dims = max(max(map(len, rows["v"])), max(map(len, queries["w"])))
            vectors, ids, rids = _matrix(rows["v"], dims), rows["vec_id"].to_numpy(np.int64), rows["rid"].to_numpy(np.int64)
            for i in range(0, len(queries), 256):
                some = queries.iloc[i : i + 256]
                local = _lists(_matrix(some["w"], dims), vectors, lists)
                cutoffs = some["cutoff"].to_numpy() if resolve else None
                for j, own in enumerate(some["query_id"].to_numpy(np.int64)):
                    scores = [part[j].astype(np.int64) for part in local]
                    if resolve:
                        cutoff = cutoffs[j]
                        seen = [part * lists >= cutoff for part in scores]
                        # A missing local score is under cutoff / lists, so lists x the score is bounded.
                        bound = sum(np.where(s, part * lists, cutoff) for s, part in zip(seen, scores, strict=True))
                        found = np.flatnonzero(np.logical_or.reduce(seen) & (bound >= cutoff * lists) & (ids != own))
                    else:
                        n = min(k + 1, len(ids))
                        tops = [np.argpartition(part, len(ids) - n)[len(ids) - n :] for part in scores]
                        found = np.unique(np.concatenate(tops))
                        found = found[ids[found] != own]
                    total = sum(part[found] for part in scores)
                    if resolve:
                        found, total = found[total >= cutoff], total[total >= cutoff]
                    best = _best(total, ids[found], sent)
                    made.append((np.full(len(best), own), ids[found][best], rids[found][best], total[best]))
        parts = [np.concatenate(x) for x in zip(*made, strict=True)] if made else [np.zeros(0, np.int64)] * 4
        return pd.DataFrame(dict(zip(("query_id", "vec_id", "rid", "score"), parts, strict=True)))

    return lambda key, rows, queries: run(rows, queries)


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    scale: int = SCALE,
    lists: int = 4,
    query_block: int = 16_384,
    row_block: int = 1024,
) -> DataFrame:
    """The ``k`` best inner products of each query among all vectors but those with its own id.

    ``vectors``: vec_id, embedding. One row a result: query_id, rank (from 1),
    vec_id, score. Vectors that are null or hold null or non-finite components, and
    rows with a null vec_id, take no part. Every row is a candidate of its own, repeated rows and
    rows that share a vec_id included; queries that share a vec_id share one list of results, and equal ones are one. Vectors of different lengths are compared over the shorter's components. A
    query without candidates, and an empty table, give no rows. Scores beyond 64 bits wrap.
    """
    usable = vectors.select("vec_id", whole_components(F.col("embedding"), scale).alias("v"), is_query.alias("q"))
    usable = usable.filter(F.col("v").isNotNull() & F.col("vec_id").isNotNull())
    usable = stored(usable.withColumns({"q": F.coalesce("q", F.lit(False)), "rid": row_number_column()}), "vectors")
    n_rows, n_queries = usable.agg(F.count(F.lit(1)), F.count_if("q")).first()
    row_blocks, query_blocks = max(1, -(-n_rows // row_block)), max(1, -(-n_queries // query_block))

    def dealt(df: DataFrame, own: str, blocks: int, other: str, others: int) -> DataFrame:
        place = F.pmod(F.xxhash64(*df.columns), F.lit(blocks)).cast("int")
        return df.withColumn(own, place).withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(others - 1))))

    rows = dealt(usable.select("vec_id", "v", "rid"), "rb", row_blocks, "qb", query_blocks)
    asked = usable.filter("q").select(F.col("vec_id").alias("query_id"), F.col("v").alias("w")).distinct()
    queries = dealt(asked, "qb", query_blocks, "rb", row_blocks)
    schema = "query_id long, vec_id long, rid long, score long"

    def in_cells(asked_with: DataFrame, sent: int, resolve: bool) -> DataFrame:
        pairs = rows.groupBy("qb", "rb").cogroup(asked_with.groupBy("qb", "rb"))
        return pairs.applyInPandas(_cell(k, sent, lists, resolve), schema)

    by_score = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id", "rid")
    numbered = F.row_number().over(by_score)
    gathered = in_cells(queries, min(k, -(-4 * k // row_blocks)), False).distinct().withColumn("_r", numbered).filter(F.col("_r") <= k)
    cutoffs = gathered.groupBy("query_id").agg(
        F.when(F.count(F.lit(1)) == k, F.min("score")).alias("cutoff")
    )
    floor = F.lit(-(1 << 62) // max(1, lists))  # fewer than k candidates in all: everything is collected
    cutoffs = stored(cutoffs.select("query_id", F.coalesce("cutoff", floor).alias("cutoff")), "cutoffs")
    found = in_cells(queries.join(cutoffs, "query_id"), k, True)
    return (
        found.distinct()
        .withColumn("rank", F.row_number().over(by_score))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
