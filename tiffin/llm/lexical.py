"""Ranked lexical search: term at a time, rarest first, with a limit on new accumulators.

Every document is scored for every item of a query set by the sum, over the item's
distinct terms, of weight x impact. One pass over the documents keeps, for the items'
vocabulary alone, each document's term frequencies; from this table come the counts
(N, L, df). A second pass cuts the table into blocks of documents and turns each into a
small inverted index. In a block, an item's terms are taken from the rarest on. A term
adds to the accumulators of the documents that hold it and creates those that are
missing, until all that the remaining terms could add together is less than the k-th
best partial score: from then on no document without an accumulator can reach the
result, and the remaining terms only update the survivors, exactly. Survivors that
fall behind in the same way go. Each block returns its best ``k`` of an item with exact
scores, and the best of those lists are the result.

Plan: nothing is shuffled but df by term and k rows an item and block. Items are taken
in blocks of about ``item_terms`` terms, so what goes to the tasks is bounded however
large the query set is; the documents are read once for each block of items.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tiffin.llm.common import map_texts, row_number_column, stored
from tiffin.llm.simhash import word_runs

#: Bytes outside of terms become spaces, A-Z become a-z.
_SEPARATORS = [*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]
_TABLE = bytes(0x20 if b in _SEPARATORS else b + 0x20 if 0x41 <= b <= 0x5A else b for b in range(256))


def term_runs(text: str | None) -> Iterator[list[bytes]]:
    """Terms of a text, in lists of a few megabytes: runs of ASCII letters, digits and all that isn't ASCII."""
    return word_runs((text or "").encode().translate(_TABLE))


def term_counts(text: str | None) -> tuple[int, Counter]:
    """Terms of a text with repeats, and how often each occurs."""
    total, counts = 0, Counter()
    for run in term_runs(text):
        total += len(run)
        counts.update(run)
    return total, counts


def weight(documents: int, df: int) -> int:
    """floor(1000 ln((2N + 2) / (2 df + 1))), in doubles."""
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


class Index:
    """Inverted index of a block of documents: impacts by term, documents ascending."""

    def __init__(self, terms: np.ndarray, rows: np.ndarray, impacts: np.ndarray, size: int):
        order = np.argsort(terms, kind="stable")
        self.size, self.rows, self.impacts = size, rows[order], impacts[order]
        self.terms, self.starts = np.unique(terms[order], return_index=True)
        self.ends = np.append(self.starts[1:], len(terms))
        self.top = np.maximum.reduceat(self.impacts, self.starts) if len(terms) else np.zeros(0, np.int64)

    def best(self, terms: np.ndarray, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows that can be among the ``k`` best (all ties included) and their exact scores, for terms from the rarest on."""
        at = np.searchsorted(self.terms, terms)
        here = at < len(self.terms)
        here[here] = self.terms[at[here]] == terms[here]
        at, weights = at[here], weights[here]
        # What the terms from each on can add at most.
        left = np.append(np.cumsum((weights * self.top[at])[::-1])[::-1], 0)
        score = np.zeros(self.size, dtype=np.int64)
        alive, kth = None, 0
        for i, (t, w) in enumerate(zip(at.tolist(), weights.tolist(), strict=True)):
            rows, impacts = self.rows[self.starts[t] : self.ends[t]], self.impacts[self.starts[t] : self.ends[t]]
            if alive is None:
                score[rows] += w * impacts
                if self.size >= k:
                    kth = int(np.partition(score, self.size - k)[self.size - k])
                if left[i + 1] < kth:
                    alive = np.flatnonzero(score + left[i + 1] >= kth)
            else:
                place = np.minimum(np.searchsorted(rows, alive), len(rows) - 1)
                held = rows[place] == alive
                score[alive[held]] += w * impacts[place[held]]
                if len(alive) > k:
                    kth = int(np.partition(score[alive], len(alive) - k)[len(alive) - k])
                    alive = alive[score[alive] + left[i + 1] >= kth]
        alive = np.flatnonzero(score) if alive is None else alive[score[alive] > 0]
        return alive, score[alive]


def _frequencies(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """Stored (doc_id, n, terms, tfs): numbers and frequencies of the vocabulary's terms, packed, for documents with a term."""

    def make():
        def work(texts: list) -> dict:
            totals, terms, tfs = [], [], []
            for text in texts:
                n, counts = term_counts(text)
                found = sorted((vocabulary[t], c) for t, c in counts.items() if t in vocabulary)
                totals.append(n)
                terms.append(np.array([t for t, _ in found], dtype="<u4").tobytes())
                tfs.append(np.array([c for _, c in found], dtype="<u4").tobytes())
            return {"n": np.array(totals, dtype=np.int64), "terms": pa.array(terms, pa.binary()), "tfs": pa.array(tfs, pa.binary())}

        return work

    found = map_texts(docs, ["doc_id"], "text", "n long, terms binary, tfs binary", make)
    return stored(found.filter("n > 0"), "frequencies")


def _document_frequencies(held: DataFrame, size: int) -> np.ndarray:
    """Documents that hold each term: counted in the tasks, summed by term."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, dtype=np.int64)
        for batch in batches:
            for raw in batch.column("terms"):
                total[np.frombuffer(raw.as_py(), "<u4")] += 1
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["term", "df"])

    df = np.zeros(size, dtype=np.int64)
    sums = held.select("terms").mapInArrow(count, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    for term, n in sums.collect():  # a number for each term of the block of items
        df[term] = n
    return df


def _best_of_blocks(
    held: DataFrame, items: list[tuple[int, np.ndarray, np.ndarray]], documents: int, length: int, k: int, block: int
) -> DataFrame:
    """(qid, doc_id, score) of each block's best ``k`` for each item (qid, terms, weights)."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list = []
        terms, rows, impacts, entries = [], [], [], 0

        def found() -> pa.RecordBatch:
            index = Index(np.concatenate(terms), np.concatenate(rows), np.concatenate(impacts), len(ids))
            out: list[tuple] = []
            for qid, own, weights in items:
                at, scores = index.best(own, weights, k)
                hits = [(-s, ids[r] is None, ids[r] or 0, qid) for r, s in zip(at.tolist(), scores.tolist(), strict=True)]
                out += sorted(hits)[:k]
            columns = [[h[3] for h in out], [None if h[1] else h[2] for h in out], [-h[0] for h in out]]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["qid", "doc_id", "score"])

        for batch in batches:
            for doc_id, n, own, tfs in zip(*[batch.column(c).to_pylist() for c in ("doc_id", "n", "terms", "tfs")], strict=True):
                if not own:
                    continue
                tf = np.frombuffer(tfs, "<u4").astype(np.int64)
                m = 100 - 90 + 90 * n * documents // length
                terms.append(np.frombuffer(own, "<u4").astype(np.int64))
                rows.append(np.full(len(tf), len(ids), dtype=np.int64))
                impacts.append(1_000_000_000 * tf // (1000 * tf + 8 * m))
                ids.append(doc_id)
                entries += len(tf)
                if len(ids) >= block or entries >= 1 << 22:
                    yield found()
                    ids, terms, rows, impacts, entries = [], [], [], [], 0
        if ids:
            yield found()

    return held.mapInArrow(search, "qid long, doc_id long, score long")


def search(docs: DataFrame, queries: DataFrame, k: int = 10, item_terms: int = 1 << 18, block: int = 1 << 15) -> DataFrame:
    """Each query's ``k`` best documents: item_id, rank (int, from 1), doc_id, score (long).

    ``docs`` has doc_id and text, ``queries`` item_id and text. Only scores above 0
    count; equal scores are ordered by ascending doc_id, null doc_ids last. A null or
    termless text takes no part on either side; repeated rows, of documents or of queries,
    are documents and queries of their own. Empty tables give no rows. Other columns are
    ignored.
    """

    def distinct():
        def work(texts: list) -> dict:
            own = [sorted(term_counts(t)[1]) for t in texts]
            return {"terms": pa.array(own, pa.list_(pa.binary())), "n_terms": np.array([len(x) for x in own], dtype=np.int64)}

        return work

    asked = map_texts(queries.select(F.col("item_id").alias("_id"), "text"), ["_id"], "text", "terms array<binary>, n_terms long", distinct)
    asked = stored(asked.filter("n_terms > 0").withColumn("qid", row_number_column()), "items")
    blocks = max(1, -(-(asked.agg(F.sum("n_terms")).first()[0] or 0) // item_terms))
    parts = []
    for b in range(blocks):
        own = asked.filter(F.pmod(F.xxhash64("qid"), F.lit(blocks)) == b).select("qid", "terms").collect()
        vocabulary = {t: i for i, t in enumerate(sorted({bytes(t) for r in own for t in r.terms}))}
        held = _frequencies(docs, vocabulary)
        documents, length = held.agg(F.count(F.lit(1)), F.sum("n")).first()
        df = _document_frequencies(held, len(vocabulary))
        items = []
        for r in own:
            terms = np.array([vocabulary[bytes(t)] for t in r.terms], dtype=np.int64)
            terms = terms[df[terms] > 0]
            terms = terms[np.lexsort((terms, df[terms]))]
            items.append((r.qid, terms, np.array([weight(documents, int(n)) for n in df[terms]], dtype=np.int64)))
        parts.append(_best_of_blocks(held, items, documents, length or 1, k, block))
    order = Window.partitionBy("qid").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    found = reduce(DataFrame.union, parts).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return found.join(asked.select("qid", F.col("_id").alias("item_id")), "qid").select("item_id", "rank", "doc_id", "score")
