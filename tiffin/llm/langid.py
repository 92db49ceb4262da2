"""Language identification by rank-order profiles of letter n-grams.

A language's profile is its ``top`` most frequent n-grams (one to three
characters of a word padded with spaces) in rank order, learned from a bounded sample
of labelled documents. A document's own most frequent n-grams are compared with
each profile by out-of-place distance: the difference of ranks, or ``top`` for an
n-gram that the profile lacks. Whole texts are counted, on either side.

Plan: one aggregate counts labelled rows by language and sets each language's
sampling rate; the sampled rows' n-grams are counted in their tasks and summed by
(language, n-gram); the profiles (``top`` x languages) go to the tasks of one pass
over the documents, which shuffles nothing.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tiffin.llm.common import map_texts, stored

TOP = 300
SPACE = 1
#: Sampling rates of so many languages are broadcast (some megabytes).
BROADCAST_LANGUAGES = 1 << 16
_PIECE = 1 << 20


@functools.cache
def _letters() -> np.ndarray:
    """Code point to itself where it is a letter, else to ``SPACE``."""
    table = np.full(0x110000, SPACE, dtype=np.int64)
    known = np.array([c for c in range(0x110000) if chr(c).isalpha()], dtype=np.int64)
    table[known] = known
    return table


def gram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Codes (21 bits a character) and counts of a text's n-grams: of each lower-cased run of letters, padded."""
    codes, counts, text = [], [], text.lower()
    for a in range(0, len(text) + 1, _PIECE):
        # Starts a to a + n - 1 of the text with a space before and after it.
        n = min(_PIECE, len(text) + 1 - a)
        piece = (" " * (a == 0) + text[max(0, a - 1) : a + n + 1] + "  ")[: n + 2]
        c = _letters()[np.frombuffer(piece.encode("utf-32-le"), dtype="<u4")]
        gap = c == SPACE
        two = (c[:-1] << 21) | c[1:]
        three = (two[:-1] << 21) | c[2:]
        part = np.concatenate([c[:n][~gap[:n]], two[:n][~(gap[:-1] & gap[1:])[:n]], three[~gap[1:-1]]])
        got = np.unique(part, return_counts=True)
        codes.append(got[0])
        counts.append(got[1])
    if len(codes) == 1:
        return codes[0], counts[0]
    every, at = np.unique(np.concatenate(codes), return_inverse=True)
    return every, np.bincount(at, weights=np.concatenate(counts)).astype(np.int64)


def ranked(codes: np.ndarray, counts: np.ndarray, top: int = TOP) -> np.ndarray:
    """The ``top`` most frequent codes, most frequent first, ties to the smaller code."""
    if len(codes) > 2 * top:
        kept = counts >= np.partition(counts, len(counts) - top)[len(counts) - top]
        codes, counts = codes[kept], counts[kept]
    return codes[np.lexsort((codes, -counts))[:top]]


class Profiles:
    """Rank of each n-gram in each language's profile, ``top`` where it is missing."""

    def __init__(self, profiles: dict[str, list[int]], top: int = TOP):
        self.top, self.languages = top, sorted(profiles)
        self.codes = np.unique(np.array([c for p in profiles.values() for c in p], dtype=np.int64))
        self.ranks = np.full((len(self.codes) + 1, len(self.languages)), -1, dtype=np.int64)
        for j, language in enumerate(self.languages):
            at = np.searchsorted(self.codes, np.array(profiles[language], dtype=np.int64))
            self.ranks[at, j] = np.arange(len(at))

    def predict(self, text: str | None) -> tuple[str, float]:
        """The language of least distance (ties to the smaller name) and 1 - distance / most; ('und', 0) without a letter."""
        codes, counts = gram_counts(text or "")
        if not (codes < 1 << 21).any() or not self.languages:
            return "und", 0.0
        own = ranked(codes, counts, self.top)
        at = np.minimum(np.searchsorted(self.codes, own), max(0, len(self.codes) - 1))
        rank = self.ranks[np.where(self.codes[at] == own, at, len(self.codes))]
        away = np.where(rank < 0, self.top, np.abs(rank - np.arange(len(own))[:, None])).sum(axis=0)
        best = int(np.argmin(away))
        return self.languages[best], float(1 - away[best] / (self.top * len(own)))


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id's text leaves 1 by 3; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def learn(labelled: DataFrame, sample: int = 1500, top: int = TOP) -> dict[str, list[int]]:
    """Profiles from rows (``key``, ``text``, ``lang``), null languages and texts left out.

    Every language is learned, each from about ``sample`` rows, chosen by a hash of ``key`` and the
    row's place in its partition, so that rows that share a key, or have none, are chosen one by one. The bound
    makes the classifier's fit small, and nothing else; profiles grow with the languages alone.
    """
    labelled = labelled.filter("lang is not null and text is not null").withColumn("_at", F.monotonically_increasing_id())
    share = stored(labelled.groupBy("lang").agg((F.lit(float(sample)) / F.count(F.lit(1))).alias("_share")), "shares")
    if share.count() <= BROADCAST_LANGUAGES:  # texts stay where they are; beyond it they are shuffled
        share = F.broadcast(share)
    place = F.xxhash64("key", "_at", F.lit("profile")).bitwiseAND(F.lit((1 << 40) - 1)) / F.lit(float(1 << 40))
    chosen = labelled.join(share, "lang").filter(place < F.col("_share")).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column("lang").to_pylist()
            texts = batch.column("text").to_pylist()
            for language in sorted(set(names)):
                parts = [gram_counts(t) for t, n in zip(texts, names, strict=True) if n == language]
                codes, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
                sums = np.bincount(at, weights=np.concatenate([p[1] for p in parts]), minlength=len(codes))
                columns = [pa.array([language] * len(codes), pa.string()), pa.array(codes), pa.array(sums.astype(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "code", "n"])

    grams = chosen.mapInArrow(count, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    # The best of each of a few buckets, then the best of those on the driver: top x 8 rows a language.
    order = Window.partitionBy("lang", F.pmod("code", F.lit(8))).orderBy(F.desc("n"), "code")
    some = grams.withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= top)
    profiles: dict[str, list[tuple[int, int]]] = {}
    for language, code, n in some.select("lang", "code", "n").collect():
        profiles.setdefault(language, []).append((-n, code))
    return {language: [code for _, code in sorted(grams)[:top]] for language, grams in profiles.items()}


def identify(docs: DataFrame, profiles: dict[str, list[int]], keep: list[str], top: int = TOP) -> DataFrame:
    """``keep`` columns with lang_pred and score (0 to 1) of each whole ``text``; 'und' and 0 without a letter."""

    def make():
        known = Profiles(profiles, top)

        def work(texts: list) -> dict:
            got = [known.predict(t) for t in texts]
            return {"lang_pred": pa.array([x for x, _ in got], pa.string()), "score": np.array([s for _, s in got])}

        return work

    return map_texts(docs, keep, "text", "lang_pred string, score double", make)


def language_of(docs: DataFrame, keep: list[str]) -> DataFrame:
    """Predictions for ``docs`` (doc_id, text, lang), learned from those of its rows that aren't held out.

    Prediction looks at the text alone. A null or letterless text is 'und' with score 0,
    as is every text where nothing was learned. Repeated rows get the same prediction,
    an empty table gives no rows, and other columns are ignored unless kept.
    """
    train = docs.filter(~held_out(F.col("doc_id"))).select(F.col("doc_id").alias("key"), "text", "lang")
    return identify(docs, learn(train), keep)
