"""Phrase collocations, laid out like a streaming estimation: count streams in prefix and in suffix order.

Words are counted first (by language, summed in the tasks before they meet). Each word
occurrence then gives one window, the word and up to three that follow it in its piece;
windows are sorted in prefix order (by first word, then second, ...), and runs of equal
beginnings in that one stream are the counts of all phrases of two to four words.

Phrases of ``least`` occurrences or more, with their words, form two streams: in prefix
order a phrase follows its beginnings, in suffix order (by last word, then the one
before, ...) its ends. A walk over each stream holds the last phrase of each length:
in the first it reads the left counts of every cut and passes a phrase's count back to
what it extends on the right, in the second the same for right counts and extensions on the
left. A phrase that lies in a longer one also lies in one that is a word longer and at least
as frequent, so these two are all extensions that matter. Streams of all lengths are
merged in lockstep; nothing is looked up by hash.

Plan: a stream's order is cut into buckets at places of a cumulative distribution, in which
a word gets its share of all words and each following word its share of that, so a word or pair
with a third of all rows is spread over a third of the buckets. Runs that a bucket's
end may cut are summed again; a phrase is copied to each bucket that its extensions
reach. Words are numbered by 64-bit hashes of language and word. Where at most
``dictionary`` words are frequent, tasks know them and send 4-byte numbers, and
windows end at rarer words, as no phrase that counts holds one; beyond that, hashes are sent.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tiffin.llm.common import stored, text_slices
from tiffin.llm.word_hashes import byte_values, mixed, text_bytes, word_hashes

#: Bytes that end a piece, and those between words.
BREAKS = b".,;:!?\n\x0b\x0c\r"
BETWEEN = BREAKS + b" \t"
LONGEST = 4
W = [f"w{i}" for i in range(1, LONGEST + 1)]
_VALUES = byte_values(BETWEEN)
_BREAK = np.isin(np.arange(256), list(BREAKS))


def _language(lang: str | None) -> str:
    return "und" if lang is None else lang


def _ids(texts: pa.Array, langs: list) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of all texts in order: numbers (never 0), whether a word begins a piece, starts and ends among the bytes, the texts' rows."""
    hashes, starts, ends = word_hashes(texts, _VALUES)
    raw, offsets = text_bytes(texts)
    row = np.repeat(np.arange(len(langs)), np.diff(np.append(0, ends)))
    salt = np.array([xxhash.xxh64_intdigest(_language(x), 7) for x in langs], dtype=np.uint64)
    ids = mixed(hashes ^ salt[row])
    ids[ids == 0] = 1
    broken = np.append(0, np.cumsum(_BREAK[raw], dtype=np.int64))[starts]
    new = np.append(True, (broken[1:] != broken[:-1]) | (row[1:] != row[:-1]))[: len(ids)]
    return ids, new, starts, offsets[1:][row], row


def _word_counts(docs: DataFrame) -> DataFrame:
    """(id, lang, word, f) of every word; the numbers of two words of one language never agree but by chance."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, langs = batch.column("text"), batch.column("lang").to_pylist()
            for a, b in text_slices(texts):
                part = texts.slice(a, b - a)
                ids, _, starts, ends, row = _ids(part, langs[a:b])
                raw = text_bytes(part)[0]
                seen, first, n = np.unique(ids, return_index=True, return_counts=True)
                words = []
                for i in first.tolist():
                    x = y = int(starts[i])
                    while y < ends[i] and raw[y] not in BETWEEN:
                        y += 1
                    words.append(raw[x:y].tobytes().lower().decode())
                columns = [pa.array(seen.view(np.int64)), pa.array([_language(langs[a + r]) for r in row[first].tolist()], pa.string())]
                columns += [pa.array(words, pa.string()), pa.array(n.astype(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "lang", "word", "f"])

    each = docs.select("lang", "text").mapInArrow(count, "id long, lang string, word string, f long")
    return each.groupBy("id", "lang", "word").agg(F.sum("f").alias("f"))


class Layout:
    """Places of phrases in [0, 1): a word's range is its share of all words, and what follows divides it alike.

    ``known`` (ascending) have the shares given; all other words share ``rest`` by their numbers.
    """

    def __init__(self, known: np.ndarray, shares: np.ndarray, compact: bool):
        self.known, self.shares, self.compact = known, shares, compact
        self.before = np.append(0.0, np.cumsum(shares))
        self.rest = 0.0 if compact else max(0.0, 1.0 - float(shares.sum()))

    def _range(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.known, ids)
        mine = np.minimum(at, max(0, len(self.known) - 1))
        low = self.before[at] + self.rest * (ids / 2.0**64)
        held = self.known[mine] == ids if len(self.known) else np.zeros(len(ids), dtype=bool)
        return low, np.where(held, self.shares[mine] if len(self.known) else 0.0, 0.0)

    def places(self, columns: list[np.ndarray], last: bool = False) -> np.ndarray:
        """Where phrases (a column a place, 0 past the end) begin, or with ``last`` where their extensions end.

        Never less for a phrase that is later in the order: every step is monotonic.
        """
        inner = np.full(len(columns[0]), 1.0 if last else 0.0)
        for ids in reversed(columns):
            low, width = self._range(ids)
            inner = np.where(ids == 0, inner, np.minimum(low + width * inner, np.minimum(low + width, 1.0)))
        return inner

    def buckets(self, columns: list[np.ndarray], n: int, last: bool = False) -> np.ndarray:
        return np.minimum((self.places(columns, last) * n).astype(np.int64), n - 1)

    def packed(self, ids: np.ndarray) -> bytes:
        """Numbers of words as they are sent; 0 stays 0."""
        if self.compact:
            return np.where(ids == 0, 0, np.searchsorted(self.known, ids) + 1).astype("<u4").tobytes()
        return ids.astype("<u8").tobytes()

    def unpacked(self, raw: bytes) -> np.ndarray:
        if self.compact:
            return np.append(np.uint64(0), self.known)[np.frombuffer(raw, "<u4")]
        return np.frombuffer(raw, "<u8")


def windows(ids: np.ndarray, new: np.ndarray, layout: Layout, at_once: int = 1 << 20) -> Iterator[list[np.ndarray]]:
    """Windows of words as columns (0 past a piece's end), and their counts, in prefix order and without repeats in a part."""
    if layout.compact and len(ids):
        at = np.minimum(np.searchsorted(layout.known, ids), max(0, len(layout.known) - 1))
        rare = layout.known[at] != ids if len(layout.known) else np.ones(len(ids), dtype=bool)
        ids = np.where(rare, np.uint64(0), ids)
    ids, new = np.append(ids, np.zeros(LONGEST, np.uint64)), np.append(new, np.ones(LONGEST, bool))
    for a in range(0, len(ids) - LONGEST, at_once):
        b = min(len(ids) - LONGEST, a + at_once)
        columns, goes_on = [ids[a:b]], ids[a:b] != 0
        for i in range(1, LONGEST):
            goes_on = goes_on & ~new[a + i : b + i] & (ids[a + i : b + i] != 0)
            columns.append(np.where(goes_on, ids[a + i : b + i], np.uint64(0)))
        used = columns[1] != 0  # single words are counted already
        yield summed([c[used] for c in columns], np.ones(int(used.sum()), dtype=np.int64))


def _ordered(columns: list[np.ndarray]) -> np.ndarray:
    return np.lexsort(columns[::-1])


def summed(columns: list[np.ndarray], counts: np.ndarray) -> list[np.ndarray]:
    """Equal rows as one with the sum of their counts, in prefix order."""
    if not len(counts):
        return [*columns, counts]
    order = _ordered(columns)
    columns, counts = [c[order] for c in columns], counts[order]
    first = np.flatnonzero(np.append(True, np.any([c[1:] != c[:-1] for c in columns], axis=0)))
    return [*[c[first] for c in columns], np.add.reduceat(counts, first)]


def phrase_counts(columns: list[np.ndarray], counts: np.ndarray, least: int) -> list[np.ndarray]:
    """Phrases of two words or more and their counts from windows in prefix order.

    Runs of ``least`` or more, and the first and the last of each length, which other buckets may continue.
    """
    parts = []
    for k in range(2, LONGEST + 1):
        held = np.flatnonzero(columns[k - 1] != 0)
        if not len(held):
            continue
        own = [c[held] for c in columns[:k]]
        first = np.flatnonzero(np.append(True, np.any([c[1:] != c[:-1] for c in own], axis=0)))
        f = np.add.reduceat(counts[held], first)
        kept = f >= least
        kept[[0, -1]] = True
        first, f = first[kept], f[kept]
        parts.append([*[c[first] for c in own], *[np.zeros(len(first), np.uint64)] * (LONGEST - k), f])
    return [np.concatenate(c) for c in zip(*parts, strict=True)] if parts else []


def _grouped(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple[int, list[tuple]]]:
    """Rows of batches sorted by ``bucket``, a bucket at a time."""
    now, rows = None, []
    for batch in batches:
        for bucket, *row in zip(*[batch.column(c).to_pylist() for c in ("bucket", *names)], strict=True):
            if bucket != now and rows:
                yield now, rows
                rows = []
            now = bucket
            rows.append(tuple(row))
    if rows:
        yield now, rows


def _phrases(docs: DataFrame, layout: Layout, buckets: int, least: int) -> DataFrame:
    """(w1, ..., w4, f) of phrases of two words or more with ``least`` occurrences or more."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, langs = batch.column("text"), batch.column("lang").to_pylist()
            for a, b in text_slices(texts):
                ids, new, *_ = _ids(texts.slice(a, b - a), langs[a:b])
                for *columns, n in windows(ids, new, layout):
                    names, starts = np.unique(layout.buckets(columns, buckets), return_index=True)
                    ends = [*starts[1:], len(n)]
                    rows = [[x[s:e] for x in (*columns, n)] for s, e in zip(starts, ends if len(starts) else [], strict=True)]
                    made = [[layout.packed(c) for c in cs] for cs in zip(*[r[:LONGEST] for r in rows], strict=True)] or [[]] * LONGEST
                    made.append([r[LONGEST].astype("<u4").tobytes() for r in rows])
                    yield pa.RecordBatch.from_arrays([pa.array(names), *[pa.array(c, pa.binary()) for c in made]], names=["bucket", *W, "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _grouped(batches, [*W, "n"]):
            columns = [np.concatenate([layout.unpacked(r[i]) for r in rows]) for i in range(LONGEST)]
            n = np.concatenate([np.frombuffer(r[LONGEST], "<u4") for r in rows]).astype(np.int64)
            *columns, n = summed(columns, n)
            got = phrase_counts(columns, n, least)
            if got:
                yield pa.RecordBatch.from_arrays([pa.array(c.view(np.int64)) for c in got], names=[*W, "f"])

    kinds = ", ".join(f"{w} binary" for w in (*W, "n"))
    sent = docs.select("lang", "text").mapInArrow(cut, f"bucket long, {kinds}").repartition("bucket").sortWithinPartitions("bucket")
    found = sent.mapInArrow(count, ", ".join(f"{w} long" for w in (*W, "f")))
    return found.groupBy(*W).agg(F.sum("f").alias("f")).filter(F.col("f") >= least)


def walk(columns: list[np.ndarray], f: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Over phrases in prefix order: the count of each one's beginning of 1, 2, 3 words (0: none), and of its most frequent extension by a word."""
    length = np.sum([c != 0 for c in columns], axis=0)
    at, starts, longer = np.arange(len(f)), [], np.zeros(len(f), dtype=np.int64)
    same = np.ones(len(f), dtype=bool)
    for k in range(1, LONGEST):
        held = np.maximum.accumulate(np.where(length == k, at, -1))  # the phrase of k words last passed
        same = same & (columns[k - 1] == columns[k - 1][held])
        own = (held >= 0) & (length > k)
        for c in columns[: k - 1]:
            own &= c == c[held]
        own &= columns[k - 1] == columns[k - 1][held]
        starts.append(np.where(own, f[held], 0))
        child = own & (length == k + 1)
        np.maximum.at(longer, held[child], f[child])
    return starts, longer


def _stream(phrases: DataFrame, layout: Layout, buckets: int, backwards: bool) -> DataFrame:
    """A walk over all phrases in prefix order, or ``backwards`` in suffix order: (w1, ..., w4, f, x1, x2, x3, longer)."""
    out = [*W, "f", "x1", "x2", "x3", "longer"]

    def turned(columns: list[np.ndarray]) -> list[np.ndarray]:
        if not backwards:
            return columns
        length = np.sum([c != 0 for c in columns], axis=0)
        table, rows = np.stack(columns), np.arange(len(length))
        return [np.where(i < length, table[np.maximum(length - 1 - i, 0), rows], np.uint64(0)) for i in range(LONGEST)]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = turned([batch.column(w).to_numpy().view(np.uint64) for w in W])
            first, last = (layout.buckets(columns, buckets, end) for end in (False, True))
            times = np.maximum(last, first) - first + 1
            row = np.repeat(np.arange(len(times)), times)
            step = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
            made = [first[row] + step, step == 0, *[c[row].view(np.int64) for c in columns], batch.column("f").to_numpy()[row]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in made], names=["bucket", "home", *W, "f"])

    def merged(rows: list[np.ndarray]) -> pa.RecordBatch:
        home, f = rows[0].astype(bool), rows[-1]
        columns = [c.view(np.uint64) for c in rows[1:-1]]
        order = _ordered(columns)
        columns, home, f = [c[order] for c in columns], home[order], f[order]
        starts, longer = walk(columns, f)
        used = home | (longer > 0)
        made = [c.view(np.int64) for c in turned(columns)]
        made += [np.where(home, x, 0) for x in (f, *starts)] + [longer]
        return pa.RecordBatch.from_arrays([pa.array(c[used]) for c in made], names=out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows = None, []
        for batch in batches:
            part = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("bucket", "home", *W, "f")]
            cuts = np.flatnonzero(np.append(True, part[0][1:] != part[0][:-1])) if batch.num_rows else []
            for a, b in zip(cuts, [*cuts[1:], batch.num_rows], strict=False):
                if part[0][a] != now and rows:
                    yield merged([np.concatenate(c) for c in zip(*rows, strict=True)])
                    rows = []
                now = part[0][a]
                rows.append([c[a:b] for c in part[1:]])
        if rows:
            yield merged([np.concatenate(c) for c in zip(*rows, strict=True)])

    kinds = ", ".join(f"{w} long" for w in (*W, "f"))
    dealt = phrases.mapInArrow(deal, f"bucket long, home boolean, {kinds}").repartition("bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(run, ", ".join(f"{c} long" for c in out))


def _layout(words: DataFrame, total: int, dictionary: int) -> Layout:
    """Shares of all frequent words where they are ``dictionary`` at most, else of words with 1 / 4096 of all occurrences."""
    compact = words.limit(dictionary + 1).count() <= dictionary
    held = words if compact else words.filter(F.col("f") * 4096 >= total)
    found = held.select("id", "f").toArrow()  # at most ``dictionary``, or 4096, rows
    ids = found.column("id").to_numpy().view(np.uint64)
    order = np.argsort(ids)
    f = found.column("f").to_numpy()[order].astype(float)
    return Layout(ids[order], f / max(1.0, f.sum() if compact else float(total)), compact)


def collocations(
    docs: DataFrame, least: int = 30, covered: int = 80, best: int = 2000, dictionary: int = 1 << 21,
    bucket_words: int = 1 << 20, bucket_phrases: int = 1 << 16,
) -> DataFrame:
    """Each language's ``best`` phrases: lang, rank (from 1), phrase, a, l, r, n, score.

    ``docs`` has lang (null: ``und``) and text (null: empty). A candidate is a phrase of 2 to 4
    words with a >= ``least`` occurrences; it goes if a longer candidate that holds it has
    ``covered`` hundredths of its occurrences. Scores are whole numbers from exact decimals; ties go by a, then
    by the phrase's bytes. Repeated rows count as often as they stand there, an empty table gives no rows, other columns are ignored.
    """
    counts = stored(_word_counts(docs), "words")
    totals = counts.groupBy("lang").agg(F.sum("f").alias("n"))
    total = counts.agg(F.coalesce(F.sum("f"), F.lit(0))).first()[0]
    words = counts.filter(F.col("f") >= least)
    layout = _layout(words, total, dictionary)
    phrases = stored(_phrases(docs, layout, max(48, total // bucket_words), least), "phrases")
    every = phrases.unionByName(words.select(F.col("id").alias("w1"), *[F.lit(0).cast("long").alias(w) for w in W[1:]], "f"))
    buckets = max(12, every.count() // bucket_phrases)
    ahead = _stream(every, layout, buckets, False).toDF(*W, "f", "l1", "l2", "l3", "longer")
    behind = _stream(every, layout, buckets, True).toDF(*W, "f", "r1", "r2", "r3", "longer")
    # The two streams' rows of a phrase meet by sorting, as rows of one table.
    both = ahead.unionByName(behind, allowMissingColumns=True).filter("w2 <> 0")
    known = both.groupBy(*W).agg(*[F.max(c).alias(c) for c in ("f", "l1", "l2", "l3", "r1", "r2", "r3", "longer")])
    length = F.when(F.col("w4") != 0, 4).when(F.col("w3") != 0, 3).otherwise(2)
    kept = stored(known.withColumns({"k": length, "a": F.col("f")}).filter(F.col("longer") * 100 < F.col("a") * covered), "candidates")

    def scored(left: str, right: str, cut: int):
        score = F.expr(f"cast(cast(a as decimal(38, 0)) * 2000000 div ({left} + {right}) as bigint)")
        return F.struct(score.alias("score"), F.lit(cut).alias("cut"), F.col(left).alias("l"), F.col(right).alias("r"))

    worst = F.when(F.col("k") == 2, scored("l1", "r1", 1))
    worst = worst.when(F.col("k") == 3, F.least(scored("l1", "r2", 1), scored("l2", "r1", 2)))
    worst = worst.otherwise(F.least(scored("l1", "r3", 1), scored("l2", "r2", 2), scored("l3", "r1", 3)))
    names = words.select("id", "lang", "word")
    rows = kept.select(*W, "a", worst.alias("_s")).select(*W, "a", "_s.l", "_s.r", "_s.score")
    rows = rows.join(names.select(F.col("id").alias("w1"), "lang"), "w1")
    order = [F.desc("score"), F.desc("a")]
    few = rows.withColumn("_r", F.rank().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("_r") <= best)
    few = stored(few.drop("_r"), "best")
    each = few.select(*W, F.posexplode(F.array(*W)).alias("_at", "id")).filter("id <> 0").join(names.select("id", "word"), "id")
    said = each.groupBy(*W).agg(F.sort_array(F.collect_list(F.struct("_at", "word"))).alias("_w"))
    said = said.select(*W, F.array_join(F.transform("_w", lambda x: x["word"]), " ").alias("phrase"))
    placed = few.join(said, W).withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order, "phrase")).cast("long"))
    return placed.filter(F.col("rank") <= best).join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
