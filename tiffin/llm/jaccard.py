"""N-gram Jaccard join by vertical partitioning.

A text's set holds its distinct word shingles as 64-bit hashes. Two sets link when
the size of their intersection is at least ``percent`` hundredths of their union's.
Documents with equal sets are one class, and all work is on classes.

Most classes go before their sets are dealt out whole. In any order of all n-grams, two sets that link have t in
common among the first size - least overlap + t n-grams of each. So these go first, in the order of their hashes
with frequent n-grams last, where t is a tenth of the least overlap; a class that has fewer of them in common with
other classes than the t of its smallest possible partner has none. A bitmap of the classes left, of
bounded size, tells the tasks which sets to deal out; one that it lets through by chance costs its
shuffling alone. All that follows is about the classes left.

Global order: n-grams by the number of classes that hold them (df), then by bucket and hash. An
n-gram of one class alone can link nothing, so only its number matters: a class with
more of them than its prefix (size - least overlap + 1 of its rarest n-grams) has no
partner and goes at once. What is left is cut along the global order:

1. Candidates: pairs that share an n-gram of both prefixes. How many they share there,
   and what can follow behind the shorter prefix, rules out most of the others.
2. The global order is cut into ``fragments`` of about the same number of entries;
   each class becomes a segment a fragment. The overlap of a candidate pair is counted
   in each fragment apart and summed by pair, and the sum decides.

Skew: counting meets by n-gram in buckets of hash; n-grams in about a thousandth of the
documents or more are found beforehand, in the tasks, and dealt by class instead. An
n-gram with over ``group`` classes in its prefixes isn't joined with itself: its
classes are dealt to cells of two blocks each, and a cell sums its overlaps, fragment by
fragment, in its task. A pair belongs to its first common prefix n-gram, so no pair
counts twice, and a cell passes on a spanning forest of its links and how many each
class has, never its pairs. Links join classes to components (simhash.components).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiffin.llm.common import WHITE_BYTES, map_texts, stored, text_slices
from tiffin.llm.simhash import components
from tiffin.llm.word_hashes import byte_values, mixed, word_hashes

SEED = 42
#: Bits of an n-gram's hash that are sent beside its bucket, and the bit that marks an n-gram of the frequent list.
_REST = 48
_FREQUENT = 1 << 62
#: A frequent n-gram is in at least one of so many documents, and in LEAST_FREQUENT of them.
PER_DOCUMENTS = 1000
LEAST_FREQUENT = 1024
#: Classes in a block of a hot n-gram's classes; a cell holds two blocks.
BLOCK = 512
#: Of a class's least overlap, one n-gram in so many is what the first round asks for.
SHARE = 10
#: Bits a class in the bitmap of classes that may have a partner, and the most it has in all (16 MB).
BITS_A_CLASS = 32
MOST_BITS = 1 << 27
#: Bits in a row of the bitmap.
_ROW = 1 << 15

Sets = dict[int, np.ndarray]


_WORDS = byte_values(WHITE_BYTES)


def shingle_sets(texts: pa.Array, size: int = 5) -> list[np.ndarray]:
    """Each text's sorted distinct hashes of ``size``-word shingles (fewer words: of the whole sequence).

    A shingle's hash is a sum of its words' hashes, each times an odd number of its place.
    """
    words, _, ends = word_hashes(texts, _WORDS)
    factors = [np.uint64(xxhash.xxh64_intdigest(f"place {i}") | 1) for i in range(size)]

    def hashed(own: np.ndarray, k: int) -> np.ndarray:
        total = np.full(max(0, len(own) - k + 1), k, dtype=np.uint64)
        for i in range(k if len(total) else 0):
            total += own[i : len(own) - k + 1 + i] * factors[i]
        return mixed(total)

    whole = hashed(words, size)  # shingles over the ends of texts are passed over
    sets, a = [], 0
    for b in ends.tolist():
        own = np.sort(whole[a : b - size + 1]) if b - a >= size else hashed(words[a:b], b - a)[: min(b - a, 1)]
        sets.append(own[np.append(True, own[1:] != own[:-1])] if len(own) else own)
        a = b
    return sets


def _key(grams: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(grams.tobytes(), SEED) - (1 << 63)


def _sized(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, key and n of each document's set, and on some rows ``often``: n-grams common among the texts beside it, with counts."""

    def make():
        def work(texts: list) -> dict:
            sets = shingle_sets(pa.array(texts, pa.large_string()), size)
            keys = [_key(s) for s in sets]
            often = [None] * len(texts)
            grams, counts = np.unique(np.concatenate(list(dict(zip(keys, sets, strict=True)).values())), return_counts=True)
            many = counts >= max(8, len(texts) // 128)
            if many.any():
                often[0] = grams[many].tobytes() + counts[many].astype("<i8").tobytes()
            return {"key": np.array(keys, dtype=np.int64), "n": np.array([len(s) for s in sets], dtype=np.int64), "often": pa.array(often, pa.binary())}

        return work

    return map_texts(docs, ["doc_id"], "text", "key long, n long, often binary", make)


def _frequent(sized: DataFrame, least: int) -> tuple[np.ndarray, np.ndarray]:
    """N-grams that tasks counted ``least`` times or more together, and the counts, ascending by n-gram.

    Sets hold all n-grams once, so there are at most PER_DOCUMENTS times as many as a set holds on average.
    """

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw in batch.column("often").to_pylist():
                both = np.frombuffer(raw, "<i8")
                half = len(both) // 2
                yield pa.RecordBatch.from_arrays([pa.array(both[:half]), pa.array(both[half:])], names=["gram", "n"])

    sums = sized.filter("often is not null").select("often").mapInArrow(unpack, "gram long, n long")
    found = sums.groupBy("gram").agg(F.sum("n").alias("n")).filter(F.col("n") >= least).collect()
    grams = np.array([r.gram for r in found], dtype=np.int64).view(np.uint64)
    counts = np.array([r.n for r in found], dtype=np.int64)
    order = np.argsort(grams)
    return grams[order], counts[order]


def first_grams(sets: Sets, known: np.ndarray, percent: int) -> Sets:
    """Of each set, the n-grams of which it shares some (``least_shared``) with any set it links to: its first by hash, those in ``known`` last."""
    grams = np.concatenate([np.zeros(0, np.uint64), *sets.values()])
    held = np.array([len(s) for s in sets.values()], dtype=np.int64)
    row = np.repeat(np.arange(len(held)), held)
    often = known[np.minimum(np.searchsorted(known, grams), len(known) - 1)] == grams if len(known) else np.zeros(len(grams), bool)
    grams = grams[np.argsort(row * 2 + often, kind="stable")]
    starts, least = np.cumsum(held) - held, -(-held * percent // 100)
    some = np.minimum(held, held - least + np.maximum(1, least // SHARE))
    return {k: grams[a : a + n] for k, a, n in zip(sets, starts.tolist(), some.tolist(), strict=True)}


def least_shared(n: Column, percent: int) -> Column:
    """How many of its ``first_grams`` a set of ``n`` shares with a set it links to, at least: as many as count for its smallest partner."""
    smallest = least_overlap(n, percent)
    return F.greatest(F.lit(1).cast("long"), F.floor(least_overlap(smallest, percent) / SHARE))


def _bitmap(keys: DataFrame, n: int) -> np.ndarray:
    """Bytes of a bitmap in which the bits of ``keys``, ``n`` of them, are set; keys are hashes, so their last bits place them."""
    bits = min(MOST_BITS, max(_ROW, 1 << (BITS_A_CLASS * n).bit_length()))
    at = F.col("key").bitwiseAND(F.lit(bits - 1))
    placed = keys.select(F.shiftright(at, 15).alias("row"), at.bitwiseAND(F.lit(_ROW - 1)).alias("at")).repartition("row")
    found = np.zeros((bits // _ROW, _ROW // 8), dtype=np.uint8)
    for r in placed.groupBy("row").agg(F.bitmap_construct_agg("at").alias("bits")).collect():
        found[r.row] = np.frombuffer(r.bits, np.uint8)
    return found.reshape(-1)


def held_in(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which ``keys`` have their bit set in a bitmap."""
    at = keys & np.int64(len(bitmap) * 8 - 1)
    return (bitmap[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def _partnered(docs: DataFrame, classes: DataFrame, size: int, percent: int, buckets: int, frequent: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """Rows of ``classes`` that share enough of their first n-grams with others: all that link, and few more."""
    known = frequent[0]
    met = _shared(docs, size, buckets, frequent, lambda sets: first_grams(sets, known, percent))
    met = met.groupBy("key").agg(F.sum(F.size("gram")).alias("met"))
    return classes.join(met, "key").filter(F.col("met") >= least_shared(F.col("n"), percent)).drop("met")


def _let_through(bitmap: np.ndarray) -> Callable[[Sets], Sets]:
    def chosen(sets: Sets) -> Sets:
        kept = held_in(bitmap, np.fromiter(sets, dtype=np.int64, count=len(sets)))
        return {k: s for (k, s), here in zip(sets.items(), kept.tolist(), strict=True) if here}

    return chosen


def _shared(docs: DataFrame, size: int, buckets: int, frequent: tuple[np.ndarray, np.ndarray], chosen: Callable[[Sets], Sets]) -> DataFrame:
    """Of what ``chosen`` leaves of the sets, each class's n-grams that another class holds too: key, df and gram, arrays
    side by side, a row for each bucket. A gram is the n-gram's number, by bucket, so that it has few bytes that aren't zero.

    Sets go to the buckets in packed rows, a class once for each few megabytes of text; a
    bucket's task drops the copies that are left and counts classes by n-gram.
    """
    known, totals = frequent

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            for a, b in text_slices(texts):
                sets: Sets = {}
                for own in shingle_sets(texts.slice(a, b - a), size):
                    sets.setdefault(_key(own), own)
                if sets := chosen(sets):
                    yield dealt(sets)

    def dealt(sets: Sets) -> pa.RecordBatch:
        grams = np.concatenate(list(sets.values()))
        keys = np.fromiter(sets, dtype=np.int64, count=len(sets))
        row = np.repeat(np.arange(len(keys)), [len(s) for s in sets.values()])
        bucket = (grams % np.uint64(buckets)).astype(np.int64)
        rest = grams // np.uint64(buckets) & np.uint64((1 << _REST) - 1)
        if len(known) and len(grams):
            at = np.minimum(np.searchsorted(known, grams), len(known) - 1)
            often = known[at] == grams
            bucket = np.where(often, buckets + keys[row] % buckets, bucket)
            rest = np.where(often, at.astype(np.uint64), rest)
        order = np.lexsort((row, bucket))
        bucket, rest, row = bucket[order], rest[order], row[order]
        names, starts = np.unique(bucket, return_index=True)
        made: dict[str, list] = {"keys": [], "sizes": [], "low": [], "high": []}
        ends = [*starts[1:], len(bucket)] if len(starts) else []
        for x, y in zip(starts, ends, strict=True):
            rows, sizes = np.unique(row[x:y], return_counts=True)
            made["keys"].append(keys[rows].tobytes())
            made["sizes"].append(sizes.astype("<u4").tobytes())
            made["low"].append((rest[x:y] & np.uint64(0xFFFFFFFF)).astype("<u4").tobytes())
            made["high"].append((rest[x:y] >> np.uint64(32)).astype("<u2").tobytes())
        columns = [pa.array(names.astype(np.int64)), *[pa.array(c, pa.binary()) for c in made.values()]]
        return pa.RecordBatch.from_arrays(columns, names=["bucket", *made])

    def count(bucket: int, parts: list[tuple]) -> pa.RecordBatch:
        keys = np.concatenate([np.repeat(np.frombuffer(k, "<i8"), np.frombuffer(s, "<u4")) for k, s, _, _ in parts])
        low = np.concatenate([np.frombuffer(x[2], "<u4") for x in parts]).astype(np.uint64)
        rest = low | (np.concatenate([np.frombuffer(x[3], "<u2") for x in parts]).astype(np.uint64) << np.uint64(32))
        order = np.lexsort((keys, rest))
        keys, rest = keys[order], rest[order]
        first = np.append(True, (rest[1:] != rest[:-1]) | (keys[1:] != keys[:-1]))
        keys, rest = keys[first], rest[first]
        if bucket >= buckets:
            df, gram = totals[rest.astype(np.int64)], rest.astype(np.int64) | _FREQUENT
        else:
            change = np.flatnonzero(np.append(True, rest[1:] != rest[:-1]))
            runs = np.diff(np.append(change, len(rest)))
            number = np.cumsum(runs > 1) - 1  # n-grams of more than one class, in the order of their hashes
            df, gram = np.repeat(runs, runs), np.repeat(number * buckets + bucket, runs)
            keys, df, gram = keys[df > 1], df[df > 1], gram[df > 1]
        order = np.lexsort((gram, df, keys))
        keys, df, gram = keys[order], df[order].astype(np.int64), gram[order]
        starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
        ends = pa.array(np.append(starts, len(keys)).astype(np.int32))
        lists = [pa.ListArray.from_arrays(ends, pa.array(x)) for x in (df, gram)]
        return pa.RecordBatch.from_arrays([pa.array(keys[starts]), *lists], names=["key", "df", "gram"])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts = None, []
        for batch in batches:
            for x in zip(*[batch.column(c).to_pylist() for c in ("bucket", "keys", "sizes", "low", "high")], strict=True):
                if x[0] != now:
                    if parts:
                        yield count(now, parts)
                    now, parts = x[0], []
                parts.append(x[1:])
        if parts:
            yield count(now, parts)

    packed = docs.select("text").mapInArrow(pack, "bucket long, keys binary, sizes binary, low binary, high binary")
    return packed.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(counted, "key long, df array<long>, gram array<long>")


def least_overlap(n: Column, percent: int) -> Column:
    """The fewest n-grams that a set of ``n`` shares with a set it links to."""
    return F.ceil(n * percent / F.lit(100.0)).cast("long")


def _pair_overlap(a: Column, b: Column, percent: int) -> Column:
    """The fewest n-grams that two linked sets of sizes ``a`` and ``b`` share."""
    return F.ceil((a + b) * percent / F.lit(100.0 + percent)).cast("long")


def _alive(shared: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Classes that may have a partner: key, n, copies, grams (struct df, gram) in the global order, and prefix.

    ``prefix`` is how many of ``grams`` are in the class's prefix, after those of its own alone.
    """
    rows = shared.groupBy("key").agg(F.collect_list(F.struct("df", "gram")).alias("_rows"))
    grams = F.sort_array(F.flatten(F.transform("_rows", lambda r: F.arrays_zip(r["df"].alias("df"), r["gram"].alias("gram")))))
    held = rows.select("key", grams.alias("grams"))
    alone = F.col("n") - F.size("grams")
    prefix = F.col("n") - least_overlap(F.col("n"), percent) + 1 - alone
    return held.join(classes, "key").withColumn("prefix", prefix).filter("prefix > 0")


def _place(x: Column) -> Column:
    """Where an n-gram (struct df, gram) stands in the global order, as a double: its number, however large, becomes a fraction."""
    return x["df"] + x["gram"] / (x["gram"] + F.lit(float(1 << 24)))


def _fragment(cuts: list[float], x: Column) -> Column:
    """The fragment of an n-gram: how many cuts of the global order are at or before it."""
    return sum((F.when(_place(x) >= c, 1).otherwise(0) for c in cuts), F.lit(0))


def _cuts(alive: DataFrame, fragments: int) -> list[float]:
    """Where the global order is cut, so that each fragment gets about the same number of entries: quantiles of (df, number)."""
    each = alive.select(F.explode("grams").alias("g"))
    shares = [i / fragments for i in range(1, fragments)]
    found = each.agg(F.percentile_approx(_place(F.col("g")), shares, 1000)).first()[0] if shares else None
    return sorted(set(found or []))


def _candidates(prefixes: DataFrame, hot: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b, need) that share a prefix n-gram which isn't hot and can still share ``need`` n-grams together."""
    side = prefixes.filter(~F.col("hot")).select("gram", "key", "n", "last", "behind")
    a, b = (side.toDF(*[f"{p}{c}" for c in ("gram", "key", "n", "last", "behind")]) for p in "ab")
    near = (F.col("an") * 100 >= F.col("bn") * percent) & (F.col("bn") * 100 >= F.col("an") * percent)
    met = a.join(b, (F.col("agram") == F.col("bgram")) & (F.col("akey") < F.col("bkey")) & near)
    pairs = met.groupBy("akey", "bkey").agg(
        F.count(F.lit(1)).alias("met"), *[F.any_value(c).alias(c) for x in "ab" for c in (f"{x}n", f"{x}last", f"{x}behind")]
    )
    for x in "ab":
        pairs = pairs.join(hot.select(F.col("key").alias(f"{x}key"), F.col("n_hot").alias(f"{x}n_hot")), f"{x}key", "left")
    # All that the two share up to the sooner end of their prefixes is met, but for hot n-grams.
    behind = F.when(F.col("alast") < F.col("blast"), F.col("abehind")).when(F.col("alast") > F.col("blast"), F.col("bbehind"))
    behind = F.coalesce(behind, F.least("abehind", "bbehind"))
    need = _pair_overlap(F.col("an"), F.col("bn"), percent)
    pairs = pairs.withColumn("need", need).filter(F.col("met") + F.least(F.coalesce("an_hot", F.lit(0)), F.coalesce("bn_hot", F.lit(0))) + behind >= F.col("need"))
    return pairs.select(F.col("akey").alias("a"), F.col("bkey").alias("b"), "need")


def _counted_links(pairs: DataFrame, segments: DataFrame, fragments: int) -> DataFrame:
    """Pairs whose partial overlaps, counted in each fragment apart and summed by pair, reach ``need``."""
    left = segments.select(F.col("key").alias("a"), "fragment", F.col("segment").alias("left"))
    right = segments.select(F.col("key").alias("b"), "fragment", F.col("segment").alias("right"))
    each = pairs.withColumn("fragment", F.explode(F.sequence(F.lit(0), F.lit(fragments - 1))))  # meets the segments where they are
    partial = each.join(left, ["a", "fragment"]).join(right, ["b", "fragment"])
    partial = partial.select("a", "b", "need", F.size(F.array_intersect("left", "right")).alias("n"))
    whole = partial.groupBy("a", "b").agg(F.sum("n").alias("n"), F.any_value("need").alias("need"))
    return whole.filter(F.col("n") >= F.col("need")).select("a", "b")


class Side:
    """Rows of one side of a cell: sets cut into fragments, and the n-grams whose meeting makes a pair another's."""

    def __init__(self, keys, n, copies, grams: list[np.ndarray], at: list[np.ndarray], others: list[np.ndarray]):
        self.keys, self.n, self.copies = (np.array(c, dtype=np.int64) for c in (keys, n, copies))
        self.held = np.array([len(g) for g in grams], dtype=np.int64)
        self.grams, self.fragment, self.other = (np.concatenate([np.zeros(0, np.int64), *c]) for c in (grams, at, others))
        self.row = np.repeat(np.arange(len(n)), self.held)
        self.other_row = np.repeat(np.arange(len(n)), [len(o) for o in others])


def _arrays(column: pa.Array) -> list[np.ndarray]:
    """A numpy array, of its own, for each row of a column of arrays of whole numbers."""
    ends = np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))
    return np.split(column.flatten().to_numpy(zero_copy_only=False).astype(np.int64), ends[:-1])


def _meetings(a: np.ndarray, a_row: np.ndarray, b: np.ndarray, b_row: np.ndarray, shape: tuple[int, int]) -> np.ndarray:
    """How many n-grams each row of one side shares with each of the other: products of 0-1 matrices for a few columns at a time."""
    total = np.zeros(shape, dtype=np.float32)
    both = np.intersect1d(a, b)
    if not len(both):
        return total
    a_at, b_at = np.searchsorted(both, a), np.searchsorted(both, b)
    a_in = both[np.minimum(a_at, len(both) - 1)] == a
    b_in = both[np.minimum(b_at, len(both) - 1)] == b
    a_at, a_row, b_at, b_row = a_at[a_in], a_row[a_in], b_at[b_in], b_row[b_in]
    a_n, b_n = np.bincount(a_at, minlength=len(both)), np.bincount(b_at, minlength=len(both))
    few = a_n * b_n <= 2048  # listed as pairs; the others are columns of the matrices
    order = np.argsort(b_at, kind="stable")
    starts = np.concatenate([[0], np.cumsum(b_n)[:-1]])
    sparse = np.flatnonzero(few[a_at])
    step = 1 << 16
    for i in range(0, len(sparse), step):
        x = sparse[i : i + step]
        times = b_n[a_at[x]]
        within = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        y = order[np.repeat(starts[a_at[x]], times) + within]
        total += np.bincount(np.repeat(a_row[x], times) * shape[1] + b_row[y], minlength=shape[0] * shape[1]).reshape(shape)
    dense = np.flatnonzero(~few)
    for i in range(0, len(dense), 1024):
        some = dense[i : i + 1024]
        left, right = np.zeros((shape[0], len(some)), np.float32), np.zeros((len(some), shape[1]), np.float32)
        x, y = (a_at >= some[0]) & (a_at <= some[-1]) & ~few[a_at], (b_at >= some[0]) & (b_at <= some[-1]) & ~few[b_at]
        left[a_row[x], np.searchsorted(some, a_at[x])] = 1
        right[np.searchsorted(some, b_at[y]), b_row[y]] = 1
        total += left @ right
    return total


def cell_links(left: Side, right: Side, same: bool, percent: int) -> np.ndarray:
    """Which rows link, as a matrix: partial overlaps fragment by fragment, until no pair can reach its least overlap."""
    shape = (len(left.n), len(right.n))
    open_ = _meetings(left.other, left.other_row, right.other, right.other_row, shape) == 0
    if same:
        open_ &= np.arange(shape[0])[:, None] < np.arange(shape[1])
    sizes = left.n[:, None] + right.n
    need = -(-sizes * percent // (100 + percent))
    open_ &= np.minimum(left.n[:, None], right.n) >= need
    total = np.zeros(shape, dtype=np.int64)
    ahead = [left.held.copy(), right.held.copy()]
    for f in np.union1d(left.fragment, right.fragment).tolist():
        if not open_.any():
            break
        x, y = left.fragment == f, right.fragment == f
        total += _meetings(left.grams[x], left.row[x], right.grams[y], right.row[y], shape).astype(np.int64)
        for side, rows, mine in ((0, left.row, x), (1, right.row, y)):
            ahead[side] -= np.bincount(rows[mine], minlength=shape[side])
        open_ &= total + np.minimum(ahead[0][:, None], ahead[1]) >= need
    return open_ & (total >= need)


def spanning(links: np.ndarray, same: bool) -> list[tuple[int, int]]:
    """Links (row, row of the other side) that connect all that a matrix of links connects."""
    n, m = links.shape
    if same:
        near, shift = links | links.T, 0
    else:
        near, shift = np.zeros((n + m, n + m), dtype=bool), n
        near[:n, n:], near[n:, :n] = links, links.T
    new, found = np.ones(len(near), dtype=bool), []
    for start in range(len(near)):
        if not new[start]:
            continue
        new[start], waiting = False, [start]
        while waiting:
            i = waiting.pop()
            for j in np.flatnonzero(near[i] & new).tolist():
                new[j] = False
                waiting.append(j)
                found.append((min(i, j), max(i, j) - shift))
    return found


def _hot_links(alive: DataFrame, prefixes: DataFrame, percent: int, block: int) -> DataFrame:
    """Links of pairs whose first common prefix n-gram is hot: rows (a, b) of a spanning forest, and (a, n) of a cell's links."""
    own = F.sort_array(F.collect_list(F.struct("df", "gram", "members", "hot")))
    grouped = prefixes.groupBy("key").agg(own.alias("_p"))
    cold = F.transform(F.filter("_p", lambda x: ~x["hot"]), lambda x: x["gram"])
    hot = F.filter("_p", lambda x: x["hot"])
    spread = grouped.select("key", cold.alias("_cold"), hot.alias("_hot")).filter(F.size("_hot") > 0)
    spread = spread.select("key", "_cold", "_hot", F.posexplode("_hot").alias("_i", "_g"))
    earlier = F.transform(F.slice("_hot", F.lit(1), F.col("_i")), lambda x: x["gram"])
    blocks = F.ceil(F.col("_g.members") / block).cast("int")
    spread = spread.select(
        "key", F.col("_g.gram").alias("gram"), F.concat("_cold", earlier).alias("others"), blocks.alias("_blocks"),
        F.pmod(F.xxhash64("key"), blocks).cast("int").alias("_own"),
    )
    spread = spread.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    cells = spread.select(
        "key", "others", "gram", F.least("_own", "_other").alias("i"), F.greatest("_own", "_other").alias("j"), (F.col("_own") > F.col("_other")).alias("right")
    )
    sets = alive.select("key", "n", "copies", F.transform("grams", lambda x: x["gram"]).alias("grams"), "at")

    def work(cell: tuple, rows: list[tuple]) -> pa.RecordBatch:
        same = cell[1] == cell[2]
        sides = [[r[1:] for r in rows if r[0] == side] for side in (False, True)]
        if not sides[0] or not (same or sides[1]):
            return pa.RecordBatch.from_arrays([pa.array([], pa.int64())] * 3, names=["a", "b", "n"])
        left = Side(*zip(*sides[0], strict=True))
        right = left if same else Side(*zip(*sides[1], strict=True))
        links = cell_links(left, right, same, percent)
        tree = spanning(links, same)
        out = [(int(left.keys[x]), int(right.keys[y]), None) for x, y in tree]
        counts = [(left.keys, links @ right.copies), (right.keys, left.copies @ links)]
        for keys, n in counts:
            out += [(int(k), None, int(c)) for k, c in zip(keys, n, strict=True) if c]
        return pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], pa.int64()) for c in range(3)], names=["a", "b", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows = None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            places = zip(*[batch.column(c).to_pylist() for c in order], strict=True)
            plain = [batch.column(c).to_pylist() for c in ("right", "key", "n", "copies")]
            for cell, *row in zip(places, *plain, *[_arrays(batch.column(c)) for c in ("grams", "at", "others")], strict=True):
                if cell != now:
                    if rows:
                        yield work(now, rows)
                    now, rows = cell, []
                rows.append(tuple(row))
        if rows:
            yield work(now, rows)

    order = ["gram", "i", "j"]
    dealt = cells.join(sets, "key").repartition(*order).sortWithinPartitions(*order)
    return dealt.mapInArrow(run, "a long, b long, n long")


def join(
    docs: DataFrame, size: int = 5, percent: int = 80, fragments: int = 8, group: int = 256,
    block: int = BLOCK, bucket_grams: int = 1 << 21, least_frequent: int = LEAST_FREQUENT,
) -> DataFrame:
    """One row a document (``doc_id``, ``text``): doc_id, n_shingles, n_links (documents it links with) and component_id.

    ``component_id`` is the smallest doc_id that links reach, the document's own included;
    null doc_ids count only where there is no other. A null or wordless text has an empty
    set, no links and its own doc_id as component. Repeated rows, and different texts with equal sets,
    link with each other. An empty table gives no rows. Other columns are ignored.

    Sets are compared by 64-bit hashes of their n-grams; of n-grams that few documents share 48
    bits and a bucket's number are used. That two n-grams of a pair agree by chance is less
    likely than one in 10^9 pairs of a thousand words.
    """
    sized = stored(_sized(docs, size), "sized")
    classes = stored(
        sized.groupBy("key").agg(F.any_value("n").alias("n"), F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("_first")), "classes"
    )
    n_classes, n_grams = classes.filter("n > 0").agg(F.count(F.lit(1)), F.coalesce(F.sum(F.col("n") * F.col("copies")), F.lit(0))).first()
    frequent = _frequent(sized, max(least_frequent, n_classes // PER_DOCUMENTS))
    n_first = n_grams * (100 - percent) // 100 + n_grams * percent // (100 * SHARE) + n_classes
    left = classes.filter("n > 0").select("key", "n", "copies")
    left = stored(_partnered(docs, left, size, percent, max(48, n_first // bucket_grams), frequent), "partnered")
    n_left, n_grams = left.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.col("n") * F.col("copies")), F.lit(0))).first()
    shared = _shared(docs, size, max(48, n_grams // bucket_grams), frequent, _let_through(_bitmap(left, n_left)))
    alive = stored(_alive(shared, left, percent), "alive")
    cuts = _cuts(alive, fragments)
    placed = alive.withColumn("at", F.transform("grams", lambda x: _fragment(cuts, x)))

    entry = alive.select(
        "key", "n", F.explode(F.slice("grams", F.lit(1), F.col("prefix").cast("int"))).alias("_g"),
        F.element_at("grams", F.least(F.col("prefix").cast("int"), F.size("grams"))).alias("last"),
        (least_overlap(F.col("n"), percent) - 1).alias("behind"),
    ).select("key", "n", "last", "behind", "_g.df", "_g.gram")
    members = entry.groupBy("gram").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    met = entry.join(members, "gram").withColumn("hot", F.col("members") > group)
    prefixes = stored(met, "prefixes")
    hot = prefixes.filter("hot").groupBy("key").agg(F.count(F.lit(1)).alias("n_hot"))

    segments = placed.select("key", F.explode(F.arrays_zip(F.transform("grams", lambda x: x["gram"]).alias("gram"), "at")).alias("_s"))
    segments = segments.groupBy("key", F.col("_s.at").alias("fragment")).agg(F.collect_list("_s.gram").alias("segment"))
    cold = stored(_counted_links(_candidates(prefixes, hot, percent), segments, len(cuts) + 1), "links")
    found = cold.select("a", "b", F.lit(None).cast("long").alias("n"))
    if not prefixes.filter("hot").isEmpty():
        found = found.union(stored(_hot_links(placed, prefixes, percent, block), "hot_links"))
    pairs = found.filter("b is not null").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    roots = components(stored(pairs, "pairs")).select(F.col("fp").alias("key"), "root")

    sides = cold.select(F.col("a").alias("key"), F.col("b").alias("other")).union(cold.select("b", "a"))
    links = sides.join(classes.select(F.col("key").alias("other"), "copies"), "other").select("key", F.col("copies").alias("n"))
    links = links.union(found.filter("b is null").select("a", "n")).groupBy("key").agg(F.sum("n").alias("_links"))
    rooted = classes.join(roots, "key", "left").withColumn("_root", F.coalesce("root", "key")).drop("root")
    least = rooted.groupBy("_root").agg(F.min("_first").alias("_least"))
    known = rooted.join(least, "_root").join(links, "key", "left")
    known = known.select("key", (F.coalesce("_links", F.lit(0)) + F.col("copies") - 1).alias("_links"), "_least")
    rows = sized.select("doc_id", "key", F.col("n").alias("n_shingles")).join(known, "key")
    empty = F.col("n_shingles") == 0
    return rows.select(
        "doc_id", "n_shingles", F.when(empty, F.lit(0)).otherwise(F.col("_links")).cast("long").alias("n_links"),
        F.when(empty, F.col("doc_id")).otherwise(F.col("_least")).alias("component_id"),
    )
