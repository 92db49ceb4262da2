"""Near duplicates by SimHash: pigeonhole blocks, Hamming distance, connected components.

A text's fingerprint holds, for each of 64 bits, whether more than half of its
word shingles' XXH64 hashes have the bit. Two fingerprints link at ``most``
differing bits or fewer. Cut into ``most`` + 1 blocks, such a pair agrees on a
whole block, so only fingerprints that share a block are compared.

Skew: equal fingerprints are one row from the start. A block value that holds
more than ``group`` fingerprints is refined: its fingerprints are joined on that
block and one of ``most`` + 1 blocks of the remaining bits, where a linked pair
agrees again; so on, until groups are small. No link is lost and no group is cut.
Within a group, only a spanning forest of its links is passed on, never all its
pairs.

Components: in each round every fingerprint points to the one of lowest random
rank among itself and its neighbours, links are redrawn between what is pointed
to, and loops go; a constant share of the fingerprints disappears each round.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiffin.llm.common import WHITE_BYTES, map_texts, matched, stored, with_row_keys

SEED = 42
BITS = 64


def word_runs(raw: bytes, at_once: int = 1 << 22) -> Iterator[list[bytes]]:
    """Words of ``raw`` in lists from about ``at_once`` bytes each."""
    a = 0
    while a < len(raw):
        b = min(len(raw), a + at_once)
        while b < len(raw) and raw[b] not in WHITE_BYTES:
            b += 1
        if words := raw[a:b].split():
            yield words
        a = b


def fingerprint(text: str | None, size: int = 3) -> int:
    """Fingerprint of a text's ``size``-word shingles; 0 without a word. Lower-cases A-Z only."""
    ones, total, carry = np.zeros(BITS, dtype=np.int64), 0, []
    digest = xxhash.xxh64_intdigest
    for words in word_runs((text or "").encode().lower()):
        words = carry + words
        if len(words) >= size:
            line = b" ".join(words)
            ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
            starts = np.concatenate([[0], ends[:-1] + 1])
            spans = zip(starts[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist(), strict=True)
            hashes = np.fromiter((digest(line[a:b], SEED) for a, b in spans), dtype="<u8")
            ones += _bit_counts(hashes)
            total += len(hashes)
        carry = words[max(0, len(words) - size + 1) :]
    if not total and carry:
        ones, total = _bit_counts(np.array([digest(b" ".join(carry), SEED)], dtype="<u8")), 1
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


def _bit_counts(hashes: np.ndarray, at_once: int = 1 << 15) -> np.ndarray:
    ones = np.zeros(BITS, dtype=np.int64)
    for i in range(0, len(hashes), at_once):
        part = hashes[i : i + at_once]
        ones += np.unpackbits(part.view(np.uint8).reshape(len(part), 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return ones


def fingerprints(docs: DataFrame, keep: list[str], text_col: str = "text", size: int = 3) -> DataFrame:
    """``keep`` columns and ``fp``, the fingerprint as a signed long."""

    def make():
        return lambda texts: {"fp": np.array([fingerprint(t, size) for t in texts], dtype=np.uint64).view(np.int64)}

    return map_texts(docs, keep, text_col, "fp long", make)


def _piece(bits: Column, start: int, width: int) -> Column:
    return F.shiftrightunsigned(bits, start).bitwiseAND(F.lit((1 << width) - 1))


def _parts(total: int, n: int) -> list[tuple[int, int]]:
    """``total`` bits cut into ``n`` runs (start, width) of nearly the same width, without empty ones."""
    edges = [total * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False) if b > a]


def _refined(rows: DataFrame, left: int, most: int) -> DataFrame:
    """Each row once for every block of its ``rest``, the ``left`` bits not yet agreed on, with a finer key.

    Keys are hashes of what a group agrees on; two groups that meet in a key only
    add comparisons, as every distance is computed.
    """
    made = []
    for i, (start, width) in enumerate(_parts(left, most + 1)):
        low = F.col("rest").bitwiseAND(F.lit((1 << start) - 1))
        over = start + width
        high = F.shiftleft(F.shiftrightunsigned("rest", over), start) if over < BITS else F.lit(0).cast("long")
        made.append(
            F.struct(
                F.xxhash64("key", F.lit(i), _piece(F.col("rest"), start, width)).alias("key"),
                low.bitwiseOR(high).cast("long").alias("rest"),
            )
        )
    return rows.select("fp", F.explode(F.array(*made)).alias("_m")).select("fp", "_m.*")


def forest(keys: np.ndarray, fps: np.ndarray, most: int) -> np.ndarray:
    """Pairs of row numbers that connect rows of one key (which stand together) as all their links do.

    Row i is compared with row i + 1, i + 2 and so on as long as the key lasts, for
    all keys at once; a link within what is already connected is passed over.
    """
    change = np.flatnonzero(np.diff(keys)) + 1
    end = np.repeat(np.append(change, len(keys)), np.diff(np.concatenate([[0], change, [len(keys)]])))
    root, found, step, rows = np.arange(len(keys)), [], 1, np.arange(len(keys))

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = int(root[i])
        return i

    while len(rows := rows[rows + step < end[rows]]):
        near = rows[np.bitwise_count(fps[rows] ^ fps[rows + step]) <= most]
        for i in near[root[near] != root[near + step]].tolist():
            a, b = top(i), top(i + step)
            if a != b:
                root[max(a, b)] = min(a, b)
                found.append((i, i + step))
        while (root != root[root]).any():
            root = root[root]
        step += 1
    return np.array(found, dtype=np.int64).reshape(-1, 2)


def _linked(rows: DataFrame, most: int) -> DataFrame:
    """Links (a, b) within the groups of ``rows`` (key, fp); groups are whole in one task and small."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def linked(keys: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
            pairs = forest(keys, fps.view(np.uint64), most)
            return pa.RecordBatch.from_arrays([pa.array(fps[pairs[:, 0]]), pa.array(fps[pairs[:, 1]])], names=["a", "b"])

        keys = fps = np.zeros(0, dtype=np.int64)
        for batch in batches:
            keys = np.concatenate([keys, batch.column("key").to_numpy()])
            fps = np.concatenate([fps, batch.column("fp").to_numpy()])
            if len(keys):
                whole = int(np.argmax(keys == keys[-1]))  # the last key may go on in the next batch
                if whole:
                    yield linked(keys[:whole], fps[:whole])
                    keys, fps = keys[whole:], fps[whole:]
        if len(keys):
            yield linked(keys, fps)

    dealt = rows.select("key", "fp").repartition("key").sortWithinPartitions("key")
    return dealt.mapInArrow(run, "a long, b long")


def links(distinct: DataFrame, most: int = 3, group: int = 2048) -> DataFrame:
    """Links (a, b) that connect the stored distinct ``fp`` as all links at ``most`` bits or fewer do."""
    left, found = BITS, []
    rows = distinct.select("fp", F.lit(0).cast("long").alias("key"), F.col("fp").alias("rest"))
    while True:
        rows = stored(_refined(rows, left, most), "blocks")
        left -= left // (most + 1)
        sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("_n"))
        large = stored(sizes.filter(F.col("_n") > group).select("key"), "large_blocks")
        if left <= most or large.isEmpty():
            found.append(_linked(rows, most))
            break
        found.append(_linked(rows.join(large, "key", "left_anti"), most))
        rows = rows.join(large, "key", "left_semi")
    pairs = [part.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")) for part in found]
    return stored(reduce(DataFrame.union, pairs).distinct(), "links")


def _ranked(c: str, turn: int) -> Column:
    return F.struct(F.xxhash64(F.lit(turn), F.col(c)).alias("rank"), F.col(c).alias("fp"))


def components(pairs: DataFrame) -> DataFrame:
    """(fp, root) for every ``fp`` in the stored links (a, b): one root a component."""
    edges, turn = pairs, 0
    both = pairs.select(F.col("a").alias("fp")).union(pairs.select("b")).distinct()
    reached = both.withColumn("root", F.col("fp"))
    while not edges.isEmpty():
        sides = edges.union(edges.select("b", "a")).toDF("fp", "near")
        least = sides.groupBy("fp").agg(F.min(_ranked("near", turn)).alias("_least"))
        point = stored(least.select("fp", F.least("_least", _ranked("fp", turn)).getField("fp").alias("to")), "pointers")
        ends = [point.select(F.col("fp").alias(c), F.col("to").alias(f"_{c}")) for c in ("a", "b")]
        moved = edges.join(ends[0], "a").join(ends[1], "b").filter("_a != _b")
        edges = stored(moved.select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b")).distinct(), "edges")
        reached = reached.join(point.withColumnRenamed("fp", "root"), "root", "left")
        reached = stored(reached.select("fp", F.coalesce("to", "root").alias("root")), "roots")
        turn += 1
    return reached


def groups(marked: DataFrame, most: int = 3, key: str = "doc_id") -> DataFrame:
    """(fp, component_id) of stored rows (``key``, ``fp``), one row a fingerprint.

    ``component_id`` is the smallest key among the fingerprints that links reach,
    null only where all of those keys are null.
    """
    distinct = stored(marked.groupBy("fp").agg(F.min(key).alias("_first")), "fingerprints")
    roots = components(links(distinct, most)).withColumnRenamed("root", "_root")
    rooted = distinct.join(roots, "fp", "left").withColumn("_root", F.coalesce("_root", "fp"))
    least = rooted.groupBy("_root").agg(F.min("_first").alias("component_id"))
    return rooted.join(least, "_root").select("fp", "component_id", F.col("_root").alias("root"))


def near_duplicates(docs: DataFrame, keep: list[str], size: int = 3, most: int = 3) -> DataFrame:
    """One row a document (``doc_id``, ``text``): ``keep`` columns, doc_id, fp, component_id and root.

    A null or wordless text has fingerprint 0 and links like any other. Repeated rows
    share a fingerprint and so a component; a null doc_id takes part, but is no
    component's smallest unless there is no other. An empty table gives no rows.
    Other columns are ignored unless kept.
    """
    marked = stored(fingerprints(docs, ["doc_id", *[c for c in keep if c != "doc_id"]], size=size), "marked")
    return marked.join(groups(marked, most), "fp")


def one_of_each(docs: DataFrame, size: int = 3, most: int = 3) -> DataFrame:
    """``docs`` with one row for each component: its smallest doc_id, ties by the rows' hashes."""
    keyed = with_row_keys(docs, ["doc_id", "text"])
    found = stored(near_duplicates(keyed, ["_k0", "_k1"], size, most), "components")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "_k0", "_k1")
    first = found.groupBy("root").agg(F.min(order).alias("_o")).select("root", "_o._k0", "_o._k1")
    rows = found.groupBy("root", "_k0", "_k1").agg(F.count(F.lit(1)).alias("rows"))
    chosen = stored(rows.join(first, ["root", "_k0", "_k1"]).drop("root"), "chosen")
    return matched(keyed, chosen).select("_row.*")
