"""Packing along a space-filling curve: neighbouring documents share sequences.

Each document's token ids are counted in hashed buckets; the normalised vector is
projected to a few dimensions with a fixed random matrix, and its cell's Hilbert
key orders the documents. Documents stand one after another in the order of
(key, document), and the line of ids is cut every ``length`` ids, so a sequence
holds documents that lie near each other and nothing is padded but its last part,
which is cut into lengths that are powers of two.

Plan: one pass tokenises and stores the ids (compressed); the narrow rows (key,
ids) are range-sorted, summed within each slice, and shifted by the sums of the
slices before (one row a slice); the starts are joined back to the ids by a unique
row number, and each document is cut by itself. The ids are shuffled once, and no
task holds more than some documents at a time.
"""

from __future__ import annotations

import bisect
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tiffin.llm.common import map_texts, row_number_column, sorted_slices, stored
from tiffin.llm.tokens import shared_encoder, tokenizer_path

BUCKETS = 256
DIMS = 4
BITS = 10


def hashed_projection(ids: list[np.ndarray], dims: int = DIMS, buckets: int = BUCKETS) -> np.ndarray:
    """One row of ``dims`` numbers in [0, 1) for each document's ids; an empty document is in the middle."""
    spread = np.random.default_rng(20_240_601).standard_normal((buckets, dims))
    if not ids:
        return np.zeros((0, dims))
    line = np.concatenate(ids).astype(np.uint32)
    hashed = (line * np.uint32(2_654_435_761)) >> np.uint32(33 - buckets.bit_length())
    row = np.repeat(np.arange(len(ids)) * buckets, [len(x) for x in ids])
    counts = np.log1p(np.bincount(row + hashed, minlength=len(ids) * buckets).reshape(-1, buckets))
    norms = np.maximum(np.sqrt((counts * counts).sum(axis=1)), 1e-9)
    places = (counts @ spread) / norms[:, None]
    # A smooth map of the line to (0, 1) that spreads normal numbers nearly evenly.
    return np.clip(0.5 + 0.5 * np.tanh(places * math.sqrt(2 / math.pi)), 0.0, 1 - 1e-9)


def hilbert_keys(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place of each point of [0, 1)^d on the Hilbert curve of 2^bits cells a side, for all points at once.

    The known transform between axes and the transposed index: undo the excess
    rotations from the top bit down, Gray-encode, and interleave the bits.
    """
    x = np.minimum((points * (1 << bits)).astype(np.int64), (1 << bits) - 1).T.copy()
    d = len(x)
    for bit in range(bits - 1, 0, -1):
        q, low = 1 << bit, (1 << bit) - 1
        for i in range(d):
            swap = np.where(x[i] & q, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(x[i] & q, low, swap)
            x[i] ^= swap if i else 0
    for i in range(1, d):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for bit in range(bits - 1, 0, -1):
        turn ^= np.where(x[d - 1] & (1 << bit), (1 << bit) - 1, 0)
    x ^= turn
    key = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(d):
            key = (key << 1) | ((x[i] >> bit) & 1)
    return key


def tail_bounds(total: int, length: int) -> list[int]:
    """Where the sequences after the last full one start and end: the rest's binary parts, largest first."""
    at, rest = total - total % length, total % length
    bounds = [at]
    for bit in reversed(range(rest.bit_length())):
        if rest >> bit & 1:
            at += 1 << bit
            bounds.append(at)
    return bounds


def _tokenised(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    def make():
        encoder, press = shared_encoder(tokenizer), zstandard.ZstdCompressor(level=1)
        end = np.array([end_id], dtype=encoder.dtype)

        def work(texts: list) -> dict:
            ids = encoder.encode(texts)
            keys = hilbert_keys(hashed_projection(ids))
            full = [np.concatenate([x, end]) for x in ids]
            return {
                "curve": keys,
                "n": np.array([len(x) for x in full], dtype=np.int64),
                "width": np.full(len(full), encoder.dtype.itemsize, dtype=np.int32),
                "ids": pa.array([press.compress(x.tobytes()) for x in full], pa.binary()),
            }

        return work

    return map_texts(docs, ["doc_id"], "text", "curve long, n long, width int, ids binary", make)


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds each row's sum of ``n`` over the rows before it in its sorted partition."""
    before = 0
    for batch in batches:
        n = batch.column("n").to_numpy()
        ends = before + np.cumsum(n)
        yield pa.RecordBatch.from_arrays(
            [batch.column("rid"), batch.column("slice"), batch.column("n"), pa.array(ends - n)],
            names=["rid", "slice", "n", "before"],
        )
        before = int(ends[-1]) if len(ends) else before


def curve_starts(tokens: DataFrame) -> DataFrame:
    """(rid, at): the place of each row's first id on the line of all ids, in the order of the curve."""
    narrow = tokens.select("curve", "doc_id", "rid", "n")
    keys = ["curve", "doc_id", "rid"]
    ranged = narrow.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("slice", F.spark_partition_id())
    lines = stored(
        ranged.select("rid", "slice", "n").mapInArrow(_summed, "rid long, slice int, n long, before long"), "lines"
    )
    slices = lines.groupBy("slice").agg(F.sum("n").alias("_n"))
    earlier = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.select("slice", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_base"))
    return lines.join(slices, "slice").select("rid", (F.col("_base") + F.col("before")).alias("at"))


def pack(docs: DataFrame, length: int = 1024, tokenizer: str | None = None, end_id: int = 0) -> DataFrame:
    """Pack whole documents (``doc_id``, ``text``) into sequences of at most ``length`` ids.

    One row a piece: doc_id, start (ids of its document before it), length, ids
    (little-endian unsigned 32-bit), doc_tokens (with the closing id), sequence_id,
    offset in the sequence, curve (the document's Hilbert key). Every id is in
    one piece; sequences are gapless; only the last ones are shorter than
    ``length``, and those are powers of two.

    A null text is empty: its document is its closing id alone. Repeated doc_ids are
    separate documents, a null doc_id comes first among equal keys, an empty table
    gives no rows, other columns are ignored.
    """
    path = tokenizer or tokenizer_path()
    tokens = stored(_tokenised(docs, path, end_id).withColumn("rid", row_number_column()), "tokens")
    total = tokens.agg(F.sum("n")).first()[0] or 0
    tail = tail_bounds(total, length)
    full = total // length
    made = "start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, curve long"
    schema = f"doc_id {tokens.schema['doc_id'].dataType.simpleString()}, {made}"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plain = zstandard.ZstdDecompressor()
        for batch in batches:
            rows, columns = [], [[] for _ in range(6)]
            for i, (at, n, width, raw) in enumerate(
                zip(*[batch.column(c).to_pylist() for c in ("at", "n", "width", "ids")], strict=True)
            ):
                ids = np.frombuffer(plain.decompress(raw), dtype=f"<u{width}").astype("<u4").tobytes()
                a = at
                while a < at + n:
                    sequence = a // length if a < tail[0] else full + bisect.bisect_right(tail, a) - 1
                    first, last = (sequence * length, (sequence + 1) * length) if a < tail[0] else tail[sequence - full :][:2]
                    b = min(at + n, last)
                    rows.append(i)
                    piece = a - at, b - a, ids[4 * (a - at) : 4 * (b - at)], n, sequence, a - first
                    for column, x in zip(columns, piece, strict=True):
                        column.append(x)
                    a = b
            kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            taken = batch.select(["doc_id", "curve"]).take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [taken.column(0), *[pa.array(x, k) for x, k in zip(columns, kinds, strict=True)], taken.column(1)],
                names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "curve"],
            )

    return tokens.join(curve_starts(tokens), "rid").mapInArrow(cut, schema)


def with_crc(pieces: DataFrame) -> DataFrame:
    """Replaces ``ids`` by ``ids_crc32``, unsigned."""
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def sequences(pieces: DataFrame) -> DataFrame:
    """The packed sequences: sequence_id, ids, doc_ids; a group holds one sequence at most."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids", "doc_id")))
    return (
        pieces.groupBy("sequence_id")
        .agg(parts.alias("_parts"))
        .select(
            "sequence_id",
            F.aggregate("_parts", F.lit(b""), lambda got, p: F.concat(got, p["ids"])).alias("ids"),
            F.col("_parts.doc_id").alias("doc_ids"),
        )
    )
