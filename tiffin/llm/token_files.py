"""Token ids of whole documents in binary shards, with constant-time access by document key.

Documents are range-sorted by key, tokenised in that order, and written shard by
shard: raw ids first, then the index, then a fixed trailer. All numbers are
little-endian.

    payload     ids of all documents one after another, ``width`` bytes each
    starts      int64 [documents + 1]: a document's first id within the shard
    keys        int64 [documents]: the keys in the order of the payload, null keys first (as 0)
    mph sizes   uint64 [levels], mph words uint64 [sum of sizes / 64]
    slots       by the key's number: uint32 fingerprint, then int64 first document with that key
    trailer     8 bytes of name, then int64: width, documents, null keys, distinct keys, levels, ids

A shard is written under a temporary name and renamed when complete; a task that
is run again writes the same bytes. The manifest (a row a shard) is stored once.
Folders are opened with pyarrow's file systems, so local, HDFS and object-store
folders work alike.
"""

from __future__ import annotations

import bisect
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tiffin.llm.common import row_number_column, scratch_path, stored, text_slices
from tiffin.llm.perfect_hash import PerfectHash, fingerprints
from tiffin.llm.tokens import shared_encoder, tokenizer_path

NAME = b"TIFFIDS1"
TRAILER = 8 + 6 * 8


def _opened(folder: str) -> tuple[fs.FileSystem, str]:
    if "://" in folder or folder.startswith("file:"):
        return fs.FileSystem.from_uri(folder.replace("file:///", "file:/").replace("file:/", "file:///"))
    return fs.LocalFileSystem(), folder


class _Writer:
    """One shard in the making: ids go to the file as they come, the index is kept (24 bytes a document)."""

    def __init__(self, folder: str, name: str, dtype: np.dtype):
        self.files, root = _opened(folder)
        self.files.create_dir(root, recursive=True)
        self.path, self.partial = f"{root}/{name}", f"{root}/_partial-{uuid.uuid4().hex}"
        self.out, self.dtype = self.files.open_output_stream(self.partial), dtype
        self.sizes: list[int] = []
        self.keys: list = []

    def add(self, key: int | None, ids: np.ndarray) -> None:
        self.out.write(ids.tobytes())
        self.sizes.append(len(ids))
        self.keys.append(key)

    def close(self) -> dict:
        nulls = sum(k is None for k in self.keys)
        keys = np.array([0 if k is None else k for k in self.keys], dtype="<i8")
        distinct, first = np.unique(keys[nulls:], return_index=True)
        index = PerfectHash.build(distinct.view("<u8"))
        number = index.number(distinct.view("<u8"))
        marks, firsts = np.zeros(len(distinct), "<u4"), np.zeros(len(distinct), "<i8")
        marks[number], firsts[number] = fingerprints(distinct.view("<u8")), first + nulls
        starts = np.concatenate([[0], np.cumsum(self.sizes)]).astype("<i8")
        trailer = np.array([self.dtype.itemsize, len(keys), nulls, len(distinct), len(index.sizes), starts[-1]], dtype="<i8")
        for part in (starts, keys, index.sizes.astype("<u8"), index.words, marks, firsts):
            self.out.write(part.tobytes())
        self.out.write(NAME + trailer.tobytes())
        self.out.close()
        self.files.move(self.partial, self.path)
        known = self.keys[nulls:]  # null keys stand first
        return {"documents": len(keys), "ids": int(starts[-1]), "first_key": known[0] if known else None, "last_key": known[-1] if known else None}


class Shard:
    """A shard read back: its index in memory, its ids on request."""

    def __init__(self, folder: str, name: str):
        files, root = _opened(folder)
        self.file = files.open_input_file(f"{root}/{name}")
        size = self.file.size()
        raw = self.file.read_at(TRAILER, size - TRAILER)
        if raw[:8] != NAME:
            raise ValueError(f"{name} is not a shard of token ids")
        width, self.documents, self.nulls, distinct, levels, ids = np.frombuffer(raw[8:], "<i8").tolist()
        self.dtype = np.dtype(f"<u{width}")
        index = self.file.read_at(size - TRAILER - ids * width, ids * width)
        at = 0

        def part(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(index, kind, n, at)
            at += out.nbytes
            return out

        self.starts, self.keys = part("<i8", self.documents + 1), part("<i8", self.documents)
        sizes = part("<u8", levels)
        self.hash = PerfectHash(sizes, part("<u8", int(sizes.sum()) // 64))
        self.marks, self.firsts = part("<u4", distinct), part("<i8", distinct)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The first document of each key, -1 where the fingerprint differs."""
        number = self.hash.number(keys.view("<u8"))
        known = number >= 0
        known[known] = self.marks[number[known]] == fingerprints(keys[known].view("<u8"))
        return np.where(known, self.firsts[np.where(known, number, 0)] if len(self.firsts) else -1, -1)

    def ids(self, first: int, last: int) -> np.ndarray:
        """Ids of the documents ``first`` to ``last`` - 1."""
        a, b = int(self.starts[first]), int(self.starts[last])
        return np.frombuffer(self.file.read_at((b - a) * self.dtype.itemsize, a * self.dtype.itemsize), self.dtype)


def write_shards(
    docs: DataFrame, folder: str, tokenizer: str | None = None, end_id: int = 2, shard_ids: int = 1 << 25
) -> DataFrame:
    """Write ids of whole documents (``doc_id``, ``text``) in ascending doc_id order; the stored manifest.

    A row a shard: slice, part (together the order of the shards), name, documents,
    ids, first_key, last_key, base (ids of all shards before it). A shard ends with
    the document that takes it to ``shard_ids`` ids.

    A null text is empty: its document is the closing id alone. Null doc_ids come
    first; documents with the same doc_id stand together, in the order of their text's
    hash. An empty table gives no shards. Other columns are ignored.
    """
    path = tokenizer or tokenizer_path()
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("_h"))
    keys = ["doc_id", "_h", "_rid"]
    keyed = keyed.withColumn("_rid", row_number_column()).repartitionByRange(*keys).sortWithinPartitions(*keys)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, shard, part, at = shared_encoder(path), None, 0, 0
        end = np.array([end_id], dtype=encoder.dtype)
        made = []

        def close() -> None:
            made.append({"slice": at, "part": part, "name": name, **shard.close()})

        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text")
            at = batch.column("slice")[0].as_py() if len(ids) else at
            for a, b in text_slices(texts):
                got_ids = encoder.encode(texts.slice(a, b - a).to_pylist())
                for key, got in zip(ids[a:b], got_ids, strict=True):
                    if shard is None:
                        name, written = f"shard-{at:06d}-{part:04d}.ids", 0
                        shard = _Writer(folder, name, encoder.dtype)
                    shard.add(key, np.concatenate([got, end]))
                    written += len(got) + 1
                    if written >= shard_ids:
                        close()
                        shard, part = None, part + 1
        if shard is not None:
            close()
        if made:
            yield pa.RecordBatch.from_pylist(made, schema=kinds)

    kinds = pa.schema(
        [("slice", pa.int32()), ("part", pa.int32()), ("name", pa.string())]
        + [(c, pa.int64()) for c in ("documents", "ids", "first_key", "last_key")]
    )
    schema = "slice int, part int, name string, documents long, ids long, first_key long, last_key long"
    shards = stored(
        keyed.select("doc_id", "text", F.spark_partition_id().alias("slice")).mapInArrow(write, schema), "manifest"
    )
    earlier = Window.orderBy("slice", "part").rowsBetween(Window.unboundedPreceding, -1)
    return shards.withColumn("base", F.coalesce(F.sum("ids").over(earlier), F.lit(0)))


def read_documents(manifest: DataFrame, folder: str, at_once: int = 1 << 20) -> DataFrame:
    """Every document read back through its shard's index: doc_id, start, n_tokens, ids (unsigned 32-bit).

    Shards are dealt to tasks one by one; a task reads about ``at_once`` ids at a time.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, base in zip(batch.column("name").to_pylist(), batch.column("base").to_pylist(), strict=True):
                shard = Shard(folder, name)
                order = np.concatenate([np.arange(shard.nulls), shard.find(shard.keys[shard.nulls :])])
                same = np.arange(shard.documents) - order  # place among documents with the same key
                if (same < 0).any() or (shard.keys[order] != shard.keys).any():
                    raise ValueError(f"the index of {name} doesn't lead to its documents")
                starts, a = shard.starts, 0
                while a < shard.documents:
                    b = max(a + 1, int(np.searchsorted(starts, starts[a] + at_once, "right")) - 1)
                    ids, offsets = shard.ids(a, b).astype("<u4"), starts[a : b + 1] - starts[a]
                    raw = pa.LargeBinaryArray.from_buffers(
                        pa.large_binary(), b - a, [None, pa.py_buffer((offsets * 4).astype("<i8")), pa.py_buffer(ids)]
                    )
                    keys = pa.array(shard.keys[a:b], mask=np.arange(a, b) < shard.nulls)
                    n = np.diff(offsets)
                    columns = [keys, pa.array(base + starts[a:b]), pa.array(n), raw.cast(pa.binary())]
                    yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids"])
                    a = b

    dealt = manifest.select("name", "base").repartition(_tasks(manifest))
    return dealt.mapInArrow(read, "doc_id long, start long, n_tokens long, ids binary")


def lookup(manifest: DataFrame, folder: str, keys: DataFrame, key: str = "doc_id") -> DataFrame:
    """Ids of single documents by key: (key, ids); keys without a document give no row.

    The manifest's key ranges (a few numbers a shard) go to the tasks; a key is
    looked up in the first shard whose range holds it, by its number and fingerprint, and the
    first document with that key, which is in that shard, is read. A task keeps the shard it used last open.
    """
    ranges = [
        tuple(r) for r in manifest.filter(F.col("first_key").isNotNull()).orderBy("slice", "part").select("first_key", "last_key", "name").collect()
    ]
    lasts = [r[1] for r in ranges]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, shard = None, None
        for batch in batches:
            got, raw = [], []
            for k in sorted({k for k in batch.column(0).to_pylist() if k is not None}):
                at = bisect.bisect_left(lasts, k)
                if at == len(ranges) or ranges[at][0] > k:
                    continue
                if name != ranges[at][2]:
                    name = ranges[at][2]
                    shard = Shard(folder, name)
                first = int(shard.find(np.array([k], dtype="<i8"))[0])
                if first >= 0 and shard.keys[first] == k:
                    got.append(k)
                    raw.append(shard.ids(first, first + 1).astype("<u4").tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(got, pa.int64()), pa.array(raw, pa.binary())], names=[key, "ids"])

    return keys.select(F.col(key).cast("long").alias(key)).mapInArrow(find, f"`{key}` long, ids binary")


def _tasks(manifest: DataFrame) -> int:
    return max(1, min(manifest.count(), int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))))


def round_trip(docs: DataFrame, tokenizer: str | None = None, end_id: int = 2) -> DataFrame:
    """Write ``docs`` to a new scratch folder and read every document back."""
    folder = scratch_path(docs.sparkSession, "ids")
    return read_documents(write_shards(docs, folder, tokenizer, end_id), folder)
