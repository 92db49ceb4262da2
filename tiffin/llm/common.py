"""Shared helpers: scratch tables on the shared folder, Arrow maps over texts, distributed ordering.

Scratch tables cut lineage: a table is written once under the folder that the
session names in ``spark.checkpoint.dir`` and read again, so a lost executor
re-reads files and every reader sees the same rows. The folder's owner cleans it
up; nothing is written to a machine-local folder.
"""

from __future__ import annotations

import functools
import re
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType

#: monotonically_increasing_id keeps the partition above bit 33 and the row below.
_ROW_BITS = 33
#: Words are runs of anything but space and \x09-\x0D; the same in Java and Python syntax.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
WHITE_BYTES = b" \t\n\x0b\x0c\r"


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; a temporary one only where it is unset on a local master."""
    sc = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if found:
        return found.rstrip("/")
    if not re.match(r"local(\[|$)", sc.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = tempfile.mkdtemp(prefix="tiffin-llm-")
    sc.setCheckpointDir(path)
    return path


@functools.cache
def _package_zip() -> str:
    root = Path(__file__).resolve().parents[1]
    out = f"{tempfile.mkdtemp(prefix='tiffin-package-')}/tiffin.zip"
    with zipfile.ZipFile(out, "w") as packed:
        for path in sorted(root.rglob("*.py")):
            packed.write(path, path.relative_to(root.parent))
    return out


def ship_package(spark: SparkSession) -> None:
    """Hand this package to the executors' Python workers, as ``--py-files`` would; once a context."""
    sc = spark.sparkContext
    if not any(f.endswith("/tiffin.zip") for f in sc.listFiles):
        sc.addPyFile(_package_zip())


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new folder name under :func:`shared_dir`."""
    return f"{shared_dir(spark)}/tiffin-llm/{uuid.uuid4().hex}/{label}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet to a new scratch folder and read again."""
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def row_number_column() -> Column:
    return F.monotonically_increasing_id()


def word_count(text: Column) -> Column:
    """Words of ``text`` as long; null counts as empty."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def _has_map(kind: DataType) -> bool:
    if isinstance(kind, StructType):
        return any(_has_map(f.dataType) for f in kind.fields)
    return isinstance(kind, MapType) or (isinstance(kind, ArrayType) and _has_map(kind.elementType))


def _hashable(col: Column, kind: DataType) -> Column:
    """``col`` with each map in it as the array of its entries, sorted by all of them."""
    if not _has_map(kind):
        return col
    if isinstance(kind, ArrayType):
        return F.transform(col, lambda x: _hashable(x, kind.elementType))
    if isinstance(kind, StructType):
        made = [_hashable(col.getField(f.name), f.dataType).alias(f"f{i}") for i, f in enumerate(kind.fields)]
        return F.when(col.isNotNull(), F.struct(*made))
    entries = F.transform(
        F.map_entries(col),
        lambda e: F.struct(_hashable(e["key"], kind.keyType).alias("k"), _hashable(e["value"], kind.valueType).alias("v")),
    )
    return F.sort_array(entries)


def with_row_keys(df: DataFrame, needed: list[str]) -> DataFrame:
    """The rows of ``df`` as one column ``_row``, the ``needed`` columns, and ``_k0`` and ``_k1``.

    The keys are 128 bits of hash over all columns (maps as their sorted entries): equal
    rows have equal keys. As one column, the rows' own names can't clash with those of an operator.
    """
    plain = [_hashable(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields]
    marked = [c for col in plain for c in (F.isnull(col), col)]
    return df.select(
        F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"),
        *needed,
        F.xxhash64(F.lit(1), *marked).alias("_k0"),
        F.xxhash64(F.lit(2), *marked).alias("_k1"),
    )


def matched(keyed: DataFrame, chosen: DataFrame) -> DataFrame:
    """``_row`` of ``keyed`` with the columns of ``chosen`` (``_k0``, ``_k1``, ``rows`` and more, one row a key).

    Equal rows become one; ``rows`` says how many there are, so that the pass that
    makes them one is planned only where there are any.
    """
    joined = keyed.select("_row", "_k0", "_k1").join(chosen, ["_k0", "_k1"])
    if not chosen.filter("rows > 1").isEmpty():
        joined = joined.dropDuplicates(["_k0", "_k1"])
    return joined


def null_safe(left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]]) -> Column:
    """Equality on every pair of columns, nulls equal to nulls."""
    cond = F.lit(True)
    for a, b in pairs:
        cond = cond & left[a].eqNullSafe(right[b])
    return cond


def map_texts(
    df: DataFrame,
    keep: list[str],
    text_col: str,
    schema: str,
    make: Callable[[], Callable[[list], dict]],
    at_once: int = 4_000_000,
) -> DataFrame:
    """Map whole texts in Arrow batches inside the scan's own partitions, without a shuffle.

    ``make()`` runs once in each task and returns a function from a list of texts
    (None for null) to a dict of columns named in ``schema``; ``keep`` columns pass
    through as they are. Batches are cut again so that one call sees at most about
    ``at_once`` bytes of text, which bounds what it makes whatever the batch size is.
    """
    kept = df.select(*[F.col(c) for c in keep], F.col(text_col).alias("_text"))
    out = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:-1]], schema])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            for a, b in text_slices(texts, at_once):
                made = work(texts.slice(a, b - a).to_pylist())
                part = batch.slice(a, b - a)
                names = [*batch.schema.names[:-1], *made]
                columns = [*part.columns[:-1], *[c if isinstance(c, pa.Array) else pa.array(c) for c in made.values()]]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return kept.mapInArrow(run, out)


def text_slices(texts: pa.Array, most: int = 4_000_000) -> Iterator[tuple[int, int]]:
    """Index ranges whose texts hold at most ``most`` bytes together, one text at least."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    a = 0
    while a < len(texts):
        before = int(ends[a - 1]) if a else 0
        b = max(a + 1, int(np.searchsorted(ends, before + most, "right")))
        yield a, b
        a = b


def sorted_slices(df: DataFrame, keys: list[str], label: str) -> DataFrame:
    """``df`` range-partitioned and sorted by ``keys``, stored, with its place in that order.

    Adds ``slice`` (the partition, in the order of the keys) and ``pos`` (the row's
    place within it, from 0). ``keys`` should identify a row, so that equal leading
    keys are split over several slices. The bounds only balance the work; results
    that use slices don't depend on them. ``df`` should be a stored table, as Spark
    samples it once for the bounds.
    """
    ranged = df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_at", row_number_column())
    at = F.col("_at")
    return stored(
        ranged.withColumns(
            {"slice": F.shiftright(at, _ROW_BITS), "pos": at.bitwiseAND(F.lit((1 << _ROW_BITS) - 1))}
        ).drop("_at"),
        label,
    )
