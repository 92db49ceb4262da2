"""Token totals by source, language and tokenizer version, maintained by signed deltas.

A batch of changes is compared with what the ledger says of the same documents;
each change gives up to two signed rows (minus what the document counted for, plus
what it counts for now), and their sums by (source, language, version) are the
batch's delta. Totals are the sums of the committed deltas.

A batch writes its ledger rows and its delta to a folder of its own, then one commit file
named by the batch's place, which appears whole or not at all and never replaces another:
of two writers at one place the second fails and may try again. A batch that broke off left
no commit file and counts for nothing; a batch whose id is committed already is passed over.

After every ``fold`` batches a snapshot holds what all batches so far say: the live documents,
the totals and the batch ids. Readers take the newest snapshot and the commits after it, so the
tables read for a batch don't grow with the batches before it.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiffin.llm.common import map_texts, null_safe, with_row_keys, word_count
from tiffin.llm.tokens import shared_encoder, tokenizer_path

GROUP = ["source", "lang", "version"]
BATCH_IDS = "batch string"


def token_counts(docs: DataFrame, keep: list[str], tokenizer: str | None = None) -> DataFrame:
    """``keep`` columns and ``n``, the ids of each whole ``text`` (null: none)."""
    path = tokenizer or tokenizer_path()

    def make():
        encoder = shared_encoder(path)
        return lambda texts: {"n": [len(x) for x in encoder.encode(texts)]}

    return map_texts(docs, keep, "text", "n long", make)


#: What identifies a row of a table and how often it stands there: columns of :func:`row_counts` for :class:`Rollup`.
ROW_KEY, COPIES = ("doc_id", "_k0", "_k1"), "copies"


def row_counts(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """doc_id, source, lang, words and ``n`` of each row of ``docs`` (with ``text``), whatever its doc_id.

    ``_k0`` and ``_k1`` are hashes of the row, so that different rows with one doc_id (or
    none) stay apart; equal rows are one row, and ``copies`` says how many there are.
    """
    keyed = with_row_keys(docs.select("doc_id", "source", "lang", "text"), ["doc_id", "source", "lang", "text"])
    keep = [*ROW_KEY, "source", "lang", "words"]
    counted = token_counts(keyed.withColumn("words", word_count(F.col("text"))), keep, tokenizer)
    return counted.groupBy(*keep, "n").agg(F.count(F.lit(1)).alias(COPIES))


class Rollup:
    """Totals kept under ``path``, a folder that all executors share.

    A document is a value of the ``key`` columns and a version; the column ``copies``, if
    named, says how many documents a change stands for (1 if not). A revision carries
    the key of the document that it replaces.
    """

    def __init__(
        self, spark: SparkSession, path: str, key: tuple = ("doc_id",), copies: str | None = None, fold: int = 8
    ):
        self.spark, self.path, self.fold = spark, path, fold
        self.key = [*key, "version"]
        self.copies = F.coalesce(copies, F.lit(1)).cast("long") if copies else F.lit(1).cast("long")
        self._files = spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.path, *parts]))

    def _put_new(self, value: dict, *parts: str) -> None:
        """Write ``value`` as the file named by ``parts``; fails if there is one. The file appears complete."""
        written = self._path("pending", uuid.uuid4().hex)
        out = self._files.create(written, False)
        out.write(bytearray(json.dumps(value).encode()))
        out.close()
        target = self._path(*parts)
        self._files.mkdirs(target.getParent())
        fs = self.spark._jvm.org.apache.hadoop.fs
        context = fs.FileContext.getFileContext(self._files.getUri(), self.spark._jsc.hadoopConfiguration())
        context.rename(written, target, self.spark._sc._gateway.new_array(fs.Options.Rename, 0))

    def _get(self, *parts: str) -> dict | None:
        target = self._path(*parts)
        if not self._files.exists(target):
            return None
        stream = self._files.open(target)
        try:
            return json.loads(bytes(stream.readAllBytes()))
        finally:
            stream.close()

    def _state(self) -> tuple[dict | None, list[dict]]:
        """The newest snapshot, if there is one, and the commits after it, in order: at most ``fold`` unless folding failed."""
        folder, snapshot = self._path("snapshots"), None
        if self._files.exists(folder):
            names = [status.getPath().getName() for status in self._files.listStatus(folder)]
            snapshot = self._get("snapshots", max(names)) if names else None
        done, seq = [], snapshot["seq"] + 1 if snapshot else 0
        while (commit := self._get("commits", f"{seq:020d}")) is not None:
            done.append(commit)
            seq += 1
        return snapshot, done

    def committed(self, batch: str) -> bool:
        """Whether ``batch`` has been committed."""
        return self._committed(batch, *self._state())

    def _committed(self, batch: str, snapshot: dict | None, done: list[dict]) -> bool:
        if any(c["batch"] == batch for c in done):
            return True
        if snapshot is None:
            return False
        ids = self.spark.read.schema(BATCH_IDS).parquet(f"{snapshot['folder']}/batches")
        return not ids.filter(F.col("batch") == F.lit(batch)).isEmpty()

    def _read(self, part: str, snapshot: dict | None, done: list[dict]) -> DataFrame | None:
        tables = [c for c in (snapshot, *done) if c is not None]
        if not tables:
            return None
        parts = [self.spark.read.parquet(f"{c['folder']}/{part}").withColumn("seq", F.lit(c["seq"])) for c in tables]
        out = parts[0]
        for df in parts[1:]:
            out = out.unionByName(df)
        return out

    def live(self) -> DataFrame | None:
        """What each document counts for now; a document deleted since the last snapshot has ``live`` false."""
        return self._live(*self._state())

    def _live(self, snapshot: dict | None, done: list[dict]) -> DataFrame | None:
        rows = self._read("ledger", snapshot, done)
        if rows is None or not done:
            return rows and rows.drop("seq")
        state = F.max_by(F.struct("live", "source", "lang", "n", "rows"), "seq")
        return rows.groupBy(*self.key).agg(state.alias("_s")).select(*self.key, "_s.*")

    def _sums(self, snapshot: dict | None, done: list[dict]) -> DataFrame | None:
        deltas = self._read("delta", snapshot, done)
        if deltas is None:
            return None
        return deltas.groupBy(*GROUP).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))

    def compact(self) -> None:
        """Fold the newest snapshot and all later commits into a snapshot; another writer's of the same place stands."""
        snapshot, done = self._state()
        if not done:
            return
        folder, seq = f"{self.path}/folded/{uuid.uuid4().hex}", done[-1]["seq"]
        self._live(snapshot, done).filter("live").write.parquet(f"{folder}/ledger")
        self._sums(snapshot, done).write.parquet(f"{folder}/delta")
        ids = self.spark.createDataFrame([(c["batch"],) for c in done], BATCH_IDS)
        if snapshot is not None:
            ids = ids.unionByName(self.spark.read.schema(BATCH_IDS).parquet(f"{snapshot['folder']}/batches"))
        ids.write.parquet(f"{folder}/batches")
        if self._get("snapshots", f"{seq:020d}") is None:
            self._put_new({"seq": seq, "folder": folder}, "snapshots", f"{seq:020d}")

    def apply(self, batch: str, changes: DataFrame) -> bool:
        """Apply and commit ``changes``; False, and nothing done, if ``batch`` is committed already.

        ``changes``: op ('insert', 'revise', 'delete'), the key columns (doc_id), source,
        lang, version, n, at. Inserts and revisions set what a document counts for, deletes
        clear it; a document is a value of (key columns, version), null equal to null. Of
        several changes to one document the one with the largest (at, n, source, lang)
        holds, so a change sent twice counts once: where rows of a table share a doc_id,
        key by :func:`row_counts`. Deletes of unknown documents, and rows with another op, change
        nothing. A null n counts as 0. If another writer has committed meanwhile, this one fails
        without effect and may be called again.
        """
        snapshot, done = self._state()
        if self._committed(batch, snapshot, done):
            return False
        if len(done) >= self.fold:
            self.compact()
            snapshot, done = self._state()
        known = changes.filter(F.col("op").isin("insert", "revise", "delete"))
        value = F.struct(
            (F.col("op") != "delete").alias("live"),
            F.col("source").cast("string").alias("source"),
            F.col("lang").cast("string").alias("lang"),
            F.coalesce("n", F.lit(0)).cast("long").alias("n"),
            self.copies.alias("rows"),
        )
        order = F.struct("at", F.coalesce("n", F.lit(0)), "source", "lang", "op")
        new = known.groupBy(*self.key).agg(F.max_by(value, order).alias("_v")).select(*self.key, "_v.*")
        old = self._live(snapshot, done)
        plus = new.select(*GROUP, "n", F.col("rows").alias("sign"), "live")
        if old is None:
            signed = plus
        else:
            minus = old.join(new.select(*self.key), null_safe(old, new, [(c, c) for c in self.key]), "left_semi")
            signed = plus.unionByName(minus.select(*GROUP, "n", (-F.col("rows")).alias("sign"), "live"))
        delta = (
            signed.filter("live")
            .groupBy(*GROUP)
            .agg(F.sum("sign").alias("docs"), F.sum(F.col("n") * F.col("sign")).alias("tokens"))
        )
        folder = f"{self.path}/batches/{uuid.uuid4().hex}"
        new.write.parquet(f"{folder}/ledger")
        delta.write.parquet(f"{folder}/delta")
        last = done[-1] if done else snapshot
        seq = last["seq"] + 1 if last else 0
        self._put_new({"seq": seq, "batch": batch, "folder": folder}, "commits", f"{seq:020d}")
        return True

    def totals(self) -> DataFrame:
        """source, lang, version, docs, tokens over all committed batches; groups without documents are left out."""
        sums = self._sums(*self._state())
        if sums is None:
            return self.spark.createDataFrame([], "source string, lang string, version string, docs long, tokens long")
        return sums.filter("docs != 0")
