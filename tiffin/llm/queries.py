"""The registered queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiffin.llm import chat, collocations, jaccard, langid, lexical, licenses, mixing, packing, quality, simhash, token_counts, token_files, topk
from tiffin.llm.common import scratch_path, ship_package, stored


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_top_k_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.with_crc(packing.pack(_table(spark, sf_dir, "documents")))


def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_chats(_table(spark, sf_dir, "conversations"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = langid.language_of(_table(spark, sf_dir, "documents"), ["doc_id"])
    return found.withColumn("held_out", langid.held_out(F.col("doc_id")))


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"), ["doc_id"])
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op7_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = token_files.round_trip(_table(spark, sf_dir, "documents"))
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_table(spark, sf_dir, "documents"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(_table(spark, sf_dir, "documents"), ["doc_id"])


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches over the whole table: word counts at ingest, then token counts; empty texts are deleted and come back."""
    counted = stored(token_counts.row_counts(_table(spark, sf_dir, "documents")), "counted")
    changes = counted.withColumns({"version": F.lit("byte_bpe_50k"), "at": F.lit(0)})
    rollup = token_counts.Rollup(spark, scratch_path(spark, "rollup"), token_counts.ROW_KEY, token_counts.COPIES)
    ingested = changes.withColumns({"op": F.lit("insert"), "n": F.col("words")})
    tokenised = changes.withColumn("op", F.lit("revise"))
    rollup.apply("ingest", ingested)
    rollup.apply("tokenise", tokenised)
    rollup.apply("tokenise", tokenised)  # sent again after a lost reply: passed over
    empty = changes.filter("n = 0")
    rollup.apply("drop-empty", empty.withColumn("op", F.lit("delete")))
    rollup.apply("return-empty", empty.withColumn("op", F.lit("insert")))  # the totals cover the whole table
    return rollup.totals()


def op11_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(_table(spark, sf_dir, "documents"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    every = (
        op1_top_k_search,
        op2_packing,
        op3_chat_formatting,
        op4_mixing,
        op5_language_id,
        op6_simhash_near_dedup,
        op7_token_ids,
        op8_license_scan,
        op9_quality_rules,
        op10_token_counts,
        op11_ngram_jaccard,
        op12_collocations,
        op13_ranked_search,
    )
    return {f.__name__: f for f in every}
