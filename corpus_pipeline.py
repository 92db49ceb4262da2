"""A corpus from raw documents to packed sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all rows of ``docs``; what one stage
returns is written as Parquet and read as the next one's ``docs``. All but the last
return the columns of the documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiffin.llm import langid, mixing, packing, quality, simhash
from tiffin.llm.common import ship_package, stored

#: Texts whose best profile is further off than this are in no learned language.
LEAST_SCORE = 0.3


def _whole(docs: DataFrame) -> DataFrame:
    """The rows as one column, so that a stage's own columns can't clash with theirs."""
    names = [f"`{c}`" for c in docs.columns]
    return docs.select(F.struct(*names).alias("_row"), "text", "lang", "doc_id")


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language; texts without a letter, and those far from every profile, go."""
    found = langid.language_of(_whole(docs), ["_row"])
    return found.filter((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SCORE)).select("_row.*")


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the limits on repeated passages."""
    return quality.judged(_whole(docs), ["_row"]).filter("kept").select("_row.*")


def one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group of near duplicates."""
    return simhash.one_of_each(docs)


def to_target_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    return mixing.mixed(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences."""
    return packing.with_crc(packing.pack(docs))


STAGES = [
    ("language_id", known_language),
    ("quality_rules", good_quality),
    ("simhash_near_dedup", one_of_near_duplicates),
    ("mix_sources", to_target_weights),
    ("packing", packed),
]

#: Needs a tokenizer, XXH64 and rank-order profiles, which SQL lacks; tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
