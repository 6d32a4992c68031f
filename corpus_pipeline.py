"""A training corpus from raw documents: each stage works on the written result of the one before.

Quality rules reject documents and take the lines above the limits out of the others; of each group of near duplicates one stays; documents that hold benchmark items go; the
sources are mixed to flatter shares, so that a document of a small source may come twice; the mixture is shuffled into
shards. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from codesieve.llm import decontaminate, jaccard_join, mixing, quality_rules, sharding
from codesieve.llm.store import Store


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, without the lines above the limits."""
    return quality_rules.keep_cleaned(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group whose shingles of five words are similar to 0.8 or more."""
    return jaccard_join.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark items."""
    return decontaminate.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document once, those of small sources up to twice."""
    return mixing.mixed_rows(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture with its shards and slots."""
    return sharding.shuffle(docs)


STAGES = [
    ("quality rules", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing to target weights", mixture),
    ("sharding", shards),
]

#: Near duplicates are closed over chains of links, which SQL expresses only by comparing all pairs.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    store = Store(spark, "pipeline")
    for number, (_, stage) in enumerate(STAGES):
        docs = store.keep(stage(spark, docs, sf_dir), f"stage{number}")
        if number:
            store.drop(f"stage{number - 1}")
    return docs
