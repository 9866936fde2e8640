"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, folder of the tables) and returns a frame; all but the last
return the columns of `docs`. `run` writes each stage to the shared folder and reads it back, so
a lost executor costs a part of one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from opinarium.llm import decontamination, near_duplicates, packing, quality, toxicity
from opinarium.runtime import materialize


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the quality rules reject."""
    return quality.keep_good(docs, _table(spark, sf_dir, "labels"))


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the clause grammar finds toxic."""
    return toxicity.keep_civil(docs, _table(spark, sf_dir, "labels"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each class of near-duplicates."""
    return near_duplicates.keep_one(docs)


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold a benchmark item."""
    return decontamination.keep_clean(docs, _table(spark, sf_dir, "benchmark"))


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents and their places in token sequences."""
    return packing.pack(docs)


STAGES = [
    ("quality", good_quality),
    ("toxicity", not_toxic),
    ("near_duplicates", one_of_each),
    ("decontamination", no_benchmark),
    ("packing", packed_sequences),
]

# Classifiers, signatures and packing can't be said in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
