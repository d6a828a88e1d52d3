"""Corpus preparation in stages, each one table to one table."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from gridseries.llm import mixing, overlap, packing, quality, simhash
from gridseries.llm.common import ensure_shared_dir


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. Labels are read from the folder of the tables."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: texts whose sets of five-word shingles have a
    similarity of 0.8 or more. Fingerprints give the first candidates; those within three bits are few of
    the copies near 0.8, so prefixes of the sets give the others, and all are verified on the sets."""
    return simhash.keep_first(docs, overlap.near_copies(docs))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document comes out as often as the mix takes it."""
    return mixing.repeat_taken(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bin and place of every piece of every document."""
    return packing.pack(docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("simhash_near_dedup", simhash_near_dedup),
    ("source_mixing", source_mixing),
    ("best_fit_packing", best_fit_packing),
]

#: The classifier, fingerprints and random rounding have no SQL; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; every stage's result but the last is written to the shared folder and read again."""
    at = f"{ensure_shared_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs.write.parquet(f"{at}/{k}")
            docs = spark.read.parquet(f"{at}/{k}")
    return docs
