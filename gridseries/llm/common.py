"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of characters other than the six ASCII white-space ones.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def ensure_shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from ``spark.checkpoint.dir``.

    Only where the cluster names none (as in tests) a folder of our own is set.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    have = spark.sparkContext.getCheckpointDir()
    if named:
        if not have:
            spark.sparkContext.setCheckpointDir(named)
        return named
    if not have:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-", dir="/tmp"))
    return spark.sparkContext.getCheckpointDir()


def cut(frame: DataFrame) -> DataFrame:
    """Materialise ``frame`` in the shared checkpoint folder and forget how it was made."""
    ensure_shared_dir(frame.sparkSession)
    return frame.checkpoint(eager=True)


@contextmanager
def stored_tables(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """A function that materialises a frame like ``cut``, but as Parquet in a folder of the shared one. The
    folder goes at the end, so what leaves the block must not read from it (``cut`` it)."""
    at = f"{ensure_shared_dir(spark).rstrip('/')}/tables-{uuid.uuid4().hex}"

    def stored(frame: DataFrame) -> DataFrame:
        path = f"{at}/{uuid.uuid4().hex}"
        frame.write.parquet(path)
        return spark.read.schema(frame.schema).parquet(path)

    try:
        yield stored
    finally:
        folder = spark._jvm.org.apache.hadoop.fs.Path(at)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def arrow_rows(spark: SparkSession, most: int) -> Iterator[None]:
    """Python workers get at most so many rows at once in what is materialised inside: long texts stay few."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(most, int(before)) if int(before) > 0 else most))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def word_count(text: Column) -> Column:
    """Number of words of a text as a long; null counts as 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def text_key(text: Column) -> Column:
    """A 64-bit key that, beside the id, tells apart rows which share an id."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def usable_vector(embedding: Column) -> Column:
    """True for vectors that are not null, not zero and hold finite components only."""
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(embedding.isNotNull() & finite & F.exists(embedding, lambda x: x != 0), F.lit(False))


def components(edges: DataFrame, most_rounds: int = 60, keep: Callable[[DataFrame], DataFrame] = cut) -> DataFrame:
    """Connected components of an undirected graph by alternating star contraction.

    ``edges`` has two long columns ``u`` and ``v``. The result has one row for each node but
    the smallest of its component: ``node`` and ``root``, that smallest one (so a node without a row is
    its own root). Self loops, repeated edges and nulls are ignored; no edges give an empty frame.

    Every round is two aggregations and joins on node keys (no neighbour list is ever gathered), is
    materialised by ``keep``, and the driver sees only whether nodes are left that are no star's centre or leaf.
    Raises if the rounds, which grow with the logarithm of the longest chain, do not suffice: links are never dropped.
    """
    now = keep(
        edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    )
    for done in range(most_rounds + 1):
        # edges lead to smaller nodes, so they are settled once no node has two of them, or one and one that leads to it
        ends = now.select(F.col("u").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("into")).unionByName(
            now.select(F.col("v").alias("node"), F.lit(0).alias("out"), F.lit(1).alias("into"))
        )
        if ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("into").alias("into")).where("out + into > 1 and out > 0").isEmpty():
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        if done == most_rounds:
            break
        # large star: every node points its larger neighbours to its smallest neighbour
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: every node points itself and its smaller neighbours to the smallest of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(least, "u")
        small = moved.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = keep(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")
