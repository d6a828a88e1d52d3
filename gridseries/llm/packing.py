"""Best-fit packing of documents into bins of equal capacity, with conflicts.

Documents are dealt to shards of bounded size by a hash of their id, which spreads every source and
every group of copies evenly. A shard packs its pieces in descending size: its bins stand in order
of their residual, and the search begins at the first bin whose residual holds the piece (its
successor) and goes on until a bin is found whose source and cluster bitmaps have neither of the
piece's bits. That is the tightest compatible bin; where there is none a bin is opened.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridseries.llm.common import cut, text_key, word_count

#: Words of a bin, and pieces of a shard on average.
CAPACITY = 2048
SHARD_ROWS = 4096


def best_fit(sizes: list[int], sources: list[int], clusters: list[int], capacity: int) -> list[int]:
    """Bin number of each piece, taken in the given order.

    ``sources`` and ``clusters`` are bits (0, 1, ...) of the bitmaps, or -1 for no conflict.
    """
    bins: list[tuple[int, int]] = []  # (residual, number), in order
    carried: list[list[int]] = []  # of each bin: its source and its cluster bitmap
    placed = []
    for size, source, cluster in zip(sizes, sources, clusters, strict=True):
        s, c = (1 << source if source >= 0 else 0), (1 << cluster if cluster >= 0 else 0)
        start = bisect_left(bins, (size, -1))
        for at, (residual, number) in enumerate(islice(bins, start, None), start):
            if not carried[number][0] & s and not carried[number][1] & c:
                del bins[at]
                break
        else:
            residual, number = capacity, len(carried)
            carried.append([0, 0])
        carried[number][0] |= s
        carried[number][1] |= c
        if residual > size:
            insort(bins, (residual - size, number))
        placed.append(number)
    return placed


def _bits(values: list) -> list[int]:
    """A bit for each value that occurs twice or more in the shard, -1 for the others and for nulls."""
    often = sorted(v for v, n in Counter(values).items() if n > 1 and v is not None)
    codes = {v: i for i, v in enumerate(often)}
    return [codes.get(v, -1) for v in values]


def pack(
    docs: DataFrame,
    capacity: int = CAPACITY,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    cluster_col: str | None = None,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """``doc_id, piece, first_word, n_words, source, cluster, shard, bin, start`` of every piece.

    A text of more than ``capacity`` words is cut into pieces of ``capacity`` words and a rest;
    texts without words (null ones too) are one piece of size 0. No bin holds two pieces of one
    source, nor two of one cluster (by default: rows of equal text), so the pieces of a document
    go to bins of their own; null sources conflict with nothing. ``start`` is a piece's first word
    in its bin. Repeated rows are copies of one text, so they conflict. Null ids are packed under a
    shard of their text. Other columns are ignored; an empty table gives none.
    """
    cluster = F.col(cluster_col).cast("long") if cluster_col else text_key(F.col(text_col))
    units = cut(docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), cluster.alias("cluster"),
        text_key(F.col(text_col)).alias("key"), word_count(F.col(text_col)).alias("n"),
    ))
    pieces = units.select(
        "doc_id", "source", "cluster", "key",
        F.posexplode(F.sequence(F.lit(0).cast("long"), F.greatest(F.lit(0).cast("long"), F.col("n") - 1), F.lit(capacity).cast("long"))).alias("piece", "first_word"),
        "n",
    ).select(
        "doc_id", "piece", "first_word", F.least(F.lit(capacity), F.col("n") - F.col("first_word")).cast("int").alias("n_words"),
        "source", "cluster", "key",
    )
    total = units.agg(F.sum(F.greatest(F.lit(1), F.ceil(F.col("n") / capacity)))).first()[0] or 0
    shards = max(1, -(-total // shard_rows))
    dealt = pieces.withColumn("shard", F.pmod(F.xxhash64("doc_id", "key", "piece"), F.lit(shards)).cast("long"))

    def place(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("n_words", "descending"), ("doc_id", "ascending"), ("piece", "ascending"), ("key", "ascending"), ("source", "ascending")])
        sizes = rows["n_words"].to_pylist()
        bins = best_fit(sizes, _bits(rows["source"].to_pylist()), _bits(rows["cluster"].to_pylist()), capacity)
        used, starts = [0] * (max(bins) + 1), []
        for number, size in zip(bins, sizes, strict=True):
            starts.append(used[number])
            used[number] += size
        return rows.drop_columns("key").append_column("bin", pa.array(bins, pa.int64())).append_column("start", pa.array(starts, pa.int32()))

    return dealt.groupBy("shard").applyInArrow(
        place,
        "doc_id long, piece int, first_word long, n_words int, source string, cluster long, shard long, bin long, start int",
    )


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bin and place of every piece of every document."""
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))
