"""Approximate nearest neighbours by collision counting over query-centred windows.

Vectors are projected on single random directions; each direction keeps its projections sorted. A
query opens a window round its own projection in every direction; a vector that lies in the windows
of more than a threshold of the directions is verified by its exact distance. The radius grows step
by step (virtual rehashing: the windows widen, nothing is hashed again) until enough verified
vectors lie within it, or the windows hold everything.

Vectors are dealt to shards, queries to blocks, both of bounded size; a task indexes one shard and
answers one block, and the answers of the shards are merged by a ranked window.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridseries.llm.common import usable_vector

#: Directions, half width of a window at radius 1, growth of the radius.
DIRECTIONS, HALF_WIDTH, GROWTH = 160, 1.5, 1.04
#: Share of directions that must collide: a vector at the radius collides in 0.866 of them on average (the normal
#: distribution's share within ``HALF_WIDTH``), and in this share with odds of 0.95.
COLLIDE = 0.866 - 1.65 * (0.866 * 0.134 / DIRECTIONS) ** 0.5
#: Vectors of a shard whose exact distances give its first radius.
FIT_ROWS = 32
SEED = 11
#: Vectors of a shard and queries of a block, on average.
SHARD_ROWS, BLOCK_ROWS = 8192, 2048


def directions(dim: int, count: int = DIRECTIONS, seed: int = SEED) -> np.ndarray:
    return np.random.default_rng([seed, dim]).standard_normal((dim, count))


class Index:
    """Sorted projections of one shard's vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        # of rows that repeat an id the least vector, by its components in turn, counts
        order = np.lexsort((*vectors.T[::-1], ids))
        self.ids, first = np.unique(ids[order], return_index=True)
        self.vectors = vectors[order][first]
        self.axes = directions(vectors.shape[1])
        at = self.vectors @ self.axes
        order = np.argsort(at, axis=0, kind="stable")
        self.sorted = np.ascontiguousarray(np.take_along_axis(at, order, axis=0).T)
        self.order = np.ascontiguousarray(order.astype(np.int32).T)
        # all directions in one ascending row, so that a look-up finds the places of all of them at once
        self.apart = 4 * float(np.abs(at).max(initial=0.0)) + 1.0
        self.line = (self.sorted + self.apart * np.arange(len(self.sorted))[:, None]).ravel()
        self.least_radius = max(1e-9 * max(1.0, float(np.abs(at).max(initial=0.0))), 1e-300)

    def first_radius(self, k: int) -> float:
        """A radius that holds the ``k`` nearest of few vectors only, from exact distances of some vectors of the shard."""
        some = self.vectors[:: max(1, len(self.vectors) // FIT_ROWS)]
        squares = (some**2).sum(axis=1)[:, None] - 2 * some @ self.vectors.T + (self.vectors**2).sum(axis=1)[None, :]
        nth = np.sqrt(np.maximum(np.partition(squares, min(k, squares.shape[1] - 1), axis=1)[:, min(k, squares.shape[1] - 1)], 0))
        return max(float(np.quantile(nth, 0.1)) * 0.97, self.least_radius)

    def places(self, at: np.ndarray) -> np.ndarray:
        """Of each direction the number of its projections below ``at``."""
        m, n = self.sorted.shape
        row = np.arange(m)
        aside = self.apart / 8  # what lies beyond a direction's ends stays between it and the next on the line
        clipped = np.clip(at, self.sorted[:, 0] - aside, self.sorted[:, -1] + aside)
        return np.searchsorted(self.line, clipped + self.apart * row) - n * row

    def search(self, query_id: int, query: np.ndarray, k: int, radius: float) -> list[tuple[int, float]]:
        """At most ``k`` (id, distance), nearest first, ties to the smaller id, the query's own id left out.

        ``radius`` is the first one; the number of vectors verified is left in ``verified``.
        """
        m, n = self.order.shape
        need = int(np.ceil(COLLIDE * m))
        here = query @ self.axes
        hits = np.zeros(n, dtype=np.int32)
        low = self.places(here)
        high = low.copy()
        own = self.ids == query_id
        distance = np.full(n, np.inf)
        checked = own.copy()
        while True:
            left, right = self.places(here - HALF_WIDTH * radius), self.places(here + HALF_WIDTH * radius)
            parts = [self.order[j, left[j] : low[j]] for j in range(m) if left[j] < low[j]]
            parts += [self.order[j, high[j] : right[j]] for j in range(m) if right[j] > high[j]]
            low, high = np.minimum(low, left), np.maximum(high, right)
            if parts:
                hits += np.bincount(np.concatenate(parts), minlength=n).astype(np.int32)
            new = np.flatnonzero((hits >= need) & ~checked)
            if len(new):
                gap = self.vectors[new] - query
                distance[new] = np.sqrt((gap * gap).sum(axis=1))
                checked[new] = True
            if (distance <= radius).sum() >= k or checked.all():
                break
            # steps are small where few are missing, so that little more than needed is verified
            radius *= GROWTH if checked.sum() > own.sum() else GROWTH**2
        found = np.flatnonzero(checked & ~own)
        self.verified = len(found)
        best = found[np.lexsort((self.ids[found], distance[found]))[:k]]
        return [(int(self.ids[i]), float(distance[i])) for i in best]


def nearest(
    vectors: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding",
    shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` nearest vectors found of each query.

    Distances are Euclidean in double precision; ties go to the smaller id. Vectors that are null,
    zero or hold null or non-finite components, and rows with a null id, take no part. Vectors meet
    only vectors of their own length. Of rows that repeat an id the vector that is least, component by
    component, counts, once. Fewer than ``k`` candidates
    are all returned. Other columns are ignored; empty tables give none.
    """

    def usable(frame: DataFrame) -> DataFrame:
        return frame.where(F.col(id_col).isNotNull() & usable_vector(F.col(vector_col))).select(
            F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"), F.size(vector_col).alias("dim")
        )

    shards = max(1, -(-vectors.count() // shard_rows))
    blocks = max(1, -(-queries.count() // block_rows))
    # both numbers are bounded by rows over a constant, and each task by one shard and one block
    left = usable(vectors).withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(shards))).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    right = usable(queries).withColumn("block", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(blocks)).cast("int")).withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))))

    def answer(key: tuple, data: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        rows = []
        if len(data) and len(asked):
            index = Index(data.id.to_numpy(), np.stack(data.v.to_numpy()))
            radius = index.first_radius(k)
            for query_id, query in asked.sort_values("v", key=lambda v: v.map(tuple)).drop_duplicates("id")[["id", "v"]].itertuples(index=False):
                rows += [(query_id, i, d) for i, d in index.search(query_id, np.asarray(query, dtype=np.float64), k, radius)]
        return pd.DataFrame(rows, columns=["query_id", "vec_id", "score"]).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})

    found = (
        left.groupBy("shard", "block", "dim").cogroup(right.groupBy("shard", "block", "dim"))
        .applyInPandas(answer, "query_id long, vec_id long, score double")
    )
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op6_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest vectors found of every vector whose id is divisible by 100."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return nearest(vectors, vectors.where("vec_id % 100 = 0"))
