"""Mixing sources to target weights by pivotal dependent rounding.

Every source gets a target number of words; a document's expected number of copies is its source's
target over the source's size. The whole copies are certain. The fractions are rounded in pairs: words
pass between two documents, in a random direction whose odds keep both expectations, until one of the
two fractions is integral; the other goes on to the next pair. Documents are paired in descending size,
so large ones settle among each other first and the fraction that is left last is of a small document.
A document of more than twice the size of the next one takes several next ones together as its partner:
one alone has too few words to settle it.
Inside a bucket of one source all but one document and the smallest ones are settled so; these residuals
meet again in a tree of buckets of buckets, until one is left per source. A source so misses its target by
less than one document.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridseries.llm.common import cut, text_key, word_count

#: Fixed values of the registered query.
WEIGHTS = (1.0, 2.0, 3.0)
MOST_COPIES = 3.0
SEED = 20240101

#: Documents of one bucket, on average; buckets of one round of the tree.
BUCKET_ROWS = 4096
FAN_IN = 128
#: Most documents that are together the partner of an outsized one; documents that a bucket passes on.
PARTNERS, RESERVE = 32, 32
#: Sources whose totals the driver holds and hands to all tasks (a few hundred bytes each).
MOST_SOURCES = 100_000


def targets(sizes: dict[str | None, int], weights: tuple[float, ...] = WEIGHTS, most: float = MOST_COPIES) -> dict[str | None, float]:
    """Target words of each source: its weight's share of all words, at most ``most`` times its size.

    Sources in code point order, null last, take the weights in turn. What is cut from one is shared
    by weight among those not cut, again until none is above its bound.
    """
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_ = float(sum(sizes.values())), list(order)
    out: dict[str | None, float] = {}
    while open_:
        total = sum(weight[s] for s in open_)
        over = [s for s in open_ if left * weight[s] / total > most * sizes[s]]
        if not over:
            return out | {s: left * weight[s] / total for s in open_}
        for s in over:
            out[s] = most * sizes[s]
        left -= sum(out[s] for s in over)
        open_ = [s for s in open_ if s not in out]
    return out


def pivot(size: np.ndarray, share: np.ndarray, draw: np.random.Generator, leave: int = 1) -> np.ndarray:
    """Round the fractions ``share`` (0..1) of documents in descending size; ``leave`` of them may stay.

    Words, not copies, pass between the partners, so the expected words stay as they are at every
    step; each step makes a document integral.
    """
    share = share.copy()
    live = np.flatnonzero((share > 0) & (share < 1))
    s, z, head = share[live], size[live], 0
    while head < len(s) - leave:
        if not 0.0 < s[head] < 1.0:
            head += 1
            continue
        near = s[head + 1 : head + 1 + 4 * PARTNERS]
        other = head + 1 + np.flatnonzero((near > 0) & (near < 1))[:PARTNERS]
        if len(other) < PARTNERS:
            rest = s[head + 1 :]
            other = head + 1 + np.flatnonzero((rest > 0) & (rest < 1))[:PARTNERS]
        if not len(other):
            break
        if z[head] <= 2 * z[other[0]]:
            other = other[:1]
        words = z[other].sum()
        up = min((1 - s[head]) * z[head], s[other].min() * words)
        down = min(s[head] * z[head], (1 - s[other].max()) * words)
        moved = up if draw.random() * (up + down) < down else -down
        s[head] += moved / z[head]
        s[other] -= moved / words
        pair = np.append(other, head)
        s[pair] = np.where(s[pair] < 1e-9, 0.0, np.where(s[pair] > 1 - 1e-9, 1.0, s[pair]))
    share[live] = s
    return share


def _settle(last: bool, seed: int, level: int):
    def settle(rows: pa.Table) -> pa.Table:
        rows = rows.take(np.lexsort((rows["draw"].to_numpy(), -rows["size"].to_numpy())))
        place = f"{seed}:{level}:{rows['source'][0].as_py()}:{rows['bucket'][0].as_py()}"
        draw = np.random.default_rng(xxhash.xxh64_intdigest(place))
        share = pivot(rows["size"].to_numpy().astype(float), rows["share"].to_numpy(), draw, 1 if last else RESERVE)
        if last:
            odd = np.flatnonzero((share > 0) & (share < 1))
            share[odd] = (draw.random(len(odd)) < share[odd]).astype(float)
        return rows.set_column(rows.schema.get_field_index("share"), "share", pa.array(share))

    return settle


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[float, ...] = WEIGHTS,
    most_copies: float = MOST_COPIES,
    seed: int = SEED,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """``doc_id, key, source, size, source_size, target, copies, taken`` of every row.

    ``copies`` is an integer from 0 to ``most_copies``, ``taken`` is copies times size. Null texts
    have size 0, and documents of size 0 take nothing. The draws depend on ids, text keys and the
    seed alone, so reruns agree. Repeated rows are rounded each on their own. Null ids and sources
    (one source, the last) take part; other columns are ignored; an empty table gives none.

    The driver sees one row per source, and refuses more than ``MOST_SOURCES`` of them.
    """
    units = cut(
        docs.select(
            F.col(id_col).alias("id"), text_key(F.col(text_col)).alias("key"),
            F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"),
        )
    )
    totals = units.groupBy("source").agg(F.sum("size").alias("words"), F.count("*").alias("n")).limit(MOST_SOURCES + 1).collect()
    if len(totals) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources: the column names no data sets")
    words = {r["source"]: r["words"] for r in totals}
    wanted = targets(words, weights, most_copies)
    plan = docs.sparkSession.createDataFrame(
        [(r["source"], r["words"], wanted[r["source"]], wanted[r["source"]] / max(1, r["words"]), max(1, -(-r["n"] // bucket_rows))) for r in totals],
        "plan_source string, source_size long, target double, rate double, buckets long",
    )
    schema = "id long, key long, source string, size long, whole long, share double, draw long, bucket long"
    rate = F.when(F.col("size") > 0, F.col("rate")).otherwise(0.0)
    now = (
        units.join(F.broadcast(plan), F.col("source").eqNullSafe(F.col("plan_source")))
        .withColumn("whole", F.floor(rate).cast("long"))
        .withColumn("share", rate - F.col("whole"))
        .withColumn("draw", F.xxhash64("id", "key", F.lit(seed)))
        .withColumn("bucket", F.pmod("draw", "buckets"))
        .select("id", "key", F.col("source").cast("string").alias("source"), "size", "whole", "share", "draw", "bucket")
    )
    done, buckets, level = None, max((-(-r["n"] // bucket_rows) for r in totals), default=1), 0
    while True:
        last = buckets <= 1
        rounded = cut(now.groupBy("source", "bucket").applyInArrow(_settle(last, seed, level), schema))
        settled = rounded if last else rounded.where("share = 0 or share = 1")
        done = settled if done is None else done.unionByName(settled)
        if last:
            break
        now = rounded.where("share > 0 and share < 1").withColumn("bucket", F.floor(F.col("bucket") / FAN_IN).cast("long"))
        buckets, level = -(-buckets // FAN_IN), level + 1
    copies = F.col("whole") + F.col("share").cast("long")
    return done.join(F.broadcast(plan), F.col("source").eqNullSafe(F.col("plan_source"))).select(
        F.col("id").alias(id_col), "key", F.col("source").alias(source_col), "size", "source_size", "target",
        copies.alias("copies"), (copies * F.col("size")).alias("taken"),
    )


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    mixed = mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return mixed.select("doc_id", "source", "copies", "size", "source_size", "target", "taken")


def repeat_taken(docs: DataFrame) -> DataFrame:
    """``docs`` with every row as often as the mix takes it (0 to 3 times), with its columns.

    Rows that repeat an id and text come out as often as the mix takes all of them.
    """
    own = "__mix"  # no column of the table begins with it
    while any(c.lower().startswith(own) for c in docs.columns):
        own += "_"
    taken = (
        mix(docs).groupBy(F.col("doc_id").alias(f"{own}id"), F.col("key").alias(f"{own}key")).agg(F.sum("copies").cast("int").alias(f"{own}copies"))
        .where(F.col(f"{own}copies") > 0)
    )
    keyed = docs.withColumn(f"{own}text", text_key(F.col("text")))
    joined = keyed.join(taken, F.col("doc_id").eqNullSafe(F.col(f"{own}id")) & (F.col(f"{own}text") == F.col(f"{own}key")))
    return (
        joined.dropDuplicates(["doc_id", f"{own}text"])
        .withColumn(f"{own}copy", F.explode(F.sequence(F.lit(1), F.col(f"{own}copies"))))
        .select([f"`{c}`" for c in docs.columns])
    )
