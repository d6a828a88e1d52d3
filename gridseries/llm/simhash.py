"""SimHash near-duplicates by multi-index hashing.

A document's fingerprint is the bitwise majority of the 64-bit hashes of its word shingles. The 64
bits are cut into two segments of 32; two fingerprints that differ in at most three bits differ in
at most one bit of some segment, so looking up the ball of radius one round each segment finds
them all. Matches are verified on the complete distance.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridseries.llm.common import components, cut, text_key

#: Values the fingerprint's definition fixes.
SEED = 42
BITS = 64
MAX_DISTANCE = 3


def majority(hashes: np.ndarray) -> int:
    """Bitwise majority of 64-bit hashes, unsigned; ties and no hashes give zeros."""
    ones = np.zeros(BITS, dtype=np.int64)
    for start in range(0, len(hashes), 8192):  # a very long text is counted in pieces
        piece = hashes[start : start + 8192].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(piece, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(text: str | None, shingle: int = 3, count: int = 1) -> list[int]:
    """Unsigned 64-bit SimHashes of one text; those after the first are of its hashes mixed anew. A
    null or wordless text has fingerprints zero."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return [0] * count
    runs = [words] if len(words) < shingle else zip(*(words[i:] for i in range(shingle)), strict=False)
    digest, join = xxhash.xxh64_intdigest, b" ".join
    hashes = np.fromiter((digest(join(run), SEED) for run in runs), dtype="<u8")
    out = [majority(hashes)]
    for k in range(1, count):
        mixed = (hashes ^ (hashes >> np.uint64(29))) * np.uint64(digest(str(k), SEED) | 1)
        out.append(majority(mixed ^ (mixed >> np.uint64(32))))
    return out


def fingerprint(text: str | None, shingle: int = 3) -> int:
    return fingerprints(text, shingle)[0]


def fingerprint_column(text: Column, shingle: int = 3, count: int = 1) -> Column:
    """The fingerprints as an array of signed longs."""

    @F.pandas_udf("array<long>")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            made = np.array([fingerprints(t, shingle, count) for t in batch], dtype=np.uint64).view(np.int64)
            yield pd.Series(list(made.reshape(len(batch), count)), dtype=object)

    return of(text)


def hex_column(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _ball(segment: Column, width: int) -> Column:
    """(value, is the centre) of a segment and of the segments with one of its set bits cleared.

    Of two segments that differ in one bit, the one that has it set meets the other this way, so
    clearing alone is enough and halves the rows.
    """
    cleared = F.transform(
        F.filter(F.sequence(F.lit(0), F.lit(width - 1)), lambda i: F.getbit(segment, i) == 1),
        lambda i: F.struct(
            segment.bitwiseAND(F.bitwise_not(F.call_function("shiftleft", F.lit(1).cast("long"), i))).alias("value"),
            F.lit(False).alias("home"),
        ),
    )
    return F.concat(F.array(F.struct(segment.alias("value"), F.lit(True).alias("home"))), cleared)


def _split(rows: DataFrame, width: int) -> DataFrame:
    """Index rows one level finer: ``at``..``at + width`` are the bits that ``key`` leaves open.

    Each row gives the balls of the two halves of its open bits. The half that was not looked up
    stays open, so ``at`` becomes the start of the other half.
    """
    half = width // 2
    mask = F.lit((1 << half) - 1).cast("long")

    def probes(k: int) -> Column:
        start = F.col("at") + half * k
        other = F.col("at") + half * (1 - k)
        segment = F.call_function("shiftrightunsigned", F.col("fp"), start).bitwiseAND(mask)
        return F.transform(
            _ball(segment, half),
            lambda x: F.struct(
                F.xxhash64(F.col("key"), F.lit(k), start, x["value"]).alias("key"), x["home"].alias("home"), other.alias("at")
            ),
        )

    return rows.select("fp", F.explode(F.concat(probes(0), probes(1))).alias("x")).select("fp", "x.key", "x.home", "x.at")


def _check_distance(max_distance: int) -> None:
    if not 0 <= max_distance <= MAX_DISTANCE:
        raise ValueError("two segments with balls of radius one reach a distance of three bits at most")


def _buckets(fingerprints: DataFrame, bucket_limit: int, keep: Callable[[DataFrame], DataFrame] = cut) -> Iterator[DataFrame]:
    """Rows (``fp, key, home``) of the buckets in which fingerprints may meet, level by level.

    A bucket of more than ``bucket_limit`` rows is not given as it stands: its rows are indexed
    again by the halves of the bits that its key leaves open (32, then 16 bits). After the last
    level a key fixes 56 of the 64 bits up to three flips, so no bucket outgrows a constant,
    however alike the fingerprints are, and no link is lost.
    """
    fps = fingerprints.select(F.col("fp").cast("long").alias("fp")).where("fp is not null").distinct()
    rows = _split(fps.select("fp", F.lit(0).cast("long").alias("key"), F.lit(0).alias("at")), BITS)
    for width in (32, 16, 0):
        # buckets with nobody at home, or one row at all, link nothing
        busy = rows.groupBy("key").agg(F.count("*").alias("rows"), F.count_if("home").alias("homes"))
        # never broadcast: the rows' size is taken for that of the fingerprints they were exploded from
        here = keep(rows.hint("merge").join(busy.where("homes > 0 and rows > 1"), "key").select("fp", "key", "home", "at", "rows"))
        hot = F.col("rows") > bucket_limit
        yield (here.where(~hot) if width else here).select("fp", "key", "home")
        if not width or here.where(hot).isEmpty():
            return
        rows = _split(here.where(hot), width)


def links(fingerprints: DataFrame, max_distance: int = MAX_DISTANCE, bucket_limit: int = 256) -> DataFrame:
    """All pairs (``u``, ``v``) of distinct fingerprints (long column ``fp``) that differ in 1 to 3 bits.

    A group of alike fingerprints gives all its pairs; ``forest`` connects the same with few.
    """
    _check_distance(max_distance)
    found = None
    for rows in _buckets(fingerprints, bucket_limit):
        centres = rows.where("home").select("key", F.col("fp").alias("v"))
        near = F.bit_count(F.col("fp").bitwiseXOR(F.col("v"))) <= max_distance
        pairs = (
            rows.join(centres, (rows["key"] == centres["key"]) & near & (F.col("fp") != F.col("v")))
            .select(F.greatest("fp", "v").alias("u"), F.least("fp", "v").alias("v"))
        )
        found = pairs if found is None else found.unionByName(pairs)
    return found.distinct()


def _spanning(fps: np.ndarray, home: np.ndarray, max_distance: int) -> list[tuple[int, int]]:
    """Links of one bucket, as few as connect what all its links connect."""
    bits = fps.view(np.uint64)
    near = np.bitwise_count(bits[:, None] ^ bits[None, :]) <= max_distance
    near &= home[:, None] | home[None, :]
    open_, kept = np.ones(len(fps), dtype=bool), []
    for start in range(len(fps)):
        if not open_[start]:
            continue
        open_[start] = False
        edge = np.array([start])
        while len(edge):
            met = near[edge] & open_
            new = np.flatnonzero(met.any(axis=0))
            kept += zip(fps[new].tolist(), fps[edge[met[:, new].argmax(axis=0)]].tolist(), strict=True)
            open_[new] = False
            edge = new
    return kept


def forest(
    fingerprints: DataFrame, max_distance: int = MAX_DISTANCE, bucket_limit: int = 256, keep: Callable[[DataFrame], DataFrame] = cut
) -> DataFrame:
    """Pairs (``u``, ``v``) that differ in 1 to 3 bits and connect the same fingerprints as all such pairs.

    A bucket gives fewer pairs than it has rows, so the result grows with the rows, not with the
    square of a group of alike fingerprints.
    """
    _check_distance(max_distance)

    @F.pandas_udf("array<struct<u:bigint,v:bigint>>")
    def spanning(fps: pd.Series, homes: pd.Series) -> pd.Series:
        return pd.Series(
            [[{"u": max(e), "v": min(e)} for e in _spanning(np.asarray(f, dtype=np.int64), np.asarray(h, dtype=bool), max_distance)] for f, h in zip(fps, homes, strict=True)],
            dtype=object,
        )

    found = None
    for rows in _buckets(fingerprints, bucket_limit, keep):
        members = rows.groupBy("key").agg(F.collect_list("fp").alias("fps"), F.collect_list("home").alias("homes"))
        pairs = members.select(F.explode(spanning("fps", "homes")).alias("x")).select("x.u", "x.v")
        found = pairs if found is None else found.unionByName(pairs)
    return found.distinct()


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 3,
    max_distance: int = MAX_DISTANCE,
    bucket_limit: int = 256,
    count: int = 1,
) -> DataFrame:
    """One row per input row: id, ``text_key``, ``fp`` (long) and ``component_id``.

    ``component_id`` is the smallest id reachable over links, the row's own included. With a ``count``
    above 1 texts link if any of so many fingerprints of theirs link, which finds more of the near copies
    whose first fingerprints lie just too far apart. Rows of equal text have equal fingerprints and so
    one component. Null texts count as empty; wordless texts share fingerprint zero. Rows with a null id
    are kept and linked by their text, but never name a component (null only if no member has an id).
    Repeated rows stay repeated, other columns are ignored, an empty table gives an empty result.
    """
    rows = cut(
        docs.select(
            F.col(id_col).alias("id"), text_key(F.col(text_col)).alias("text_key"), fingerprint_column(F.col(text_col), shingle, count).alias("fps")
        ).select("id", "text_key", F.col("fps")[0].alias("fp"), "fps")
    )
    # equal first fingerprints link, so the first fingerprint stands for all texts that have it
    kinds = rows.groupBy("fp").agg(F.min("id").alias("least_id"))
    edges = forest(kinds, max_distance, bucket_limit)
    for k in range(1, count):
        also = rows.select("fp", F.col("fps")[k].alias("also")).distinct()
        named = also.groupBy("also").agg(F.min("fp").alias("name"))
        found = forest(named.select(F.col("also").alias("fp")), max_distance, bucket_limit)
        u, v = (named.select(F.col("also").alias(c), F.col("name").alias(f"{c}_name")) for c in ("u", "v"))
        linked = found.join(u, "u").join(v, "v").select(F.col("u_name").alias("u"), F.col("v_name").alias("v"))
        equal = also.join(named, "also").select(F.col("fp").alias("u"), F.col("name").alias("v")).where("u <> v")
        # cut for each fingerprint: the driver never holds one plan of them all
        edges = cut(edges.unionByName(linked).unionByName(equal))
    roots = components(edges)
    rooted = kinds.join(roots, kinds["fp"] == roots["node"], "left").select(
        "fp", "least_id", F.coalesce("root", "fp").alias("root")
    )
    named = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    by_fp = rooted.join(named, "root").select("fp", "component_id")
    return rows.join(by_fp, "fp").select(F.col("id").alias(id_col), "text_key", "fp", "component_id")


def op4_simhash(spark, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return near_duplicates(docs).select("doc_id", hex_column(F.col("fp")).alias("fingerprint"), "component_id")


def one_per_group(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one row left of each near-duplicate group: the one with the smallest id.

    Of rows that repeat an id and text, one stays. Groups whose ids are all null keep one row.
    """
    return keep_first(docs, near_duplicates(docs, **options))


def keep_first(docs: DataFrame, groups: DataFrame) -> DataFrame:
    """``docs`` with the first row of each group of ``near_duplicates``."""
    keep = groups.groupBy("component_id", F.when(F.col("component_id").isNull(), F.col("fp")).alias("nameless")).agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "text_key")).alias("best")
    )
    keep = keep.select(F.col("best.doc_id").alias("keep_id"), F.col("best.text_key").alias("keep_key"))
    columns = docs.columns
    keyed = docs.withColumn("__key", text_key(F.col("text")))
    kept = keyed.join(
        keep, keyed["doc_id"].eqNullSafe(keep["keep_id"]) & (keyed["__key"] == keep["keep_key"]), "left_semi"
    )
    return kept.dropDuplicates(["doc_id", "__key"]).select(columns)
