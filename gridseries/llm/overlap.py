"""Near copies by exact similarity of word shingles, SimHash first.

Two texts are near copies if the Jaccard similarity of their sets of hashed word shingles reaches a
bound. The fingerprints of the sets give the first candidates, by multi-index hashing. Copies of a
similarity near 0.8 differ in ten of 64 bits, which no lookup within three bits reaches, so prefixes
find the rest: with all sets in one order, two sets that reach the bound share a member among the
first ``n - ceil(bound * n) + 1`` of each, and no pair is missed. The order puts members that many
texts have last; it decides how many candidates there are, never the result. Candidates
whose bitmaps differ in more places than the bound allows are no near copies (a bitmap holds the
parities of a set's hashes, so it differs in no more places than the set); all others are verified on
the whole sets.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridseries.llm.common import arrow_rows, components, cut, stored_tables, text_key
from gridseries.llm.simhash import forest, majority

SEED = 42
#: So many candidate pairs are broadcast to the scan that fetches their texts (115 MB); more are joined by a shuffle.
MOST_BROADCAST = 500_000
#: Places of the bitmap that stands beside bucket members.
SKETCH_BITS = 512
#: From this size on a group of near copies meets others' texts by a few of its members first.
LARGE_GROUP, LAGS, FIRST_TRIES = 8, 3, 6
#: Texts in which common shingles are looked for, and how many of these are set last at most.
SAMPLE = 5_000
MOST_COMMON = 200_000


def shingle_set(text: str | None, shingle: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles; a shorter text is one shingle, a wordless one has none."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, dtype=np.int64)
    runs = [words] if len(words) < shingle else zip(*(words[i:] for i in range(shingle)), strict=False)
    digest, join = xxhash.xxh64_intdigest, b" ".join
    return np.unique(np.fromiter((digest(join(run), SEED) for run in runs), dtype="<u8").view(np.int64))


def _set_column(text: Column, shingle: int) -> Column:
    @F.pandas_udf("array<long>")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([shingle_set(t, shingle) for t in batch], dtype=object)

    return of(text)


def parities(made: np.ndarray, places: int = 0) -> bytes:
    """Bitmap with about a place for each hash (or ``places``): whether an odd number of hashes falls there."""
    places = places or max(64, 1 << max(0, len(made) - 1).bit_length())
    counts = np.bincount((made.view(np.uint64) & np.uint64(places - 1)).astype(np.int64), minlength=places)
    return np.packbits((counts & 1).astype(np.uint8)).tobytes()


def least_difference(left: bytes, right: bytes) -> int:
    """No more than the number of members that only one of the two sets has."""
    a, b = sorted((np.frombuffer(left, np.uint8), np.frombuffer(right, np.uint8)), key=len)
    folded = np.bitwise_xor.reduce(b.reshape(-1, len(a)), axis=0)
    return int(np.bitwise_count(a ^ folded).sum())


def _likely_column(u: Column, v: Column, percent: int) -> Column:
    """Whether two kinds (structs of ``n`` and ``bits``) may reach the bound."""

    @F.pandas_udf("boolean")
    def of(u: pd.DataFrame, v: pd.DataFrame) -> pd.Series:
        most = (u.n + v.n) * (100 - percent)
        return pd.Series([least_difference(a, b) * (100 + percent) <= m for a, b, m in zip(u.bits, v.bits, most, strict=True)], dtype=bool)

    return of(u, v)


def _prefix_column(text: Column, shingle: int, percent: int, common: np.ndarray) -> Column:
    """``kind`` (hash of the set), its SimHash ``fp``, its size ``n``, its bitmap ``bits``, a bitmap of equal
    length for all, ``sketch``, and the ``prefix`` that must meet that of a near copy."""
    order = np.argsort(common)  # ``common`` stands from the rarest to the most frequent
    known = common[order]

    @F.pandas_udf("kind long, fp long, n int, bits binary, sketch array<long>, prefix array<long>")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for t in batch:
                made = shingle_set(t, shingle)
                n = len(made)
                place = np.zeros(n, dtype=np.int64)
                if n and len(known):
                    at = np.minimum(np.searchsorted(known, made), len(known) - 1)
                    place = np.where(known[at] == made, order[at] + 1, 0)
                prefix = made[np.argsort(place, kind="stable")][: n - -(-percent * n // 100) + 1]
                kind = np.uint64(xxhash.xxh64_intdigest(made.tobytes(), SEED)).astype(np.int64)
                rows.append((kind, np.uint64(majority(made)).astype(np.int64), n, parities(made), np.frombuffer(parities(made, SKETCH_BITS), np.int64), prefix))
            yield pd.DataFrame(rows, columns=["kind", "fp", "n", "bits", "sketch", "prefix"])

    return of(text)


def common_shingles(docs: DataFrame, text_col: str = "text", shingle: int = 5) -> np.ndarray:
    """Hashes of shingles that stand in several texts of a sample, the most frequent last."""
    every = max(1, docs.count() // SAMPLE)
    some = docs.where(F.pmod(F.xxhash64(text_col), F.lit(every)) == 0).select(text_col).distinct()
    found = (
        some.select(F.explode(_set_column(F.col(text_col), shingle)).alias("token"))
        .groupBy("token").count().where("count > 2").orderBy(F.desc("count"), "token").limit(MOST_COMMON)
    )
    return found.select("token").toPandas()["token"].to_numpy(dtype=np.int64)[::-1].copy()


def _possible(percent: int) -> Column:
    """Whether the first shared member leaves enough for the bound: sizes, and what follows it in both sets."""
    least = F.least(F.col("n") - F.col("pos"), F.col("n2") - F.col("pos2"))
    return least * (100 + percent) >= (F.col("n") + F.col("n2")) * percent


def _sketches_near(percent: int) -> Column:
    """What ``least_difference`` tells, of the sketches, inside a join."""
    places = F.aggregate(F.zip_with("sketch", "sketch2", lambda a, b: F.bit_count(a.bitwiseXOR(b))), F.lit(0), lambda s, x: s + x)
    return places * (100 + percent) <= (F.col("n") + F.col("n2")) * (100 - percent)


def _similar_column(left: Column, right: Column, shingle: int, percent: int) -> Column:
    @F.pandas_udf("boolean")
    def of(left: pd.Series, right: pd.Series) -> pd.Series:
        found = []
        for t, u in zip(left, right, strict=True):
            a, b = shingle_set(t, shingle), shingle_set(u, shingle)
            both = len(np.intersect1d(a, b, assume_unique=True))
            found.append(both * (100 + percent) >= (len(a) + len(b)) * percent)
        return pd.Series(found, dtype=bool)

    return of(left, right)


def _verified(
    pairs: DataFrame, docs: DataFrame, kinds: DataFrame, shingle: int, percent: int, stored: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """The pairs (``u``, ``v``) of kinds whose whole sets reach the bound.

    Only texts of pairs that the bitmaps leave are fetched, one of each kind, and shuffled once for each pair.
    """
    u, v = (kinds.select(F.col("kind").alias(k), F.struct("n", "bits").alias(f"{k}_set")) for k in ("u", "v"))
    pairs = pairs.select(F.greatest("kind", "kind2").alias("u"), F.least("kind", "kind2").alias("v")).distinct()
    pairs = stored(pairs.join(u, "u").join(v, "v").where(_likely_column(F.col("u_set"), F.col("v_set"), percent)).select("u", "v"))
    # joins of what is exploded, packed by Parquet or holds arrays are never broadcast: Spark takes these for smaller than they are
    wanted = pairs.select("u", "v", F.explode(F.array("u", "v")).alias("kind")).hint("merge").join(kinds.select("kind", "rep"), "kind")
    wanted = wanted.select("u", "v", "kind", F.col("rep.id").alias("rep_id"), F.col("rep.text_key").alias("rep_key"))
    if pairs.count() <= MOST_BROADCAST:
        wanted = F.broadcast(wanted)
    texts = docs.join(wanted, (F.col("text_key") == F.col("rep_key")) & F.col("id").eqNullSafe(F.col("rep_id")))
    both = texts.groupBy("u", "v").agg(F.min_by("text", "kind").alias("a"), F.max_by("text", "kind").alias("b"))
    with arrow_rows(docs.sparkSession, 500):
        return stored(both.where(_similar_column(F.col("a"), F.col("b"), shingle, percent)).select("u", "v"))


def _by_fingerprint(kinds: DataFrame, percent: int, stored: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Candidates (``kind``, ``kind2``) whose fingerprints are equal or within three bits, and whose sizes allow the bound."""
    named = kinds.groupBy("fp").agg(F.min(F.struct("kind", "n")).alias("hub"))
    equal = kinds.join(named, "fp").select("kind", "n", F.col("hub.kind").alias("kind2"), F.col("hub.n").alias("n2"))
    u, v = (named.select(F.col("fp").alias(c), F.col("hub").alias(f"{c}_hub")) for c in ("u", "v"))
    linked = forest(named.select("fp"), keep=stored).join(u, "u").join(v, "v").select(
        F.col("u_hub.kind").alias("kind"), F.col("u_hub.n").alias("n"), F.col("v_hub.kind").alias("kind2"), F.col("v_hub.n").alias("n2")
    )
    sizes = F.least("n", "n2") * 100 >= F.greatest("n", "n2") * percent
    return equal.unionByName(linked).where((F.col("kind") != F.col("kind2")) & sizes).select("kind", "kind2")


def near_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, percent: int = 80
) -> DataFrame:
    """One row per input row: id, ``text_key``, ``fp`` (hash of the shingle set) and ``component_id``, the
    smallest id reachable over pairs of a similarity of ``percent`` hundredths or more.

    Rows with a null id are linked by their text, but never name a component (null only if no member has an
    id). First the pairs that fingerprints give are compared, and the members of a bucket of equal prefix
    members with the bucket's first one and the one before, then texts beside a large group with a few of its
    members; last the pairs of a bucket that are not connected by that are compared, all of them. So large groups
    of near copies, which the first comparisons connect, do not give the square of their size.
    """
    with stored_tables(docs.sparkSession) as stored:
        return cut(_near_copies(docs, id_col, text_col, shingle, percent, stored))


def _near_copies(
    docs: DataFrame, id_col: str, text_col: str, shingle: int, percent: int, stored: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    common = common_shingles(docs, text_col, shingle)
    made = _prefix_column(F.col(text_col), shingle, percent, common)
    keyed = docs.select(F.col(id_col).alias("id"), text_key(F.col(text_col)).alias("text_key"), F.col(text_col).alias("text"))
    with arrow_rows(docs.sparkSession, 2000):
        rows = stored(keyed.select("id", "text_key", made.alias("x")).select("id", "text_key", "x.*"))
    kinds = stored(
        rows.groupBy("kind").agg(
            F.min("fp").alias("fp"), F.min("n").alias("n"), F.min("bits").alias("bits"), F.min("sketch").alias("sketch"),
            F.min("id").alias("least_id"),
            F.min(F.struct(F.col("id").isNull().alias("late"), "id", "text_key")).alias("rep"),
        )
    )
    bucket = Window.partitionBy("token")
    index = rows.dropDuplicates(["kind"]).select("kind", "n", F.posexplode("prefix").alias("pos", "token"))
    shared = stored(index.withColumn("members", F.count("*").over(bucket)).where("members > 1"))
    me, ordered = F.struct("kind", "n", "pos"), bucket.orderBy("kind")
    few = shared.withColumns({"hub": F.first(me).over(ordered), "before": F.lag(me).over(ordered)})
    few = few.select("kind", "n", "pos", "members", F.explode(F.array("hub", "before")).alias("o")).select(
        "kind", "n", "pos", "members", F.col("o.kind").alias("kind2"), F.col("o.n").alias("n2"), F.col("o.pos").alias("pos2")
    )
    few = few.where((F.col("kind") != F.col("kind2")) & _possible(percent))
    # larger buckets are looked at again; the pair of a bucket of two is compared here, whatever else its members meet
    twos = few.where("members = 2").select("kind", "kind2").distinct()
    few = few.where("members > 2").groupBy("kind").agg(F.explode(F.array(F.min("kind2"), F.max("kind2"))).alias("kind2")).unionByName(twos)
    roots = components(_verified(_by_fingerprint(kinds, percent, stored).unionByName(few), keyed, kinds, shingle, percent, stored), keep=stored)

    def joined(candidates: DataFrame) -> DataFrame:
        """The components with those of the candidates that the whole sets confirm."""
        more = _verified(candidates.select("kind", "kind2"), keyed, kinds, shingle, percent, stored)
        return roots if more.isEmpty() else components(roots.select(F.col("node").alias("u"), F.col("root").alias("v")).unionByName(more), keep=stored)

    def unsettled(members: DataFrame) -> DataFrame:
        """The members of buckets that hold more than one group, with their group's ``root`` and ``size``."""
        sizes = roots.groupBy("root").agg((F.count("*") + 1).alias("size"))
        of = roots.unionByName(sizes.select(F.col("root").alias("node"), "root")).join(sizes, "root")
        here = members.select("kind", "n", "pos", "token").join(of, F.col("kind") == F.col("node"), "left").select(
            "kind", "n", "pos", "token", F.coalesce("root", "kind").alias("root"), F.coalesce("size", F.lit(1)).alias("size")
        )
        here = here.withColumns({"least": F.min("root").over(bucket), "most": F.max("root").over(bucket)})
        return stored(here.where("least <> most").drop("least", "most"))

    # a text that the first comparison left beside a large group meets a few of the group at random
    here = unsettled(shared.where("members > 2"))  # a bucket of two is settled by now
    them, mixed = F.struct("kind", "n", "pos", "root", "size"), bucket.orderBy(F.xxhash64("kind", "token"), "kind")
    some = here.withColumn("others", F.array(*[F.lag(them, k).over(mixed) for k in range(1, LAGS + 1)]))
    some = some.select(*here.columns, F.explode("others").alias("o"))
    some = some.select(*here.columns, *[F.col(f"o.{c}").alias(f"{c}2") for c in ("kind", "n", "pos", "root", "size")])
    some = some.where((F.col("root") != F.col("root2")) & (F.greatest("size", "size2") >= LARGE_GROUP) & _possible(percent))
    lone, large = (F.when((F.col("size") < F.col("size2")) == first, F.col("kind")).otherwise(F.col("kind2")) for first in (True, False))
    some = some.select(lone.alias("kind"), large.alias("kind2")).groupBy("kind").agg(
        F.slice(F.sort_array(F.collect_set(F.struct(F.xxhash64("kind", "kind2").alias("draw"), "kind2"))), 1, FIRST_TRIES).alias("tries")
    ).select("kind", F.explode("tries.kind2").alias("kind2"))
    roots = joined(some)
    # whatever is left: all pairs of a bucket that the first shared member, sizes and bitmaps allow
    here = stored(unsettled(here).hint("merge").join(kinds.select("kind", "sketch"), "kind").select("token", "kind", "n", "pos", "root", "sketch"))
    other = here.select("token", *[F.col(c).alias(f"{c}2") for c in ("kind", "n", "pos", "root", "sketch")])
    rest = here.hint("merge").join(other, "token").where((F.col("root") < F.col("root2")) & _possible(percent) & _sketches_near(percent))
    roots = joined(rest)
    rooted = kinds.join(roots, kinds["kind"] == roots["node"], "left").select(
        "kind", "least_id", F.coalesce("root", "kind").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    by_kind = rooted.join(least, "root").select("kind", "component_id")
    return rows.select("id", "text_key", "kind").join(by_kind, "kind").select(F.col("id").alias(id_col), "text_key", F.col("kind").alias("fp"), "component_id")
