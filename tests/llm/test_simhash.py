import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridseries.llm import simhash
from gridseries.llm.common import components, cut, stored_tables


def brute_components(fps):
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 3
    label = np.arange(len(fps))
    while True:
        new = np.where(near, label[None, :], len(fps)).min(axis=1)
        if (new == label).all():
            return label
        label = new


def test_fingerprint_against_plain_definition(spark):
    text = "The Quick\tbrown fox  jumps over\nthe lazy dog the quick brown fox"
    words = text.lower().split()
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)]
    # the engine's own XXH64 with seed 42
    hashes = [r[0] % 2**64 for r in spark.createDataFrame([(s,) for s in shingles], "s string").select(F.xxhash64("s")).collect()]
    want = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    assert simhash.fingerprint(text) == want
    one = spark.createDataFrame([("two words",)], "s string").select(F.xxhash64("s")).first()[0] % 2**64
    assert simhash.fingerprint(" Two  WORDS ") == one
    assert simhash.fingerprint(None) == simhash.fingerprint(" \n\t") == 0
    # only ASCII letters are folded, only ASCII white space parts words
    assert simhash.fingerprint("É a") != simhash.fingerprint("é a")
    assert simhash.fingerprint("a b") != simhash.fingerprint("a b")


def test_links_of_clusters_in_every_bucket_size(spark):
    random.seed(3)
    fps = set()
    for centre in (0, 2**64 - 1, random.getrandbits(64), random.getrandbits(64)):
        for _ in range(40):
            x = centre
            for b in random.sample(range(64), random.choice((0, 1, 2, 3, 4))):
                x ^= 1 << b
            fps.add(x)
        for low in range(30):  # many that agree in the upper half
            fps.add((centre & ~0xFF) | low)
    fps = np.array(sorted(fps), dtype=np.uint64)
    near = np.argwhere(np.triu(np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 3, 1))
    want = {frozenset((int(fps[i].astype(np.int64)), int(fps[j].astype(np.int64)))) for i, j in near}
    frame = spark.createDataFrame([(int(f.astype(np.int64)),) for f in fps], "fp long")
    for limit in (10_000, 8, 1):
        got = simhash.links(frame, bucket_limit=limit).collect()
        assert len(got) == len(want) and {frozenset(r) for r in got} == want


def test_components_of_all_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = simhash.near_duplicates(docs).toPandas().sort_values("doc_id").reset_index(drop=True)
    label = brute_components(got.fp.to_numpy().view(np.uint64))
    assert (got.doc_id.to_numpy()[label] == got.component_id).all()


def test_nulls_repeats_long_texts_and_clashing_columns(spark):
    long = " ".join(f"w{i % 977}" for i in range(60_000))
    rows = [(3, None), (1, ""), (2, "a b c d"), (2, "a b c d"), (None, "a b c d"), (7, long), (8, long + " w1"), (None, "only nameless")]
    docs = spark.createDataFrame([(*r, 0, 1) for r in rows], "doc_id long, text string, fp int, component_id int")
    got = sorted(((r["doc_id"], r["component_id"]) for r in simhash.near_duplicates(docs).collect()), key=str)
    assert got == sorted([(3, 1), (1, 1), (2, 2), (2, 2), (None, 2), (7, 7), (8, 7), (None, None)], key=str)
    kept = simhash.one_per_group(docs)
    assert kept.columns == docs.columns
    assert sorted((str(r["doc_id"]) for r in kept.collect())) == ["1", "2", "7", "None"]
    assert simhash.near_duplicates(docs.limit(0)).count() == 0 and simhash.one_per_group(docs.limit(0)).count() == 0


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(5, k) for k in range(6, 40)] + [(7, 7), (200, 201), (201, 200), (None, 3)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 100 for i in range(101, 161)}, **{k: 5 for k in range(6, 40)}, 201: 200}


def test_more_fingerprints_find_more_near_copies(spark):
    random.seed(9)
    rows = []
    for k in range(60):
        words = [f"w{random.randrange(4000)}" for _ in range(120)]
        copy = list(words)
        for at in random.sample(range(120), 2):
            copy[at] = "changed"
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(copy))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [simhash.one_per_group(docs, count=n).count() for n in (1, 6)]
    assert 60 <= kept[1] < kept[0] <= 120
    ids = {r["doc_id"] // 2 for r in simhash.one_per_group(docs, count=6).collect()}
    assert len(ids) == 60  # no unlike document goes
    groups = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(docs, count=6).collect()}
    fps = [simhash.fingerprints(t, count=6) for _, t in rows]
    label = brute_any(fps)
    assert groups == {i: label[i] for i in range(len(rows))}


def brute_any(fps):
    """Smallest index reachable where any of the fingerprints links."""
    fps = np.array(fps, dtype=np.uint64)
    near = (np.bitwise_count(fps[:, None, :] ^ fps[None, :, :]) <= 3).any(axis=2)
    label = np.arange(len(fps))
    while True:
        new = np.where(near, label[None, :], len(fps)).min(axis=1)
        if (new == label).all():
            return label.tolist()
        label = new


@pytest.mark.parametrize("parquet", [False, True])
def test_exploded_fingerprints_are_never_broadcast(spark, parquet):
    """The threshold lies above the size of the fingerprints, but below that of the segments looked up."""
    random.seed(4)
    fps = spark.createDataFrame([(random.getrandbits(63),) for _ in range(1000)] + [(k,) for k in range(1000)], "fp long")
    key, plans = "spark.sql.autoBroadcastJoinThreshold", []
    spark.conf.set(key, "100000")
    try:
        with stored_tables(spark) as stored:

            def keep(frame):
                assert frame.collect()
                plans.append(frame._jdf.queryExecution().executedPlan().toString())
                return stored(frame) if parquet else cut(frame)

            for rows in simhash._buckets(fps, 8, keep):
                rows.count()
    finally:
        spark.conf.unset(key)
    assert len(plans) == 3 and all("SortMergeJoin" in p and "BroadcastHashJoin" not in p for p in plans)
