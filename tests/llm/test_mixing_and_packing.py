import numpy as np
import pytest

from gridseries.llm import mixing, packing


def brute_targets(sizes, weights, most):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    fixed = {}
    while True:
        rest = sum(sizes.values()) - sum(fixed.values())
        free = {s: rest * weight[s] / sum(weight[x] for x in order if x not in fixed) for s in order if s not in fixed}
        over = [s for s in free if free[s] > most * sizes[s]]
        if not over:
            return fixed | free
        fixed |= {s: most * sizes[s] for s in over}


def test_targets_reshare_the_excess():
    sizes = {"a": 1000, "b": 10, "c": 500, None: 3, "é": 200}
    got = mixing.targets(sizes)
    assert got == pytest.approx(brute_targets(sizes, mixing.WEIGHTS, 3.0))
    assert sum(got.values()) == pytest.approx(sum(sizes.values())) and got["b"] == 30
    assert mixing.targets({}) == {}


def test_pivot_keeps_words_and_expectations():
    size = np.sort(np.random.default_rng(0).integers(5, 500, 60))[::-1].astype(float)
    share = np.full(60, 0.37)
    runs = np.array([mixing.pivot(size, share, np.random.default_rng(k)) for k in range(800)])
    fractional = ((runs > 0) & (runs < 1)).sum(axis=1)
    assert fractional.max() <= 1
    assert np.allclose(runs @ size, (share * size).sum())  # every step keeps the words
    assert np.abs(runs.mean(axis=0) - 0.37).max() < 0.09  # and the expectation of each document


def test_mix_is_near_its_targets_and_agrees_with_itself(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = mixing.mix(docs, bucket_rows=7).toPandas()  # many buckets: several levels of the tree
    text = docs.toPandas().set_index("doc_id").text.str.split()
    assert all(len(text[i]) == n for i, n in zip(got.doc_id, got["size"], strict=True))
    assert (got.taken == got.copies * got["size"]).all() and got.copies.between(0, 3).all() and len(got) == 1000
    by = got.groupby("source").agg(taken=("taken", "sum"), target=("target", "first"), size=("size", "sum"), given=("source_size", "first"), biggest=("size", "max"))
    assert (by["size"] == by.given).all() and ((by.taken - by.target).abs() <= by.biggest).all()
    assert by.target.sum() == pytest.approx(by["size"].sum())
    again = mixing.mix(docs.repartition(5), bucket_rows=7).toPandas()
    assert got.sort_values("doc_id").copies.tolist() == again.sort_values("doc_id").copies.tolist()


def test_mix_of_nulls_repeats_and_clashing_columns(spark):
    rows = [(1, "a b c", None), (1, "a b c", None), (None, "d e", "s"), (2, None, "s"), (3, "", "t"), (2**60 + 1, "x y", "s")]
    docs = spark.createDataFrame([(*r, 5, 6) for r in rows], "doc_id long, text string, source string, size int, taken int")
    got = mixing.mix(docs).collect()
    assert len(got) == 6 and {r["doc_id"] for r in got} == {1, None, 2, 3, 2**60 + 1}
    assert all(r["taken"] == 0 for r in got if r["size"] == 0)
    assert mixing.mix(docs.limit(0)).count() == 0
    taken = mixing.repeat_taken(docs)
    assert taken.columns == docs.columns and taken.count() == sum(r["copies"] for r in got)


def plain_best_fit(sizes, sources, clusters, capacity):
    bins, out = [], []
    for z, s, c in zip(sizes, sources, clusters, strict=True):
        fits = [(b["left"], i) for i, b in enumerate(bins) if b["left"] >= z and b["left"] > 0 and (s < 0 or s not in b["s"]) and (c < 0 or c not in b["c"])]
        if fits:
            i = min(fits)[1]
        else:
            bins.append({"left": capacity, "s": set(), "c": set()})
            i = len(bins) - 1
        bins[i]["left"] -= z
        bins[i]["s"].add(s)
        bins[i]["c"].add(c)
        out.append(i)
    return out


def test_best_fit_against_plain_search():
    draw = np.random.default_rng(5)
    for _ in range(20):
        sizes = np.sort(draw.integers(0, 100, 120))[::-1].tolist()
        sources, clusters = draw.integers(-1, 6, 120).tolist(), draw.integers(-1, 9, 120).tolist()
        assert packing.best_fit(sizes, sources, clusters, 100) == plain_best_fit(sizes, sources, clusters, 100)


def test_pack_keeps_every_word_and_all_conflicts_apart(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = packing.pack(docs, capacity=300, shard_rows=200).toPandas()
    text = docs.toPandas().set_index("doc_id").text.str.split()
    by_doc = got.sort_values("piece").groupby("doc_id")
    assert all(g.n_words.sum() == len(text[i]) and (g.first_word.diff().dropna() == 300).all() for i, g in by_doc) and len(by_doc) == 1000
    bins = got.groupby(["shard", "bin"])
    assert bins.n_words.sum().max() <= 300
    assert not got.duplicated(["shard", "bin", "source"]).any() and not got.duplicated(["shard", "bin", "cluster"]).any()
    for _, g in bins:
        g = g.sort_values(["start", "n_words"])
        assert (g.start.to_numpy() == np.concatenate([[0], g.n_words.cumsum()[:-1]])).all()


def test_pack_of_nulls_repeats_and_clashing_columns(spark):
    rows = [(1, None, "s"), (2, "", None), (3, "a b c", "s"), (3, "a b c", "s"), (None, "q r", None), (4, "w " * 5000, "t")]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, source string, bin int, piece int")
    got = packing.pack(docs).collect()
    assert len(got) == 8 and sum(r["n_words"] for r in got) == 5008
    assert packing.pack(docs.limit(0)).count() == 0


def test_columns_named_like_those_of_the_mix(spark):
    docs = spark.createDataFrame([(k, f"some words {k}", "s", k, "x", 3, "y") for k in range(20)], "doc_id long, text string, source string, taken_id long, taken_key string, taken_copies int, __mix string")
    assert mixing.repeat_taken(docs).columns == docs.columns and mixing.repeat_taken(docs).count() > 0


def test_long_texts_are_spread_over_shards(spark):
    docs = spark.createDataFrame([(k, "w " * 40_000, None) for k in range(3)], "doc_id long, text string, source string")
    packed = packing.pack(docs, capacity=100, shard_rows=100).groupBy("shard").count().collect()
    assert len(packed) >= 8 and max(r["count"] for r in packed) < 250 and sum(r["count"] for r in packed) == 1200
