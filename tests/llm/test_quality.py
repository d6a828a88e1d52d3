import zlib

import numpy as np
from pyspark.sql import functions as F

from gridseries.llm import quality


def test_dual_coordinate_descent_separates_and_meets_its_optimum():
    draw = np.random.default_rng(1)
    rows = [np.unique(draw.integers(0, 40, 8)) + 100 * (i % 2) for i in range(200)]
    labels = np.arange(200) % 2
    scale = quality.log_count_ratio(rows, labels)
    w, b = quality.dual_coordinate_descent(rows, labels, scale, epochs=200)
    y = np.where(labels == 1, 1, -1)
    margin = np.array([w[r] @ scale[r] / np.sqrt(len(r)) + b for r in rows]) * y
    assert (margin > 0).all()
    # at the optimum the primal is as low as at any nearby point
    loss = lambda w, b: 0.5 * (w @ w + b * b) + np.maximum(0, 1 - np.array([w[r] @ scale[r] / np.sqrt(len(r)) + b for r in rows]) * y).sum()
    best = loss(w, b)
    assert all(loss(w + 0.01 * draw.standard_normal(len(w)) * (w != 0), b) > best - 1e-3 for _ in range(5))


def test_log_count_ratio_by_hand():
    rows, labels = [np.array([1, 2]), np.array([2])], np.array([1, 0])
    got = quality.log_count_ratio(rows, labels)
    n1, n0 = quality.SLOTS + 2, quality.SLOTS + 1
    assert np.isclose(got[1], np.log(2 / n1) - np.log(1 / n0)) and np.isclose(got[2], np.log(2 / n1) - np.log(2 / n0))


def test_held_out_accuracy_and_that_held_out_labels_are_not_used(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = quality.classify(docs, labels).toPandas()
    assert len(got) == docs.count()
    assert all(h == (zlib.crc32(str(i).encode()) % 5 == 0) for i, h in zip(got.doc_id, got.held_out, strict=True))
    known = got.merge(labels.toPandas(), on="doc_id")
    test = known[known.held_out]
    assert (test.predicted == test.quality).mean() >= 0.95
    assert (got.predicted == (got.score >= 0.3)).all() and got.score.between(0, 1).all()
    flipped = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    again = quality.classify(docs, flipped).toPandas()
    assert np.allclose(got.sort_values("doc_id").score, again.sort_values("doc_id").score)


def test_nulls_repeats_one_class_and_no_labels(spark):
    rows = [(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "c"), (4, "x " * 50_000)]
    docs = spark.createDataFrame([(*r, 9.9) for r in rows], "doc_id long, text string, score double")
    none = spark.createDataFrame([(None, 1), (1, None)], "doc_id long, quality int")
    got = quality.classify(docs, none).collect()
    assert len(got) == 6 and {r["score"] for r in got} == {0.5}
    ones = spark.createDataFrame([(i, 1) for i in range(10)], "doc_id long, quality int")
    assert all(r["score"] > 0.5 for r in quality.classify(docs, ones).collect())
    assert quality.classify(docs.limit(0), ones).count() == 0
    assert quality.keep_good(docs, ones).columns == docs.columns


def test_ids_that_repeat_with_other_texts_fit_alike_however_rows_lie(spark):
    rows = [(i, f"{'good clean words here' if i % 2 else 'BUY $$$ now !!!'} {i} {k}") for i in range(40) for k in range(5)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    scores = []
    for order, parts in ((rows, 1), (rows[::-1], 7)):
        docs = spark.createDataFrame(order, "doc_id long, text string").repartition(parts)
        scores.append(sorted((r.doc_id, r.score) for r in quality.classify(docs, labels).collect()))
    assert scores[0] == scores[1] and len(scores[0]) == 200


def test_scores_against_plain_code(spark):
    sf = "/root/testdata/sf0.001"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    texts, known = {r.doc_id: r.text for r in docs.collect()}, {r.doc_id: r.quality for r in labels.collect()}
    fitted = sorted(i for i in known if i in texts and known[i] is not None and zlib.crc32(str(i).encode()) % 5)
    slots = quality.Slots()
    model = quality.fit_rows(quality.PackedRows([quality.pack_slots(slots.of(texts[i])) for i in fitted]), np.array([known[i] for i in fitted]))
    for r in quality.op5_quality_classifier(spark, sf).collect():
        on = slots.of(texts[r.doc_id])
        margin = sum(float(model.weights[s]) for s in on.tolist()) / max(1, len(on)) ** 0.5 + model.bias
        assert abs(r.score - 1 / (1 + np.exp(-(model.slope * margin + model.offset)))) < 1e-6
        assert r.predicted == (r.score >= 0.3) and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
