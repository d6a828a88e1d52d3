import numpy as np

import corpus_pipeline
from gridseries.llm import quality, registry
from tests.llm.test_mixing_and_packing import plain_best_fit
from tests.llm.test_simhash import brute_components


def test_stages_take_effect(spark, sf, tmp_path):
    docs = first = spark.read.parquet(f"{sf}/documents.parquet")
    seen = []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        seen.append((name, docs.toPandas()))
        if k < 3:
            assert docs.dtypes == first.dtypes
    (_, good), (_, unique), (_, mixed), (_, packed) = seen
    model = quality.fit(first, spark.read.parquet(f"{sf}/labels.parquet"))
    slots = quality.Slots()
    want = {r.doc_id for r in first.toPandas().itertuples() if model.score(slots.of(r.text)) >= 0.3}
    assert set(good.doc_id) == want and len(good) == len(want)
    groups = good.sort_values("doc_id").reset_index(drop=True)
    from gridseries.llm.simhash import near_duplicates

    fps = near_duplicates(spark.createDataFrame(groups)).toPandas().sort_values("doc_id").fp.to_numpy().view(np.uint64)
    label = brute_components(fps)
    strict = set(groups.doc_id.to_numpy()[label])
    assert set(unique.doc_id) <= strict and len(unique) == unique.doc_id.nunique()  # at least these go
    assert set(mixed.doc_id) <= set(unique.doc_id) and mixed.groupby("doc_id").size().max() <= 3
    words = mixed.text.str.split().str.len()
    assert packed.n_words.sum() == words.sum()
    for _, shard in packed.groupby("shard"):
        shard = shard.sort_values(["n_words", "doc_id", "piece"], ascending=[False, True, True])
        bits = lambda col: shard[col].map({v: i for i, v in enumerate(v for v, n in shard[col].value_counts().items() if n > 1)}).fillna(-1).astype(int).tolist()  # noqa: E731,B023
        n_bins = len(set(plain_best_fit(shard.n_words.tolist(), bits("source"), bits("cluster"), 2048)))
        assert shard.bin.nunique() == n_bins


def test_registered_names():
    assert [n.partition("_")[0] for n in registry.QUERIES] == [f"op{i}" for i in range(1, 14)]
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "simhash_near_dedup", "source_mixing", "best_fit_packing"]
