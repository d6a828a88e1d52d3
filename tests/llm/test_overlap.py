import random
from contextlib import contextmanager

import numpy as np

import corpus_pipeline
from gridseries.llm import overlap, simhash


def brute_labels(texts, shingle=5, bound=0.8):
    """Smallest index reachable over pairs of a Jaccard similarity of the bound or more."""
    sets = []
    for t in texts:
        words = (t or "").lower().split()
        sets.append({tuple(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))} if words else set())
    near = [[j for j, b in enumerate(sets) if not (a or b) or (a and len(a & b) >= bound * len(a | b) - 1e-9)] for a in sets]
    label = list(range(len(texts)))
    while True:
        new = [min(label[j] for j in js) for js in near]
        if new == label:
            return label
        label = new


def planted():
    """Texts with copies of many degrees, chains, a large group and a passage that many share."""
    random.seed(4)
    word = lambda: f"w{random.randrange(3000)}"
    passage = [f"p{i}" for i in range(30)]
    texts = [None, "", " \n", "one two", "One  TWO", "one two three"]
    for k in range(60):
        words = [word() for _ in range(random.choice((12, 60, 150)))]
        if k % 3 == 0:
            words[5:5] = passage
        texts.append(" ".join(words))
        for _ in range(3):  # each copy of the last one
            words = list(words)
            for _ in range(random.randrange(4)):
                words[random.randrange(len(words))] = word()
            texts.append(" ".join(words) + random.choice(("", " tail of it")))
    base = [word() for _ in range(200)]
    for _ in range(80):
        words = list(base)
        for at in random.sample(range(200), 3):
            words[at] = word()
        texts.append(" ".join(words))
    return texts


def test_near_copies_against_brute_force(spark):
    texts = planted()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in overlap.near_copies(docs).collect()}
    assert got == dict(enumerate(brute_labels(texts)))


def test_stage_keeps_one_of_each_group_and_all_else(spark):
    texts = planted()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = {r["doc_id"] for r in corpus_pipeline.simhash_near_dedup(spark, docs, "").collect()}
    assert kept == set(brute_labels(texts))


def test_stage_on_the_given_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = sorted((r["doc_id"], r["text"]) for r in docs.collect())
    kept = {r["doc_id"] for r in corpus_pipeline.simhash_near_dedup(spark, docs, sf).collect()}
    assert kept == {rows[i][0] for i in brute_labels([t for _, t in rows])}


def test_order_of_common_shingles_never_changes_the_result(spark, monkeypatch):
    texts = planted()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    monkeypatch.setattr(overlap, "MOST_COMMON", 5)
    got = {r["doc_id"]: r["component_id"] for r in overlap.near_copies(docs).collect()}
    assert got == dict(enumerate(brute_labels(texts)))


def test_bitmaps_never_differ_more_than_the_sets():
    draw = np.random.default_rng(5)
    for _ in range(300):
        a = draw.integers(0, 400, draw.integers(0, 300)) * 0x9E3779B97F4A7C1
        b = np.concatenate([a[: draw.integers(0, len(a) + 1)], draw.integers(0, 400, draw.integers(0, 60)) * 0x9E3779B97F4A7C1])
        a, b = np.unique(a), np.unique(b)
        got = overlap.least_difference(overlap.parities(a), overlap.parities(b))
        assert got <= len(np.setxor1d(a, b)) and (got == 0 or len(np.setxor1d(a, b)))
        assert overlap.least_difference(overlap.parities(a), overlap.parities(a)) == 0


def test_null_ids_repeats_and_an_empty_table(spark):
    rows = [(3, None), (1, ""), (2, "a b c d"), (2, "a b c d"), (None, "a b c d"), (None, "only nameless")]
    docs = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, fp int")
    got = sorted(((r["doc_id"], r["component_id"]) for r in overlap.near_copies(docs).collect()), key=str)
    assert got == sorted([(3, 1), (1, 1), (2, 2), (2, 2), (None, 2), (None, None)], key=str)
    kept = simhash.keep_first(docs, overlap.near_copies(docs))
    assert kept.columns == docs.columns and sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "2", "None"]
    assert overlap.near_copies(docs.limit(0)).count() == 0


def test_a_pair_of_a_bucket_of_two_is_compared_whatever_else_the_texts_meet(spark):
    """Three texts meet the last one, each alone in buckets of two; the one in the middle is the near copy."""
    import random

    import xxhash

    draw = random.Random(5)
    kind = lambda t: np.uint64(xxhash.xxh64_intdigest(overlap.shingle_set(t).tobytes(), overlap.SEED)).astype(np.int64)
    some = lambda n: [f"w{draw.randrange(10**9)}" for _ in range(n)]
    cases = []
    while len(cases) < 12:
        words = some(60)
        changed = list(words)
        at = draw.randrange(10, 50)
        changed[at] = some(1)[0]
        whole, copy = overlap.shingle_set(" ".join(words)), overlap.shingle_set(" ".join(changed))
        alone = [s for s in whole[:4] if s not in copy]
        if len(alone) < 2:
            continue
        runs = {int(overlap.shingle_set(" ".join(words[i : i + 5]))[0]): words[i : i + 5] for i in range(56)}
        others = [[" ".join(runs[int(s)] + some(51)) for _ in range(12)] for s in alone[:2]]
        last, middle = kind(" ".join(words)), kind(" ".join(changed))
        low = [t for t in others[0] if kind(t) < middle and runs and overlap.shingle_set(t)[:4].__contains__(alone[0])]
        high = [t for t in others[1] if middle < kind(t) < last and overlap.shingle_set(t)[:4].__contains__(alone[1])]
        if low and high:
            cases.append((" ".join(words), " ".join(changed), low[0], high[0]))
    rows = [(4 * i + j, t) for i, case in enumerate(cases) for j, t in enumerate(case)]
    found = {r["doc_id"]: r["component_id"] for r in overlap.near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == {4 * i + j: 4 * i + (0 if j == 1 else j) for i in range(len(cases)) for j in range(4)}


def test_what_spark_sizes_too_low_is_never_broadcast(spark, monkeypatch):
    plans, tables = [], overlap.stored_tables

    @contextmanager
    def watched(session):
        with tables(session) as stored:

            def keep(frame):
                frame.collect()
                plans.append((set(frame.columns), frame._jdf.queryExecution().executedPlan().toString()))
                return stored(frame)

            yield keep

    monkeypatch.setattr(overlap, "stored_tables", watched)
    texts = planted()[-100:]
    overlap.near_copies(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    buckets = [p for columns, p in plans if columns == {"token", "kind", "n", "pos", "root", "sketch"}]
    assert len(buckets) == 1 and "SortMergeJoin [kind" in buckets[0] and "BroadcastHashJoin" not in buckets[0]
    assert not any("BroadcastHashJoin [token" in p for _, p in plans) and any("SortMergeJoin [token" in p for _, p in plans)
    # the pairs' texts are fetched by a broadcast of the pairs, which were exploded and joined without one
    fetched = [p for columns, p in plans if columns == {"u", "v"} and "rep_key" in p]
    assert fetched and all("SortMergeJoin [kind" in p for p in fetched)
