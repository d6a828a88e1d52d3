import numpy as np
from pyspark.sql import functions as F

from gridseries.llm import lattice, neighbours


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, score double, component_id long")


def unit(draw, n, d=64):
    x = draw.standard_normal((n, d)).astype(np.float32)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def test_search_against_brute_force(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    got = neighbours.nearest(vectors, vectors.where("vec_id % 20 = 0"), shard_rows=300, block_rows=40).toPandas()
    data = vectors.toPandas()
    v, ids = np.stack(data.embedding).astype(float), data.vec_id.to_numpy()
    hits = 0
    for q, found in got.groupby("query_id"):
        i = np.flatnonzero(ids == q)[0]
        d = np.sqrt(((v - v[i]) ** 2).sum(axis=1))
        rest = ids != q
        best = ids[rest][np.lexsort((ids[rest], d[rest]))[:10]]
        found = found.sort_values("rank")
        assert found["rank"].tolist() == list(range(1, 11))
        assert np.allclose(found.score, [d[ids == x][0] for x in found.vec_id], rtol=0, atol=1e-12)
        hits += len(set(best) & set(found.vec_id))
    assert hits >= 0.95 * len(got)


def test_search_of_ties_few_candidates_and_unusable_vectors(spark):
    rows = [(i, [1.0, 2.0], 0, 0.0, 0) for i in range(1, 16)] + [
        (100, [1.0, 2.0], 0, 0.0, 0), (101, [0.0, 0.0], 0, 0.0, 0), (102, None, 0, 0.0, 0), (103, [1.0, None], 0, 0.0, 0),
        (104, [float("nan"), 1.0], 0, 0.0, 0), (105, [float("inf"), 1.0], 0, 0.0, 0), (None, [1.0, 2.0], 0, 0.0, 0), (200, [1.0, 2.0, 3.0], 0, 0.0, 0), (201, [1.0, 2.0, 4.0], 0, 0.0, 0),
        (100, [1.0, 2.0], 0, 0.0, 0),
    ]
    frame = table(spark, rows)
    got = neighbours.nearest(frame, frame.where("vec_id >= 100 or vec_id is null")).orderBy("query_id", "rank").collect()
    of = lambda q: [(r["vec_id"], r["score"]) for r in got if r["query_id"] == q]
    assert of(100) == [(i, 0.0) for i in range(1, 11)]
    assert of(200) == [(201, 1.0)] and {r["query_id"] for r in got} == {100, 200, 201}
    assert neighbours.nearest(frame.limit(0), frame.limit(0)).count() == 0


def test_most_vectors_are_not_verified():
    # no clusters: the nearest vectors are nearly as far as all others, the hardest case for windows
    x = unit(np.random.default_rng(6), 8000).astype(float)
    index = neighbours.Index(np.arange(len(x)), x)
    radius, hits, verified = index.first_radius(10), 0, []
    for q in range(0, 8000, 200):
        got = {i for i, _ in index.search(q, x[q], 10, radius)}
        verified.append(index.verified / len(x))
        d = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
        d[q] = np.inf
        hits += len(got & set(np.argsort(d)[:10].tolist()))
    assert hits >= 0.95 * 400 and np.mean(verified) <= 0.3


def test_rows_that_repeat_an_id_count_by_their_least_vector(spark):
    rows = [(0, [0.0, 1.0], 0, 0.0, 0), (1, [9.0, 1.0], 0, 0.0, 0), (1, [3.0, 8.0], 0, 0.0, 0), (1, [3.0, 5.0], 0, 0.0, 0), (0, [0.0, 2.0], 0, 0.0, 0)]
    for frame in (table(spark, rows), table(spark, rows[::-1])):
        got = neighbours.nearest(frame, frame.where("vec_id = 0")).collect()
        assert [tuple(r) for r in got] == [(0, 1, 1, 5.0)]


def test_e8_decoding_is_nearest():
    draw = np.random.default_rng(2)
    x = draw.standard_normal((300, 8)) * 2
    got = lattice.decode_e8(x) / 2
    halves = np.abs(got - np.rint(got)).max(axis=1)
    assert set(np.round(halves, 3)) <= {0.0, 0.5} and (np.rint(got.sum(axis=1)) % 2 == 0).all()
    for v in lattice.MINIMAL / 2:  # no neighbour is nearer
        assert (((x - got) ** 2).sum(axis=1) <= ((x - got - v) ** 2).sum(axis=1) + 1e-9).all()
    assert len(lattice.MINIMAL) == 240 and (((lattice.MINIMAL / 2) ** 2).sum(axis=1) == 2).all()


def brute(rows, least=0.93):
    n = len(rows)
    u = [None] * n
    for i, (_, v, lab, *_) in enumerate(rows):
        if rows[i][0] is not None and lab is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v):
            u[i] = np.array(v, dtype=np.float32).astype(float)
            u[i] /= np.linalg.norm(u[i])
    link = [[j for j in range(n) if j != i and u[i] is not None and u[j] is not None and rows[i][2] == rows[j][2] and len(u[i]) == len(u[j]) and u[i] @ u[j] >= least] for i in range(n)]
    ids = [r[0] for r in rows]
    label = list(ids)
    moved = True
    while moved:
        moved = False
        for i in range(n):
            for j in link[i]:
                if label[j] < label[i]:
                    label[i], moved = label[j], True
    return link, label


def clusters(draw):
    centres = unit(draw, 12)
    rows, k = [], 0
    for c, centre in enumerate(centres):
        for _ in range(int(draw.integers(1, 40))):
            noise = unit(draw, 1)[0] * draw.uniform(0, 0.45)
            rows.append((k, (centre + noise).astype(float).tolist(), c % 3, 0.0, 0))
            k += 1
    return rows + [(k + i, *rows[i][1:]) for i in range(20)]  # exact copies


def test_links_and_components_against_brute_force(spark):
    rows = clusters(np.random.default_rng(4))
    link, label = brute(rows)
    for chunk in (512, 7):  # small chunks: cells are cut into pairs of chunks
        got = {r["vec_id"]: r for r in lattice.near_duplicates(table(spark, rows), chunk_rows=chunk).collect()}
        true, found = sum(map(len, link)), sum(r["n_links"] for r in got.values())
        assert found <= true and found >= 0.97 * true
        assert sum(got[r[0]]["component_id"] == label[i] for i, r in enumerate(rows)) >= 0.99 * len(rows)
        assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got.values())
    # with every cell asked for nothing is missed, and nothing is counted twice
    got = {r["vec_id"]: r["n_links"] for r in lattice.near_duplicates(table(spark, rows), tables=6, scale=2.0, probes=24, chunk_rows=9).collect()}
    assert got == {r[0]: len(link[i]) for i, r in enumerate(rows)}


def test_recall_of_every_setting_near_the_bound():
    draw = np.random.default_rng(8)
    for dim in (16, 32, 64, 256):
        a, w = unit(draw, 1500, dim).astype(float), unit(draw, 1500, dim).astype(float)
        w -= (w * a).sum(axis=1, keepdims=True) * a
        w /= np.linalg.norm(w, axis=1, keepdims=True)
        c = draw.uniform(0.93, 0.95, (1500, 1))
        b = c * a + np.sqrt(1 - c * c) * w
        for _, (tables, blocks, scale, probes) in lattice.SETTINGS:
            x, y = lattice.cells(a, tables, blocks, scale, probes), lattice.cells(b, tables, blocks, scale, probes)
            met = ((x == y[:, :, :1]).any(axis=2) | (y == x[:, :, :1]).any(axis=2)).any(axis=1)
            assert met.mean() >= 0.95, (dim, tables, blocks)


def test_unusable_vectors_and_labels_link_with_nothing(spark):
    a, b = [1.0, 0.0], [1.0, 0.01]
    rows = [
        (1, a, 0, 0.0, 9), (2, b, 0, 0.0, 9), (3, a, 1, 0.0, 9), (4, a, None, 0.0, 9), (5, a, None, 0.0, 9), (6, [0.0, 0.0], 0, 0.0, 9), (7, None, 0, 0.0, 9),
        (8, [1.0, None], 0, 0.0, 9), (9, [float("inf"), 0.0], 0, 0.0, 9), (None, a, 0, 0.0, 9), (2, b, 0, 0.0, 9), (10, [2.0, 0.0], 0, 0.0, 9), (11, [1.0], 0, 0.0, 9),
    ]
    got = sorted((tuple(r) for r in lattice.near_duplicates(table(spark, rows)).collect()), key=str)
    want = [(1, 3, 1, True), (2, 3, 1, False), (2, 3, 1, False), (10, 3, 1, False), (3, 0, 3, True), (4, 0, 4, True), (5, 0, 5, True), (6, 0, 6, True), (7, 0, 7, True), (8, 0, 8, True), (9, 0, 9, True), (11, 0, 11, True), (None, 0, None, False)]
    assert got == sorted(want, key=str)
    assert lattice.near_duplicates(table(spark, rows).limit(0)).count() == 0


def test_registered_tables(spark, sf):
    got = lattice.op10_embedding_near_dedup(spark, sf)
    assert got.count() == spark.read.parquet(f"{sf}/embeddings.parquet").count() and got.where(F.col("n_links") < 0).count() == 0


def test_links_of_a_small_table_are_those_of_a_large_one(spark):
    """All pairs are near the bound; a label of few vectors is asked as one of five million is."""
    draw = np.random.default_rng(21)
    a, w = unit(draw, 1500).astype(float), unit(draw, 1500).astype(float)
    w -= (w * a).sum(axis=1, keepdims=True) * a
    w /= np.linalg.norm(w, axis=1, keepdims=True)
    b = 0.931 * a + np.sqrt(1 - 0.931**2) * w
    rows = [(2 * i + j, v.tolist(), 0, 0.0, 0) for i, two in enumerate(zip(a, b, strict=True)) for j, v in enumerate(two)]
    found = lambda **setting: {(r["vec_id"], r["n_links"]) for r in lattice.near_duplicates(table(spark, rows), **setting).collect()}
    assert found() == found(tables=9, blocks=2, scale=5.0, probes=16)
