"""What near-dedup asks of the driver: jobs for small steps."""

import uuid

from gridseries.llm import overlap
from gridseries.llm.common import components


def jobs(spark, run):
    """Result of ``run`` and the number of Spark jobs that it took."""
    group = f"jobs-{uuid.uuid4().hex}"
    spark.sparkContext.setJobGroup(group, group)
    try:
        return run(), len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_stars_are_components_without_a_round(spark):
    edges = spark.createDataFrame([(k, 100 * (k // 100)) for k in range(400)] + [(1, 0), (500, 500)], "u long, v long")
    got, n = jobs(spark, lambda: components(edges).collect())
    assert {r["node"]: r["root"] for r in got} == {k: 100 * (k // 100) for k in range(400) if k % 100}
    assert n <= 8


def test_near_dedup_of_pairs_joins_components_once(spark, monkeypatch):
    words = lambda k: [f"w{k}x{i}" for i in range(60)]
    rows = [(2 * k + c, " ".join(words(k) + ["end"] * c)) for k in range(20) for c in (0, 1)]
    calls = []
    monkeypatch.setattr(overlap, "components", lambda *a, **b: calls.append(1) or components(*a, **b))
    got = {r["doc_id"]: r["component_id"] for r in overlap.near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: i // 2 * 2 for i in range(40)} and len(calls) == 1
