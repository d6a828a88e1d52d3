"""Scans by blocks of time against the same scans over whole series."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from gridseries.functions import timeparts as T
from gridseries.operators import blocks, catalog, store

AT = dt.datetime(2023, 12, 30)


@pytest.fixture(scope="module")
def series(spark):
    rnd, rows = random.Random(4), []
    for key in ("a", "b", None, "nulls", "one", "dense"):
        hours = {"one": [5], "dense": range(400)}.get(key) or sorted(rnd.sample(range(900), 260))
        blank = 0
        for n, h in enumerate(hours):
            blank = blank - 1 if blank else rnd.choice([0, 0, 0, 1, 3, 40])
            value = None if key == "nulls" or blank else float(rnd.randint(0, 9))
            rows += [(key, AT + dt.timedelta(hours=h), value)] * (2 if key != "dense" and n % 50 == 7 else 1)
    return spark.createDataFrame(rows, "property string, ts timestamp_ntz, value double").repartition(5)


def rows(frame):
    return sorted((tuple(r[c] for c in sorted(frame.columns)) for r in frame.collect()), key=str)


BLOCKS = [3600, 7 * 3600, 86_400, 400 * 86_400]


@pytest.mark.parametrize("block_s", BLOCKS)
def test_null_runs(series, block_s):
    order = Window.partitionBy("property").orderBy("ts")
    island = series.withColumn("run", F.count("value").over(order)).where("value is null")
    want = island.groupBy("property", "run").agg(F.min("ts").alias("start"), F.max("ts").alias("end"), F.count("*").alias("length")).drop("run")
    assert rows(store.null_runs(series, ["property"], block_s)) == rows(want)


@pytest.mark.parametrize("block_s", BLOCKS)
def test_gaps(series, block_s):
    step = T.seconds(F.col("ts")) - T.seconds(F.lag("ts").over(Window.partitionBy("property").orderBy("ts")))
    want = series.withColumn("missing_s", step - 3600).where("missing_s <> 0").select("property", "ts", "missing_s")
    assert rows(store.gap_report(series, ["property"], 3600, block_s)) == rows(want)


@pytest.mark.parametrize("block_s", BLOCKS)
def test_profile(series, block_s):
    got = {r.property: r for r in store.profile_series(series, ["property"], block_s).collect()}
    held = {}
    for r in series.collect():
        held.setdefault(r.property, []).append((r.ts, r.value))
    assert got.keys() == held.keys()
    for key, own in held.items():
        own.sort(key=lambda x: x[0])
        stamps = [t for t, _ in own]
        distinct, values = sorted(set(stamps)), [v for _, v in own if v is not None]
        usual = (distinct[1] - distinct[0]).total_seconds() if len(distinct) > 1 else None
        r = got[key]
        assert (r.start, r.end, r.resolution_s, r.n_rows, r.n_nulls) == (stamps[0], stamps[-1], usual, len(own), len(own) - len(values))
        assert (r.min_value, r.max_value) == (min(values, default=None), max(values, default=None))
        assert r["mean"] is None if not values else abs(r["mean"] - sum(values) / len(values)) < 1e-9
        assert r.n_duplicates == sum(stamps.count(t) for t in distinct if stamps.count(t) > 1)
        assert r.n_leaps == (0 if usual is None else sum((b - a).total_seconds() != usual for a, b in zip(stamps, stamps[1:])))
        assert r.n_missing == (None if usual is None else (stamps[-1] - stamps[0]).total_seconds() // usual + 1 - len(own))


@pytest.mark.parametrize("block_s", [1800, 5 * 3600, None])
def test_upsampling(series, block_s):
    known = series.where("property is not null")
    got = catalog.upsample_linear(known, ["property"], 1800, block_s)
    grid = store.fill_grid(known.groupBy("property", "ts").agg(F.avg("value").alias("value")), ["property"], 1800)
    held = {}
    for r in grid.collect():
        held.setdefault(r.property, []).append((r.ts, r.value))
    want = {}
    for key, own in held.items():
        own.sort()
        places = [k for k, (_, v) in enumerate(own) if v is not None]
        for k, (t, v) in enumerate(own):
            b, a = max((p for p in places if p <= k), default=None), min((p for p in places if p >= k), default=None)
            if v is None and b is not None:
                v = own[b][1] if a is None else own[b][1] + (own[a][1] - own[b][1]) * (k - b) / (a - b)
            want[key, t] = v
    found = {(r.property, r.ts): r.value for r in got.collect()}
    assert found.keys() == want.keys()
    assert all((found[k] is None) == (v is None) and (v is None or abs(found[k] - v) < 1e-9) for k, v in want.items())


def test_no_task_holds_a_whole_series(spark):
    one = spark.range(0, 40_000, 1, 4).select(F.lit("s").alias("property"), T.from_seconds(F.col("id") * 3600).alias("ts"), F.when(F.col("id") % 3 > 0, 1.0).alias("value"))
    marked = blocks.cut(one, 86_400).withColumn("n", F.lag("ts").over(blocks.inside(["property"])))
    spread = marked.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(spread) > 1 and max(r["count"] for r in spread) < 20_000
    for frame in (store.null_runs(one, ["property"]), store.gap_report(one, ["property"], 3600), store.profile_series(one, ["property"]), catalog.upsample_linear(one, ["property"], 1800)):
        plan = frame._jdf.queryExecution().optimizedPlan().toString()
        for line in plan.splitlines():
            if "Window [" in line and "windowspecdefinition(property" in line:
                inner = line.split("windowspecdefinition(")[1:]
                assert all("__block" in w or "first" in w for w in inner), line


def test_empty_series(spark, series):
    none = series.limit(0)
    assert not store.null_runs(none, ["property"]).collect() and not store.profile_series(none, ["property"]).collect()
    assert not store.gap_report(none, ["property"], 60).collect() and not catalog.upsample_linear(none, ["property"], 60).collect()
