"""The log of versions: what is rewritten, what readers see, and writers that meet."""

import datetime as dt
import threading

import pytest
from pyspark.sql import functions as F

from gridseries.operators import commits
from gridseries.streaming import incremental

SCHEMA = "report string, property string, ts timestamp_ntz, value double"
KEYS = ["report", "property", "ts"]
AT = dt.datetime(2024, 1, 1)


def rows(spark, *found):
    return spark.createDataFrame([(r, p, AT + dt.timedelta(hours=h), v) for r, p, h, v in found], SCHEMA)


def held(frame):
    return sorted(((r.report, r.property, (r.ts - AT).days * 24 + (r.ts - AT).seconds // 3600, r.value) for r in frame.collect()), key=str)


def paths(table, report):
    return {r["path"] for r in table.files().where(F.col("report").eqNullSafe(F.lit(report))).collect()}


@pytest.fixture
def table(spark, tmp_path):
    out = commits.Table(spark, f"file://{tmp_path}/t", ["report"])
    out.append(rows(spark, ("A", "x", 0, 1.0), ("A", "x", 1, 2.0), ("B b:+%", "y", 0, 3.0), (None, "z", 0, 4.0), ("007", "z", 0, 5.0)))
    return out


def test_an_upsert_rewrites_the_partitions_that_it_touches(spark, table):
    before = {r: paths(table, r) for r in ("A", "B b:+%", None, "007")}
    assert all(before.values())
    assert table.upsert(rows(spark, ("A", "x", 1, 9.0), ("A", "x", 2, 7.0), (None, "z", 0, 8.0), ("C", "n", 0, 6.0)), KEYS, keep="new") == 1
    assert {r for r in before if paths(table, r) == before[r]} == {"B b:+%", "007"}
    assert held(table.read()) == sorted([("A", "x", 0, 1.0), ("A", "x", 1, 9.0), ("A", "x", 2, 7.0), ("B b:+%", "y", 0, 3.0), (None, "z", 0, 8.0), ("007", "z", 0, 5.0), ("C", "n", 0, 6.0)], key=str)
    assert len(held(table.read(0))) == 5 and ("A", "x", 1, 2.0) in held(table.read(0))
    with pytest.raises(ValueError, match="report"):
        table.upsert(rows(spark), ["property", "ts"])


def test_new_columns_and_empty_tables(spark, tmp_path, table):
    table.upsert(rows(spark, ("A", "x", 5, 1.0)).withColumn("note", F.lit("n")), KEYS)
    assert {r.note for r in table.read().collect()} == {None, "n"}
    other = commits.Table(spark, f"{tmp_path}/none")
    with pytest.raises(FileNotFoundError):
        other.read()
    assert other.append(rows(spark)) == 0 and other.read().dtypes == rows(spark).dtypes and other.read().count() == 0
    assert other.upsert(rows(spark), KEYS) == 1 and other.read().count() == 0


def test_a_batch_that_comes_again_is_skipped(spark, table):
    one = rows(spark, ("A", "x", 0, 50.0))
    assert table.upsert(one, KEYS, keep="new", batch=("s", 3)) == 1
    assert table.upsert(one.withColumn("value", F.lit(0.0)), KEYS, keep="new", batch=("s", 3)) is None
    assert table.append(one, batch=("s", 2)) is None
    assert table.append(rows(spark, ("D", "x", 0, 1.0)), batch=("other", 0)) == 2
    assert ("A", "x", 0, 50.0) in held(table.read()) and table.read().count() == 6


def meet(table, monkeypatch, first, second):
    """Runs ``second`` between the moment that ``first`` has written its files and its commit."""
    publish, met = commits.Table._publish, []

    def late(self, state):
        if not met:
            met.append(1)
            second()
        return publish(self, state)

    monkeypatch.setattr(commits.Table, "_publish", late)
    return first()


def test_writers_of_one_partition_lose_no_rows(spark, table, monkeypatch):
    got = meet(table, monkeypatch, lambda: table.upsert(rows(spark, ("A", "x", 3, 30.0)), KEYS), lambda: table.upsert(rows(spark, ("A", "x", 4, 40.0)), KEYS))
    assert got == 2
    assert {("A", "x", h, v) for h, v in ((0, 1.0), (1, 2.0), (3, 30.0), (4, 40.0))} <= set(held(table.read())) and table.read().count() == 7


def test_writers_of_two_partitions_merge_once(spark, table, monkeypatch):
    merged, upsert = [], commits.store.upsert
    monkeypatch.setattr(commits.store, "upsert", lambda *a, **b: merged.append(1) or upsert(*a, **b))
    meet(table, monkeypatch, lambda: table.upsert(rows(spark, ("A", "x", 3, 30.0)), KEYS), lambda: table.upsert(rows(spark, ("007", "z", 4, 40.0)), KEYS))
    assert len(merged) == 2 and table.read().count() == 7


def test_a_rebuild_does_not_lose_what_came_meanwhile(spark, table, monkeypatch):
    with pytest.raises(commits.ConflictError):
        meet(table, monkeypatch, lambda: table.replace(table.read().where("report = 'A'")), lambda: table.append(rows(spark, ("E", "x", 0, 1.0))))
    assert table.read().count() == 6


def test_threads_that_append_at_once(spark, table):
    def add(k):
        commits.Table(spark, table.path).append(rows(spark, (f"T{k}", "x", k, float(k))))

    threads = [threading.Thread(target=add, args=(k,)) for k in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert table.read().count() == 9 and table.versions() == [0, 1, 2, 3, 4]


def test_readers_see_a_whole_version_while_it_is_replaced(spark, table, monkeypatch):
    seen = []
    meet(table, monkeypatch, lambda: table.upsert(rows(spark, ("A", "x", 0, 0.0)), KEYS), lambda: seen.append(table.read().count()))
    old = table.read(0)
    table.replace(rows(spark, ("Z", "x", 0, 1.0)))
    assert seen == [5] and old.count() == 5 and held(table.read()) == [("Z", "x", 0, 1.0)]


def test_a_slice_opens_few_files_and_vacuum_keeps_what_is_held(spark, tmp_path):
    table = commits.Table(spark, f"{tmp_path}/z", ["report"])
    for day in range(4):
        table.append(rows(spark, *[("A", p, 24 * day + h, 1.0) for p in ("x", "y") for h in range(24)]))
    few = table.slice("2024-01-02 05:00", "2024-01-02 08:00", ["x"])
    assert few.count() == 3 and 1 <= len(few.inputFiles()) < len(table.read().inputFiles())
    table.upsert(rows(spark, ("A", "x", 0, 2.0)), KEYS)
    gone = table.vacuum(keep=1, older_than_s=-5)
    assert any(g.startswith("data/") for g in gone) and table.versions() == [4] and table.read().count() == 192


def test_a_stream_that_stops_after_its_commit_adds_nothing_twice(spark, tmp_path):
    rows(spark, ("A", "x", 0, 1.0)).write.parquet(f"{tmp_path}/in")

    def load(checkpoint):
        incremental.stream_upsert(spark.readStream.schema(SCHEMA).parquet(f"{tmp_path}/in"), f"{tmp_path}/out", checkpoint, KEYS, partition_by=["report"]).awaitTermination()

    load(f"{tmp_path}/cp")
    table = commits.Table(spark, f"{tmp_path}/out")
    before = table.versions()
    import shutil

    shutil.rmtree(f"{tmp_path}/cp/commits")  # as if it had stopped between the two commits
    load(f"{tmp_path}/cp")
    assert table.versions() == before and table.read().count() == 1
