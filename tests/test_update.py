"""The update run on a small lake: failures stay apart, later runs take what is new."""

import datetime as dt
from functools import partial

import pytest
from pyspark.sql import functions as F

from gridseries.operators import store
from gridseries.operators.commits import Table
from gridseries.plans import update, update_queries

DAY = dt.date(2024, 2, 1)
GOOD = "\n".join(f"L{n}," + ",".join(str(n * d) for d in range(1, 30)) for n in (1, 2))


@pytest.fixture
def lake(spark, tmp_path):
    def write(**sheets):
        for name, text in sheets.items():
            (tmp_path / f"lake/folder={name}").mkdir(parents=True, exist_ok=True)
            (tmp_path / f"lake/folder={name}/sheet.txt").write_bytes(text if isinstance(text, bytes) else text.encode())

    stored, log = Table(spark, f"{tmp_path}/store", ["report"]), Table(spark, f"{tmp_path}/log", zones=())

    def run(*families):
        listed = update.list_files(spark, f"{tmp_path}/lake", F.regexp_extract("path", "folder=([^/]+)/", 1))
        catalogue = listed.select(F.split_part("file", F.lit("_"), F.lit(1)).alias("report"), F.lit(DAY).alias("date"), "file", "path")
        known = [(r, f) for r, f in (("a", "grid"), ("b", "grid"), ("c", "grid"), ("p", "plain"), ("q", "plain"), ("r", "plain"), ("s", "plain"))]
        reports = spark.createDataFrame(known, "report string, family string").withColumns({"min_potential": F.lit(DAY), "max_potential": F.lit(DAY)})
        number = update.run_update(spark, catalogue, reports, list(families or update_queries.families()), stored, log, f"{tmp_path}/staging")
        found = update.report_log(log.read()).where(F.col("run") == number).collect()
        return {r.report: (r.status, r.n_files, r.n_loaded, r.n_rows) for r in found}

    return write, run, stored, log


def test_failures_stay_with_their_report_and_their_file(spark, lake):
    write, run, stored, log = lake
    write(a_1=GOOD, b_1=GOOD.replace("L1,1,", "L1,one,"), p_1=GOOD, q_1=b"\xff\xfe\x00\x80,\xc0", r_1="", s_1=GOOD + "\nL3,x")
    assert run() == {
        "a": ("stored", 1, 1, 58), "b": ("failed", 1, 0, 0), "c": ("idle", 0, 0, 0), "p": ("stored", 1, 1, 58), "q": ("partial", 1, 0, 0), "r": ("partial", 1, 0, 0), "s": ("partial", 1, 1, 59),
    }
    note = log.read().where("report = 'b'").first()["note"]
    assert "text among numbers in b_1" in note
    assert {r.report: r["count"] for r in stored.read().groupBy("report").count().collect()} == {"a": 58, "p": 58, "s": 58}
    assert {r.report: r.status for r in log.read().where("family = 'plain'").collect()} == {"p": "loaded", "q": "unreadable", "r": "empty", "s": "partial"}
    # a new version of the broken sheet, and of a stored one; the rest is settled
    write(b_2=GOOD, a_2=GOOD.replace("L1,1,", "L1,100,"))
    got = run()
    assert got["b"] == got["a"] == ("stored", 1, 1, 58) and {v[0] for k, v in got.items() if k not in "ab"} == {"idle"}
    assert stored.read().where("report = 'a' and property = 'L1'").orderBy("ts").first()["value"] == 100.0
    before = stored.versions()
    assert {v[0] for v in run().values()} == {"idle"} and stored.versions() == before
    summary = {r.status: (r.n, r.reports) for r in store.run_summary(update.report_log(log.read())).collect()}
    assert summary["failed"] == (1, "b") and summary["stored"] == (4, "a,b,p")


def test_a_family_whose_reader_fails_leaves_the_others(spark, lake):
    write, run, stored, _ = lake
    write(a_1=GOOD, p_1=GOOD)

    def broken(spark, paths):
        raise OSError("no such share")

    got = run(update.Family("grid", broken, partial(update_queries.steps)), update_queries.families()[1])
    assert got["a"][0] == "failed" and got["p"][0] == "stored" and {r.report for r in stored.read().select("report").distinct().collect()} == {"p"}
