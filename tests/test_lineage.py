"""Values and the cells they come from."""

import datetime as dt

from pyspark.sql import functions as F

from gridseries.operators import cells, lineage, market
from gridseries.operators.commits import Table
from gridseries.plans import recipes, update, update_queries

H = lambda n: dt.datetime(2024, 1, 1, n)
CELL = "file string, row int, col int, cell string"
KEYS = ["property", "ts"]


def grid(spark, *lines):
    return spark.createDataFrame([("f", r, c, x) for r, line in enumerate(lines) for c, x in enumerate(line)], CELL)


def test_every_kind_of_difference(spark):
    raw = grid(spark, ("A", "1", "n/a", None), ("B", "2", "", "7"), ("C", "3", "4", "5"))
    at = lambda row, col: [(row << lineage.COL_BITS) + col]
    parsed = [
        ("f", "A", H(0), 1.0, at(0, 1)), ("f", "A", H(1), None, at(0, 2)), ("f", "A", H(2), 0.0, at(0, 3)), ("f", "B", H(0), 2.5, at(1, 1)), ("f", "B", H(1), 9.0, at(1, 2)),
        ("f", "B", H(2), 7.0, at(1, 3)), ("f", "C", H(0), 7.0, at(2, 1) + at(2, 2)), ("f", "D", H(0), 0.0, []),
    ]
    stored = [("A", H(0), 1.0), ("A", H(2), 0.0), ("B", H(0), 2.5), ("B", H(1), 9.0), ("B", H(2), 8.0), ("D", H(0), 0.0), ("E", H(0), 1.0)]
    found = lineage.compare(
        raw, spark.createDataFrame(parsed, "file string, property string, ts timestamp_ntz, value double, origin array<long>"),
        spark.createDataFrame(stored, "property string, ts timestamp_ntz, value double"), KEYS,
    )
    got = sorted(((r.row, r.col, r.property, r.ts and r.ts.hour, r.parsing, r.storing) for r in found.collect()), key=str)
    assert got == sorted([
        (0, 1, "A", 0, "same", "same"), (0, 2, "A", 1, "text", None), (0, 3, "A", 2, "same", "same"), (1, 1, "B", 0, "changed", "same"), (1, 2, "B", 1, "filled", "same"),
        (1, 3, "B", 2, "same", "replaced"), (2, 1, "C", 0, "summed", "missing"), (2, 2, "C", 0, "summed", "missing"), (None, None, "D", 0, "filled", "same"),
        (None, None, "E", 0, None, "orphan"), (2, 3, None, None, "unread", None),
    ], key=str)
    assert lineage.disagreements(found).count() == 9


def test_no_rows_at_all(spark):
    long = spark.createDataFrame([], "file string, property string, ts timestamp_ntz, value double, origin array<long>")
    assert lineage.compare(grid(spark), long, long.select(*KEYS, "value"), KEYS).count() == 0


def test_steps_keep_and_gather_origins(spark):
    raw = lineage.stamped(grid(spark, ("Thermal", None), ("BIG_GT1", "5"), ("BIG_ST", "(2)"), ("End", None)))
    steps = [
        lambda g: cells.replace_values(g, patterns=[(r"[()]", "")]), recipes.sections([cells.Cue("Thermal", "Thermal", "End", False, False)]), recipes.transposed(),
        recipes.numbers(("file", "section")),
    ]
    long = recipes.run(raw, steps)
    assert {(r.property, r.value): r.origin for r in long.collect()} == {("BIG_GT1", 5.0): [(1 << 20) + 1], ("BIG_ST", 2.0): [(2 << 20) + 1]}
    total = market.plant_totals(long, ["pos"])[0].first()
    assert (total["property"], total["value"], total["origin"]) == ("BIG", 7.0, [(1 << 20) + 1, (2 << 20) + 1])


def test_trace_of_runs_with_a_failed_report(spark, tmp_path):
    sheets = {"AF_1": "L1,1,2\nL2,3,4", "RF_1": "L1,x,2", "AO_1": "L1,5,no"}
    for name, text in sheets.items():
        (tmp_path / f"lake/folder={name}").mkdir(parents=True)
        (tmp_path / f"lake/folder={name}/sheet.txt").write_text(text)
    stored, log = Table(spark, f"{tmp_path}/store", ["report"]), Table(spark, f"{tmp_path}/log", zones=())
    listed = update.list_files(spark, f"{tmp_path}/lake", F.regexp_extract("path", "folder=([^/]+)/", 1))
    day = F.lit(dt.date(2024, 2, 1))
    catalogue = listed.select(F.split_part("file", F.lit("_"), F.lit(1)).alias("report"), day.alias("date"), "file", "path")
    reports = spark.createDataFrame([("AF", "grid"), ("RF", "grid"), ("AO", "plain")], "report string, family string").withColumns({"min_potential": day, "max_potential": day})
    for _ in range(2):  # the failed report is tried again
        update.run_update(spark, catalogue, reports, update_queries.families(), stored, log, f"{tmp_path}/staging")
    found = update.trace(spark, update_queries.families(), catalogue, log, stored, f"{tmp_path}/staging")
    got = {(r.file, r.row, r.col, r.cell, r.parsed, r.stored, r.parsing, r.storing) for r in found.collect()}
    same = lambda f, r, c, x: (f, r, c, x, float(x), float(x), "same", "same")
    assert got == {
        same("AF_1", 0, 1, "1"), same("AF_1", 0, 2, "2"), same("AF_1", 1, 1, "3"), same("AF_1", 1, 2, "4"), same("AO_1", 0, 1, "5"),
        ("AO_1", 0, 2, "no", None, None, "text", None), ("RF_1", 0, 2, "2", None, None, "unread", None),
    }
