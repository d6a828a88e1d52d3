"""Report families on small sheets."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from gridseries.operators import calendars, cells
from gridseries.plans import recipes

DAY = dt.date(2024, 6, 1)


def sheets(spark, **given):
    rows = [(name, r, c, x) for name, lines in given.items() for r, line in enumerate(lines) for c, x in enumerate(line)]
    return spark.createDataFrame(rows, "file string, row int, col int, cell string")


@pytest.fixture
def day(spark):
    """Hours of a day in UTC, for three files of that day."""
    periods = spark.createDataFrame([(f, DAY) for f in "fgh"], "file string, period date")
    return calendars.period_calendar(periods.select("period").distinct(), "UTC", resolution_min=60), periods


def found(frame, *columns):
    return {tuple(r[c].hour if c == "ts" else r[c] for c in columns) for r in frame.collect()}


def test_a_run_within_the_day_begins_at_its_own_stamp(spark, day):
    head = ("Load", "1/6/2024 21:00:00", "1/6/2024 22:00:00", "1/6/2024 23:00:00")
    late = ("Load", "01/06/2024 23:00:00", None, None)
    grid = sheets(spark, f=[head, ("A", "1", "2", "3"), ("End", None, None, None)], g=[late, ("A", "7", None, None), ("End", None, None, None)], h=[("Load", "soon"), ("A", "9"), ("End", None)])
    got = recipes.run(grid, recipes.adhoc_schedule([cells.Cue("Units", "Load", "End", False, False)], *day))
    assert found(got.where("file = 'f'"), "section", "property", "ts", "value") == {("Units", "A", 21, 1.0), ("Units", "A", 22, 2.0), ("Units", "A", 23, 3.0)}
    assert found(got.where("file <> 'f'").where("value > 0"), "file", "ts", "value") == {("g", 23, 7.0)}


def test_filling_rates_of_an_empty_sheet_are_null(spark, day):
    # a column stays if it has five values; the second sheet has none
    grid = sheets(spark, f=[(f"R{k}", str(k), None) for k in range(6)], g=[(f"R{k}", None, None) for k in range(6)])
    got = recipes.run(grid, recipes.reservoirs(*day, properties=["R0", "R1"]))
    assert found(got.where("file = 'f'"), "property", "ts", "value") == {(f"R{k}", 0, float(k)) for k in range(6)}
    empty = got.where("file = 'g'")
    assert empty.count() == 48 and empty.where("value is not null").count() == 0


def test_requirements_are_named_by_the_second_column(spark, day):
    grid = sheets(spark, f=[("Hydro", None, "00:00", "23:30", "more"), ("x", "LAKE", "1", "2", "9"), ("y", "DAM", "3", "4", "9"), ("End", None, None, None, None)])
    got = recipes.run(grid, recipes.requirements([cells.Cue("Hydro", "Hydro", "End", False, False)], *day))
    assert found(got, "section", "property", "ts", "value") == {("Hydro", "LAKE", 0, 1.0), ("Hydro", "LAKE", 1, 2.0), ("Hydro", "DAM", 0, 3.0), ("Hydro", "DAM", 1, 4.0)}


def test_nominations_without_their_sum(spark, day):
    got = recipes.run(sheets(spark, f=[("GR-IT", "1", "2"), ("Sum", "1", "2")]), recipes.nominations(*day))
    assert found(got, "property", "ts", "value") == {("GR-IT", 0, 1.0), ("GR-IT", 1, 2.0)}


def test_real_time_sheets_of_25_columns(spark, day):
    row = lambda name, base: (name, *[str(base + k) for k in range(24)], "0")
    grid = sheets(spark, f=[("Note", *[None] * 25), row("Date", 0), row("Load", 100)], g=[row("Load", 200), row("?", 300)])
    got = recipes.run(grid, recipes.real_time(*day, names=["Total", "Crete"]))
    assert got.where("file = 'f'").count() == 24 and found(got.where("file = 'f' and pos in (0, 23)"), "property", "ts", "value") == {("Load", 0, 100.0), ("Load", 23, 123.0)}
    assert found(got.where("file = 'g' and pos = 5"), "property", "ts", "value") == {("Total", 5, 205.0), ("Crete", 5, 305.0)}


def test_results_of_one_side_are_left_out(spark):
    rows = [("a", 0, "Sell", "x", "RES", 10.0), ("a", 0, "Buy", "x", "RES", 3.0), ("b", 1, "Sell", "x", "RES", 6.0)]
    trades = spark.createDataFrame(rows, "file string, ts int, side string, asset string, classification string, value double")
    got = recipes.run(trades, recipes.market_results(by=["file"]))
    assert {(r.ts, r.asset, r.value) for r in got.where(F.col("asset") == "RES").collect()} == {(0, "RES", 7.0)}
