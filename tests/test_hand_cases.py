"""Tiny frames with answers worked out by hand, for what SQL on the given tables does not reach."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from gridseries.functions import textparts as X
from gridseries.functions import timeparts as T
from gridseries.operators import calendars, catalog, cells, commits, lake, market, store
from gridseries.sources import files as io
from gridseries.streaming import incremental

H = lambda day, hour=0, minute=0: dt.datetime(2024, 1, day, hour, minute)


def series(spark, rows, schema="property string, ts timestamp_ntz, value double"):
    return spark.createDataFrame(rows, schema)


def values(frame, *order, col="value"):
    return [r[col] for r in frame.orderBy(*order).collect()]


def days(spark, *texts):
    return spark.createDataFrame([(dt.date.fromisoformat(t),) for t in texts], "period date")


def test_calendar_of_switch_days(spark):
    got = calendars.period_calendar(days(spark, "2024-03-31", "2024-06-01", "2024-10-27"), "EET").groupBy("period").count().orderBy("period").collect()
    assert [r["count"] for r in got] == [23, 24, 25]
    month = calendars.period_calendar(days(spark, "2024-02-01"), "EET", covered="1 month", resolution_min=1440, start_hour=6)
    assert month.count() == 29 and month.orderBy("ts").first()["local_ts"] == dt.datetime(2024, 2, 1, 6)


def test_short_autumn_and_long_spring_sheets(spark):
    calendar = calendars.period_calendar(days(spark, "2024-03-31", "2024-10-27"), "EET")
    sheet = days(spark, "2024-03-31", "2024-10-27").select("period", F.explode(F.sequence(F.lit(0), F.lit(23))).alias("pos")).withColumn("value", F.col("pos"))
    got = cells.assign_calendar(sheet, calendar)
    spring, autumn = (values(got.where(F.col("period") == d), "ts") for d in ("2024-03-31", "2024-10-27"))
    assert spring == list(range(23)) and autumn == [0, 1, 2, 3, 3, *range(4, 24)]


def test_secondary_resolution_is_taken_for_many_rows(spark):
    day = days(spark, "2024-06-01")
    hourly, quarter = (calendars.period_calendar(day, "EET", resolution_min=m) for m in (60, 15))
    sheet = day.select("period", F.explode(F.sequence(F.lit(0), F.lit(95))).alias("pos")).withColumn("value", F.col("pos"))
    got = cells.assign_calendar(sheet, hourly, secondary=quarter)
    assert got.count() == 96 and values(got, "ts") == list(range(96))


def test_repeated_local_hour(spark):
    wall = [dt.datetime(2024, 10, 27, h) for h in (2, 3, 3, 4)]
    frame = spark.createDataFrame([(i, w) for i, w in enumerate(wall)], "n int, local_ts timestamp_ntz")
    got = calendars.from_local(frame, "EET", order=("n",))
    assert values(got, "n", col="ts") == [dt.datetime(2024, 10, 26, 23), dt.datetime(2024, 10, 27, 0), dt.datetime(2024, 10, 27, 1), dt.datetime(2024, 10, 27, 2)]
    again = calendars.to_timezone(got, "EET", truncate_tz=True)
    assert values(again, "n", col="local_ts") == wall


def test_date_only_end_covers_the_day(spark):
    rows = [("a", dt.datetime(2022, 1, 30) + dt.timedelta(hours=h), 1.0) for h in range(48)]
    assert calendars.slice_time(series(spark, rows), end="2022-01-30").count() == 24
    assert calendars.slice_time(series(spark, rows), "2022-01-30 05:00", "2022-01-30 06").count() == 2
    assert calendars.slice_time(series(spark, rows), start="2022-02").count() == 0


def test_slice_reaches_the_scan(spark, tmp_path):
    series(spark, [("a", H(1), 1.0)]).write.parquet(f"{tmp_path}/s")
    plan = calendars.slice_time(spark.read.parquet(f"{tmp_path}/s"), "2024-01-01", "2024-01-02", tz="EET")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in plan and "LessThan(ts" in plan


GRID = ["Non Dispatchable Load|00:00|00:30|TOTAL", "Load|10|11|21", "Thermal Units|00:00|00:30|", "UNIT_A|5|6|11", "Total Thermal Production|5|6|11", "Hydro Units|00:00|00:30|", "UNIT_H|2||2", "Total Hydro Production|2|0|2"]


def grid(spark):
    rows = [("f", r, c, x or None) for r, line in enumerate(GRID) for c, x in enumerate(line.split("|"))]
    return spark.createDataFrame(rows, "file string, row int, col int, cell string")


def test_sections_consume_and_recipe_end_to_end(spark):
    sheet = cells.truncate_at_trigger(grid(spark), "TOTAL", drop_last=True)
    rows = sheet.where("col = 0").select("file", "row", F.col("cell").alias("indicator"))
    thermal = cells.Cue("Thermal", "Thermal Units", "Total Thermal Production", False, True)
    hydro = cells.Cue("Hydro", "Hydro Units", "Total Hydro Production", False, True)
    found = lambda cues: sorted((r["section"], r["row"]) for r in cells.split_sections(rows, cues).collect())
    assert found([thermal, hydro]) == [("Hydro", 6), ("Hydro", 7), ("Thermal", 3), ("Thermal", 4)]
    assert found([hydro, thermal]) == [("Hydro", 6), ("Hydro", 7)]  # cues consume
    assert found([cells.Cue("x", "absent", "last"), thermal]) == [("Thermal", 3), ("Thermal", 4)]  # a missing cue consumes nothing
    assert found([cells.Cue("x", "UNIT_H", None)]) == [("x", 6), ("x", 7)]
    parts = cells.split_sections(rows, [thermal, hydro]).select("file", "row", "section")
    long = cells.to_double_fill0(cells.transpose_sheet(sheet.join(parts.where("section = 'Hydro'"), ["file", "row"], "left_semi")))
    assert values(long.where("property = 'UNIT_H'"), "pos") == [2.0, 0.0]


def test_one_row_sheet_is_one_section(spark):
    rows = spark.createDataFrame([("f", 4, "x")], "file string, row int, indicator string")
    assert [tuple(r) for r in cells.split_sections(rows, [cells.Cue("a", "y", "z")], whole_name="all").select("section", "row").collect()] == [("all", 4)]


def test_linear_upsampling_edges(spark):
    rows = [("a", H(1, h), v) for h, v in enumerate([None, 1.0, None, 3.0, None])]
    assert values(catalog.upsample_linear(series(spark, rows), ["property"], 1800), "ts") == [None, None, 1, 1.5, 2, 2.5, 3, 3, 3]


def test_upsert_precedence_grid_and_idempotence(spark):
    base, new = series(spark, [("a", H(1, 0), 1.0)]), series(spark, [("a", H(1, 0), 9.0), ("a", H(1, 2), 3.0)])
    once = store.upsert(base, new, ["property", "ts"], 3600)
    assert values(once, "ts") == [1.0, None, 3.0]
    assert values(store.upsert(once, new, ["property", "ts"], 3600), "ts") == [1.0, None, 3.0]
    assert values(store.upsert(base, new, ["property", "ts"], keep="new"), "ts") == [9.0, 3.0]


def test_infer_numeric_threshold(spark):
    rows = [("good", str(i)) for i in range(9)] + [("good", "n/a")] + [("bad", str(i)) for i in range(8)] + [("bad", "x"), ("bad", "y")]
    got = store.infer_numeric(spark.createDataFrame(rows, "property string, text string"), ["property"])
    assert got.where("property = 'good' and value is null").count() == 1 and got.where("property = 'bad' and numeric").count() == 0


def test_null_runs(spark):
    rows = [("a", H(1, h), v) for h, v in enumerate([1.0, None, None, 2.0, None])]
    runs = store.null_runs(series(spark, rows), ["property"])
    assert sorted(values(runs, "start", col="length")) == [1, 2]


def test_net_positions_by_hand(spark):
    rows = [("Sell", "RES", 10.0), ("Buy", "RES", 3.0), ("Buy", "LV", 8.0), ("Buy", "PUMP", 1.0), ("Buy", "GR-AL", 4.0), ("Sell", "AL-GR", 6.0)]
    got = market.net_positions(spark.createDataFrame([(0, *r) for r in rows], "ts int, side string, asset string, value double"), ["ts"])
    assert {r["asset"]: r["value"] for r in got.collect()} == {"RES": 7, "LV": 8, "PUMP": 1, "GR-AL": -2, "Demand": 8, "Generation": 7, "NetMarketSchedule": -2}


def test_one_sided_trades_are_refused(spark):
    trades = spark.createDataFrame([(0, "Buy", "a", 1.0)], "ts int, side string, key string, v double")
    with pytest.raises(ValueError):
        market.side_split(trades, ["ts"], "key", ["a"], "v")


def test_plant_modes_and_units(spark):
    cases = {"a": (5.0, 0.0, 3.0), "b": (0.0, 0.0, 0.0), "c": (0.0, 0.0, 3.0)}
    rows = [(t, f"P_{u}", v) for t, vs in cases.items() for u, v in zip(("GT1", "GT2", "ST"), vs, strict=True)]
    got = market.plant_modes(spark.createDataFrame(rows, "ts string, property string, value double"), ["ts"])
    assert {r["ts"]: r["mode"] for r in got.collect()} == {"a": "1GT+ST", "b": "", "c": "ST"}
    units = market.allocate_units(spark.createDataFrame([("U", "120"), ("U", "out")], "unit string, cell string"), 49, 3)
    assert sorted((r["unit"], r["cell"]) for r in units.collect()) == [("U1", "49"), ("U1", "out"), ("U2", "49"), ("U2", "out"), ("U3", "22"), ("U3", "out")]


def test_versions_below_the_asked_one(spark):
    names = ["20220101_R_02.xlsx", "20220101_R_07.xlsx", "20220102_R_01.xlsx", "2022_bad.xlsx"]
    got = lake.file_versions(lake.file_dates(spark.createDataFrame([(n,) for n in names], "file_name string")))
    pick = lambda v: sorted(r["file_name"] for r in lake.pick_version(got, v).collect())
    assert pick(4) == pick("latest") == [names[1], names[2]] and pick("first") == pick(1) == [names[0], names[2]]


def test_combined_names_and_resolutions(spark):
    a = spark.createDataFrame([(H(1, h), float(h)) for h in range(3)], "ts timestamp_ntz, MCP double")
    b = spark.createDataFrame([(H(1, k // 2, 30 * (k % 2)), float(k)) for k in range(4)], "ts timestamp_ntz, MCP double")
    fine, coarse = catalog.combine([a, b]), catalog.combine([a, b], resolution="max", rename=["x", "y"])
    assert fine.columns == ["ts", "MCP_1", "MCP_2"] and values(fine, "ts", col="MCP_1") == [0, 0.5, 1, 1.5, 2]
    assert values(coarse, "ts", col="y") == [0.5, 2.5, None]


def test_locators(spark):
    leaves = spark.createDataFrame([("P", "R1", "F"), ("P", "R2", "F")], "a string, b string, c string")
    tree = catalog.build_catalog(leaves, ["a", "b", "c"], kinds=("root", "publisher", "report", "file"))
    assert catalog.resolve_node(tree, "r1.f").first()["dna"] == "root.P.R1.F"
    assert catalog.resolve_node(tree, None).first()["dna"] == "root" and catalog.resolve_node(tree, "P/R2").first()["dna"] == "root.P.R2"
    assert catalog.resolve_node(tree, "P.>>").first()["dna"] == "root.P.R1.F"
    for bad in ("F", "nothing"):
        with pytest.raises(LookupError):
            catalog.resolve_node(tree, bad)
    with pytest.raises(LookupError):
        catalog.select_reports(spark.createDataFrame([("a", True)], "report_name string, is_alive boolean"), which="b")


def test_text_functions(spark):
    row = spark.range(1).select(
        X.eval_fraction(F.lit("=120/10^2")).alias("a"), X.eval_fraction(F.lit("=1/0")).alias("b"), X.eval_fraction(F.lit("x=1/2")).alias("c"),
        X.transliterate(F.lit(" Θερμική Παραγωγή ")).alias("d"), X.camel_parts(F.lit("ISP1ISPResults")).alias("e"), X.decimal_comma(F.lit("1.234,5")).alias("f"),
        T.convert_duration(F.lit("48H"), "D").alias("g"), T.convert_duration(F.lit("5min"), "H").alias("h"), T.duration_seconds(F.lit("M")).alias("i"),
    ).first()
    assert row["a"] == "1.2" and row["b"] is None and row["c"] == "x=1/2" and row["d"] == "Thermiki Paragogi"
    assert row["e"] == ["ISP1ISP", "Results"] and row["f"] == 1234.5 and (row["g"], row["h"], row["i"]) == ("2D", "5min", 2_592_000)


def test_csv_series_and_ladder_files(spark, tmp_path):
    (tmp_path / "s.csv").write_text("t;a;note\n2024-01-01 00:00;1,5;x\n2024-01-02;bad;\n2024-01-02 05:06:07;3;y\nnope;4;z\n")
    got = io.read_series(spark, str(tmp_path / "s.csv"), sep=";", decimal=",", text_columns=("note",))
    assert [tuple(r) for r in got.collect()] == [(H(1), 1.5, "x"), (H(2), None, None), (dt.datetime(2024, 1, 2, 5, 6, 7), 3.0, "y"), (None, 4.0, "z")]
    assert io.read_series_or_empty(spark, str(tmp_path / "absent.csv")).count() == 0
    (tmp_path / "l.csv").write_text(",,Buy,Unnamed: 3,Sell,Unnamed: 5\ndatetime,AA,QUANTITY,PRICE,QUANTITY,PRICE\n2024-01-01 00:00,0,5,10,,\n2024-01-01 00:00,1,6,11,7,12\n")
    header = io.ladder_header(spark, str(tmp_path / "l.csv"))
    assert header == [("Buy", "QUANTITY"), ("Buy", "PRICE"), ("Sell", "QUANTITY"), ("Sell", "PRICE")]
    rows = sorted(tuple(r)[1:] for r in io.read_ladder(spark, str(tmp_path / "l.csv"), header).collect())
    assert rows == [(0, "Buy", 5.0, 10.0), (1, "Buy", 6.0, 11.0), (1, "Sell", 7.0, 12.0)]


def test_sheets_and_skipped_files(spark, tmp_path):
    (tmp_path / "a.txt").write_text("x,1\n\ny,,3\n")
    (tmp_path / "b.txt").write_text("")
    got = io.read_cells(spark, f"{tmp_path}/*.txt", tags={"a.txt": "A"})
    assert {(r["row"], r["col"], r["cell"]) for r in got.where("file = 'A'").collect()} == {(0, 0, "x"), (0, 1, "1"), (1, 0, None), (2, 0, "y"), (2, 1, None), (2, 2, "3")}
    files = spark.createDataFrame([("A",), ("b.txt",)], "file string")
    assert [r["file"] for r in io.unreadable(got, files).collect()] == ["b.txt"]


def test_export_refuses_the_database(spark, tmp_path):
    frame = series(spark, [("a", H(1), 1.0)])
    for inside in (f"{tmp_path}/db", f"{tmp_path}/db/x", f"file:{tmp_path}/db/../db/y"):
        with pytest.raises(ValueError):
            io.export_node(frame, inside, f"{tmp_path}/db")
    io.export_node(frame, f"{tmp_path}/db2", f"{tmp_path}/db")


def test_csv_tree_scan(spark, tmp_path):
    (tmp_path / "root/P/R").mkdir(parents=True)
    (tmp_path / "root/P/R/f.csv").write_text("ts,a,b\n1,2,3\n")
    (tmp_path / "root/P/.hidden").mkdir()
    (tmp_path / "root/P/.hidden/g.csv").write_text("ts,c\n1,2\n")
    assert sorted(r["dna"] for r in io.scan_csv_tree(spark, f"{tmp_path}/root").collect()) == ["root", "root.P", "root.P.R", "root.P.R.f", "root.P.R.f.a", "root.P.R.f.b"]


def test_rebuild_keeps_a_backup_and_may_read_what_it_replaces(spark, tmp_path):
    stored = commits.Table(spark, f"{tmp_path}/r")
    stored.append(series(spark, [("a", H(1), 1.0)]))
    for n in (0, 1):
        assert store.rebuild_report(stored, stored.read().withColumn("value", F.col("value") + 1)) == n
    assert [values(stored.read(v), "ts") for v in stored.versions()] == [[1.0], [2.0], [3.0]]


def test_streamed_revisions(spark, tmp_path):
    schema = "property string, ts timestamp_ntz, value double"
    for keep, want in (("existing", 1.0), ("new", 2.0)):
        at = f"{tmp_path}/{keep}"
        for value in (1.0, 2.0):
            series(spark, [("a", H(1), value)]).write.mode("append").parquet(f"{at}/in")
            incremental.stream_upsert(spark.readStream.schema(schema).parquet(f"{at}/in"), f"{at}/out", f"{at}/cp", ["property", "ts"], keep).awaitTermination()
        assert values(commits.Table(spark, f"{at}/out").read(), "ts") == [want]


def test_user_functions(spark):
    frame = series(spark, [("a", H(1), 1.0), ("b", H(1), 2.0)])
    out = catalog.transform_hook(frame, lambda pdf: pdf.assign(value=pdf["value"].cumsum()), frame.schema.simpleString()[7:-1].replace(":", " ").replace(",", ", "), keys=["property"])
    assert values(out, "property") == [1.0, 2.0]


def test_recipe_of_a_schedule(spark):
    from gridseries.plans import recipes

    day = days(spark, "2024-06-01")
    calendar = calendars.period_calendar(day, "EET", resolution_min=720)
    periods = day.select(F.lit("f").alias("file"), "period")
    cues = [cells.Cue("Thermal", "Thermal Units", "Total Thermal Production", False), cells.Cue("Hydro", "Hydro Units", "Total Hydro Production", False)]
    got = recipes.run(grid(spark), recipes.schedule(cues, calendar, periods))
    assert {(r["section"], r["property"], r["pos"], r["value"]) for r in got.where("property like 'UNIT%'").collect()} == {
        ("Thermal", "UNIT_A", 0, 5.0), ("Thermal", "UNIT_A", 1, 6.0), ("Hydro", "UNIT_H", 0, 2.0), ("Hydro", "UNIT_H", 1, 0.0)
    }


def test_recipe_of_market_results(spark):
    from gridseries.plans import recipes

    rows = [(0, "Sell", "x", "RES", 10.0), (0, "Buy", "x", "RES", 3.0), (0, "Buy", "GR-AL", "Exports", 4.0), (0, "Sell", "AL-GR", "Imports", 6.0)]
    got = recipes.run(spark.createDataFrame(rows, "ts int, side string, asset string, classification string, value double"), recipes.market_results())
    assert {r["asset"]: r["value"] for r in got.collect()} == {"RES": 7, "GR-AL": -2, "Demand": 0, "Generation": 7, "NetMarketSchedule": -2}


def test_units_of_a_plant_whose_name_holds_a_unit_mark(spark):
    rows = [("NORTH_STATION_GT1", 1, 5.0), ("NORTH_STATION_ST", 1, 3.0), ("NORTH_GTX", 1, 7.0), ("NORTH_GT2", 1, 2.0)]
    series = spark.createDataFrame(rows, "property string, ts int, value double")
    modes = {r["plant"]: r["mode"] for r in market.plant_modes(series, ["ts"]).collect()}
    assert modes == {"NORTH_STATION": "1GT+ST", "NORTH": "1GT"}


def test_grid_of_several_blocks(spark):
    rows = [("a", H(1), 1.0), ("a", H(2, 0, 1), 2.0), ("b", H(3), 5.0)]
    got = store.fill_grid(series(spark, rows), ["property"], 5)
    a = got.where("property = 'a'").agg(F.count("*"), F.countDistinct("ts"), F.min("ts"), F.max("ts"), F.count("value")).first()
    assert tuple(a) == (17_293, 17_293, H(1), H(2, 0, 1), 2) and values(got.where("property = 'b'"), "ts") == [5.0]
    none = series(spark, [("c", None, 1.0)])
    assert store.fill_grid(none, ["property"], 5).count() == 0 and store.fill_grid(none.limit(0), ["property"], 5).count() == 0


def test_combination_with_frames_without_a_step(spark):
    wide = "ts timestamp_ntz, x double"
    hours = spark.createDataFrame([(H(1), 1.0), (H(1, 1), 2.0)], wide)
    single, empty = spark.createDataFrame([(H(1), 7.0)], wide), spark.createDataFrame([], wide)
    got = {tuple(r) for r in catalog.combine([hours, single, empty]).collect()}
    assert got == {(H(1), 1.0, 7.0, None), (H(1, 1), 2.0, None, None)}
    assert catalog.combine([empty, empty]).count() == 0


def test_first_file_below_a_node(spark):
    leaves = spark.createDataFrame([("p", "r", "f", "x"), ("p", "r", "f", "a"), ("p", "rr", "f", "0")], "publisher string, report string, field string, file string")
    tree = catalog.build_catalog(leaves, ["publisher", "report", "field", "file"])
    assert catalog.resolve_node(tree, "p/r.>>").first()["dna"] == "root.p.r.f.a"


@pytest.mark.parametrize("block", [1, 7, 1024])
def test_best_names_in_blocks_against_all_pairs(spark, block):
    draw = random.Random(block)
    text = lambda: "".join(draw.choice("abCDe -(f") for _ in range(draw.randrange(9)))
    asked, listed = [text() for _ in range(40)] + [None], [text() for _ in range(30)] + ["LoadForecast", "loadForecast"]
    frame = lambda values, name: spark.createDataFrame([(v,) for v in values], f"{name} string")
    refined = lambda t: set(re.sub("[()-]", "", re.sub(" +", " ", (t or "").strip(" "))).lower())
    alike = lambda a, b: len(a & b) / len(a | b) if a | b else 0.0
    split = lambda t: re.split(r"(?<=[a-z])(?=[A-Z])|(?<!^)(?=[A-Z][a-z])", t)
    for parts, of in ((None, lambda t: [t]), (X.camel_parts, split)):
        found = catalog.jaccard_match(frame(asked, "name"), frame(listed, "candidate"), 3, parts=parts, block=block).collect()
        got = {}
        for r in sorted(found, key=lambda r: r["rank"]):
            got.setdefault(r["name"], []).append((-round(r["score"], 9), r["candidate"]))
        scores = {a: [(-round(sum(alike(refined(a), refined(p)) for p in of(c)), 9), c) for c in set(listed)] for a in asked}
        assert got == {a: sorted(s)[:3] for a, s in scores.items()}


def test_best_names_of_none(spark):
    none, one = spark.createDataFrame([], "name string"), spark.createDataFrame([("a",)], "candidate string")
    assert catalog.jaccard_match(none, one).count() == 0
    assert catalog.jaccard_match(one.toDF("name"), one.limit(0)).count() == 0


def sheet(spark, *lines):
    cells_of = [("f", r, c, x) for r, line in enumerate(lines) for c, x in enumerate(line)]
    return spark.createDataFrame(cells_of, "file string, row int, col int, cell string")


def test_recipe_of_unit_availabilities(spark):
    from gridseries.plans import recipes

    given = sheet(
        spark, ("Thermal", None, None, None), ("BIG", "100", "90", "none"), ("BIG_GT1", "50", "45", "none"), ("TRIO", "60", "150", "late"), ("Hydro", None, None, None), ("LAKE", "7", "8", None),
        ("STRAY", "1", "2", None), ("End", None, None, None),
    )
    cues = [cells.Cue("Thermal", "Thermal", "Hydro", False, False), cells.Cue("Hydro", "Hydro", "End", False, False)]
    periods = spark.createDataFrame([("f", dt.date(2024, 1, 2))], "file string, date date")
    moves = spark.createDataFrame([("STRAY", "Thermal")], "unit string, to_section string")
    got = recipes.run(given, recipes.unit_availabilities(cues, periods, moves, ("TRIO", 49.0, 3)))
    found = {(r["section"], r["kind"], r["unit"]): (r["date"].day, r["cell"]) for r in got.collect()}
    assert found["Thermal", "Actual", "BIG"] == (1, "100") and found["Thermal", "Forecast", "BIG"] == (2, "90")
    assert [found["Thermal", "Actual", f"TRIO{k}"][1] for k in (1, 2, 3)] == ["49", "11", "0"] and found["Thermal", "Reason", "TRIO3"] == (2, "late")
    assert found["Thermal", "Forecast", "STRAY"] == (2, "2") and found["Hydro", "Forecast", "LAKE"] == (2, "8") and not any(u == "BIG_GT1" for _, _, u in found)


def test_recipe_of_day_ahead_schedules(spark):
    from gridseries.plans import recipes

    given = sheet(
        spark, ("", "x", "1", "25", "sum"), ("Reserve", None, None, None, None), ("UNIT", "Up", "5", "6", "11"), (None, "Down", "3", "4", "7"), ("End", None, None, None, None),
    )
    day = days(spark, "2024-06-01")
    calendar = calendars.period_calendar(day, "EET", resolution_min=720)
    cues = [cells.Cue("Reserve", "Reserve", "End", False, False)]
    got = recipes.run(given, recipes.day_ahead_schedule(cues, calendar, day.select(F.lit("f").alias("file"), "period"), ("Reserve",)))
    assert {(r["property"], r["pos"], r["value"]) for r in got.collect()} == {("UNIT_Up", 0, 5.0), ("UNIT_Up", 1, 6.0), ("UNIT_Down", 0, 3.0), ("UNIT_Down", 1, 4.0)}


def test_recipes_over_long_frames(spark):
    from gridseries.plans import recipes

    trades = spark.createDataFrame([(1, 10.0, 2.0), (1, 20.0, 2.0)], "ts int, price double, quantity double")
    assert tuple(recipes.run(trades, recipes.continuous_trades(["ts"])).first()) == (1, 15.0, 10.0, 20.0, 4.0)
    blocks = trades.withColumn("kind", F.lit("base"))
    assert recipes.run(blocks, recipes.orders(["ts"], "kind", ["base"], ["price"])).first()["base_price"] == 15.0
    flows = spark.createDataFrame([(1, "A", 2.0), (1, "B", 3.0)], "ts int, border string, flow double")
    assert tuple(recipes.run(flows, recipes.coupling("border", ["A", "B"], "flow", ["ts"])).first()) == (1, 2.0, 3.0)
    bids = spark.createDataFrame([(1, "FCR", "Dn", 2.0), (1, "FCR", "Dn", 1.0), (1, "aFRR", "Dn", 9.0)], "ts int, service string, direction string, price double")
    got = recipes.run(bids, recipes.offers(["ts"], ["price"], "service"))
    assert {(r["service"], r["direction"], r["price"], r["step"]) for r in got.collect()} == {("FCR", "Down", 1.0, 0), ("FCR", "Down", 2.0, 1), ("aFRR", "Down", 9.0, 0)}
    halves = spark.createDataFrame([(1, 1, "U", "S", 5.0), (1, 1, "U", "A", 2.0)], "period int, ts int, property string, section string, value double")
    assert recipes.run(halves, recipes.market_balance("S", "A")).first()["value"] == 3.0


def test_recipe_of_maintenance(spark):
    from gridseries.plans import recipes

    files = spark.createDataFrame([("old", dt.date(2024, 1, 1)), ("new", dt.date(2024, 3, 1))], "file_name string, date date")
    rows = spark.createDataFrame([("old", "U", 0, 90.0, "9 1/5/2024 3/5/2024"), ("new", "U", 0, 40.0, "2 1/5/2024 2/5/2024")], "file_name string, unit string, ord int, mw double, text string")
    units = spark.createDataFrame([("U", 100.0)], "unit string, nominal double")
    calendar = spark.createDataFrame([(dt.date(2024, 5, d),) for d in (1, 2, 3)], "day date")
    got = recipes.run(rows, recipes.maintenance(files, units, calendar))
    assert values(got, "day", col="available") == [60.0, 60.0, 100.0]


def test_modes_of_a_renamed_gas_turbine(spark):
    from gridseries.plans import recipes

    given = sheet(spark, ("Gas", None, None), ("SITE_THISVI", "5", "0"), ("SITE_THISVI_ST", "2", "0"), ("End", None, None))
    day = days(spark, "2024-06-01")
    calendar = calendars.period_calendar(day, "EET", resolution_min=720)
    steps = recipes.realization([], [cells.Cue("Gas", "Gas", "End", False, False)], calendar, day.select(F.lit("f").alias("file"), "period"), {"SITE_THISVI": "SITE_THISVI_GT"}, modes=True)
    assert values(recipes.run(given, steps), "ts", col="mode") == ["1GT+ST", ""]


def test_series_in_utf16_and_columns_that_files_lack(spark, tmp_path):
    for name, encoding in (("a.csv", "utf-8"), ("b.csv", "utf-16")):
        (tmp_path / name).write_text("t,Älpha,b\n2024-01-01 00:00,1.5,x\n2024-01-01 01:00,,y\n", encoding=encoding)
        got = io.read_series(spark, str(tmp_path / name), columns=["Älpha", "none", "b"], text_columns=("b",))
        assert got.columns == ["ts", "Älpha", "b", "none"]
        assert [tuple(r) for r in got.orderBy("ts").collect()] == [(H(1), 1.5, "x", None), (H(1, 1), None, "y", None)]


def test_read_node_of_a_property_that_the_file_lacks(spark):
    rows = [("P", "R", "F", "f", "a", H(1), 1.0), ("P", "R", "F", "f", "b", H(1), 2.0), ("P", "R", "F", "f", "a", H(2), 3.0)]
    store_rows = spark.createDataFrame(rows, "publisher string, report string, field string, file string, property string, ts timestamp_ntz, value double")
    assert values(catalog.read_node(store_rows, "root.p.r.f.f.A"), "ts") == [1.0, 3.0]
    got = catalog.read_node(store_rows, "root.p.r.f.f.none").orderBy("ts").collect()
    assert [(r["property"], r["ts"], r["value"]) for r in got] == [("none", H(1), None), ("none", H(2), None)]
    assert catalog.read_node(store_rows, "root.p.r.f.other.none").count() == 0


def test_files_of_unequal_headers_and_encodings(spark, tmp_path):
    (tmp_path / "d").mkdir()
    write = lambda name, text, encoding="utf-8": (tmp_path / "d" / name).write_bytes(text if isinstance(text, bytes) else text.encode(encoding))
    write("1.csv", "ts,A,B\n2024-01-01 00:00,1,2\n")
    write("2 +é%41.csv", "ts,B,C\r\n2024-01-01 01:00,3,4\r\n")
    write("3.csv", "when,C,Ċ\n2024-01-01 02:00,5,6\n", "utf-16")
    write("4.csv", b"\xfe\xff" + "ts,Ċ,A\n2024-01-01 03:00,7,8\nnever,1,1\n".encode("utf-16-be"))
    write("5.csv", "ts,A\n2024-01-01 04:00,9\n", "utf-8-sig")
    write("6.csv", b"\x00\x01\x80\xff,\n\x00\n")
    write("7.csv", "")
    write("8.csv", "ts,A,a,\n2024-01-01 05:00,10,11,12\n")
    got = io.read_series(spark, f"{tmp_path}/d")
    assert got.columns[0] == "ts" and set(got.columns[1:]) == {"A", "B", "C", "Ċ", "A1", "a2", "_c3"}
    rows = {r.ts.hour: {k: v for k, v in r.asDict().items() if v is not None and k != "ts"} for r in got.where("ts is not null").collect()}
    assert rows == {0: {"A": 1, "B": 2}, 1: {"B": 3, "C": 4}, 2: {"C": 5, "Ċ": 6}, 3: {"Ċ": 7, "A": 8}, 4: {"A": 9}, 5: {"A1": 10, "a2": 11, "_c3": 12}}
    report = {r.file.rpartition("/")[2]: (r.status, r.encoding, r.n_columns, r.n_rows, r.n_unstamped) for r in io.series_report(spark, f"{tmp_path}/d").collect()}
    assert report == {
        "1.csv": ("read", "UTF-8", 3, 1, 0), "2 +é%41.csv": ("read", "UTF-8", 3, 1, 0), "3.csv": ("read", "UTF-16", 3, 1, 0), "4.csv": ("read", "UTF-16", 3, 2, 1), "5.csv": ("read", "UTF-8", 2, 1, 0),
        "6.csv": ("unreadable", None, None, 0, 0), "7.csv": ("empty", None, None, 0, 0), "8.csv": ("read", "UTF-8", 4, 1, 0),
    }


def test_all_blocks_of_a_log(spark):
    logs = spark.createDataFrame([(1, "<R1>\n++a:1\n</R1> between <R2>++A : 2\nWARNING x\n</R2><R1></R1>"), (2, "no block"), (3, None)], "id int, text string")
    got = [(r.id, r.nth, r["name"], dict(r.facts), r.warnings) for r in store.log_facts(logs).orderBy("id", "nth").collect()]
    assert got == [(1, 0, "R1", {"a": "1"}, []), (1, 1, "R2", {"a": "2"}, ["WARNING x"]), (1, 2, "R1", {}, []), (2, 0, "", {}, []), (3, 0, "", {}, [])]


def test_functions_of_other_frequencies(spark):
    rows = [("a", H(1, 1), 4.0), ("a", H(1, 2), 1.0), ("a", H(1, 3), None), ("a", H(3), 5.0)]
    frame = series(spark, rows)
    found = {f: values(io.multi_freq(frame, ["D"], {"a": f})["D"], "ts") for f in io.AGGREGATIONS}
    assert found == {
        "sum": [5, 0, 5], "mean": [2.5, None, 5], "min": [1, None, 5], "max": [4, None, 5], "count": [2, 0, 1], "std": [pytest.approx(4.5**0.5), None, None], "var": [4.5, None, None],
        "median": [2.5, None, 5], "first": [4, None, 5], "last": [1, None, 5],
    }
    with pytest.raises(ValueError, match="kurtosis"):
        io.multi_freq(frame, ["D"], {"a": "kurtosis"})


def test_a_hot_level_is_written_by_several_tasks(spark, tmp_path):
    stamp = (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(mins=F.col("id").cast("int"))).alias("ts")
    rows = spark.range(8000).select(
        F.lit("p").alias("publisher"), F.lit("r").alias("report"), F.lit("f").alias("field"), F.when(F.col("id") % 100 > 0, "hot").otherwise("cold").alias("file"),
        F.lit("x").alias("property"), stamp, F.col("id").cast("double").alias("value"),
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        io.write_series(rows, f"{tmp_path}/tree")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    back = spark.read.parquet(f"{tmp_path}/tree")
    spans = sorted((r["a"], r["b"]) for r in back.where("file = 'hot'").groupBy(F.col("_metadata.file_path")).agg(F.min("ts").alias("a"), F.max("ts").alias("b")).collect())
    assert len(spans) >= 3 and all(b < a for (_, b), (a, _) in zip(spans, spans[1:], strict=False))
    assert back.count() == 8000
