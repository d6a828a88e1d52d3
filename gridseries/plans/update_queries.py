"""Queries of the update run: monthly sheets of order lines go to the lake, and through two runs to the store."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridseries.functions import textparts as X
from gridseries.operators import calendars, lineage
from gridseries.operators.commits import Table
from gridseries.plans import recipes, update
from gridseries.plans.base import query, scratch, table
from gridseries.sources import files as io

#: Reports of the two families; one of the first holds a text that its recipe does not stand.
GRID, PLAIN, BROKEN = ("AF", "NO", "RF"), ("AO", "NF", "RO"), "RF"


def write_sheets(spark, sf, root: str) -> None:
    """One text file per report and month: a row for each line number, a column for each day. Of the family
    ``PLAIN`` files of February are no text, those of March are empty, and a cell in April is a word."""
    lines = table(spark, sf, "lineitem").select(
        F.concat("l_returnflag", "l_linestatus").alias("report"), F.trunc("l_shipdate", "month").alias("date"), F.dayofmonth("l_shipdate").alias("day"), F.col("l_linenumber").alias("n"), F.col("l_quantity").alias("q"),
    )
    daily = lines.groupBy("report", "date", "n", "day").agg(F.sum("q").alias("q"))
    by_day = F.map_from_entries(F.collect_list(F.struct("day", "q")))
    row = F.transform(F.sequence(F.lit(1), F.dayofmonth(F.last_day("date"))), lambda d: F.coalesce(F.try_element_at(F.col("days"), d).cast("string"), F.lit("")))
    sheet = daily.groupBy("report", "date", "n").agg(by_day.alias("days")).select("report", "date", "n", F.concat(F.lit("L"), F.col("n"), F.lit(","), F.array_join(row, ",")).alias("line"))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", "line"))), lambda x: x["line"]), "\n")
    whole = sheet.groupBy("report", "date").agg(text.alias("value"))
    plain, month = F.col("report").isin(*PLAIN), F.month("date")
    value = (
        F.when(plain & (month == 2), F.unhex(F.lit("FF80FE2C00C1")).cast("string")).when(plain & (month == 3), "").when(plain & (month == 4), F.concat("value", F.lit("\nL9,n/a")))
        .when((F.col("report") == BROKEN) & (month == 5), F.concat("value", F.lit("\nL9,n/a"))).otherwise(F.col("value"))
    )
    whole.withColumn("value", value).withColumn("folder", F.concat_ws("_", "report", "date")).repartition("folder").select("folder", "value").write.mode("overwrite").partitionBy("folder").text(root)


def read(spark, paths: list[str]):
    return io.read_cells(spark, paths, name_pattern="folder=([^/]+)/")


def steps(planned, strict: bool = False) -> list[recipes.Step]:
    periods = planned.select("period").distinct()
    calendar = calendars.period_calendar(periods, "UTC", resolution_min=1440, covered="1 month")
    bad = F.col("cell").isNotNull() & X.number(F.col("cell")).isNull()
    stop = F.when(bad, F.raise_error(F.concat(F.lit("text among numbers in "), F.col("file")))).otherwise(F.col("cell"))

    def placed(long):
        """Stamps by position for each file on its own, as files of several reports share a period."""
        return long.join(calendar.join(planned.select("file", "period"), "period").select("file", "pos", "ts"), ["file", "pos"])

    check = [lambda long: long.withColumn("cell", stop)] if strict else []
    values = recipes.numbers() if strict else lambda long: long.withColumn("value", F.when(F.col("cell").isNull(), 0.0).otherwise(X.number(F.col("cell"))))
    return [recipes.transposed(), *check, values, placed]


def families() -> list[update.Family]:
    return [update.Family("grid", read, partial(steps, strict=True)), update.Family("plain", read, steps)]


def two_runs(spark, sf) -> tuple[Table, Table, str, DataFrame]:
    """The store, the log, the staging folder and the files after a run up to 1997 and one over all sheets."""
    at = scratch(spark, "update")
    stored, log = Table(spark, f"{at}/store", ["report"]), Table(spark, f"{at}/log", zones=())
    write_sheets(spark, sf, f"{at}/lake")
    known = [(r, f) for f, names in (("grid", GRID), ("plain", PLAIN)) for r in names]
    listed = update.list_files(spark, f"{at}/lake", F.regexp_extract("path", "folder=([^/]+)/", 1)).where("file <> ''")
    catalogue = listed.select(F.split_part("file", F.lit("_"), F.lit(1)).alias("report"), F.split_part("file", F.lit("_"), F.lit(2)).cast("date").alias("date"), "file", "path")
    for last in ("1997-12-31", "2001-10-31"):
        reports = spark.createDataFrame(known, "report string, family string").withColumns({"min_potential": F.lit("1995-01-01").cast("date"), "max_potential": F.lit(last).cast("date")})
        update.run_update(spark, catalogue, reports, families(), stored, log, f"{at}/staging")
    return stored, log, f"{at}/staging", catalogue


SHEETS_SQL = """
SELECT l_returnflag || l_linestatus AS report, date_trunc('month', l_shipdate)::DATE AS date, l_linenumber AS n, l_shipdate::DATE AS day, sum(l_quantity) AS q FROM lineitem
WHERE l_shipdate < TIMESTAMP '2001-11-01' GROUP BY ALL
"""
#: Every row of a sheet has all days of its month; files that are no text or empty have none.
STORED_SQL = f"""
SELECT report, 'L' || n AS property, d::TIMESTAMP AS ts, coalesce(q, 0) AS value, date FROM (
  SELECT report, date, n, unnest(generate_series(date::TIMESTAMP, date + INTERVAL 1 MONTH - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS d FROM (SELECT DISTINCT report, date, n FROM ({SHEETS_SQL}))
) LEFT JOIN (SELECT report, n, day::TIMESTAMP AS d, q FROM ({SHEETS_SQL})) USING (report, n, d)
WHERE report <> '{BROKEN}' AND NOT (report IN {PLAIN} AND month(date) IN (2, 3))
"""


@query(f"""
WITH f AS (SELECT DISTINCT report, date, CASE WHEN date < DATE '1998-01-01' THEN 0 ELSE 1 END AS run FROM ({SHEETS_SQL})),
planned AS (SELECT report, date, run FROM f UNION ALL SELECT report, date, 1 FROM f WHERE run = 0 AND report = '{BROKEN}'),
n AS (SELECT report, date, count(*) AS n_rows FROM ({STORED_SQL}) GROUP BY ALL)
SELECT run, report, CASE WHEN report IN {GRID} THEN 'grid' ELSE 'plain' END AS family, CASE WHEN report = '{BROKEN}' THEN 'failed' WHEN report IN {PLAIN} THEN 'partial' ELSE 'stored' END AS status,
       count(*) AS n_files, count(*) FILTER (report <> '{BROKEN}' AND NOT (report IN {PLAIN} AND month(date) IN (2, 3))) AS n_loaded,
       coalesce(sum(n_rows), 0)::BIGINT + count(*) FILTER (report IN {PLAIN} AND month(date) = 4) AS n_rows, report = '{BROKEN}' AS explained
FROM planned LEFT JOIN n USING (report, date) GROUP BY ALL
""")
def update_run(spark, sf):
    """Reports of both runs: one that fails beside two that are stored, and files left out of three others."""
    _, log, _, _ = two_runs(spark, sf)
    return update.report_log(log.read()).select("run", "report", "family", "status", "n_files", "n_loaded", "n_rows", F.coalesce(F.contains("note", F.lit("text among numbers in RF")), F.lit(False)).alias("explained"))


@query(f"SELECT report, property, ts, value FROM ({STORED_SQL})")
def update_store(spark, sf):
    """What both runs have stored."""
    return two_runs(spark, sf)[0].read().select("report", "property", "ts", "value")


#: Cells of all sheets, and the id of the row of each line number; words stand in a row of their own.
CELLS_SQL = f"""
SELECT report || '_' || strftime(date, '%Y-%m-%d') AS file, report, date, 'L' || n AS property, (dense_rank() OVER (PARTITION BY report, date ORDER BY n) - 1)::INT AS row, day(day)::INT AS col, day, q
FROM ({SHEETS_SQL})
"""


@query(f"""
WITH c AS ({CELLS_SQL}), kept AS (SELECT * FROM c WHERE report <> '{BROKEN}' AND NOT (report IN {PLAIN} AND month(date) IN (2, 3))),
corrected AS (SELECT report, property, ts, value + 0.5 AS value FROM ({STORED_SQL}) WHERE property = 'L3' AND day(ts) = 15),
rows AS (SELECT DISTINCT file, report, date, property, row FROM kept),
words AS (SELECT file, report, date, count(DISTINCT row)::INT AS row FROM c WHERE (report IN {PLAIN} AND month(date) = 4) OR (report = '{BROKEN}' AND month(date) = 5) GROUP BY ALL)
SELECT r.file, r.row, 15 AS col, q::VARCHAR AS cell, report, property, ts, coalesce(q, 0) AS parsed, value AS stored, 'same' AS parsing, 'replaced' AS storing
FROM corrected JOIN rows r USING (report, property) LEFT JOIN kept k ON k.file = r.file AND k.property = r.property AND k.day::TIMESTAMP = ts WHERE date_trunc('month', ts) = r.date
UNION ALL SELECT NULL, NULL, NULL, NULL, report, 'total', date::TIMESTAMP, NULL, 1, NULL, 'orphan' FROM (SELECT DISTINCT report, date FROM rows)
UNION ALL SELECT file, row, 1, 'n/a', report, 'L9', date::TIMESTAMP, NULL, NULL, 'text', NULL FROM words WHERE report <> '{BROKEN}'
UNION ALL SELECT file, row, col, q::VARCHAR, NULL, NULL, NULL, NULL, NULL, 'unread', NULL FROM c WHERE report = '{BROKEN}'
""")
def cell_lineage(spark, sf):
    """Every disagreement of sheets, parsed and stored values with its cell, after some stored values were corrected by
    hand (``L3`` on the 15th) and totals were added that no sheet has."""
    stored, log, staging, catalogue = two_runs(spark, sf)
    have = stored.read().select(*update.KEYS, "value")
    corrected = have.where((F.col("property") == "L3") & (F.dayofmonth("ts") == 15)).withColumn("value", F.col("value") + 0.5)
    totals = have.select("report", F.lit("total").alias("property"), F.date_trunc("month", "ts").cast("timestamp_ntz").alias("ts"), F.lit(1.0).alias("value")).distinct()
    stored.upsert(corrected.unionByName(totals), update.KEYS, keep="new")
    return lineage.disagreements(update.trace(spark, families(), catalogue, log, stored, staging))
