"""Queries over the file catalogue: one file per order."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridseries.operators import lake
from gridseries.plans.base import DATED_SQL, FILES_SQL, REPORTS_SQL, VERSIONS_SQL, day, files, query


def dated(spark, sf):
    return lake.file_dates(files(spark, sf))


def versions(spark, sf):
    return lake.file_versions(dated(spark, sf), keys=("report",))


def reports(spark, sf):
    """``report, min_potential, max_potential``."""
    return dated(spark, sf).groupBy("report").agg(F.date_add(F.min("date"), 20).alias("min_potential"), F.lit("2001-08-01").cast("date").alias("max_potential"))


@query(f"SELECT report, file_name FROM ({FILES_SQL}) WHERE regexp_matches(file_name, '^19.*_HIGH_.*7\\.xlsx$')")
def match_files(spark, sf):
    return lake.match_files(files(spark, sf), start="19", between="_HIGH_", end="7", extension="xlsx").select("report", "file_name")


@query(f"SELECT report, file_name, date::TIMESTAMP AS date FROM ({DATED_SQL})")
def file_dates(spark, sf):
    return dated(spark, sf).select("report", "file_name", day("date"))


@query(f"SELECT report, file_name, date::TIMESTAMP AS date, true_version, latest_available FROM ({VERSIONS_SQL})")
def file_versions(spark, sf):
    return versions(spark, sf).select("report", "file_name", day("date"), "true_version", "latest_available")


@query(f"SELECT report, date::TIMESTAMP AS date, file_name, true_version FROM ({VERSIONS_SQL}) WHERE true_version = least(2, latest_available)")
def pick_version(spark, sf):
    return lake.pick_version(versions(spark, sf), 2).select("report", day("date"), "file_name", "true_version")


@query(f"""
SELECT report, file_name, date::TIMESTAMP AS date FROM ({DATED_SQL})
WHERE date BETWEEN DATE '1996-03-01' AND DATE '1999-10-31' AND date IN (SELECT o_orderdate::DATE FROM orders WHERE o_orderstatus = 'P')
""")
def slice_files(spark, sf):
    from gridseries.plans.base import table

    wanted = table(spark, sf, "orders").where("o_orderstatus = 'P'").select(F.col("o_orderdate").cast("date").alias("date"))
    return lake.slice_files(dated(spark, sf), "1996-03-01", "1999-10-31", wanted).select("report", "file_name", day("date"))


@query(f"SELECT report, file_name, (date - CASE WHEN report = 'LOW' THEN 30 ELSE 1 END)::TIMESTAMP AS date FROM ({DATED_SQL})")
def shift_lag(spark, sf):
    lag = F.when(F.col("report") == "LOW", 30).otherwise(1)
    return lake.shift_lag(dated(spark, sf), lag).select("report", "file_name", day("date"))


@query(f"""
SELECT r.report, min_potential::TIMESTAMP AS min_potential, max_potential::TIMESTAMP AS max_potential, min_observed::TIMESTAMP AS min_observed,
       max_observed::TIMESTAMP AS max_observed, max_observed >= max_potential AND min_observed <= min_potential AS up_to_date
FROM ({REPORTS_SQL}) r JOIN (SELECT report, min(date) AS min_observed, max(date) AS max_observed FROM ({DATED_SQL}) GROUP BY 1) USING (report)
""")
def lake_coverage(spark, sf):
    return lake.lake_coverage(dated(spark, sf), reports(spark, sf)).select(
        "report", day("min_potential"), day("max_potential"), day("min_observed"), day("max_observed"), "up_to_date"
    )


@query(f"""
WITH seen AS (SELECT DISTINCT report, date FROM ({DATED_SQL})), last AS (SELECT report, max(date) AS m FROM seen GROUP BY 1),
ideal AS (SELECT report, unnest(generate_series(min_potential::TIMESTAMP, m::TIMESTAMP, INTERVAL 1 DAY))::DATE AS date FROM ({REPORTS_SQL}) JOIN last USING (report))
SELECT report, (date + 2)::TIMESTAMP AS date FROM ideal ANTI JOIN seen USING (report, date)
""")
def missing_periods(spark, sf):
    known = reports(spark, sf).withColumn("lag", F.lit(2))
    return lake.missing_periods(dated(spark, sf), known, lag_col="lag").select("report", day("date"))


@query(f"""
WITH a AS (SELECT date, count(*) AS n FROM ({DATED_SQL}) GROUP BY 1),
b AS (SELECT date, count(*) AS n FROM ({DATED_SQL}) WHERE NOT (report = 'HIGH' OR date > DATE '2001-01-01') GROUP BY 1)
SELECT date::TIMESTAMP AS date, coalesce(b.n, 0) AS versions_before, coalesce(a.n, 0) AS versions_after, coalesce(a.n, 0) - coalesce(b.n, 0) AS added
FROM a FULL JOIN b USING (date) WHERE coalesce(a.n, 0) <> coalesce(b.n, 0)
""")
def refresh_diff(spark, sf):
    now = dated(spark, sf)
    before = now.where("not (report = 'HIGH' or date > '2001-01-01')")
    return lake.refresh_diff(before, now).select(day("date"), "versions_before", "versions_after", "added")


@query(f"""
WITH seen AS (SELECT DISTINCT report, date FROM ({DATED_SQL})),
gone AS (SELECT report, date FROM seen WHERE dayofmonth(date) = 13),
days AS (SELECT report, unnest(generate_series(greatest(DATE '1995-01-01', min_potential)::TIMESTAMP, least(DATE '2003-01-01', max_potential)::TIMESTAMP, INTERVAL 1 DAY))::DATE AS date FROM ({REPORTS_SQL})),
open AS (SELECT * FROM days ANTI JOIN (SELECT * FROM seen WHERE date < DATE '1999-01-01') USING (report, date) ANTI JOIN gone USING (report, date)),
span AS (SELECT report, min(date) AS a, max(date) AS b FROM open GROUP BY 1)
SELECT report, unnest(generate_series(a::TIMESTAMP, b::TIMESTAMP, INTERVAL 1 DAY))::TIMESTAMP AS date FROM span
""")
def plan_ingest(spark, sf):
    seen = dated(spark, sf)
    wanted = reports(spark, sf).withColumn("start", F.lit("1995-01-01").cast("date")).withColumn("end", F.lit("2003-01-01").cast("date"))
    plan = lake.plan_ingest(wanted, seen.where("date < '1999-01-01'"), seen.where("day(date) = 13"))
    return plan.select("report", day("date"))


@query(f"""
SELECT file_name, CASE WHEN regexp_matches(file_name, '_(HIGH|URGENT)_') THEN 'prio' WHEN regexp_matches(file_name, '_LOW_.*[05]\\.xlsx$') THEN 'rest_low' END AS category,
       split_part(file_name, '_', -2) AS market
FROM ({FILES_SQL})
""")
def classify_files(spark, sf):
    named = lake.classify_files(files(spark, sf), [("top-prio", "_(HIGH|URGENT)_"), ("rest_low", r"_LOW_.*[05]\.xlsx$")], rename=("^top-", ""))
    return named.select("file_name", "category", lake.market_parts(F.col("file_name"))[0].alias("market"))


@query(f"""
SELECT report, year, date::TIMESTAMP AS date, file_name FROM (
  SELECT report, year(date) AS year, date, file_name, row_number() OVER (PARTITION BY report, year(date) ORDER BY date DESC, file_name DESC) AS n FROM ({DATED_SQL}))
WHERE n = 1
""")
def latest_per_year(spark, sf):
    return lake.latest_per_year(dated(spark, sf), ("report",)).select("report", "year", day("date"), "file_name")
