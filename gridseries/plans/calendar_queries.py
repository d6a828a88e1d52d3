"""Queries over calendars, dates and time zones."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridseries.functions import timeparts as T
from gridseries.operators import calendars
from gridseries.plans.base import HOURLY_SQL, day, events, hourly, query, table

LOCAL = "timezone('{tz}', timezone('UTC', {ts}))"
UTC = "timezone('UTC', timezone('{tz}', {ts}))"


@query(f"""
WITH days AS (SELECT DISTINCT o_orderdate::DATE::TIMESTAMP AS period FROM orders),
grid AS (SELECT period, unnest(generate_series({UTC.format(tz='EET', ts='period')}, {UTC.format(tz='EET', ts='period + INTERVAL 1 DAY')} - INTERVAL 1 HOUR, INTERVAL 1 HOUR)) AS ts FROM days)
SELECT period, (row_number() OVER (PARTITION BY period ORDER BY ts)) - 1 AS pos, ts, {LOCAL.format(tz='EET', ts='ts')} AS local_ts FROM grid
""")
def period_calendar(spark, sf):
    days = table(spark, sf, "orders").select(F.col("o_orderdate").cast("date").alias("period")).distinct()
    return calendars.period_calendar(days, "EET").select(day("period"), "pos", "ts", "local_ts")


@query(f"""
WITH years AS (SELECT DISTINCT year(o_orderdate) AS year FROM orders),
h AS (SELECT year, unnest(generate_series(make_timestamp(year, 1, 1, 0, 0, 0.0), make_timestamp(year, 12, 31, 23, 0, 0.0), INTERVAL 1 HOUR)) AS utc_ts FROM years),
l AS (SELECT *, {LOCAL.format(tz='CET', ts='utc_ts')} AS local_ts FROM h),
d AS (SELECT *, coalesce(hour(local_ts) - lag(hour(local_ts)) OVER w NOT IN (1, -23), false) AS down FROM l WINDOW w AS (PARTITION BY year ORDER BY utc_ts)),
u AS (SELECT *, coalesce(lead(down) OVER (PARTITION BY year ORDER BY utc_ts), false) AS up FROM d)
SELECT year, utc_ts, local_ts, CASE WHEN down THEN 'downstream' ELSE 'upstream' END AS side FROM u WHERE down OR up
""")
def dst_switches(spark, sf):
    years = table(spark, sf, "orders").select(F.year("o_orderdate").alias("from_year"), F.year("o_orderdate").alias("to_year")).distinct()
    return calendars.dst_switches(years, "CET")


@query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 6 < 5 THEN o_orderdate::DATE::TIMESTAMP END AS day FROM orders
""")
def parse_dates(spark, sf):
    forms = ["yyyyMMdd", "yyyy/MM/dd", "yyyy-MM-dd", "yyyy.M.d", "dd/MM/yyyy"]
    text = F.lit("not a date")
    for k, form in enumerate(forms):
        text = F.when(F.col("o_orderkey") % 6 == k, F.date_format("o_orderdate", form)).otherwise(text)
    return table(spark, sf, "orders").select("o_orderkey", T.parse_date(text).cast(T.NTZ).alias("day"))


@query("SELECT o_orderkey, strftime(o_orderdate, '%d.%m.%Y') AS day_first, strftime(o_orderdate, '%Y/%m/%d') AS year_first FROM orders")
def format_dates(spark, sf):
    orders = table(spark, sf, "orders")
    return orders.select(
        "o_orderkey", T.format_date(F.col("o_orderdate"), "day-month-year", ".").alias("day_first"), T.format_date(F.col("o_orderdate")).alias("year_first")
    )


@query("""
WITH d AS (SELECT p_partkey, p_size AS n, ['sec', 'min', 'H', 'D', 'W', 'M', 'Y'][1 + p_partkey % 7] AS unit FROM part),
f AS (SELECT *, [1, 60, 3600, 86400, 604800, 2592000, 31536000][1 + p_partkey % 7] AS factor FROM d)
SELECT p_partkey, n || unit AS duration, n * factor AS seconds,
       CASE WHEN n * factor >= 86400 THEN (n * factor // 86400) || 'D' ELSE n || unit END AS in_days
FROM f
""")
def normalize_duration(spark, sf):
    units = F.array(*map(F.lit, T.UNIT_SECONDS))
    part = table(spark, sf, "part").withColumn("duration", F.concat("p_size", F.element_at(units, (F.col("p_partkey") % 7 + 1).cast("int"))))
    return part.select("p_partkey", "duration", T.duration_seconds(F.col("duration")).alias("seconds"), T.convert_duration(F.col("duration"), "D").alias("in_days"))


@query(f"""
SELECT ts, property, value, {LOCAL.format(tz='EET', ts='ts')} AS local_ts, (epoch({LOCAL.format(tz='EET', ts='ts')}) - epoch(ts))::BIGINT // 60 AS utc_offset_min
FROM (SELECT ts + to_days((event_id % 400)::INT) AS ts, event_type AS property, value FROM events)
""")
def to_timezone(spark, sf):
    spread = events(spark, sf).select((F.col("ts") + F.make_dt_interval((F.col("event_id") % 400).cast("int"))).alias("ts"), "property", "value")
    return calendars.to_timezone(spread, "EET")


@query(f"""
SELECT period, local_ts, ts FROM (
  WITH days AS (SELECT DISTINCT o_orderdate::DATE::TIMESTAMP AS period FROM orders)
  SELECT period, {LOCAL.format(tz='CET', ts='ts')} AS local_ts, ts FROM (
    SELECT period, unnest(generate_series({UTC.format(tz='CET', ts='period')}, {UTC.format(tz='CET', ts='period + INTERVAL 1 DAY')} - INTERVAL 1 HOUR, INTERVAL 1 HOUR)) AS ts FROM days))
""")
def from_local(spark, sf):
    days = table(spark, sf, "orders").select(F.col("o_orderdate").cast("date").alias("period")).distinct()
    wall = calendars.period_calendar(days, "CET").select("period", "pos", "local_ts")
    return calendars.from_local(wall, "CET", keys=("period",), order=("pos",)).select(day("period"), "local_ts", "ts")


@query(f"""
SELECT * FROM ({HOURLY_SQL}) WHERE {LOCAL.format(tz='EET', ts='ts')} >= TIMESTAMP '2024-01-05' AND {LOCAL.format(tz='EET', ts='ts')} < TIMESTAMP '2024-01-21'
""")
def slice_time(spark, sf):
    return calendars.slice_time(hourly(spark, sf), "2024-01-05", "2024-01-20", tz="EET")


@query(f"""
WITH r AS (
  SELECT p_partkey, DATE '1996-01-01' + (p_partkey % 900)::INT AS a, DATE '1999-01-01' + (p_partkey % 700)::INT AS u, (p_partkey % 24) AS h,
         ['1D', '2W', '1H'][1 + p_partkey % 3] AS period, [1440, 20160, 60][1 + p_partkey % 3] AS minutes, [15, 30, 60][1 + p_size % 3] AS res, ['EET', 'CET', 'UTC'][1 + p_size % 3] AS tz
  FROM part)
SELECT p_partkey, timezone('UTC', timezone(tz, a::TIMESTAMP + to_hours(h))) AS min_ts,
       timezone('UTC', timezone(tz, u::TIMESTAMP + to_hours(h) + to_minutes(minutes))) - to_minutes(res) AS max_ts
FROM r
""")
def potential_bounds(spark, sf):
    pick = lambda values, col: F.element_at(F.array(*map(F.lit, values)), (F.col(col) % 3 + 1).cast("int"))
    reports = table(spark, sf, "part").select(
        "p_partkey",
        F.date_add(F.lit("1996-01-01").cast("date"), (F.col("p_partkey") % 900).cast("int")).alias("available_from"),
        F.date_add(F.lit("1999-01-01").cast("date"), (F.col("p_partkey") % 700).cast("int")).alias("available_until"),
        (F.col("p_partkey") % 24).cast("int").alias("start_hour"),
        pick(["1D", "2W", "1H"], "p_partkey").alias("period"),
        pick([15, 30, 60], "p_size").alias("resolution_min"),
        pick(["EET", "CET", "UTC"], "p_size").alias("inherent_tz"),
    )
    return calendars.potential_bounds(reports).select("p_partkey", "min_ts", "max_ts")
