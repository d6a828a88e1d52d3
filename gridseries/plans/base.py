"""Registration of queries, and the views of the given tables that several of them share."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridseries.functions.timeparts import NTZ

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a function under its name, with the SQL that gives the same rows."""

    def add(run: Callable[[SparkSession, str], DataFrame]):
        QUERIES[run.__name__] = run
        if sql is not None:
            ORACLES[run.__name__] = sql
        return run

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder that driver and executors share: below ``spark.checkpoint.dir`` where the cluster
    names it, else (in tests, on a local master alone) below a temporary folder."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        shared = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def day(col: str):
    """A date as a naive stamp, so that results compare the same everywhere."""
    return F.col(col).cast(NTZ).alias(col)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``event_id, ts, property, value``."""
    return table(spark, sf_dir, "events").select("event_id", "ts", F.col("event_type").alias("property"), "value")


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``ts, property, value``: the greatest value per hour and event type (exact in any engine)."""
    return events(spark, sf_dir).groupBy(F.date_trunc("hour", "ts").cast(NTZ).alias("ts"), "property").agg(F.max("value").alias("value"))


HOURLY_SQL = "SELECT date_trunc('hour', ts)::TIMESTAMP AS ts, event_type AS property, max(value) AS value FROM events GROUP BY 1, 2"


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``report, file_name`` of one file per order: ``yyyyMMdd_<priority>_<key>.xlsx``; some names are ill-formed."""
    orders = table(spark, sf_dir, "orders")
    stamp = F.when(F.col("o_orderkey") % 97 == 0, F.lit("undated")).otherwise(F.date_format("o_orderdate", "yyyyMMdd"))
    report = F.regexp_replace("o_orderpriority", "[^A-Z]", "")
    return orders.select(
        report.alias("report"),
        F.concat(stamp, F.lit("_"), report, F.lit("_"), F.lpad(F.col("o_orderkey").cast("string"), 12, "0"), F.lit(".xlsx")).alias("file_name"),
    )


FILES_SQL = """
SELECT regexp_replace(o_orderpriority, '[^A-Z]', '', 'g') AS report,
       (CASE WHEN o_orderkey % 97 = 0 THEN 'undated' ELSE strftime(o_orderdate, '%Y%m%d') END) || '_'
       || regexp_replace(o_orderpriority, '[^A-Z]', '', 'g') || '_' || lpad(o_orderkey::VARCHAR, 12, '0') || '.xlsx' AS file_name
FROM orders
"""
DATED_SQL = f"""
SELECT report, file_name, strptime(regexp_extract(file_name, '[0-9]{{8}}'), '%Y%m%d')::DATE AS date
FROM ({FILES_SQL}) WHERE file_name NOT LIKE 'undated%'
"""
# an undated name has a run of digits too: the key; its first eight digits are no date, so it is left out
VERSIONS_SQL = f"""
SELECT *, row_number() OVER (PARTITION BY report, date ORDER BY file_name) AS true_version,
       count(*) OVER (PARTITION BY report, date) AS latest_available
FROM ({DATED_SQL})
"""
REPORTS_SQL = f"""
SELECT report, min(date) + 20 AS min_potential, DATE '2001-08-01' AS max_potential FROM ({DATED_SQL}) GROUP BY report
"""
