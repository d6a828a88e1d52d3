"""All registered queries over the given tables, and the SQL that must give the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridseries.functions.timeparts import NTZ
from gridseries.operators import calendars, store
from gridseries.plans import (
    base,
    calendar_queries,
    catalog_queries,
    cell_queries,
    lake_queries,
    market_queries,
    source_queries,
    store_queries,
    update_queries,
)
from gridseries.plans.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "calendar_queries", "catalog_queries", "cell_queries", "flagship", "lake_queries", "market_queries", "source_queries", "store_queries", "update_queries"]


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly mean per property on the full grid, in EET, for a local date range."""
    hours = base.events(spark, sf_dir).withColumn("ts", F.date_trunc("hour", "ts").cast(NTZ))
    means = hours.groupBy("property", "ts").agg(F.round(F.avg("value"), 6).alias("value"))
    grid = store.fill_grid(means, ["property"], 3600)
    return calendars.to_timezone(calendars.slice_time(grid, "2024-01-05", "2024-01-20", tz="EET"), "EET", truncate_tz=True)
