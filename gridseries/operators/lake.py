"""The catalogue of raw files: names, dates, versions, gaps and what to load next."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def glob_pattern(start: str = "*", between: str = "*", end: str = "*", extension: str = "*") -> str:
    """Regular expression of ``start*between*end.extension`` with ``*`` for any run of characters."""
    glob = re.sub(r"\*+", "*", f"{start}*{between}*{end}.{extension}")
    return "^" + ".*".join(re.escape(part) for part in glob.split("*")) + "$"


def match_files(files: DataFrame, name_col: str = "file_name", **parts: str) -> DataFrame:
    """Files whose name is eligible; for a scan of a store pass the glob to ``pathGlobFilter``."""
    return files.where(F.col(name_col).rlike(glob_pattern(**parts)))


def file_dates(files: DataFrame, name_col: str = "file_name") -> DataFrame:
    """Adds ``date`` from the first run of digits that is a day (8) or a stamp to the second (14); files without
    a date are left out. The digits of a longer number, such as a key, are no date."""
    day = F.try_to_date(F.nullif(F.regexp_extract(name_col, r"(?<!\d)\d{8}(?=(?:\d{6})?(?!\d))", 0), F.lit("")), "yyyyMMdd")
    return files.withColumn("date", day).where("date is not null")


def file_versions(files: DataFrame, name_col: str = "file_name", keys: tuple[str, ...] = ()) -> DataFrame:
    """Adds ``true_version`` (1, 2, ... by name) and ``latest_available`` of each date."""
    day = Window.partitionBy(*keys, "date")
    return files.withColumn("true_version", F.row_number().over(day.orderBy(name_col))).withColumn("latest_available", F.count("*").over(day).cast("int"))


def pick_version(files: DataFrame, version: int | str = "latest") -> DataFrame:
    """One file per date: the asked version, or the latest one below it."""
    wanted = {"latest": F.col("latest_available"), "first": F.lit(1)}.get(version, F.least(F.lit(version), F.col("latest_available")))
    return files.where(F.col("true_version") == wanted)


def slice_files(files: DataFrame, start: str | None = None, end: str | None = None, dates: DataFrame | None = None) -> DataFrame:
    """Files from ``start`` to ``end``, both included, and of the listed ``date`` values."""
    if start is not None:
        files = files.where(F.col("date") >= F.lit(start).cast("date"))
    if end is not None:
        files = files.where(F.col("date") <= F.lit(end).cast("date"))
    return files if dates is None else files.join(dates.select("date").distinct(), "date", "left_semi")


def shift_lag(files: DataFrame, lag_days: Column | int) -> DataFrame:
    """File dates moved back by the days that publication lags."""
    return files.withColumn("date", F.date_sub("date", lag_days if isinstance(lag_days, Column) else F.lit(lag_days)))


def lake_coverage(files: DataFrame, reports: DataFrame, key: str = "report") -> DataFrame:
    """Observed against potential dates (``min_potential, max_potential``) of each report."""
    seen = files.groupBy(key).agg(F.min("date").alias("min_observed"), F.max("date").alias("max_observed"))
    fresh = (F.col("max_observed") >= F.col("max_potential")) & (F.col("min_observed") <= F.col("min_potential"))
    return reports.join(seen, key, "left").withColumn("up_to_date", F.coalesce(fresh, F.lit(False)))


def missing_periods(files: DataFrame, reports: DataFrame, key: str = "report", lag_col: str | None = None) -> DataFrame:
    """Dates from ``min_potential`` to the last observed one that have no file, publication lag added back."""
    seen = files.select(key, "date").distinct()
    last = seen.groupBy(key).agg(F.max("date").alias("last"))
    ideal = reports.join(last, key).select("*", F.explode(F.sequence("min_potential", F.greatest("last", "min_potential"))).alias("date"))
    gaps = ideal.where("date <= last").join(seen, [key, "date"], "left_anti")
    return gaps.select(key, (F.date_add("date", F.col(lag_col)) if lag_col else F.col("date")).alias("date"))


def refresh_diff(before: DataFrame, after: DataFrame) -> DataFrame:
    """``date, versions_before, versions_after, added`` of dates whose number of versions changed."""
    count = lambda frame, name: frame.groupBy("date").agg(F.count("*").alias(name))
    both = count(before, "versions_before").join(count(after, "versions_after"), "date", "full_outer").na.fill(0)
    return both.where("versions_before <> versions_after").withColumn("added", F.col("versions_after") - F.col("versions_before"))


def plan_ingest(
    wanted: DataFrame, present: DataFrame, known_missing: DataFrame | None = None, key: str = "report", fill_range: bool = True
) -> DataFrame:
    """``report, date`` to load: the wanted range (``start, end``) inside the potential one, without
    present and known missing dates, then (``fill_range``) everything from the first to the last left.
    """
    ranged = wanted.withColumn("start", F.greatest("start", "min_potential")).withColumn("end", F.least("end", "max_potential"))
    days = ranged.where("start <= end").select(key, F.explode(F.sequence("start", "end")).alias("date"))
    left = days.join(present.select(key, "date").distinct(), [key, "date"], "left_anti")
    if known_missing is not None:
        left = left.join(known_missing.select(key, "date").distinct(), [key, "date"], "left_anti")
    if not fill_range:
        return left
    return left.groupBy(key).agg(F.min("date").alias("a"), F.max("date").alias("b")).select(key, F.explode(F.sequence("a", "b")).alias("date"))


def split_candidates(candidates: DataFrame, present: DataFrame, name_col: str = "file_name") -> DataFrame:
    """Candidate names with ``is_new``: false where a file of that name is present already."""
    have = present.select(name_col).distinct().withColumn("__have", F.lit(True))
    return candidates.join(have, name_col, "left").withColumn("is_new", F.col("__have").isNull()).drop("__have")


def classify_files(files: DataFrame, categories: list[tuple[str, str]], rename: tuple[str, str] | None = None, name_col: str = "file_name") -> DataFrame:
    """Adds ``category``: the first one whose pattern the name matches, then renamed; others stay null.

    Categories are a short list from configuration, so they become one expression, not a join.
    """
    label = F.coalesce(*[F.when(F.col(name_col).rlike(p), F.lit(c)) for c, p in categories], F.lit(None).cast("string"))
    return files.withColumn("category", F.regexp_replace(label, *rename) if rename else label)


def market_parts(name: Column) -> tuple[Column, Column]:
    """(market, category) of a report name: its last but one and last part, split by underscores."""
    parts = F.split(name, "_")
    return F.try_element_at(parts, F.lit(-2)), F.try_element_at(parts, F.lit(-1))


def latest_per_year(files: DataFrame, keys: tuple[str, ...] = (), name_col: str = "file_name") -> DataFrame:
    """The most recent file of every year; of files of one date the last by name."""
    best = files.groupBy(*keys, F.year("date").alias("year")).agg(F.max(F.struct("date", name_col)).alias("x"))
    return best.select(*keys, "year", "x.date", f"x.{name_col}")
