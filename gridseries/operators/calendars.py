"""Calendars of published periods, daylight-saving switches and time-zone moves of series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridseries.functions import timeparts as T


def period_calendar(
    periods: DataFrame, tz: str, resolution_min: int = 60, start_hour: int = 0, covered: str = "1 day", start_col: str = "period"
) -> DataFrame:
    """``period, pos, ts, local_ts``: the instants of each local period, 23 or 25 hours on switch days.

    ``covered`` is an interval such as ``1 day``, ``1 month`` or ``1 year``.
    """
    start = F.col(start_col).cast(T.NTZ) + F.expr(f"interval {start_hour} hours")
    end = start + F.expr(f"interval {covered}")
    step = resolution_min * 60
    last = T.from_seconds(T.seconds(T.local_to_utc(end, tz)) - step)
    grid = T.steps(T.local_to_utc(start, tz), last, step)
    return periods.select(start_col, F.posexplode(grid).alias("pos", "ts")).withColumn("local_ts", T.utc_to_local(F.col("ts"), tz))


def dst_switches(years: DataFrame, tz: str, keep: str = "both", from_col: str = "from_year", to_col: str = "to_year") -> DataFrame:
    """``year, utc_ts, local_ts, side``: hours before (``upstream``) and after (``downstream``) a switch.

    One row of ``years`` gives one range. Every year is cut out on its own, so years run in parallel.
    """
    year = F.explode(F.sequence(F.col(from_col), F.col(to_col)))
    hours = T.steps(F.make_timestamp_ntz("year", F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0)), F.make_timestamp_ntz("year", F.lit(12), F.lit(31), F.lit(23), F.lit(0), F.lit(0)), 3600)
    hourly = years.select(year.alias("year")).distinct().select("year", F.explode(hours).alias("utc_ts"))
    local = hourly.withColumn("local_ts", T.utc_to_local(F.col("utc_ts"), tz))
    over = Window.partitionBy("year").orderBy("utc_ts")
    hour = F.hour("local_ts")
    jump = ~(hour - F.lag(hour).over(over)).isin(1, -23)
    marked = local.withColumn("down", F.coalesce(jump, F.lit(False))).withColumn("up", F.coalesce(F.lead("down").over(over), F.lit(False)))
    side = F.when(F.col("down"), "downstream").when(F.col("up"), "upstream")
    found = marked.withColumn("side", side).where("side is not null")
    return (found if keep == "both" else found.where(F.col("side") == keep)).select("year", "utc_ts", "local_ts", "side")


def to_timezone(series: DataFrame, tz: str | None, truncate_tz: bool = False, ts_col: str = "ts") -> DataFrame:
    """Adds ``local_ts`` and, unless ``truncate_tz``, ``utc_offset_min``; ``tz`` None leaves the series alone."""
    if tz is None:
        return series
    local = T.utc_to_local(F.col(ts_col), tz)
    out = series.withColumn("local_ts", local)
    if truncate_tz:
        return out
    return out.withColumn("utc_offset_min", ((T.seconds(local) - T.seconds(F.col(ts_col))) / 60).cast("int"))


def from_local(series: DataFrame, tz: str, local_col: str = "local_ts", keys: tuple[str, ...] = (), order: tuple[str, ...] = ()) -> DataFrame:
    """Adds ``ts``, UTC: of rows that repeat a wall time the second is the later instant.

    Rows repeat in each group of ``keys`` and are told apart by ``order``. Only a wall time that does
    occur twice is moved, by the length of the switch.
    """
    first = T.local_to_utc(F.col(local_col), tz)
    later = T.from_seconds(T.seconds(first) + 3600)
    twice = T.utc_to_local(later, tz) == F.col(local_col)
    rank = F.row_number().over(Window.partitionBy(*keys, local_col).orderBy(*order))
    return series.withColumn("__n", rank).withColumn("ts", F.when((F.col("__n") > 1) & twice, later).otherwise(first)).drop("__n")


def _bound(text: str, end: bool) -> tuple[str, str]:
    """(stamp, unit that an inclusive end adds) of ``YYYY``, ``YYYY-MM``, ``YYYY-MM-DD`` or finer text."""
    parts = text.strip().replace("T", " ")
    forms = [(4, "-01-01", "1 year"), (7, "-01", "1 month"), (10, "", "1 day"), (13, ":00", "1 hour"), (16, "", "1 minute")]
    for length, rest, unit in forms:
        if len(parts) == length:
            return parts + rest, unit if end else "0 seconds"
    return parts, "1 second" if end else "0 seconds"


def slice_time(series: DataFrame, start: str | None = None, end: str | None = None, tz: str = "UTC", ts_col: str = "ts") -> DataFrame:
    """Rows whose wall time in ``tz`` lies between two texts, both included to their precision.

    The bounds are moved to UTC, so the filter reaches the scan of the stored column.
    """

    def instant(text: str, plus: str) -> Column:
        wall = F.lit(text).cast(T.NTZ) + F.expr(f"interval {plus}")
        return T.local_to_utc(wall, tz)

    if start is not None:
        at, _ = _bound(start, False)
        series = series.where(F.col(ts_col) >= instant(at, "0 seconds"))
    if end is not None:
        at, unit = _bound(end, True)
        series = series.where(F.col(ts_col) < instant(at, unit))
    return series


def potential_bounds(reports: DataFrame) -> DataFrame:
    """Adds ``min_ts`` and ``max_ts``: the first and last instant that a report can have, in UTC.

    Needs ``available_from, available_until`` (dates), ``start_hour``, ``period`` (duration text),
    ``resolution_min`` and ``inherent_tz`` (one of the session's zones, per row).
    """
    start = F.col("available_from").cast("timestamp") + F.make_dt_interval(F.lit(0), F.col("start_hour"))
    until = F.col("available_until").cast("timestamp") + F.make_dt_interval(F.lit(0), F.col("start_hour"))
    end = F.timestamp_seconds(F.unix_timestamp(until) + T.duration_seconds(F.col("period")))
    utc = lambda ts: F.to_utc_timestamp(ts, F.col("inherent_tz"))
    return reports.withColumn("min_ts", T.naive(utc(start))).withColumn(
        "max_ts", T.from_seconds(F.unix_timestamp(utc(end)) - F.col("resolution_min") * 60)
    )
