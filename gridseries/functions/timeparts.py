"""Column functions for dates, durations and time zones. Naive stamps are ``timestamp_ntz`` in UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NTZ = "timestamp_ntz"

#: Seconds of a duration unit. Months have 30 and years 365 days.
UNIT_SECONDS = {"sec": 1, "min": 60, "H": 3600, "D": 86_400, "W": 604_800, "M": 2_592_000, "Y": 31_536_000}


def naive(ts: Column) -> Column:
    return ts.cast(NTZ)


def utc_to_local(ts: Column, tz: str) -> Column:
    """Naive UTC to naive wall time."""
    return F.from_utc_timestamp(ts.cast("timestamp"), tz).cast(NTZ)


def local_to_utc(ts: Column, tz: str) -> Column:
    """Naive wall time to naive UTC; of the two instants of a repeated hour the first."""
    return F.to_utc_timestamp(ts.cast("timestamp"), tz).cast(NTZ)


def seconds(ts: Column) -> Column:
    """Seconds since 1970 of a naive stamp."""
    return F.unix_timestamp(ts.cast("timestamp"))


def from_seconds(sec: Column) -> Column:
    return F.timestamp_seconds(sec).cast(NTZ)


def floor_to(ts: Column, step_seconds: int) -> Column:
    """Start of the bucket of ``step_seconds``, counted from 1970."""
    return from_seconds(F.floor(seconds(ts) / step_seconds) * step_seconds)


def steps(start: Column, end: Column, step_seconds: int) -> Column:
    """Array of naive stamps from ``start`` to ``end``, both included; empty if end is before start."""
    grid = F.sequence(seconds(start), seconds(end), F.lit(step_seconds).cast("long"))
    return F.when(seconds(end) >= seconds(start), F.transform(grid, from_seconds)).otherwise(F.array().cast(f"array<{NTZ}>"))


def parse_date(text: Column) -> Column:
    """Date of ``YYYYMMDD``, or of year, month, day parted by ``/``, ``-`` or ``.``; else null."""
    dashed = F.regexp_replace(F.trim(text), "[/.]", "-")
    return F.coalesce(F.try_to_date(dashed, "yyyy-M-d"), F.try_to_date(dashed, "yyyyMMdd"), F.try_to_date(dashed, "d-M-yyyy"))


def parse_stamp(text: Column) -> Column:
    """Naive stamp of text to the minute, of a date, or of any form that Spark casts; else null."""
    return F.coalesce(
        F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm")).cast(NTZ),
        F.try_to_timestamp(text, F.lit("yyyy-MM-dd")).cast(NTZ),
        text.try_cast("timestamp").cast(NTZ),
    )


def format_date(day: Column, order: str = "year-month-day", sep: str = "/") -> Column:
    """Zero-padded parts of a date in the given order."""
    forms = {"year": "yyyy", "month": "MM", "day": "dd"}
    return F.date_format(day, sep.join(f"'{p}'" if p not in forms else forms[p] for p in order.split("-")).replace("'", ""))


def duration_seconds(text: Column) -> Column:
    """Seconds of ``15min``, ``2W``, ``M`` (number 1) and the like; unknown units are null."""
    unit = F.regexp_extract(text, "[A-Za-z]+", 0)
    number = F.coalesce(F.try_to_number(F.nullif(F.regexp_extract(text, r"\d+", 0), F.lit("")), F.lit("999999999")), F.lit(1)).cast("long")
    factors = F.create_map(*[F.lit(x) for pair in UNIT_SECONDS.items() for x in pair])
    return number * F.try_element_at(factors, unit)


def convert_duration(text: Column, to_unit: str) -> Column:
    """Duration text in another unit, whole units only; the input where it is less than one."""
    units = F.floor(duration_seconds(text) / UNIT_SECONDS[to_unit])
    return F.when(units > 0, F.concat(units.cast("string"), F.lit(to_unit))).when(units == 0, text)
