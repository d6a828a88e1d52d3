"""Validity windows of days: which window holds on a day, and disjoint segments.

A window (``from_date`` to ``to_date``, both included) is cut into aligned blocks of 1, 2, 4, ... days, as in
a segment tree: at most two of each length, so a window of a hundred years takes about thirty rows and
not one for each day. Of all windows that cover a block the last one (greatest ``ord``) stays; this
is an aggregation with partial sums, so a border with a third of all windows is no task of its own.
A day meets the block of each length that holds it, by equality, and takes the last of these.

Windows without a start, an end or an ``ord`` and windows that end before they start hold on no
day. Of windows with equal ``ord`` the greatest content wins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Lengths of blocks: 2 to the power of 0 .. 22 days hold every date of the calendar.
LEVELS = 22


def blocks_of(windows: DataFrame, keys: list[str], content: list[str]) -> DataFrame:
    """``keys, level, block, last``: the last window (struct of ``ord`` and ``content``) of those that have the block."""
    at = windows.where("ord is not null and from_date <= to_date").select(
        *keys, F.struct("ord", *content).alias("last"), F.unix_date("from_date").alias("__a"), (F.unix_date("to_date") + 1).alias("__e")
    )
    first, end = "-shiftright(-__a, l)", "shiftright(__e, l)"  # blocks of a length that lie inside: from `first` up to `end`
    pieces = at.select(*keys, "last", F.expr(f"""explode(flatten(transform(sequence(0, {LEVELS}), l -> filter(array(
        if({first} < {end} and ({first} & 1) = 1, named_struct('level', l, 'block', {first}), null),
        if({first} < {end} and ({end} & 1) = 1, named_struct('level', l, 'block', {end} - 1), null)), x -> x is not null))))""").alias("p"))
    return pieces.select(*keys, "p.level", "p.block", "last").groupBy(*keys, "level", "block").agg(F.max("last").alias("last"))


def holding(windows: DataFrame, days: DataFrame, keys: list[str], content: list[str]) -> DataFrame:
    """``keys, day, ord, content`` of the last window on each of the ``days`` (``keys, day``) that has one."""
    asked = days.select(*keys, "day", F.explode(F.sequence(F.lit(0), F.lit(LEVELS))).alias("level")).withColumn("block", F.expr("shiftright(unix_date(day), level)"))
    met = asked.join(blocks_of(windows, keys, content), [*keys, "level", "block"]).groupBy(*keys, "day").agg(F.max("last").alias("last"))
    return met.select(*keys, "day", "last.*")


def disjoint_segments(windows: DataFrame, keys: list[str], content: list[str]) -> DataFrame:
    """``keys, from_date, to_date, ord, content``: the windows without overlaps, the last one winning.

    Only edges of windows are looked at. A window that is covered in its middle gives two segments;
    neighbours of one window are one segment. Days without a window are in no segment. The
    running scans hold one row for each distinct edge of a key, which the days of the calendar bound.
    """
    held = windows.where("ord is not null and from_date <= to_date")
    edges = held.select(*keys, F.explode(F.array("from_date", F.date_add("to_date", 1))).alias("day")).distinct()
    # keys may be null, so the edges come back by null-safe equality
    named = holding(held.withColumns({k: F.struct(k) for k in keys}), edges.withColumns({k: F.struct(k) for k in keys}), keys, content)
    named = named.withColumns({k: F.col(f"{k}.{k}") for k in keys})
    bare = edges.select(*keys, "day", F.lit(None).cast(named.schema["ord"].dataType).alias("ord"), *[F.lit(None).cast(named.schema[c].dataType).alias(c) for c in content])
    both = named.unionByName(bare).groupBy(*keys, "day").agg(F.max(F.struct("ord", *content)).alias("last"))
    run = Window.partitionBy(*keys).orderBy("day")
    both = both.withColumn("__new", ~F.col("last").eqNullSafe(F.lag("last").over(run)) | F.lag("day").over(run).isNull())
    starts = both.where("__new").withColumn("to_date", F.date_sub(F.lead("day").over(run), 1))
    return starts.where("last.ord is not null").select(*keys, F.col("day").alias("from_date"), "to_date", "last.*")
