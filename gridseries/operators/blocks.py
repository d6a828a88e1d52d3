"""Scans along time of series of any length.

A series is cut into blocks of time. Windows run inside a block, so no task holds a whole series; each block is
folded to one row (its first and last stamp, its known edges, its open runs), those rows are scanned along
each series, and what crosses a border of blocks is made of them. ``block_s`` is the length of a block in seconds:
its rows should fit a task easily, and a series' blocks too (28 days of a quarter-hourly series have 2,688 rows,
a century of them 1,300 blocks).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridseries.functions import timeparts as T

BLOCK_S = 28 * 86_400
BLOCK = "__block"


def cut(series: DataFrame, block_s: int = BLOCK_S) -> DataFrame:
    """Adds the number of each row's block; all rows of one stamp have one block."""
    return series.withColumn(BLOCK, F.floor(T.seconds(F.col("ts")) / block_s))


def inside(keys: list[str]):
    """Window over the rows of a block along time."""
    return Window.partitionBy(*keys, BLOCK).orderBy("ts")


def along(keys: list[str]):
    """Window over the blocks of a series; for folded blocks only."""
    return Window.partitionBy(*keys).orderBy(BLOCK)


def steps(series: DataFrame, keys: list[str], block_s: int = BLOCK_S) -> DataFrame:
    """``keys, ts, step_s`` of every row but a series' first: seconds since the row before it. The first row of a
    block has its step from the block before."""
    rows = cut(series.select(*keys, "ts"), block_s)
    near = rows.withColumn("step_s", T.seconds(F.col("ts")) - T.seconds(F.lag("ts").over(inside(keys))))
    edges = rows.groupBy(*keys, BLOCK).agg(F.min("ts").alias("ts"), F.max("ts").alias("__last"))
    far = edges.withColumn("step_s", T.seconds(F.col("ts")) - T.seconds(F.lag("__last").over(along(keys))))
    return near.select(*keys, "ts", "step_s").unionByName(far.select(*keys, "ts", "step_s")).where("step_s is not null")


def null_runs(series: DataFrame, keys: list[str], block_s: int = BLOCK_S) -> DataFrame:
    """``keys, start, end, length`` of every run of consecutive nulls.

    A run between two values of a block is whole. A block's run before its first value, and the one after its
    last, may go on in the next blocks: these, two of a block at most, are numbered along the series and added.
    """
    rows = cut(series.select(*keys, "ts", "value"), block_s)
    run = F.count("value").over(inside(keys))
    values = F.count("value").over(Window.partitionBy(*keys, BLOCK))
    marked = rows.withColumn("__run", run).withColumn("__values", values)
    empty = F.col("value").isNull()
    spans = marked.where(empty & (F.col("__run") > 0) & (F.col("__run") < F.col("__values")))
    whole = spans.groupBy(*keys, BLOCK, "__run").agg(F.min("ts").alias("start"), F.max("ts").alias("end"), F.count("*").alias("length"))

    def edge(at: Column) -> Column:
        here = empty & at
        return F.struct(F.min(F.when(here, F.col("ts"))).alias("start"), F.max(F.when(here, F.col("ts"))).alias("end"), F.count_if(here).alias("length"))

    folded = marked.groupBy(*keys, BLOCK, "__values").agg(edge(F.col("__run") == 0).alias("__head"), edge(F.col("__run") == F.col("__values")).alias("__tail"))
    open_before = F.coalesce(F.lag(F.col("__tail.length") > 0).over(along(keys)), F.lit(False))
    joined = folded.withColumn("__open", open_before)
    head = F.struct(F.lit(0).alias("place"), F.col("__open").alias("goes_on"), F.col("__head").alias("run"))
    tail = F.struct(F.lit(1).alias("place"), F.lit(False).alias("goes_on"), F.col("__tail").alias("run"))
    edges = joined.select(*keys, BLOCK, F.explode(F.when(F.col("__values") == 0, F.array(head)).otherwise(F.array(head, tail))).alias("x")).where("x.run.length > 0")
    number = F.sum(F.when(F.col("x.goes_on"), 0).otherwise(1)).over(Window.partitionBy(*keys).orderBy(BLOCK, "x.place"))
    crossing = edges.withColumn("__n", number).groupBy(*keys, "__n").agg(F.min("x.run.start").alias("start"), F.max("x.run.end").alias("end"), F.sum("x.run.length").alias("length"))
    return whole.select(*keys, "start", "end", "length").unionByName(crossing.select(*keys, "start", "end", "length"))


def known_around(series: DataFrame, keys: list[str], block_s: int = BLOCK_S) -> DataFrame:
    """Adds ``before`` and ``after``, structs of stamp (seconds) and value: the last known value up to each row and
    the first one from it on, wherever in the series they lie."""
    at = F.when(F.col("value").isNotNull(), F.struct(T.seconds(F.col("ts")).alias("t"), F.col("value").alias("v")))
    rows = cut(series, block_s)
    up_to, onward = inside(keys).rowsBetween(Window.unboundedPreceding, 0), inside(keys).rowsBetween(0, Window.unboundedFollowing)
    near = rows.withColumn("before", F.last(at, ignorenulls=True).over(up_to)).withColumn("after", F.first(at, ignorenulls=True).over(onward))
    folded = rows.groupBy(*keys, BLOCK).agg(F.max(at).alias("__last"), F.min(at).alias("__first"))
    past, coming = along(keys).rowsBetween(Window.unboundedPreceding, -1), along(keys).rowsBetween(1, Window.unboundedFollowing)
    carried = folded.select(*keys, BLOCK, F.last("__last", ignorenulls=True).over(past).alias("__b"), F.first("__first", ignorenulls=True).over(coming).alias("__a"))
    both = near.join(carried, [*keys, BLOCK], "left")
    return both.withColumn("before", F.coalesce("before", "__b")).withColumn("after", F.coalesce("after", "__a")).drop("__a", "__b", BLOCK)


def profile(series: DataFrame, keys: list[str], block_s: int = BLOCK_S) -> DataFrame:
    """See :func:`gridseries.operators.store.profile_series`."""
    n = F.count("*").alias("n")
    stamps = series.groupBy(*keys, "ts").agg(
        n, F.count("value").alias("filled"), F.sum("value").alias("total"), F.min("value").alias("low"), F.max("value").alias("high")
    )
    rows = cut(stamps, block_s)
    marked = rows.withColumn("__before", F.lag("ts").over(inside(keys)))
    folded = marked.groupBy(*keys, BLOCK).agg(
        F.min("ts").alias("first"), F.min(F.when(F.col("__before").isNotNull(), F.col("ts"))).alias("second"), F.max("ts").alias("last"), F.sum("n").alias("n"), F.sum("filled").alias("filled"),
        F.sum("total").alias("total"), F.min("low").alias("low"), F.max("high").alias("high"), F.sum(F.when(F.col("n") > 1, F.col("n")).otherwise(0)).alias("copies"), F.sum(F.col("n") - 1).alias("repeats"),
    )
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col("first").asc_nulls_last()))
    ranked = folded.withColumn("__k", place)
    second = F.min(F.when(F.col("__k") == 1, F.col("second")).when(F.col("__k") == 2, F.col("first")))
    whole = ranked.groupBy(*keys).agg(
        F.min("first").alias("start"), F.max("last").alias("end"), (T.seconds(second) - T.seconds(F.min("first"))).alias("resolution_s"), F.sum("n").alias("n_rows"), (F.sum("n") - F.sum("filled")).alias("n_nulls"),
        (F.sum("total") / F.sum("filled")).alias("mean"), F.min("low").alias("min_value"), F.max("high").alias("max_value"), F.sum("copies").alias("n_duplicates"), F.sum("repeats").alias("__repeats"),
    )
    # steps are counted by length first, as the resolution is known for whole series only
    far = folded.select(*keys, (T.seconds(F.col("first")) - T.seconds(F.lag("last").over(along(keys)))).alias("step"))
    lengths = marked.select(*keys, (T.seconds(F.col("ts")) - T.seconds(F.col("__before"))).alias("step")).unionByName(far).where("step is not null").groupBy(*keys, "step").agg(F.count("*").alias("__steps"))
    renamed = whole.select(*[F.col(k).alias(f"__{k}") for k in keys], F.col("resolution_s").alias("__usual"))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__{k}"))
    leaps = lengths.join(renamed, same).where("step <> __usual").groupBy(*[f"__{k}" for k in keys]).agg(F.sum("__steps").alias("__leaps"))
    out = whole.join(leaps, same, "left")
    missing = F.floor((T.seconds(F.col("end")) - T.seconds(F.col("start"))) / F.col("resolution_s")) + 1 - F.col("n_rows")
    n_leaps = F.when(F.col("resolution_s").isNull(), 0).otherwise(F.coalesce("__leaps", F.lit(0)) + F.col("__repeats"))
    return out.select(
        *keys, "start", "end", "resolution_s", "n_rows", "n_nulls", "mean", "min_value", "max_value", "n_duplicates", missing.alias("n_missing"), n_leaps.cast("long").alias("n_leaps"),
    )
