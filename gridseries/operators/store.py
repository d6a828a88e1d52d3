"""Upkeep of stored series and diagnostics of what they hold.

A stored series is long: keys, ``ts`` (naive UTC), ``value``. Steps are in seconds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridseries.functions import timeparts as T
from gridseries.operators import blocks


def update_window(stored: DataFrame, reports: DataFrame, key: str = "report") -> DataFrame:
    """``start, end, needed`` of each report: from the step after the last stamp (or the first potential
    one) to the last potential one. ``reports`` has ``min_ts, max_ts, resolution_s``."""
    last = stored.groupBy(key).agg(F.max("ts").alias("last"))
    joined = reports.join(last, key, "left")
    start = F.coalesce(T.from_seconds(T.seconds(F.col("last")) + F.col("resolution_s")), F.col("min_ts"))
    return joined.select(key, start.alias("start"), F.col("max_ts").alias("end"), (start <= F.col("max_ts")).alias("needed"))


def align_columns(host: DataFrame, new: DataFrame) -> DataFrame:
    """``new`` under ``host``: the host's column order, new columns after, missing values null."""
    return host.unionByName(new, allowMissingColumns=True)


def clean_batch(batch: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key (the first by value) and no empty properties."""
    return batch.where("value is not null").groupBy(*keys).agg(F.min("value").alias("value"))


def append_update(batch: DataFrame, path: str, keys: list[str], partition_by: list[str] = ()) -> None:
    """Large reports: the new batch is cleaned and appended; what is stored is not read."""
    clean_batch(batch, keys).write.mode("append").partitionBy(*partition_by).parquet(path)


def upsert(base: DataFrame, new: DataFrame, keys: list[str], step_s: int | None = None, keep: str = "existing", order: str | None = None) -> DataFrame:
    """Base and new rows with one row per key; the existing one wins, or with ``keep='new'`` the new one.

    Among rows of one side the first by ``order`` (else by value) wins. With ``step_s`` the result is put
    on its full grid (see :func:`fill_grid`).
    """
    both = base.withColumn("__new", F.lit(keep != "existing")).unionByName(new.withColumn("__new", F.lit(keep == "existing")), allowMissingColumns=True)
    values = [c for c in both.columns if c not in (*keys, "__new")]
    rank = F.struct("__new", *([order] if order else []), *[c for c in values if c != order])
    one = both.groupBy(*keys).agg(F.min_by(F.struct(*values), rank).alias("__x")).select(*keys, "__x.*")
    return one if step_s is None else fill_grid(one, [k for k in keys if k != "ts"], step_s)


def _filesystem(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    Path = jvm.org.apache.hadoop.fs.Path
    at = Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at, Path


#: Stamps of a grid that are one array at a time.
GRID_BLOCK = 4096


def grid_rows(series: DataFrame, keys: list[str], step_s: int) -> DataFrame:
    """``keys, ts``: the regular grid of every group from its first to its last stamp.

    A grid is opened to blocks first and each block to its stamps, so no row holds a whole grid.
    """
    block = step_s * GRID_BLOCK
    span = series.groupBy(*keys).agg(T.seconds(F.min("ts")).alias("__a"), T.seconds(F.max("ts")).alias("__b"))
    blocks = span.select(*keys, "__b", F.explode(F.sequence("__a", "__b", F.lit(block).cast("long"))).alias("__from"))
    stamps = F.sequence("__from", F.least(F.col("__from") + block - step_s, F.col("__b")), F.lit(step_s).cast("long"))
    return blocks.select(*keys, F.explode(stamps).alias("__at")).select(*keys, T.from_seconds(F.col("__at")).alias("ts"))


def fill_grid(series: DataFrame, keys: list[str], step_s: int) -> DataFrame:
    """Every group on its regular grid from first to last stamp; new rows are null, stamps off the grid go."""
    return grid_rows(series, keys, step_s).join(series, [*keys, "ts"], "left")


def infer_numeric(texts: DataFrame, keys: list[str], text: str = "text", least: float = 0.9) -> DataFrame:
    """Adds ``numeric`` and ``value``: a column of which ``least`` of the filled cells are numbers is a
    number (its other cells null); another stays text (``value`` null)."""
    number = F.col(text).try_cast("double")
    share = texts.groupBy(*keys).agg((F.count(number) / F.count(text)).alias("share"))
    marked = texts.join(share, keys).withColumn("numeric", F.coalesce(F.col("share") >= least, F.lit(False)))
    return marked.withColumn("value", F.when(F.col("numeric"), number))


def store_status(series: DataFrame, keys: list[str], max_ts: str | None = None) -> DataFrame:
    """Per group and day: sum, whether the day comes after a gap of more than a day, and the group's
    first and last stamp with ``up_to_date`` against ``max_ts``."""
    daily = series.groupBy(*keys, F.date_trunc("day", "ts").cast(T.NTZ).alias("day")).agg(F.sum("value").alias("total"), F.min("ts").alias("a"), F.max("ts").alias("b"))
    group = Window.partitionBy(*keys)
    before = F.lag("day").over(group.orderBy("day"))
    out = daily.withColumn("after_gap", F.coalesce(T.seconds(F.col("day")) - T.seconds(before) > 86_400, F.lit(False)))
    out = out.withColumn("min_ts", F.min("a").over(group)).withColumn("max_ts", F.max("b").over(group)).drop("a", "b")
    return out if max_ts is None else out.withColumn("up_to_date", F.col("max_ts") >= F.lit(max_ts).cast(T.NTZ))


def rebuild_report(table, fresh: DataFrame) -> int:
    """The stored rows of a :class:`gridseries.operators.commits.Table` are replaced by ``fresh``, which may read
    them; gives the version that holds what was stored before (-1 if nothing was)."""
    return table.replace(fresh) - 1


def profile_series(series: DataFrame, keys: list[str], block_s: int = blocks.BLOCK_S) -> DataFrame:
    """One row per group: span, resolution (first difference), rows, nulls, mean, extremes, duplicated
    stamps, missing records and edges of gaps. Null stamps count as rows only."""
    return blocks.profile(series, keys, block_s)


def gap_report(series: DataFrame, keys: list[str], step_s: int, block_s: int = blocks.BLOCK_S) -> DataFrame:
    """Rows whose step differs from the frequency: what is missing before them, in seconds (negative
    for a repeated stamp)."""
    found = blocks.steps(series, keys, block_s)
    return found.select(*keys, "ts", (F.col("step_s") - step_s).alias("missing_s")).where("missing_s <> 0")


def null_runs(series: DataFrame, keys: list[str], block_s: int = blocks.BLOCK_S) -> DataFrame:
    """Runs of consecutive nulls: first and last stamp and length."""
    return blocks.null_runs(series, keys, block_s)


def null_run_histogram(runs: DataFrame, keys: list[str]) -> DataFrame:
    return runs.groupBy(*keys, "length").agg(F.count("*").alias("how_often"))


def label_history(labels: DataFrame, keys: list[str] = ("pos",)) -> DataFrame:
    """Label of each position per date, with ``changed`` against the date before."""
    before = F.lag("label").over(Window.partitionBy(*keys).orderBy("date"))
    first = F.row_number().over(Window.partitionBy(*keys).orderBy("date")) == 1
    return labels.withColumn("before", before).withColumn("changed", ~first & ~F.col("label").eqNullSafe(before))


def compare_stages(keys: list[str], tolerance: float = 0.0, **stages: DataFrame) -> DataFrame:
    """Values of the stages side by side (one column each), with ``differs``."""
    names, out = list(stages), None
    for name, frame in stages.items():
        one = frame.select(*keys, F.col("value").alias(name))
        out = one if out is None else out.join(one, keys, "full_outer")
    first = F.col(names[0])
    same = [F.coalesce(F.abs(first - F.col(n)) <= tolerance, first.isNull() & F.col(n).isNull()) for n in names[1:]]
    differs = F.lit(False)
    for one in same:
        differs = differs | ~one
    return out.withColumn("differs", differs)


def run_summary(log: DataFrame, key: str = "report") -> DataFrame:
    """``status, n, seconds, reports`` from a run log (``report, status, seconds``)."""
    return log.groupBy("status").agg(
        F.count("*").alias("n"), F.sum("seconds").alias("seconds"), F.array_join(F.sort_array(F.collect_set(key)), ",").alias("reports")
    )


def log_facts(logs: DataFrame, text: str = "text", name: str = "name") -> DataFrame:
    """One row for every block ``<name>...</name>`` of a log, in order: its number ``nth``, ``block``, its
    ``++key:value`` lines as map ``facts`` (in lower case) and its warnings. A log without blocks gives one
    row with an empty one."""
    pattern = F.lit(r"(?s)<(\w+)>(.*?)</\1>")
    pairs = F.arrays_zip(F.regexp_extract_all(text, pattern, 1).alias("name"), F.regexp_extract_all(text, pattern, 2).alias("block"))
    opened = logs.select("*", F.posexplode_outer(pairs).alias("nth", "__x"))
    blocks = opened.withColumns({"nth": F.coalesce("nth", F.lit(0)), name: F.coalesce("__x.name", F.lit("")), "block": F.coalesce("__x.block", F.lit(""))}).drop("__x")
    lines = F.regexp_extract_all("block", F.lit(r"\+\+([^\n]*)"), 1)
    pair: Column = F.transform(
        F.filter(lines, lambda x: F.instr(x, ":") > 0),
        lambda x: F.struct(F.lower(F.trim(F.split_part(x, F.lit(":"), F.lit(1)))).alias("key"), F.lower(F.trim(F.split_part(x, F.lit(":"), F.lit(2)))).alias("value")),
    )
    # of a key that repeats the last value stays
    facts = F.aggregate(pair, F.create_map().cast("map<string,string>"), lambda m, x: F.map_concat(F.map_filter(m, lambda k, _: k != x["key"]), F.create_map(x["key"], x["value"])))
    return blocks.withColumn("facts", facts).withColumn("warnings", F.regexp_extract_all("block", F.lit("(WARNING[^\n]*)"), 1))

