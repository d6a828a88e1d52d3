"""Readers of series, ladders and raw sheets, writers and exports, and the scan of a stored tree."""

from __future__ import annotations

import csv
import posixpath
import unicodedata
import urllib.parse
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridseries.functions import textparts as X
from gridseries.functions import timeparts as T
from gridseries.operators.calendars import slice_time, to_timezone
from gridseries.operators.catalog import build_catalog

STAMP = "yyyy-MM-dd HH:mm"


MARKS = {b"\xff\xfe": ("UTF-16", "\n\0"), b"\xfe\xff": ("UTF-16", "\0\n"), b"\xef\xbb\xbf": ("UTF-8", None)}


@dataclass(frozen=True)
class Layout:
    """Files that have one header, and how it reads."""

    encoding: str
    columns: tuple[str, ...]
    paths: tuple[str, ...]


def _first_lines(spark: SparkSession, paths: str | list[str], line_sep: str | None = None) -> dict[str, bytes]:
    """The first line of every file that has one. All lines are scanned, one row per file is kept."""
    reader = spark.read.option("lineSep", line_sep) if line_sep else spark.read
    at = F.url_decode(F.regexp_replace("_metadata.file_path", r"\+", "%2B"))
    lines = reader.text(paths).select(at.alias("file"), F.col("_metadata.file_block_start").alias("start"), F.col("value").cast("binary").alias("line"))
    first = lines.where("start = 0").withColumn("n", F.monotonically_increasing_id()).groupBy("file").agg(F.min_by("line", "n").alias("line"))
    return {r["file"]: bytes(r["line"]) for r in first.collect()}  # as many rows as Spark's own listing of the files


def _columns(header: str, sep: str) -> tuple[str, ...]:
    """Names of a header line: blank ones take their number, of equal ones each has its number appended."""
    names = [n.strip() for n in next(csv.reader([header], delimiter=sep), [])]
    lower = [n.lower() for n in names]
    return tuple(f"_c{k}" if not n else f"{n}{k}" if lower.count(n.lower()) > 1 else n for k, n in enumerate(names))


def series_layouts(spark: SparkSession, path: str | list[str], sep: str = ",", encoding: str = "UTF-8") -> tuple[list[Layout], dict[str, str]]:
    """Layouts of CSV files, and the reason for each file that has none: ``empty``, or ``unreadable`` if its first
    line is no text of its encoding. A byte order mark decides the encoding of its file alone."""
    heads, marked = _first_lines(spark, path), {}
    listed = spark.read.text(path).inputFiles()
    bad = dict.fromkeys(set(map(urllib.parse.unquote, listed)) - set(heads), "empty")
    for mark, (_, line_sep) in MARKS.items():
        wide = sorted(f for f, line in heads.items() if line.startswith(mark) and line_sep)
        marked |= _first_lines(spark, wide, line_sep) if wide else {}
    found: dict[tuple[str, tuple[str, ...]], list[str]] = {}
    for file, line in sorted((heads | marked).items()):
        mark = next((m for m in MARKS if line.startswith(m)), b"")
        own = MARKS[mark][0] if mark else encoding
        try:
            header = line.decode(own if mark != b"\xef\xbb\xbf" else "utf-8-sig").rstrip("\r\n")
        except UnicodeError:
            bad[file] = "unreadable"
            continue
        if not header.strip():
            bad[file] = "empty"
        elif any(unicodedata.category(c) == "Cc" and c != "\t" for c in header) or "\ufffd" in header:
            bad[file] = "unreadable"
        else:
            found.setdefault((own, _columns(header, sep)), []).append(file)
    return [Layout(e, c, tuple(files)) for (e, c), files in found.items()], bad


def _read_layout(spark: SparkSession, layout: Layout, sep: str) -> DataFrame:
    schema = ", ".join(f"`{c.replace('`', '``')}` string" for c in layout.columns)
    return spark.read.csv(list(layout.paths), header=True, schema=schema, sep=sep, encoding=layout.encoding, multiLine=layout.encoding == "UTF-16")


def read_series(
    spark: SparkSession, path: str | list[str], tz: str | None = None, sep: str = ",", decimal: str = ".", encoding: str = "UTF-8", columns: list[str] | None = None, text_columns: tuple[str, ...] = (), order: str | None = None
) -> DataFrame:
    """Wide series of CSV files: the first column is ``ts``, the others doubles (or texts, as named).

    Every file is read by its own header and mark: columns are joined by name, and a file that lacks one has nulls
    there. Files of one layout are one scan, so only the columns asked for are parsed; a file in UTF-16 is not
    split. Empty files and files that are no text are left out (see :func:`series_report`).

    Stamps are read to the minute, as dates, or freely. With ``tz`` they are wall time and come out in
    UTC; to tell the two instants of a repeated hour apart rows need an ``order`` column. Named columns
    that all files lack are null and stand last.
    """
    layouts, _ = series_layouts(spark, path, sep, encoding)
    names = list(dict.fromkeys(c for x in layouts for c in x.columns[1:]))
    wanted = [n for n in names if columns is None or n in columns] + [n for n in columns or [] if n not in names]
    number = (lambda c: X.decimal_comma(c)) if decimal == "," else X.number
    kind = lambda n: "string" if n in text_columns else "double"
    quoted = lambda n: F.col(f"`{n.replace('`', '``')}`")
    frame = None
    for layout in layouts:
        raw = _read_layout(spark, layout, sep)
        own = [F.lit(None).cast(kind(n)) if n not in layout.columns[1:] else quoted(n) if n in text_columns else number(quoted(n)) for n in wanted]
        one = raw.select(T.parse_stamp(quoted(layout.columns[0])).alias("ts"), *[c.alias(n) for c, n in zip(own, wanted, strict=True)])
        frame = one if frame is None else frame.unionByName(one)
    if frame is None:
        frame = spark.createDataFrame([], "ts timestamp_ntz").select("ts", *[F.lit(None).cast(kind(n)).alias(n) for n in wanted])
    if tz is None:
        return frame
    if order is None:
        return frame.withColumn("ts", T.local_to_utc(F.col("ts"), tz))
    from gridseries.operators.calendars import from_local

    return from_local(frame.withColumnRenamed("ts", "local_ts"), tz, order=(order,)).drop("local_ts").select("ts", *wanted)


def series_report(spark: SparkSession, path: str | list[str], sep: str = ",", encoding: str = "UTF-8") -> DataFrame:
    """``file, status, encoding, n_columns, n_rows, n_unstamped`` of every CSV file: ``read``, ``empty`` or
    ``unreadable`` (then without the rest), and how many of its rows have no stamp that can be read."""
    layouts, bad = series_layouts(spark, path, sep, encoding)
    out = spark.createDataFrame([(f, why) for f, why in sorted(bad.items())], "file string, status string").withColumns(
        {"encoding": F.lit(None).cast("string"), "n_columns": F.lit(None).cast("int"), "n_rows": F.lit(0).cast("long"), "n_unstamped": F.lit(0).cast("long")}
    )
    at = F.url_decode(F.regexp_replace("_metadata.file_path", r"\+", "%2B")).alias("file")
    for layout in layouts:
        stamp = T.parse_stamp(F.col(f"`{layout.columns[0].replace('`', '``')}`"))
        rows = _read_layout(spark, layout, sep).select(at, stamp.isNull().alias("bad")).groupBy("file").agg(F.count("*").alias("n_rows"), F.count_if("bad").alias("n_unstamped"))
        every = spark.createDataFrame([(p,) for p in layout.paths], "file string").join(rows, "file", "left")
        out = out.unionByName(every.select(
            "file", F.lit("read").alias("status"), F.lit(layout.encoding).alias("encoding"), F.lit(len(layout.columns)).alias("n_columns"),
            F.coalesce("n_rows", F.lit(0)).cast("long").alias("n_rows"), F.coalesce("n_unstamped", F.lit(0)).cast("long").alias("n_unstamped"),
        ))
    return out


def read_series_or_empty(spark: SparkSession, path: str, schema: str = "ts timestamp_ntz", **options) -> DataFrame:
    """:func:`read_series`, or an empty frame where the path does not exist."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    if not at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(at):
        return spark.createDataFrame([], schema)
    return read_series(spark, path, **options)


def read_ladder(spark: SparkSession, path: str, header: list[tuple[str, str]], sep: str = ",") -> DataFrame:
    """Ladder ``ts, aa, side, quantity, price`` of CSV files with two header rows and two index columns.

    ``header`` names the value columns as (side, QUANTITY or PRICE), as :func:`ladder_header` reads them.
    """
    names = ["ts", "aa", *[f"{side}|{kind}" for side, kind in header]]
    raw = spark.read.csv(path, sep=sep, schema=", ".join(f"`{n}` string" for n in names))
    body = raw.withColumn("aa", F.col("aa").try_cast("int")).where("aa is not null")
    sides = list(dict.fromkeys(s for s, _ in header))
    rows = F.array(*[
        F.struct(F.lit(s).alias("side"), *[(X.number(F.col(f"`{s}|{kind}`")) if (s, kind) in header else F.lit(None).cast("double")).alias(kind.lower()) for kind in ("QUANTITY", "PRICE")])
        for s in sides
    ])
    long = body.select(T.parse_stamp(F.col("ts")).alias("ts"), "aa", F.explode(rows).alias("x")).select("ts", "aa", "x.*")
    return long.where("quantity is not null or price is not null")


def ladder_header(spark: SparkSession, path: str, sep: str = ",") -> list[tuple[str, str]]:
    """(side, kind) of the value columns from the two header rows of one file; ``Unnamed`` labels are
    blank and take the label before."""
    top, low = (r["value"].split(sep) for r in spark.read.text(path).limit(2).collect())
    out, side = [], ""
    for a, b in zip(top[2:], low[2:], strict=True):
        side = side if not a.strip() or a.startswith("Unnamed") else a.strip()
        out.append((side, b.strip()))
    return out


def read_cells(spark: SparkSession, path: str, sep: str = ",", tags: dict[str, str] | None = None, name_pattern: str = "([^/]+)$") -> DataFrame:
    """Cell grid ``file, row, col, cell`` of sheets kept as one text file each; empty cells are null.

    A file is one sheet and is read whole, so its rows keep their order. The group of ``name_pattern``
    in the path names it; ``tags`` renames files (sheet locators) by that name.
    """
    name = F.regexp_extract(F.col("_metadata.file_path"), name_pattern, 1)
    if tags:
        name = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for p in tags.items() for x in p]), name), name)
    sheets = spark.read.option("recursiveFileLookup", True).text(path, wholetext=True)
    lines = sheets.select(name.alias("file"), F.posexplode(F.split(F.regexp_replace("value", "\r?\n$", ""), "\r?\n")).alias("row", "line"))
    cells = lines.select("file", "row", F.posexplode(F.split("line", F.lit(f"\\Q{sep}\\E"))).alias("col", "cell"))
    return cells.withColumn("cell", F.nullif(F.trim("cell"), F.lit("")))


def unreadable(cells: DataFrame, files: DataFrame, least: int = 1) -> DataFrame:
    """Files (``file``) that gave fewer than ``least`` filled cells: these were skipped."""
    full = cells.where("cell is not null").groupBy("file").count().where(F.col("count") >= least)
    return files.select("file").distinct().join(full, "file", "left_anti")


def write_series(series: DataFrame, path: str, mode: str = "append", levels: tuple[str, ...] = ("publisher", "report", "field", "file")) -> None:
    """Long series to a Parquet tree by its levels, sorted by property and time inside each file. With
    mode ``overwrite`` only the levels that occur in the series are replaced.

    Rows are dealt by ranges of levels, property and time, so a level that holds most rows is written by several
    tasks, as files whose bounds hardly overlap; small levels stay one file each."""
    order = [c for c in ("property", "ts") if c in series.columns]
    sorted_rows = series.repartitionByRange(*levels, *order).sortWithinPartitions(*levels, *order)
    writer = sorted_rows.write.mode(mode).partitionBy(*levels)
    if mode == "overwrite":
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def inside(path: str, root: str) -> bool:
    """Whether a path lies in a root or is the root."""
    norm = lambda p: posixpath.normpath(p.removeprefix("file://").removeprefix("file:"))
    a, b = norm(path), norm(root)
    return a == b or a.startswith(b.rstrip("/") + "/")


def export_node(series: DataFrame, to_path: str, root: str, tz: str | None = None, start: str | None = None, end: str | None = None, truncate_tz: bool = True) -> None:
    """A node's rows as CSV, in wall time of ``tz`` and sliced. Refuses targets inside the database."""
    if inside(to_path, root):
        raise ValueError(f"{to_path} lies inside the database {root}")
    out = to_timezone(slice_time(series, start, end, tz or "UTC"), tz, truncate_tz)
    if tz is not None:
        out = out.withColumn("ts", F.col("local_ts")).drop("local_ts")
    out.write.mode("overwrite").option("header", True).option("timestampNTZFormat", STAMP).csv(to_path)


FREQUENCIES = {"H": "hour", "D": "day", "M": "month", "Y": "year"}


#: Functions of a bucket of values; buckets without rows are 0 for those of ``ZERO``, else null.
AGGREGATIONS = {
    "sum": F.sum, "mean": F.avg, "min": F.min, "max": F.max, "count": F.count, "std": F.stddev_samp, "var": F.var_samp, "median": F.median,
    "first": lambda v: F.min_by(v, F.when(F.col(v).isNotNull(), F.col("ts"))), "last": lambda v: F.max_by(v, F.when(F.col(v).isNotNull(), F.col("ts"))),
}
ZERO = ("sum", "count")


def multi_freq(series: DataFrame, freqs: list[str], aggregations: dict[str, str] | None = None, default: str = "sum") -> dict[str, DataFrame]:
    """One long series (``property, ts, value``) per frequency; H is an unchanged copy. ``aggregations``
    names a function per property, of ``AGGREGATIONS``; another one is refused. Buckets without rows between
    first and last are 0 for sums and counts, else null. Of equal stamps ``first`` and ``last`` take any."""
    used = sorted({default, *(aggregations or {}).values()})
    if unknown := set(used) - set(AGGREGATIONS):
        raise ValueError(f"no such function: {', '.join(sorted(unknown))}; there are {', '.join(AGGREGATIONS)}")
    out = {}
    how = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for p in (aggregations or {"": default}).items() for x in p]), F.col("property")), F.lit(default))
    for freq in freqs:
        if freq == "H":
            out[freq] = series
            continue
        unit = FREQUENCIES[freq]
        bucket = F.date_trunc(unit, "ts").cast(T.NTZ)
        grouped = series.withColumn("how", how).groupBy("property", "how", bucket.alias("__ts")).agg(*[AGGREGATIONS[f]("value").cast("double").alias(f) for f in used])
        value = F.coalesce(*[F.when(F.col("how") == f, F.col(f)) for f in used])
        values = grouped.select("property", "how", F.col("__ts").alias("ts"), value.alias("value"))
        span = values.groupBy("property", "how").agg(F.min("ts").alias("a"), F.max("ts").alias("b"))
        grid = span.select("property", "how", F.explode(F.sequence("a", "b", F.expr(f"interval 1 {unit}"))).alias("ts"))
        filled = grid.join(values, ["property", "how", "ts"], "left")
        out[freq] = filled.select("property", "ts", F.when(F.col("value").isNull() & F.col("how").isin(*ZERO), 0.0).otherwise(F.col("value")).alias("value"))
    return out


def export_multi_freq(series: DataFrame, path: str, freqs: tuple[str, ...] = ("H", "D", "M", "Y"), aggregations: dict[str, str] | None = None, default: str = "sum") -> None:
    for freq, frame in multi_freq(series, list(freqs), aggregations, default).items():
        frame.write.mode("overwrite").parquet(f"{path}/{freq}")


def scan_catalog(spark: SparkSession, root: str, levels: tuple[str, ...] = ("publisher", "report", "field", "file"), ignore: str = ".") -> DataFrame:
    """Catalogue of a stored Parquet tree; names that begin with ``ignore`` are left out."""
    leaves = spark.read.parquet(root).select(*levels, "property").distinct()
    for level in (*levels, "property"):
        leaves = leaves.where(~F.col(level).startswith(ignore))
    return build_catalog(leaves, [*levels, "property"])


def scan_csv_tree(spark: SparkSession, root: str, ignore: str = ".") -> DataFrame:
    """Catalogue of a tree of CSV files: folders, files and the columns of their header rows."""
    files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").text(root, wholetext=False)
    tail = F.split(F.substring_index(F.col("_metadata.file_path"), root.rstrip("/") + "/", -1), "/")
    heads = files.select(tail.alias("parts"), F.col("value"), F.col("_metadata.file_block_start").alias("at")).where("at = 0")
    first = heads.withColumn("n", F.monotonically_increasing_id()).groupBy("parts").agg(F.min_by("value", "n").alias("header"))
    names = F.filter(F.split("header", ","), lambda c, k: (k > 0) & (c != ""))
    leaves = first.where(~F.exists("parts", lambda p: p.startswith(ignore))).select("parts", F.explode_outer(names).alias("property"))
    parts = F.concat(F.array(F.lit("root")), F.transform("parts", lambda p: F.regexp_replace(p, r"\.csv$", "")), F.when(F.col("property").isNotNull(), F.array("property")).otherwise(F.array().cast("array<string>")))
    nodes = leaves.select(parts.alias("all")).select(F.explode(F.transform(F.sequence(F.lit(1), F.size("all")), lambda n: F.slice("all", 1, n))).alias("parts")).distinct()
    return nodes.select(F.array_join("parts", ".").alias("dna"), "parts", F.element_at("parts", -1).alias("name"), (F.size("parts") - 1).alias("depth"))
