"""The update run: from the files of the lake to the store and a log, reports apart from each other.

Reports whose sheets look alike are a :class:`Family`. All new files of a family are read, parsed and merged by
one job, so a run has as many jobs as families, however many reports and files there are. What is wrong with a
file becomes a row of the log: a file that cannot be read, is empty or gives no values is left out, texts among
numbers are counted, and the other files go on. Only if a family's job fails as a whole are its reports run one by
one; those that fail alone are logged with the reason, and their rows in the store stay as they were.

Parsed rows are written before they are merged (``staging``), with their file and the ids of their cells: the log
counts them without parsing again, and :func:`trace` follows a stored value back to its cells.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridseries.operators import lake, lineage
from gridseries.operators.store import _filesystem
from gridseries.operators.commits import Table
from gridseries.plans import recipes

KEYS = ["report", "property", "ts"]
LOG = "run int, report string, family string, date date, file string, status string, n_rows long, n_bad long, seconds double, note string"
PARSED = {"file": "string", "row": "int", "pos": "int", "property": "string", "ts": "timestamp_ntz", "value": "double", "origin": "array<long>"}


@dataclass(frozen=True)
class Family:
    """``read`` gives the cells (``file, row, col, cell``) of paths; ``recipe`` makes the steps of the planned files
    (``report, file, date, period``). The steps keep ``file``; their rows have ``property, ts, value``."""

    name: str
    read: Callable[[SparkSession, list[str]], DataFrame]
    recipe: Callable[[DataFrame], list[recipes.Step]]
    keep: str = field(default="new")


def list_files(spark: SparkSession, root: str, name: Column | None = None) -> DataFrame:
    """``path, file`` (by default the last part of the path), ``length, modified`` of the files below a root, whose
    content is not read."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    found = listed.select("path", "length", F.col("modificationTime").alias("modified"))
    # a scan leaves out files without a byte; Spark's own listing has them
    every = spark.createDataFrame([(p,) for p in listed.inputFiles()], "path string")
    every = every.select(F.regexp_replace(F.url_decode(F.regexp_replace("path", r"\+", "%2B")), "^file:/+", "file:/").alias("path"))
    empty = every.join(found, "path", "left_anti").select("path", F.lit(0).cast("long").alias("length"), F.lit(None).cast("timestamp").alias("modified"))
    found = found.unionByName(empty)
    return found.withColumn("file", F.substring_index("path", "/", -1) if name is None else name)


def new_files(catalogue: DataFrame, reports: DataFrame, log: DataFrame | None) -> DataFrame:
    """``report, family, date, file, path`` of what is to be loaded: the latest version of every date of the potential
    range (``reports``: ``report, family, min_potential, max_potential``) that no run has loaded or found bad. A file
    of a report that failed comes again."""
    latest = lake.pick_version(lake.file_versions(catalogue, name_col="file", keys=("report",)))
    wanted = latest.join(reports.select("report", "family", "min_potential", "max_potential"), "report").where("date between min_potential and max_potential")
    if log is not None:
        settled = log.where("file is not null and status <> 'failed'").select("report", "file").distinct()
        wanted = wanted.join(settled, ["report", "file"], "left_anti")
    return wanted.select("report", "family", "date", "file", "path")


def readable(cells: DataFrame) -> DataFrame:
    """``file, n_cells, garbled``: filled cells of a file, and whether any is no text (bytes that are no UTF-8, or zeros)."""
    odd = ~F.is_valid_utf8("cell") | F.contains(F.col("cell"), F.lit("\0"))
    return cells.groupBy("file").agg(F.count("cell").alias("n_cells"), F.coalesce(F.max(odd), F.lit(False)).alias("garbled"))


def parse(spark: SparkSession, family: Family, planned: DataFrame, staging: str) -> DataFrame:
    """Parses planned files into ``staging`` and gives ``report, date, file, status, n_rows, n_bad`` of each."""
    paths = [r["path"] for r in planned.select("path").collect()]  # of new files only, as any reader lists them
    cells = lineage.stamped(family.read(spark, paths))
    state = readable(cells)
    fit = cells.join(state.where("n_cells > 0 and not garbled").select("file"), "file", "left_semi")
    periods = planned.select("report", "file", "date", F.col("date").alias("period"))
    long = recipes.run(fit, family.recipe(periods))
    have = [F.col(c).cast(t).alias(c) if c in long.columns else F.lit(None).cast(t).alias(c) for c, t in PARSED.items()]
    long.select(*have).join(periods.select("report", "file", "date"), "file").write.parquet(staging)
    rows = spark.read.parquet(staging).groupBy("file").agg(F.count("*").alias("rows"), F.count_if(F.col("value").isNull()).alias("bad"))
    full = planned.select("report", "date", "file").join(state, "file", "left").join(rows, "file", "left")
    n_rows, n_bad = F.coalesce("rows", F.lit(0)), F.coalesce("bad", F.lit(0))
    status = (
        F.when(F.col("garbled"), "unreadable").when(F.coalesce("n_cells", F.lit(0)) == 0, "empty").when(n_rows == 0, "no values").when(n_bad > 0, "partial").otherwise("loaded")
    )
    return full.select("report", "date", "file", status.alias("status"), n_rows.alias("n_rows"), n_bad.alias("n_bad"))


def run_update(spark: SparkSession, catalogue: DataFrame, reports: DataFrame, families: list[Family], table: Table, log: Table, staging: str) -> int:
    """One run over all families; gives its number. ``catalogue`` has ``report, date, file, path``.

    Every new file gets a row in ``log``; a report without any gets one with status ``idle``. Values of a later
    run take the place of stored ones unless the family keeps those; a family's job that is repeated after a
    crash adds nothing twice, as its rows are merged by key.
    """
    before = log.read() if log.versions() else None
    run = 0 if before is None else 1 + (before.agg(F.max("run")).first()[0] or 0)
    # the plan is fixed before anything is loaded: it reads the log that the run writes
    new_files(catalogue, reports, before).write.parquet(f"{staging}/{run}/plan")
    plan = spark.read.parquet(f"{staging}/{run}/plan")
    tagged = [F.lit(run).cast("int").alias("run"), F.col("report")]
    idle = reports.join(plan.select("report").distinct(), "report", "left_anti")
    blank = [F.lit(None).cast("date").alias("date"), F.lit(None).cast("string").alias("file")]
    none = [F.lit(0).cast("long").alias("n_rows"), F.lit(0).cast("long").alias("n_bad")]
    log.append(idle.select(*tagged, "family", *blank, F.lit("idle").alias("status"), *none, F.lit(0.0).alias("seconds"), F.lit(None).cast("string").alias("note")))

    def load(family: Family, planned: DataFrame, at: str) -> DataFrame:
        files = parse(spark, family, planned, at)
        good = spark.read.parquet(at).where("value is not null").select(*KEYS, "value")
        table.upsert(good, KEYS, keep=family.keep)
        return files

    def one(family: Family, planned: DataFrame, at: str) -> Exception | None:
        began, failure = time.monotonic(), None
        try:
            found = load(family, planned, at).withColumn("note", F.lit(None).cast("string"))
        except Exception as error:  # noqa: BLE001  whatever a report's data or recipe raise is that report's
            failure = error
            found = planned.select("report", "date", "file", F.lit("failed").alias("status"), *none, F.lit(reason(error)).alias("note"))
        if failure is None or at.endswith("/alone"):
            log.append(found.select(*tagged, F.lit(family.name).alias("family"), "date", "file", "status", "n_rows", "n_bad", F.lit(time.monotonic() - began).alias("seconds"), "note"))
        return failure

    named = {r["family"] for r in plan.select("family").distinct().collect()}
    for family in families:
        if family.name not in named:
            continue
        planned = plan.where(F.col("family") == family.name)
        if one(family, planned, f"{staging}/{run}/{family.name}/all") is not None:
            for k, r in enumerate(planned.select("report").distinct().orderBy("report").collect()):
                one(family, planned.where(F.col("report") == r["report"]), f"{staging}/{run}/{family.name}/{k}/alone")
    return run


def staged(spark: SparkSession, staging: str) -> DataFrame:
    """The parsed rows of all runs (``report, date, file, property, ts, value, origin``); of a file that was parsed
    several times those of the last time. What a failed job left half written is not read."""
    fs, _, Path = _filesystem(spark, staging)
    done = [s for deep in ("*/*/all", "*/*/*/alone") for s in fs.globStatus(Path(f"{staging}/{deep}/_SUCCESS")) or []]
    folders = [s.getPath().getParent().toString() for s in done]
    if not folders:
        columns = ", ".join(f"{c} {t}" for c, t in PARSED.items())
        return spark.createDataFrame([], f"file string, {columns.removeprefix('file string, ')}, report string, date date")
    part = lambda k: F.regexp_extract("_metadata.file_path", r"/(\d+)/[^/]+/(all|\d+/alone)/[^/]+$", k)
    folder = F.struct(part(1).cast("int").alias("run"), (part(2) != "all").alias("alone"))
    rows = spark.read.parquet(*folders).withColumn("__folder", folder)
    last = rows.groupBy("file").agg(F.max("__folder").alias("__folder"))
    return rows.join(last, ["file", "__folder"]).drop("__folder")


def trace(spark: SparkSession, families: list[Family], catalogue: DataFrame, log: Table, table: Table, staging: str) -> DataFrame:
    """:func:`gridseries.operators.lineage.compare` of all files that the log knows, read again from the lake."""
    known = log.read().where("file is not null").select("family", "file").distinct().join(catalogue.select("file", "path").distinct(), "file")
    raw = None
    for family in families:
        paths = [r["path"] for r in known.where(F.col("family") == family.name).select("path").distinct().collect()]  # as any reader lists them
        if paths:
            cells = family.read(spark, paths).select("file", "row", "col", "cell")
            raw = cells if raw is None else raw.unionByName(cells)
    if raw is None:
        raw = spark.createDataFrame([], "file string, row int, col int, cell string")
    return lineage.compare(raw, staged(spark, staging), table.read(), KEYS)


def reason(error: Exception) -> str:
    """The line of an error that names its cause."""
    text = str(getattr(error, "_desc", None) or error).strip()
    lines = [x.strip() for x in text.splitlines() if x.strip()]
    return (lines[0] if lines else type(error).__name__)[:500]


def report_log(log: DataFrame) -> DataFrame:
    """``run, report, family, status, n_files, n_loaded, n_rows, seconds, note``: a report of a run is ``failed`` if its job
    failed, ``idle`` without new files, ``partial`` if some files gave less than all, else ``stored``."""
    kinds = F.col("status")
    grouped = log.groupBy("run", "report", "family").agg(
        F.max(kinds == "failed").alias("__failed"), F.max(kinds == "idle").alias("__idle"), F.max(kinds != "loaded").alias("__less"),
        F.count("file").alias("n_files"), F.count_if(kinds.isin("loaded", "partial")).alias("n_loaded"), F.sum("n_rows").alias("n_rows"), F.max("seconds").alias("seconds"), F.max("note").alias("note"),
    )
    status = F.when(F.col("__failed"), "failed").when(F.col("__idle"), "idle").when(F.col("__less"), "partial").otherwise("stored")
    return grouped.select("run", "report", "family", status.alias("status"), "n_files", "n_loaded", "n_rows", "seconds", "note")
