"""Loads of new files that set aside what cannot be read, and count it by file.

Rows go three ways: good ones to the sink, bad ones with their file, batch, reason and text to the dead letters,
and one row of counts for each file of a batch. All three are tables with versions that remember the batch's
number, so a batch that is repeated after a crash adds to none of them twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gridseries.operators.commits import Table

CORRUPT, FILE = "_corrupt_record", "file"


def checked_stream(
    spark: SparkSession, source: str, schema: str, sink: Table, dead: Table, counts: Table, checkpoint: str, checks: dict[str, Column] | None = None,
    parse: Callable[[DataFrame], DataFrame] = lambda f: f, format: str = "csv", options: dict | None = None, glob: str | None = None,
) -> StreamingQuery:
    """Starts the load of the files that no earlier run has loaded; it stops when there are no more.

    A row is bad if its text does not fit ``schema`` (``malformed``) or if one of ``checks`` (reason: condition) is
    not true of it. ``parse`` makes the sink's rows of good ones and keeps ``file``. Files whose format cannot be
    opened at all give no rows; :func:`load` finds these.
    """
    reader = spark.readStream.format(format).schema(f"{schema}, {CORRUPT} string").option("columnNameOfCorruptRecord", CORRUPT).option("ignoreCorruptFiles", True).options(**(options or {}))
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    path = F.url_decode(F.regexp_replace("_metadata.file_path", r"\+", "%2B"))
    rows = reader.load(source).select("*", path.alias(FILE))
    reason = F.when(F.col(CORRUPT).isNotNull(), "malformed")
    for why, holds in (checks or {}).items():
        reason = reason.when(~F.coalesce(holds, F.lit(False)), why)

    def divide(batch: DataFrame, number: int) -> None:
        marked = batch.withColumn("__reason", reason).persist()  # read once, and a text column alone may not be asked for
        try:
            own, bad = (checkpoint, number), F.col("__reason").isNotNull()
            text = F.coalesce(F.col(CORRUPT), F.to_json(F.struct(*[c for c in batch.columns if c not in (CORRUPT, FILE)])))
            dead.append(marked.where(bad).select(FILE, F.lit(number).cast("long").alias("batch"), F.col("__reason").alias("reason"), text.alias("record")), batch=own)
            sink.append(parse(marked.where(~bad).drop("__reason", CORRUPT)), batch=own)
            counts.append(marked.groupBy(FILE).agg(F.count("*").alias("n_rows"), F.count_if(~bad).alias("n_good"), F.count_if(bad).alias("n_bad")).withColumn("batch", F.lit(number).cast("long")), batch=own)
        finally:
            marked.unpersist()

    return rows.writeStream.foreachBatch(divide).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def load(spark: SparkSession, source: str, schema: str, sink: Table, dead: Table, counts: Table, checkpoint: str, **how) -> None:
    """Runs :func:`checked_stream` to its end. Files that were there before and gave no row in this or an earlier run go
    to the dead letters as ``no rows`` (empty, or of another format), once."""
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if how.get("glob"):
        listing = listing.option("pathGlobFilter", how["glob"])
    present = [(p,) for p in listing.load(source).inputFiles()]
    checked_stream(spark, source, schema, sink, dead, counts, checkpoint, **how).awaitTermination()
    plain = lambda c: F.regexp_replace(F.url_decode(F.regexp_replace(c, r"\+", "%2B")), "^file:/+", "file:/")
    silent = spark.createDataFrame(present, "path string").select(plain("path").alias(FILE))
    for table in (counts, dead):
        if table.versions():
            silent = silent.join(table.read().select(F.regexp_replace(FILE, "^file:/+", "file:/").alias(FILE)).distinct(), FILE, "left_anti")
    if not silent.isEmpty():
        dead.append(silent.select(FILE, F.lit(None).cast("long").alias("batch"), F.lit("no rows").alias("reason"), F.lit(None).cast("string").alias("record")))


def reconcile(sink: DataFrame, dead: DataFrame, counts: DataFrame) -> DataFrame:
    """``file, n_rows, n_good, n_bad, stored, set_aside, whole``: what was counted of each file against what is in the sink (by
    its column ``file``) and among the dead letters; ``whole`` if they agree."""
    kept = sink.groupBy(FILE).agg(F.count("*").alias("stored"))
    aside = dead.where("reason <> 'no rows'").groupBy(FILE).agg(F.count("*").alias("set_aside"))
    seen = counts.groupBy(FILE).agg(*[F.sum(c).alias(c) for c in ("n_rows", "n_good", "n_bad")])
    both = seen.join(kept, FILE, "full_outer").join(aside, FILE, "full_outer").na.fill(0)
    return both.withColumn("whole", (F.col("n_good") == F.col("stored")) & (F.col("n_bad") == F.col("set_aside")) & (F.col("n_rows") == F.col("n_good") + F.col("n_bad")))
