"""Incremental loads as streams: only files not loaded yet are read, batches are merged by key."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gridseries.operators import commits


def stream_ingest(
    spark: SparkSession, source: str, schema: str, sink: str, checkpoint: str, parse: Callable[[DataFrame], DataFrame] = lambda f: f,
    format: str = "parquet", glob: str | None = None, options: dict | None = None,
) -> StreamingQuery:
    """Files of ``source`` that no earlier run has loaded, parsed and appended to ``sink``; then it stops.

    The checkpoint remembers the files, so a run after a failure repeats none and misses none.
    """
    reader = spark.readStream.format(format).schema(schema).options(**(options or {}))
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    parsed = parse(reader.load(source))
    return parsed.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(sink)


def stream_upsert(
    stream: DataFrame, sink: str, checkpoint: str, keys: list[str], keep: str = "existing", partition_by: list[str] = ()
) -> StreamingQuery:
    """Every batch is merged into the table ``sink`` (:class:`gridseries.operators.commits.Table`) with one row per
    key; only the partitions that it touches are rewritten. ``keep='existing'`` never replaces a stored row,
    ``keep='new'`` lets late revisions win. A batch that comes again is skipped by its number."""

    def merge(batch: DataFrame, number: int) -> None:
        if not batch.isEmpty():
            commits.Table(batch.sparkSession, sink, partition_by).upsert(batch, keys, keep, batch=(checkpoint, number))

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_means(stream: DataFrame, step: str, lateness: str, keys: list[str] = ("property",)) -> DataFrame:
    """Means per window of ``ts`` (a timestamp), final when the watermark has passed."""
    return (
        stream.withWatermark("ts", lateness).groupBy(F.window("ts", step), *keys).agg(F.avg("value").alias("value"), F.count("*").alias("n"))
        .select(F.col("window.start").alias("ts"), *keys, "value", "n")
    )
