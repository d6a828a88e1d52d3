"""Stored tables with versions: files that never change, and a log that says which of them a version holds.

Below the table's folder lie ``data/commit=<id>/<partition>/`` (Parquet files, written once), ``manifests/<id>``
(the files of one version with their partition, number of rows and bounds, as Parquet) and ``_log/<version>.json``
(one small file for each version). A version exists from the moment that its log file does, which is moved to
its name only if no other writer has taken it: readers see one version or the next, never a part.

An upsert reads and writes only the partitions that its rows touch; the files of the others are carried over by
name. A writer that comes second finds its version's name taken. It then looks whether the other one changed
a partition of its own: if so it merges anew, if not it only writes its manifest again. A streamed batch leaves
its number in the log and is skipped when it comes again.

The log needs a file system that refuses to move a file to a name that exists (HDFS does).
"""

from __future__ import annotations

import json
import os
import time
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from gridseries.operators import store


class ConflictError(RuntimeError):
    """Other writers were faster each time."""


class Table:
    """A table below ``path``. ``partition_by`` and ``zones`` (columns whose bounds the manifest holds for every
    file) count for a table that is not there yet; an existing one keeps its own."""

    def __init__(self, spark: SparkSession, path: str, partition_by: tuple[str, ...] | list[str] = (), zones: tuple[str, ...] = ("property", "ts")):
        self.spark, self.path = spark, path.rstrip("/")
        self._new = {"version": -1, "partition_by": list(partition_by), "zones": list(zones), "manifest": None, "schema": None, "batches": {}}

    # the log

    def _fs(self):
        fs, at, Path = store._filesystem(self.spark, f"{self.path}/_log")
        return fs, at, Path

    def versions(self) -> list[int]:
        fs, at, _ = self._fs()
        if not fs.exists(at):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(at)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def state(self, version: int | None = None) -> dict:
        """What the log says of a version, by default the newest; of a table without any a blank."""
        if version is None:
            have = self.versions()
            if not have:
                return dict(self._new)
            version = have[-1]
        fs, _, Path = self._fs()
        stream = fs.open(Path(f"{self.path}/_log/{version:020d}.json"))
        try:
            return json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _publish(self, state: dict) -> bool:
        """Takes the version's name in the log; False if it is taken."""
        fs, at, Path = self._fs()
        fs.mkdirs(at)
        beside, final = f"{self.path}/_log/.{uuid.uuid4().hex}", f"{self.path}/_log/{state['version']:020d}.json"
        out = fs.create(Path(beside), True)
        out.write(bytearray(json.dumps(state).encode("utf-8")))
        out.close()
        try:
            if fs.getScheme() == "file":  # a move would replace the other writer's file, a link does not
                local = [self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p).toUri().getPath() for p in (beside, final)]
                try:
                    os.link(*local)
                except FileExistsError:
                    return False
                return True
            context = self.spark.sparkContext._jvm.org.apache.hadoop.fs.FileContext.getFileContext(Path(final).toUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
            none = self.spark.sparkContext._gateway.new_array(self.spark.sparkContext._jvm.org.apache.hadoop.fs.Options.Rename, 0)
            try:
                context.rename(Path(beside), Path(final), none)
            except Exception as error:
                if fs.exists(Path(final)):
                    return False
                raise error
            return True
        finally:
            fs.delete(Path(beside), False)

    # files

    def files(self, version: int | None = None) -> DataFrame | None:
        """``path, n_rows``, the partition columns and ``min_``/``max_`` of the zone columns, one row per file of a
        version; None of a table without files."""
        state = self.state(version)
        return self.spark.read.parquet(f"{self.path}/{state['manifest']}") if state["manifest"] else None

    def read(self, version: int | None = None, where: Column | None = None) -> DataFrame:
        """Rows of a version. ``where`` is a condition on the columns of :meth:`files`: files that it rules out
        are not opened (rows of the others are not filtered). A table without rows is empty, with its columns."""
        return self._read(self.state(version), where)

    def slice(self, start: str | None = None, end: str | None = None, properties: list[str] | None = None, version: int | None = None, where: Column | None = None) -> DataFrame:
        """Rows of some properties from ``start`` to before ``end`` (stamps). Files whose bounds lie outside are not opened."""
        held, rows = F.lit(True) if where is None else where, F.lit(True)
        stamp = lambda x: F.lit(x).cast("timestamp_ntz")
        if start is not None:
            held, rows = held & (F.col("max_ts") >= stamp(start)), rows & (F.col("ts") >= stamp(start))
        if end is not None:
            held, rows = held & (F.col("min_ts") < stamp(end)), rows & (F.col("ts") < stamp(end))
        if properties is not None:
            inside = [F.lit(p).between(F.col("min_property"), F.col("max_property")) for p in properties]
            held, rows = held & reduce(lambda a, b: a | b, inside, F.lit(False)), rows & F.col("property").isin(properties)
        return self.read(version, held).where(rows)

    def _read(self, state: dict, where: Column | None = None) -> DataFrame:
        if state["schema"] is None:
            raise FileNotFoundError(f"no version of {self.path}")
        entries = self.spark.read.parquet(f"{self.path}/{state['manifest']}") if state["manifest"] else None
        found = [] if entries is None else [r["path"] for r in (entries if where is None else entries.where(where)).select("path").collect()]
        return self._open(found, state)

    def _open(self, paths: list[str], state: dict) -> DataFrame:
        schema = StructType.fromJson(state["schema"])
        if not paths:
            return self.spark.createDataFrame([], schema)
        frame = self.spark.read.schema(schema).option("basePath", f"{self.path}/data").parquet(*[f"{self.path}/{p}" for p in paths])
        return frame.select(*[f"`{n}`" for n in schema.names])

    def _write(self, rows: DataFrame, state: dict) -> DataFrame:
        """Writes rows as files of a new folder; gives the files' entries. ``state`` learns the rows' columns."""
        known = StructType.fromJson(state["schema"]).fields if state["schema"] else []
        names = {f.name for f in known}
        fields = [*known, *(StructField(f.name, f.dataType, True) for f in rows.schema.fields if f.name not in names)]
        state["schema"] = StructType(fields).jsonValue()
        folder = f"commit={uuid.uuid4().hex}"
        order = [c for c in (*state["partition_by"], *state["zones"]) if c in rows.columns]
        parts = [F.col(f"`{c}`") for c in state["partition_by"]]
        sorted_rows = rows.repartitionByRange(*map(F.col, order)).sortWithinPartitions(*order) if order else rows
        sorted_rows.write.partitionBy(*state["partition_by"]).parquet(f"{self.path}/data/{folder}")
        written = self.spark.read.schema(StructType(fields)).option("basePath", f"{self.path}/data").parquet(f"{self.path}/data/{folder}")
        at = F.substring_index(F.url_decode(F.regexp_replace("_metadata.file_path", r"\+", "%2B")), f"/data/{folder}/", -1)
        bounds = [f(f"`{z}`").alias(f"{n}_{z}") for z in state["zones"] if z in [f.name for f in fields] for n, f in (("min", F.min), ("max", F.max))]
        return written.groupBy(F.concat(F.lit(f"data/{folder}/"), at).alias("path"), *parts).agg(F.count("*").alias("n_rows"), *bounds)

    def _touched(self, state: dict, rows: DataFrame) -> DataFrame | None:
        """Entries of the files that lie in the rows' partitions."""
        if not state["manifest"]:
            return None
        entries = self.spark.read.parquet(f"{self.path}/{state['manifest']}")
        parts = state["partition_by"]
        if not parts:
            return entries
        named = rows.select(*[F.col(f"`{c}`").alias(f"__{k}") for k, c in enumerate(parts)]).distinct()
        same = reduce(lambda a, b: a & b, [F.col(f"`{c}`").eqNullSafe(F.col(f"__{k}")) for k, c in enumerate(parts)])
        return entries.join(named, same, "left_semi")

    # changes

    def _commit(self, kind: str, work: Callable[[dict], tuple[DataFrame, set[str] | None]], batch: tuple[str, int] | None, still: Callable[[dict, set[str]], bool], tries: int) -> int | None:
        """``work`` gives entries of new files and the paths that they take the place of (None: of all)."""
        done = None
        for k in range(tries):
            state = self.state()
            if batch is not None and state["batches"].get(batch[0], -1) >= batch[1]:
                return None
            if done is None or not still(state, done[1]):
                fresh = dict(state)
                entries, gone = work(fresh)
                done = entries, gone, fresh["schema"]
            entries, gone, schema = done
            manifest = entries
            if state["manifest"] and gone is not None:
                kept = self.spark.read.parquet(f"{self.path}/{state['manifest']}")
                if gone:
                    names = self.spark.createDataFrame([(p,) for p in sorted(gone)], "path string")
                    kept = kept.join(names, "path", "left_anti")
                manifest = kept.unionByName(entries, allowMissingColumns=True)
            named = f"manifests/{uuid.uuid4().hex}"
            manifest.coalesce(1 + self.spark.sparkContext.defaultParallelism // 8).write.parquet(f"{self.path}/{named}")
            batches = state["batches"] | ({batch[0]: batch[1]} if batch else {})
            if self._publish(state | {"version": state["version"] + 1, "kind": kind, "manifest": named, "schema": schema, "batches": batches}):
                return state["version"] + 1
            time.sleep(0.05 * (k + 1))
        raise ConflictError(f"{tries} tries to write to {self.path} met other writers")

    def upsert(self, rows: DataFrame, keys: list[str], keep: str = "existing", batch: tuple[str, int] | None = None, order: str | None = None, tries: int = 20) -> int | None:
        """One row per key (see :func:`gridseries.operators.store.upsert`; keys must hold the partition columns).
        Gives the new version, or None if the ``batch`` (stream, number) is stored already. New columns are added."""
        lacking = set(self.state()["partition_by"]) - set(keys)
        if lacking:
            raise ValueError(f"rows of one key may lie in two partitions: {sorted(lacking)} are not among the keys")

        def work(state: dict) -> tuple[DataFrame, set[str]]:
            touched = self._touched(state, rows)
            gone = set() if touched is None else {r["path"] for r in touched.select("path").collect()}
            base = self._open(sorted(gone), state) if state["schema"] else rows.limit(0)
            return self._write(store.upsert(base, rows, keys, keep=keep, order=order), state), gone

        def still(state: dict, gone: set[str]) -> bool:
            touched = self._touched(state, rows)
            return gone == (set() if touched is None else {r["path"] for r in touched.select("path").collect()})

        return self._commit("upsert", work, batch, still, tries)

    def append(self, rows: DataFrame, batch: tuple[str, int] | None = None, tries: int = 20) -> int | None:
        """Adds rows as they are; nothing that is stored is read."""
        return self._commit("append", lambda state: (self._write(rows, state), set()), batch, lambda *_: True, tries)

    def replace(self, rows: DataFrame, based_on: int | None = None) -> int:
        """The rows (which may read the table) take the place of all that is stored; earlier versions stay
        readable. Fails if another writer has changed the table since version ``based_on``, by default the
        newest one at the call, as its rows would be lost."""
        base = self.state()["version"] if based_on is None else based_on

        def work(state: dict) -> tuple[DataFrame, None]:
            if state["version"] != base:
                raise ConflictError(f"version {state['version']} has come after {base}")
            state["schema"] = None
            return self._write(rows, state), None

        return self._commit("replace", work, None, lambda *_: False, 1)

    def vacuum(self, keep: int = 10, older_than_s: int = 7 * 86_400) -> list[str]:
        """Deletes what none of the last ``keep`` versions holds, if it is older than any writer may still take;
        gives the deleted folders. Versions before those can no longer be read and leave the log first."""
        fs, _, Path = self._fs()
        have = self.versions()
        for version in have[:-keep]:
            fs.delete(Path(f"{self.path}/_log/{version:020d}.json"), False)
        states = [self.state(v) for v in have[-keep:]]
        used = {s["manifest"] for s in states}
        for manifest in filter(None, set(used)):
            folders = self.spark.read.parquet(f"{self.path}/{manifest}").select(F.concat(F.lit("data/"), F.split_part("path", F.lit("/"), F.lit(2))).alias("folder")).distinct()
            used |= {r["folder"] for r in folders.collect()}
        gone, limit = [], time.time() - older_than_s
        for kind in ("data", "manifests"):
            if not fs.exists(Path(f"{self.path}/{kind}")):
                continue
            for s in fs.listStatus(Path(f"{self.path}/{kind}")):
                name = f"{kind}/{s.getPath().getName()}"
                if name not in used and s.getModificationTime() / 1000 <= limit:
                    fs.delete(s.getPath(), True)
                    gone.append(name)
        return sorted(gone)
