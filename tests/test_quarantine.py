"""Bad rows and files are set aside once, with their reason."""

import shutil

from pyspark.sql import functions as F

from gridseries.operators.commits import Table
from gridseries.streaming import quarantine

SCHEMA = "ts timestamp_ntz, property string, value double"


def test_rows_reasons_and_counts(spark, tmp_path):
    at = tmp_path / "in"
    at.mkdir()
    (at / "good.csv").write_text("2024-01-01 00:00,a,1\n2024-01-01 01:00,b,2\n")
    (at / "cut.csv").write_text("2024-01-01 00:00,a,5\n2024-01-01 0")
    (at / "binary +%.csv").write_bytes(b"\x00\x01\xff,\x80\n\xfe")
    (at / "empty.csv").write_text("")
    (at / "minus.csv").write_text("2024-01-01 00:00,a,-5\n,a,3\n2024-01-01 00:00,a,many\n")
    (at / "other.txt").write_text("not asked for")
    sink, dead, counts = (Table(spark, f"{tmp_path}/{n}", zones=()) for n in ("sink", "dead", "counts"))

    def load():
        quarantine.load(
            spark, str(at), SCHEMA, sink, dead, counts, f"{tmp_path}/cp", glob="*.csv", options={"timestampNTZFormat": "yyyy-MM-dd HH:mm"},
            checks={"no stamp": F.col("ts").isNotNull(), "negative": F.col("value") >= 0}, parse=lambda f: f.withColumn("value", F.col("value") * 10),
        )

    load()
    name = F.substring_index("file", "/", -1).alias("name")
    aside = lambda: sorted((r.name, r.reason, r.record is None) for r in dead.read().select(name, "reason", "record").collect())
    want = [("binary +%.csv", "malformed", False)] * 2 + [("cut.csv", "malformed", False), ("empty.csv", "no rows", True), ("minus.csv", "malformed", False), ("minus.csv", "negative", False), ("minus.csv", "no stamp", False)]
    assert aside() == want
    assert sorted(r.value for r in sink.read().collect()) == [10.0, 20.0, 50.0]
    whole = {r.name: (r.n_rows, r.stored, r.set_aside, r.whole) for r in quarantine.reconcile(sink.read(), dead.read(), counts.read()).select("*", name).collect()}
    assert whole == {"good.csv": (2, 2, 0, True), "cut.csv": (2, 1, 1, True), "binary +%.csv": (2, 0, 2, True), "minus.csv": (3, 0, 3, True)}
    # nothing new; and a batch that comes again after a stop between its writes
    load()
    shutil.rmtree(f"{tmp_path}/cp/commits")
    load()
    assert aside() == want and sink.read().count() == 3 and counts.read().count() == 4
    (at / "late.csv").write_text("2024-01-02 00:00,a,7\n")
    load()
    assert sink.read().count() == 4 and aside() == want


def test_a_parquet_file_that_cannot_be_opened(spark, tmp_path):
    frame = spark.createDataFrame([("a", 1.0)], "property string, value double").coalesce(1)
    frame.write.parquet(f"{tmp_path}/in/one")
    (tmp_path / "in/one/bad.parquet").write_bytes(b"PAR1 but not for long")
    sink, dead, counts = (Table(spark, f"{tmp_path}/{n}", zones=()) for n in ("sink", "dead", "counts"))
    quarantine.load(spark, f"{tmp_path}/in/one", "property string, value double", sink, dead, counts, f"{tmp_path}/cp", format="parquet", glob="*.parquet")
    assert sink.read().count() == 1
    assert [(r.file.rpartition("/")[2], r.reason) for r in dead.read().collect()] == [("bad.parquet", "no rows")]
