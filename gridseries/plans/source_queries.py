"""Queries of readers, writers, exports and streams: series go to files and come back."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridseries.operators import commits
from gridseries.plans.base import HOURLY_SQL, hourly, query, scratch, table
from gridseries.plans.cell_queries import TYPES
from gridseries.plans.market_queries import LADDER_SQL, trades
from gridseries.sources import files as io
from gridseries.streaming import incremental, quarantine

WIDE_SQL = "SELECT ts, " + ", ".join(f"max(value) FILTER (property = '{t}') AS {t}" for t in TYPES) + f" FROM ({HOURLY_SQL}) GROUP BY 1"


@query(WIDE_SQL)
def read_series(spark, sf):
    path = scratch(spark, "series")
    wide = hourly(spark, sf).groupBy("ts").pivot("property", TYPES).agg(F.max("value"))
    comma = [F.regexp_replace(F.col(t).cast("string"), r"\.", ",").alias(t) for t in TYPES]
    stamp = F.when(F.hour("ts") == 0, F.date_format("ts", "yyyy-MM-dd")).when(F.hour("ts") == 1, F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm"))
    wide.select(stamp.alias("stamp"), *comma).write.option("header", True).option("sep", ";").csv(path)
    return io.read_series(spark, path, sep=";", decimal=",")


@query(f"""
SELECT ts, max(value) FILTER (property = 'click') AS click, max(value) FILTER (property = 'error' AND day(ts) % 3 <> 0) AS error, max(value) FILTER (property = 'view' AND day(ts) % 3 = 0) AS view, NULL::DOUBLE AS absent
FROM ({HOURLY_SQL}) WHERE day(ts) % 4 <> 3 GROUP BY 1
""")
def read_series_by_header(spark, sf):
    """Daily files of unequal headers: every third day another column and another order, every fourth no text."""
    path = scratch(spark, "headers")
    wide = hourly(spark, sf).groupBy("ts").pivot("property", ["click", "error", "view"]).agg(F.max("value"))
    cell = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    third, stamp = F.dayofmonth("ts") % 3 == 0, F.date_format("ts", io.STAMP)
    line = F.when(third, F.concat_ws(",", stamp, cell("view"), cell("click"))).otherwise(F.concat_ws(",", stamp, cell("click"), cell("error")))
    head = F.when(F.dayofmonth("day") % 3 == 0, "stamp,view,click").otherwise("ts,click,error")
    files = wide.groupBy(F.date_trunc("day", "ts").alias("day")).agg(F.array_join(F.sort_array(F.collect_list(line)), "\n").alias("lines"))
    text = F.when(F.dayofmonth("day") % 4 == 3, F.decode(F.unhex(F.lit("000102032C04")), "UTF-8")).otherwise(F.concat_ws("\n", head, "lines"))
    files.select(F.dayofmonth("day").alias("day"), text.alias("value")).repartition("day").write.partitionBy("day").text(path)
    return io.read_series(spark, path, columns=["click", "error", "view", "absent"])


@query(f"""
WITH m AS (SELECT period AS ts, aa, side, max(quantity) AS quantity, max(price) AS price FROM ({LADDER_SQL}) GROUP BY 1, 2, 3)
SELECT ts, aa, side, quantity, price FROM m
""")
def read_ladder(spark, sf):
    path = scratch(spark, "ladder")
    # one aggregation: every further one, as of a pivot, is another hash map in the same task
    best = [F.max(F.when(F.col("side") == s, F.col(c))).alias(f"{s}_{c[0]}") for s in ("Buy", "Sell") for c in ("quantity", "price")]
    wide = trades(spark, sf).groupBy("ts", F.col("l_partkey").alias("aa")).agg(*best)
    # the two header rows stand at the head of every file
    line = F.concat_ws(",", F.date_format("ts", io.STAMP), F.col("aa").cast("string"), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("Buy_q", "Buy_p", "Sell_q", "Sell_p")])
    head = F.array(F.lit(",,Buy,Unnamed: 3,Sell,Unnamed: 5"), F.lit("datetime,AA,QUANTITY,PRICE,QUANTITY,PRICE"))
    numbered = wide.select(line.alias("line"), F.monotonically_increasing_id().alias("n"))
    is_first = F.col("n").bitwiseAND(F.lit((1 << 33) - 1)) == 0  # the lower bits count the rows of a partition
    lines = F.when(is_first, F.concat(head, F.array("line"))).otherwise(F.array("line"))
    numbered.select(F.explode(lines).alias("value")).write.text(path)
    return io.read_ladder(spark, path, [("Buy", "QUANTITY"), ("Buy", "PRICE"), ("Sell", "QUANTITY"), ("Sell", "PRICE")])


@query("""
WITH l AS (SELECT l_orderkey // 1000 AS file, string_agg(l_orderkey || ',' || l_partkey || ',' || CASE WHEN l_discount > 0 THEN l_suppkey::VARCHAR ELSE '' END, chr(10) ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_discount) AS text FROM lineitem GROUP BY 1),
r AS (SELECT file, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS row FROM l)
SELECT 'sheet_' || file AS file, row, unnest([0, 1, 2]) AS col, unnest(list_transform(string_split(line, ','), lambda c: nullif(c, ''))) AS cell FROM r
""")
def read_cells(spark, sf):
    path = scratch(spark, "sheets")
    text = F.concat_ws(",", F.col("l_orderkey").cast("string"), F.col("l_partkey").cast("string"), F.when(F.col("l_discount") > 0, F.col("l_suppkey").cast("string")).otherwise(""))
    # sheets of a thousand order numbers: their number grows with the table, their size does not
    lines = table(spark, sf, "lineitem").withColumn("sheet", F.concat(F.lit("sheet_"), F.expr("l_orderkey div 1000"))).withColumn("value", text)
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_discount"]
    # one file per sheet, its rows in order
    lines.repartition("sheet").sortWithinPartitions("sheet", *order).select("sheet", "value").write.partitionBy("sheet").text(path)
    return io.read_cells(spark, path, name_pattern="/sheet=([^/]+)/")


def leveled(spark, sf):
    return hourly(spark, sf).select(F.lit("Site").alias("publisher"), F.lit("Events").alias("report"), F.lit("Hourly").alias("field"), F.concat(F.lit("d"), F.dayofmonth("ts") % 5).alias("file"), "property", "ts", "value")


@query(f"SELECT 'd' || (day(ts) % 5) AS file, property, ts, CASE WHEN day(ts) % 5 = 0 THEN value + 1 ELSE value END AS value FROM ({HOURLY_SQL})")
def write_series(spark, sf):
    path = scratch(spark, "tree")
    io.write_series(leveled(spark, sf), path)
    io.write_series(leveled(spark, sf).where("file = 'd0'").withColumn("value", F.col("value") + 1), path, mode="overwrite")
    return spark.read.parquet(path).select("file", "property", "ts", "value")


@query(f"""
SELECT strftime(timezone('EET', timezone('UTC', ts)), '%Y-%m-%d %H:%M') AS ts, property, value FROM ({HOURLY_SQL})
WHERE timezone('EET', timezone('UTC', ts)) >= TIMESTAMP '2024-01-02' AND timezone('EET', timezone('UTC', ts)) < TIMESTAMP '2024-01-12'
""")
def export_node(spark, sf):
    path = scratch(spark, "export")
    io.export_node(hourly(spark, sf), path, root=f"{path}-database", tz="EET", start="2024-01-02", end="2024-01-11")
    return spark.read.csv(path, header=True, schema="ts string, property string, value double")


@query("""
WITH s AS (SELECT o_orderpriority AS property, o_orderdate AS ts, (o_custkey % 50)::DOUBLE AS value FROM orders),
y AS (SELECT 'Y' AS freq, property, date_trunc('year', ts)::TIMESTAMP AS ts, CASE WHEN property = '5-LOW' THEN max(value) ELSE sum(value) END AS value FROM s GROUP BY 1, 2, 3),
m AS (SELECT 'M' AS freq, property, date_trunc('month', ts)::TIMESTAMP AS ts, CASE WHEN property = '5-LOW' THEN max(value) ELSE sum(value) END AS value FROM s GROUP BY 1, 2, 3),
d AS (SELECT 'D' AS freq, property, date_trunc('day', ts)::TIMESTAMP AS ts, CASE WHEN property = '5-LOW' THEN max(value) ELSE sum(value) END AS value FROM s GROUP BY 1, 2, 3),
g AS (SELECT 'M' AS freq, property, unnest(generate_series(min(ts), max(ts), INTERVAL 1 MONTH)) AS ts FROM m GROUP BY property UNION ALL SELECT 'D', property, unnest(generate_series(min(ts), max(ts), INTERVAL 1 DAY)) FROM d GROUP BY property UNION ALL SELECT 'Y', property, unnest(generate_series(min(ts), max(ts), INTERVAL 1 YEAR)) FROM y GROUP BY property)
SELECT freq, property, ts, CASE WHEN value IS NULL AND property <> '5-LOW' THEN 0 ELSE value END AS value FROM g LEFT JOIN (SELECT * FROM m UNION ALL SELECT * FROM d UNION ALL SELECT * FROM y) USING (freq, property, ts)
UNION ALL SELECT 'H', property, ts, value FROM s
""")
def export_multi_freq(spark, sf):
    path = scratch(spark, "freqs")
    series = table(spark, sf, "orders").select(F.col("o_orderpriority").alias("property"), F.col("o_orderdate").alias("ts"), (F.col("o_custkey") % 50).cast("double").alias("value"))
    io.export_multi_freq(series, path, ("H", "D", "M", "Y"), {"5-LOW": "max"})
    out = None
    for freq in ("H", "D", "M", "Y"):
        one = spark.read.parquet(f"{path}/{freq}").select(F.lit(freq).alias("freq"), "property", "ts", "value")
        out = one if out is None else out.unionByName(one)
    return out


@query(f"""
WITH l AS (SELECT DISTINCT 'd' || (day(ts) % 5) AS file, property FROM ({HOURLY_SQL}))
SELECT 'root' AS dna, 'root' AS kind, 0 AS depth UNION ALL SELECT 'root.Site', 'publisher', 1 UNION ALL SELECT 'root.Site.Events', 'report', 2 UNION ALL SELECT 'root.Site.Events.Hourly', 'field', 3
UNION ALL SELECT DISTINCT 'root.Site.Events.Hourly.' || file, 'file', 4 FROM l UNION ALL SELECT 'root.Site.Events.Hourly.' || file || '.' || property, 'property', 5 FROM l
""")
def scan_catalog(spark, sf):
    path = scratch(spark, "scan")
    io.write_series(leveled(spark, sf), path)
    return io.scan_catalog(spark, path).select("dna", "kind", "depth")


@query(f"SELECT ts, property, value, n FROM (SELECT ts, property, value, 1 AS n FROM ({HOURLY_SQL}))")
def stream_ingest(spark, sf):
    at = scratch(spark, "stream")
    series = hourly(spark, sf)
    schema = "ts timestamp_ntz, property string, value double"
    load = lambda: incremental.stream_ingest(spark, f"{at}/in", schema, f"{at}/out", f"{at}/checkpoint").awaitTermination()
    series.where("ts < '2024-01-15'").write.mode("append").parquet(f"{at}/in")
    load()
    series.where("ts >= '2024-01-15'").write.mode("append").parquet(f"{at}/in")
    load()
    load()
    return spark.read.parquet(f"{at}/out").groupBy("ts", "property", "value").agg(F.count("*").alias("n"))


@query(f"SELECT ts, property, CASE WHEN ts < TIMESTAMP '2024-01-20' THEN value ELSE value + 100 END AS value FROM ({HOURLY_SQL})")
def stream_upsert(spark, sf):
    at = scratch(spark, "upsert")
    series, schema = hourly(spark, sf), "ts timestamp_ntz, property string, value double"

    def load() -> None:
        stream = spark.readStream.schema(schema).parquet(f"{at}/in")
        incremental.stream_upsert(stream, f"{at}/out", f"{at}/checkpoint", ["ts", "property"]).awaitTermination()

    series.where("ts < '2024-01-20'").write.mode("append").parquet(f"{at}/in")
    load()
    series.where("ts >= '2024-01-18'").withColumn("value", F.col("value") + 100).write.mode("append").parquet(f"{at}/in")
    load()
    return commits.Table(spark, f"{at}/out").read().select("ts", "property", "value")


@query(f"""
WITH f AS (SELECT day(ts) AS day, count(*) AS n, count(*) FILTER (value < 2) AS low FROM ({HOURLY_SQL}) GROUP BY 1)
SELECT day, CASE WHEN day % 7 = 0 THEN 1 WHEN day % 5 = 0 THEN n + 1 ELSE n END AS n_rows, CASE WHEN day % 7 = 0 THEN 0 ELSE n - low END AS stored,
       concat_ws(',', CASE WHEN day % 7 <> 0 AND low > 0 THEN 'low' END, CASE WHEN day % 7 = 0 OR day % 5 = 0 THEN 'malformed' END) AS reasons, true AS whole
FROM f WHERE day % 11 <> 0 UNION ALL SELECT day, 0, 0, 'no rows', NULL FROM f WHERE day % 11 = 0
""")
def stream_quarantine(spark, sf):
    """Daily files in two loads: every fifth ends in the middle of a row, every seventh is no text, every eleventh is
    empty, and values below 2 are refused."""
    at, day = scratch(spark, "quarantine"), F.dayofmonth("ts")
    line = F.concat_ws(",", F.date_format("ts", io.STAMP), "property", F.col("value").cast("string"))
    files = hourly(spark, sf).groupBy(day.alias("day")).agg(F.array_join(F.sort_array(F.collect_list(line)), "\n").alias("lines"))
    cut = F.when(F.col("day") % 5 == 0, "\n2024-01-0").otherwise("")
    text = F.when(F.col("day") % 7 == 0, F.unhex(F.lit("00FF80C12C02")).cast("string")).otherwise(F.concat("lines", cut))
    written = files.select("day", F.when(F.col("day") % 11 == 0, "").otherwise(text).alias("value"))
    sink, dead, counts = (commits.Table(spark, f"{at}/{n}", zones=()) for n in ("sink", "dead", "counts"))
    for some in (F.col("day") <= 15, F.col("day") > 15, F.lit(False)):
        written.where(some).repartition("day").write.mode("append").partitionBy("day").text(f"{at}/in")
        quarantine.load(
            spark, f"{at}/in", "ts timestamp_ntz, property string, value double, day int", sink, dead, counts, f"{at}/checkpoint", checks={"low": F.col("value") >= 2}, glob="*.txt",
            options={"timestampNTZFormat": io.STAMP, "mode": "PERMISSIVE"},
        )
    number = F.regexp_extract("file", "day=([0-9]+)/", 1).cast("int").alias("day")
    reasons = dead.read().groupBy(number).agg(F.array_join(F.sort_array(F.collect_set("reason")), ",").alias("reasons"))
    whole = quarantine.reconcile(sink.read(), dead.read(), counts.read()).select(number, "n_rows", "stored", "whole")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return whole.join(reasons, "day", "full_outer").select("day", zero("n_rows"), zero("stored"), F.coalesce("reasons", F.lit("")).alias("reasons"), "whole")
