"""Queries of store upkeep and diagnostics over hourly event series."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridseries.functions import timeparts as T
from gridseries.operators import commits, store
from gridseries.plans.base import HOURLY_SQL, events, hourly, query, scratch, table

# base: hours of even events; new: of all
BASE_SQL = HOURLY_SQL.replace("FROM events", "FROM events WHERE event_id % 2 = 0")
KEYS = ["property", "ts"]


def base(spark, sf):
    return events(spark, sf).where("event_id % 2 = 0").groupBy(F.date_trunc("hour", "ts").cast(T.NTZ).alias("ts"), "property").agg(F.max("value").alias("value"))


@query(f"""
WITH r AS (SELECT property AS report, min(ts) AS min_ts, TIMESTAMP '2024-01-30 23:00' AS max_ts FROM ({HOURLY_SQL}) GROUP BY 1),
s AS (SELECT property AS report, max(ts) AS last FROM ({HOURLY_SQL}) WHERE property <> 'view' AND ts < TIMESTAMP '2024-01-20' OR property = 'click' GROUP BY 1)
SELECT report, coalesce(last + INTERVAL 1 HOUR, min_ts) AS start, max_ts AS "end", coalesce(last + INTERVAL 1 HOUR, min_ts) <= max_ts AS needed FROM r LEFT JOIN s USING (report)
""")
def update_window(spark, sf):
    series = hourly(spark, sf).withColumnRenamed("property", "report")
    reports = series.groupBy("report").agg(F.min("ts").alias("min_ts")).withColumn("max_ts", F.lit("2024-01-30 23:00:00").cast(T.NTZ)).withColumn("resolution_s", F.lit(3600))
    return store.update_window(series.where("(report <> 'view' and ts < '2024-01-20') or report = 'click'"), reports)


@query("SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance, NULL::DOUBLE AS nation FROM customer UNION ALL SELECT s_suppkey, NULL, s_acctbal, s_nationkey::DOUBLE FROM supplier")
def align_columns(spark, sf):
    host = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"))
    new = table(spark, sf, "supplier").select(F.col("s_acctbal").alias("balance"), F.col("s_nationkey").cast("double").alias("nation"), F.col("s_suppkey").alias("id"))
    return store.align_columns(host, new)


@query(f"SELECT ts, property, value FROM ({BASE_SQL}) UNION ALL SELECT ts, property, value FROM ({HOURLY_SQL}) WHERE ts >= TIMESTAMP '2024-01-25'")
def append_update(spark, sf):
    path = scratch(spark, "append")
    store.append_update(base(spark, sf), path, KEYS)
    store.append_update(hourly(spark, sf).where("ts >= '2024-01-25'"), path, KEYS)
    return spark.read.parquet(path).select("ts", "property", "value")


UPSERT_SQL = f"SELECT ts, property, coalesce(b.value, n.value) AS value FROM ({BASE_SQL}) b FULL JOIN ({HOURLY_SQL}) n USING (ts, property)"


@query(f"""
WITH u AS ({UPSERT_SQL}), s AS (SELECT property, min(ts) AS a, max(ts) AS b FROM u GROUP BY 1), g AS (SELECT property, unnest(generate_series(a, b, INTERVAL 1 HOUR)) AS ts FROM s)
SELECT ts, property, value FROM g LEFT JOIN u USING (property, ts)
""")
def upsert(spark, sf):
    return store.upsert(base(spark, sf), hourly(spark, sf), KEYS, step_s=3600)


@query(f"""
WITH s AS (SELECT property, min(ts) AS a, max(ts) AS b FROM ({HOURLY_SQL}) GROUP BY 1), g AS (SELECT property, unnest(generate_series(a, b, INTERVAL 20 MINUTE)) AS ts FROM s)
SELECT ts, property, value FROM g LEFT JOIN ({HOURLY_SQL}) USING (property, ts)
""")
def fill_grid(spark, sf):
    return store.fill_grid(hourly(spark, sf).select("ts", "property", "value"), ["property"], 1200)


@query("""
WITH t AS (SELECT p_partkey, p_brand AS property, CASE WHEN p_partkey % (5 + length(p_brand)) = 0 THEN 'n/a' WHEN p_partkey % 31 = 0 THEN NULL ELSE p_retailprice::VARCHAR END AS text FROM part),
s AS (SELECT property, count(try_cast(text AS DOUBLE)) / count(text) AS share FROM t GROUP BY 1)
SELECT p_partkey, property, share >= 0.88 AS numeric, CASE WHEN share >= 0.88 THEN try_cast(text AS DOUBLE) END AS value FROM t JOIN s USING (property)
""")
def infer_numeric(spark, sf):
    bad = F.col("p_partkey") % (5 + F.length("p_brand")) == 0
    text = F.when(bad, F.lit("n/a")).when(F.col("p_partkey") % 31 == 0, F.lit(None)).otherwise(F.col("p_retailprice").cast("string"))
    texts = table(spark, sf, "part").select("p_partkey", F.col("p_brand").alias("property"), text.alias("text"))
    return store.infer_numeric(texts, ["property"], least=0.88).select("p_partkey", "property", "numeric", "value")


@query("""
WITH d AS (SELECT o_orderpriority AS report, o_orderdate::DATE::TIMESTAMP AS day, count(*)::DOUBLE AS total, min(o_orderdate) AS a, max(o_orderdate) AS b FROM orders GROUP BY 1, 2)
SELECT report, day, total, coalesce(epoch(day) - epoch(lag(day) OVER (PARTITION BY report ORDER BY day)) > 86400, false) AS after_gap,
       min(a) OVER (PARTITION BY report) AS min_ts, max(b) OVER (PARTITION BY report) AS max_ts, max(b) OVER (PARTITION BY report) >= TIMESTAMP '2001-08-01' AS up_to_date FROM d
""")
def store_status(spark, sf):
    series = table(spark, sf, "orders").select(F.col("o_orderpriority").alias("report"), F.col("o_orderdate").alias("ts"), F.lit(1.0).alias("value"))
    return store.store_status(series, ["report"], "2001-08-01")


@query(f"SELECT ts, property, value, 1 AS backups FROM ({HOURLY_SQL})")
def rebuild_report(spark, sf):
    stored = commits.Table(spark, scratch(spark, "rebuild"))
    stored.append(base(spark, sf))
    store.rebuild_report(stored, hourly(spark, sf))
    return stored.read().withColumn("backups", F.lit(len(stored.versions()) - 1))


@query(f"""
WITH v0 AS ({BASE_SQL}), n AS (SELECT ts, property, value + 100 AS value FROM ({HOURLY_SQL}) WHERE property IN ('click', 'view') AND day(ts) > 10),
v1 AS (SELECT ts, property, coalesce(n.value, v0.value) AS value FROM v0 FULL JOIN n USING (ts, property))
SELECT 0 AS version, ts, property, value FROM v0 UNION ALL SELECT 1, ts, property, value FROM v1
UNION ALL SELECT 2, ts, property, value FROM v1 WHERE property = 'error' AND ts >= TIMESTAMP '2024-01-20'
""")
def upsert_versions(spark, sf):
    stored = commits.Table(spark, scratch(spark, "versions"), partition_by=["property"], zones=("ts",))
    stored.append(base(spark, sf))
    revised = hourly(spark, sf).where("property in ('click', 'view') and day(ts) > 10").withColumn("value", F.col("value") + 100)
    stored.upsert(revised, KEYS, keep="new", batch=("feed", 7))
    stored.upsert(revised.withColumn("value", F.lit(-1.0)), KEYS, keep="new", batch=("feed", 7))  # the same batch again
    cut = stored.slice(start="2024-01-20", where=F.col("property") == "error").where("property = 'error'")
    kept = [stored.read(v).select(F.lit(v).alias("version"), "ts", "property", "value") for v in stored.versions()]
    return kept[0].unionByName(kept[1]).unionByName(cut.select(F.lit(2).alias("version"), "ts", "property", "value"))


SPREAD_SQL = "SELECT l_suppkey AS report, l_shipdate AS ts, CASE WHEN l_discount > 0.02 THEN l_quantity END AS value FROM lineitem"


def spread(spark, sf):
    return table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("report"), F.col("l_shipdate").alias("ts"), F.when(F.col("l_discount") > 0.02, F.col("l_quantity")).alias("value"))


@query(f"""
WITH s AS ({SPREAD_SQL}), m AS (SELECT *, dense_rank() OVER w AS rank, count(*) OVER (PARTITION BY report, ts) AS copies, lag(ts) OVER w AS before FROM s WINDOW w AS (PARTITION BY report ORDER BY ts)),
r AS (SELECT report, (epoch(min(ts) FILTER (rank = 2)) - epoch(min(ts)))::BIGINT AS resolution_s FROM m GROUP BY 1)
SELECT report, min(ts) AS start, max(ts) AS "end", max(resolution_s) AS resolution_s, count(*) AS n_rows, count(*) - count(value) AS n_nulls, round(avg(value), 6) AS mean, min(value) AS min_value, max(value) AS max_value,
       count(*) FILTER (copies > 1) AS n_duplicates, floor((epoch(max(ts)) - epoch(min(ts))) / max(resolution_s))::BIGINT + 1 - count(*) AS n_missing, count(*) FILTER (epoch(ts) - epoch(before) <> resolution_s) AS n_leaps
FROM m JOIN r USING (report) GROUP BY report
""")
def profile_series(spark, sf):
    return store.profile_series(spread(spark, sf), ["report"]).withColumn("mean", F.round("mean", 6))


@query(f"""
SELECT * FROM (SELECT report, ts, (epoch(ts) - epoch(lag(ts) OVER (PARTITION BY report ORDER BY ts)))::BIGINT - 86400 AS missing_s FROM ({SPREAD_SQL})) WHERE missing_s <> 0
""")
def gap_report(spark, sf):
    return store.gap_report(spread(spark, sf), ["report"], 86_400)


NULLED_SQL = f"SELECT property, ts, CASE WHEN value >= 4 THEN value END AS value FROM ({HOURLY_SQL})"


@query(f"""
WITH r AS (SELECT property, run, min(ts) AS start, max(ts) AS "end", count(*) AS length FROM (SELECT *, count(value) OVER (PARTITION BY property ORDER BY ts) AS run FROM ({NULLED_SQL})) WHERE value IS NULL GROUP BY 1, 2)
SELECT property, length, count(*) AS how_often, min(start) AS first_start, max("end") AS last_end FROM r GROUP BY 1, 2
""")
def null_runs(spark, sf):
    runs = store.null_runs(hourly(spark, sf).select("property", "ts", F.when(F.col("value") >= 4, F.col("value")).alias("value")), ["property"])
    edges = runs.groupBy("property", "length").agg(F.min("start").alias("first_start"), F.max("end").alias("last_end"))
    return store.null_run_histogram(runs, ["property"]).join(edges, ["property", "length"])


@query("""
WITH l AS (SELECT o_custkey % 30 AS pos, o_orderdate::DATE::TIMESTAMP AS date, max(o_orderstatus) AS label FROM orders GROUP BY 1, 2)
SELECT pos, date, label, lag(label) OVER w AS before, row_number() OVER w > 1 AND label IS DISTINCT FROM lag(label) OVER w AS changed FROM l WINDOW w AS (PARTITION BY pos ORDER BY date)
""")
def label_history(spark, sf):
    labels = table(spark, sf, "orders").groupBy((F.col("o_custkey") % 30).alias("pos"), F.col("o_orderdate").cast("date").cast(T.NTZ).alias("date")).agg(F.max("o_orderstatus").alias("label"))
    return store.label_history(labels)


@query(f"""
SELECT ts, property, r.value AS raw, s.value AS stored, coalesce(abs(r.value - s.value) > 0.5, NOT (r.value IS NULL AND s.value IS NULL)) AS differs
FROM ({HOURLY_SQL}) r FULL JOIN ({BASE_SQL}) s USING (ts, property)
""")
def compare_stages(spark, sf):
    return store.compare_stages(["ts", "property"], 0.5, raw=hourly(spark, sf), stored=base(spark, sf))


@query("""
SELECT o_orderstatus AS status, count(*) AS n, sum(o_custkey % 100) AS seconds, string_agg(DISTINCT o_orderpriority, ',' ORDER BY o_orderpriority) AS reports FROM orders GROUP BY 1
""")
def run_summary(spark, sf):
    log = table(spark, sf, "orders").select(F.col("o_orderpriority").alias("report"), F.col("o_orderstatus").alias("status"), (F.col("o_custkey") % 100).alias("seconds"))
    return store.run_summary(log)


@query("""
SELECT o_orderkey, 0 AS nth, 'R' || o_custkey AS name, floor(o_totalprice)::BIGINT::VARCHAR AS total, lower(o_orderpriority) AS prio,
       CASE WHEN o_orderstatus = 'F' THEN 'WARNING late ' || o_orderkey END AS warning FROM orders
UNION ALL SELECT o_orderkey, 1, 'S', o_custkey::VARCHAR, NULL, 'WARNING second' FROM orders WHERE o_orderkey % 3 = 0
UNION ALL SELECT o_orderkey, 2, 'R' || o_custkey, NULL, 'again', NULL FROM orders WHERE o_orderkey % 3 = 0
""")
def log_facts(spark, sf):
    o = table(spark, sf, "orders")
    more = F.concat(F.lit("<S>++Total:"), "o_custkey", F.lit("\nWARNING second\n</S>\n<R"), "o_custkey", F.lit(">\n++prio: AGAIN\n</R"), "o_custkey", F.lit(">"))
    text = F.concat(
        F.lit("noise <R"), "o_custkey", F.lit(">\n++Total: 0\n++ Total : "), F.floor("o_totalprice").cast("string"), F.lit("\nfree text\n++Prio:"), "o_orderpriority",
        F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("\nWARNING late "), "o_orderkey")).otherwise(""), F.lit("\n</R"), "o_custkey", F.lit("> noise"),
        F.when(F.col("o_orderkey") % 3 == 0, more).otherwise(""),
    )
    found = store.log_facts(o.select("o_orderkey", text.alias("text")))
    return found.select("o_orderkey", "nth", "name", F.col("facts")["total"].alias("total"), F.col("facts")["prio"].alias("prio"), F.try_element_at("warnings", F.lit(1)).alias("warning"))
