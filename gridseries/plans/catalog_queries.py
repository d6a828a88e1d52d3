"""Queries over the catalogue (region > nation > customer) and the report pool (parts)."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridseries.functions import textparts as X
from gridseries.functions import timeparts as T
from gridseries.operators import catalog, names
from gridseries.operators.calendars import slice_time
from gridseries.plans.base import HOURLY_SQL, events, hourly, query, scratch, table

LEVELS = ["publisher", "report", "field"]


def leaves(spark, sf):
    region, nation, customer = (table(spark, sf, t) for t in ("region", "nation", "customer"))
    joined = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    return joined.select(F.col("r_name").alias("publisher"), F.col("n_name").alias("report"), F.col("c_name").alias("field"), F.col("c_mktsegment").alias("file"), F.col("c_acctbal").alias("value"))


LEAVES_SQL = "SELECT r_name AS publisher, n_name AS report, c_name AS field, c_mktsegment AS file, c_acctbal AS value FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"
NODES_SQL = f"""
SELECT 'root' AS dna, ['root'] AS parts, 'root' AS name, 'root' AS kind, 0 AS depth
UNION ALL SELECT DISTINCT 'root.' || publisher, ['root', publisher], publisher, 'publisher', 1 FROM ({LEAVES_SQL})
UNION ALL SELECT DISTINCT 'root.' || publisher || '.' || report, ['root', publisher, report], report, 'report', 2 FROM ({LEAVES_SQL})
UNION ALL SELECT DISTINCT 'root.' || publisher || '.' || report || '.' || field, ['root', publisher, report, field], field, 'field', 3 FROM ({LEAVES_SQL})
"""


def nodes(spark, sf):
    return catalog.build_catalog(leaves(spark, sf), LEVELS)


@query(f"SELECT dna, name, kind, depth, replace(dna, '.', '/') AS path FROM ({NODES_SQL})")
def register_frames(spark, sf):
    return nodes(spark, sf).select("dna", "name", "kind", "depth", "path")


@query(f"""
WITH n AS ({NODES_SQL}), q AS (SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN c_name WHEN 1 THEN upper('NATION_' || c_nationkey || '/' || c_name) ELSE 'nowhere.' || c_name END AS locator FROM customer),
m AS (SELECT c_custkey, locator, n.dna FROM q LEFT JOIN n ON ends_with(lower('.' || n.dna), lower('.' || replace(locator, '/', '.'))))
SELECT locator, count(dna) AS n_matches, CASE WHEN count(dna) = 1 THEN min(dna) END AS dna FROM m GROUP BY 1
""")
def resolve_node(spark, sf):
    customer = table(spark, sf, "customer")
    locator = F.when(F.col("c_custkey") % 3 == 0, F.col("c_name")).when(F.col("c_custkey") % 3 == 1, F.upper(F.concat(F.lit("NATION_"), "c_nationkey", F.lit("/"), "c_name"))).otherwise(F.concat(F.lit("nowhere."), "c_name"))
    return catalog.resolve_all(nodes(spark, sf), customer.select(locator.alias("locator")))


@query(f"""
WITH n AS ({NODES_SQL}), u AS (SELECT *, array_to_string(parts[1:len(parts) - 1], '.') AS up FROM n)
SELECT 'children' AS relation, a.dna AS of_dna, b.dna AS dna FROM u a JOIN u b ON b.up = a.dna WHERE a.kind = 'report'
UNION ALL SELECT 'siblings', a.dna, b.dna FROM u a JOIN u b ON a.up = b.up WHERE a.kind = 'report'
UNION ALL SELECT 'descendants', a.dna, b.dna FROM u a JOIN u b ON starts_with(b.dna, a.dna || '.') WHERE a.kind = 'publisher'
UNION ALL SELECT 'ascendants', a.dna, b.dna FROM u a JOIN u b ON a.dna = b.dna OR starts_with(a.dna, b.dna || '.') WHERE a.kind = 'field'
UNION ALL SELECT 'ancestor', a.dna, b.dna FROM u a JOIN u b ON starts_with(a.dna, b.dna || '.') WHERE a.kind = 'field' AND b.kind = 'publisher'
""")
def node_relations(spark, sf):
    tree, out = nodes(spark, sf), None
    for relation, of, kind in (("children", "report", None), ("siblings", "report", None), ("descendants", "publisher", None), ("ascendants", "field", None), ("ancestor", "field", "publisher")):
        part = catalog.node_relations(tree, tree.where(F.col("kind") == of), relation, kind).select(F.lit(relation).alias("relation"), "of_dna", "dna")
        out = part if out is None else out.unionByName(part)
    return out


@query(f"""
SELECT ts, value, timezone('EET', timezone('UTC', ts)) AS local_ts FROM ({HOURLY_SQL}) WHERE property = 'purchase'
AND timezone('EET', timezone('UTC', ts)) >= TIMESTAMP '2024-01-03 06:00' AND timezone('EET', timezone('UTC', ts)) < TIMESTAMP '2024-01-26'
""")
def read_node(spark, sf):
    store = hourly(spark, sf).select(F.lit("Site").alias("publisher"), F.lit("Events").alias("report"), F.lit("Hourly").alias("field"), F.lit("all").alias("file"), "property", "ts", "value")
    return catalog.read_node(store, "root.site.events.hourly.all.PURCHASE", "EET", "2024-01-03 06:00", "2024-01-25").select("ts", "value", "local_ts")


def _wide_sql(step: str, cols: str) -> str:
    return f"SELECT time_bucket(INTERVAL {step}, ts) AS ts, {cols} FROM events GROUP BY 1"


@query(f"""
WITH a AS ({_wide_sql("'1 hour'", "max(value) FILTER (event_type = 'click') AS click, max(value) FILTER (event_type = 'view') AS view")}),
b AS ({_wide_sql("'1 hour'", "min(value) FILTER (event_type = 'click') AS click, max(value) FILTER (event_type = 'error') AS error")})
SELECT ts, a.click AS click_1, view, b.click AS click_2, error FROM a FULL JOIN b USING (ts)
""")
def combine(spark, sf):
    hours = events(spark, sf).withColumn("ts", F.date_trunc("hour", "ts").cast(T.NTZ))
    pick = lambda fn, name: fn(F.when(F.col("property") == name, F.col("value"))).alias(name)
    a = hours.groupBy("ts").agg(pick(F.max, "click"), pick(F.max, "view"))
    b = hours.groupBy("ts").agg(pick(F.min, "click"), pick(F.max, "error"))
    return catalog.combine([a, b])


@query(f"""
WITH s AS (SELECT property, ts, CASE WHEN value > 3 THEN value END AS value FROM ({HOURLY_SQL})),
sp AS (SELECT property, min(ts) AS a, max(ts) AS b FROM s GROUP BY 1), g AS (SELECT property, unnest(generate_series(a, b, INTERVAL 30 MINUTE)) AS ts FROM sp),
j AS (SELECT g.property, g.ts, value, CASE WHEN value IS NOT NULL THEN epoch(g.ts) END AS t FROM g LEFT JOIN s USING (property, ts)),
m AS (SELECT *, last_value(t IGNORE NULLS) OVER bw AS tb, last_value(value IGNORE NULLS) OVER bw AS vb, first_value(t IGNORE NULLS) OVER aw AS ta, first_value(value IGNORE NULLS) OVER aw AS va FROM j
  WINDOW bw AS (PARTITION BY property ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), aw AS (PARTITION BY property ORDER BY ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
SELECT property, ts, round(CASE WHEN value IS NOT NULL OR va IS NULL THEN coalesce(value, vb) WHEN vb IS NOT NULL THEN vb + (va - vb) * (epoch(ts) - tb) / (ta - tb) END + 1e-7, 5) AS value FROM m
""")
def upsample_linear(spark, sf):
    every = hourly(spark, sf).select("property", "ts", F.when(F.col("value") > 3, F.col("value")).alias("value"))
    return catalog.upsample_linear(every, ["property"], 1800).withColumn("value", F.round(F.col("value") + 1e-7, 5))


@query("""
WITH m AS (SELECT event_type AS property, time_bucket(INTERVAL 20 MINUTE, ts, TIMESTAMP '1970-01-01') AS ts, avg(value) AS value FROM events GROUP BY 1, 2),
s AS (SELECT property, min(ts) AS a, max(ts) AS b FROM m GROUP BY 1), g AS (SELECT property, unnest(generate_series(a, b, INTERVAL 20 MINUTE)) AS ts FROM s)
SELECT property, ts, round(value + 1e-7, 5) AS value FROM g LEFT JOIN m USING (property, ts)
""")
def downsample_mean(spark, sf):
    every = events(spark, sf).select("property", "ts", "value")
    return catalog.downsample_mean(every, ["property"], 1200).withColumn("value", F.round(F.col("value") + 1e-7, 5))


def _score_sql(word: str) -> str:
    ratio = "100.0 * (greatest(length({0}), length('{1}')) - levenshtein({0}, '{1}')) / greatest(length({0}), length('{1}'))"
    return f"greatest({ratio.format('lower(dna)', word)}, {ratio.format('lower(name)', word)})"


# customer names are nearest to the first word, nations to the second: the deeper one goes first
@query(f"""
WITH n AS ({NODES_SQL}), a AS (SELECT * FROM n ORDER BY {_score_sql('customer#000000123')} DESC, dna LIMIT 500)
SELECT dna, round({_score_sql('nation_12')}, 6) AS score FROM a ORDER BY {_score_sql('nation_12')} DESC, dna LIMIT 10
""")
def fuzzy_search(spark, sf):
    tree = nodes(spark, sf)
    index = names.node_index(tree, scratch(spark, "names"))
    found = catalog.fuzzy_search(tree, ["Nation_12", "customer#000000123"], index=index)
    return found.withColumn("score", F.round("score", 6))


# every supplier's name, misspelt, against the names of all customers and nations
MISSPELT_SQL = "SELECT DISTINCT replace(replace(s_name, 'Supplier', CASE WHEN s_suppkey % 5 = 0 THEN 'Cutsomers' ELSE 'Customr' END), '#0', '#') AS word FROM supplier"


@query(f"""
WITH w AS ({MISSPELT_SQL}), k AS (SELECT c_name AS key FROM customer UNION SELECT n_name FROM nation),
s AS (SELECT word, key, 100.0 * (greatest(length(word), length(key)) - levenshtein(word, key)) / greatest(length(word), length(key)) AS score FROM w, k)
SELECT word, key, round(score, 6) AS score, rank FROM (SELECT *, row_number() OVER (PARTITION BY word ORDER BY score DESC, key) AS rank FROM s) WHERE rank <= 3
""")
def nearest_names(spark, sf):
    supplier = table(spark, sf, "supplier")
    wrong = F.when(F.col("s_suppkey") % 5 == 0, "Cutsomers").otherwise("Customr")
    words = supplier.select(F.replace(F.replace("s_name", F.lit("Supplier"), wrong), F.lit("#0"), F.lit("#")).alias("word"))
    known = table(spark, sf, "customer").select(F.col("c_name").alias("key")).unionByName(table(spark, sf, "nation").select(F.col("n_name").alias("key")))
    index = names.NameIndex.build(known.withColumn("text", F.col("key")), scratch(spark, "names"))
    return index.nearest(words, 3).withColumn("score", F.round("score", 6))


SET_SQL = "list_distinct(list_filter(string_split(lower(regexp_replace(regexp_replace(trim({0}), ' +', ' ', 'g'), '[()-]', '', 'g')), ''), lambda x: x <> ''))"
JACCARD_SQL = "len(list_intersect({a}, {b}))::DOUBLE / (len({a}) + len({b}) - len(list_intersect({a}, {b})))"


@query(f"""
WITH n AS (SELECT DISTINCT p_name AS name FROM part), c AS (SELECT DISTINCT p_type || ' ' || p_brand AS candidate FROM part),
s AS (SELECT name, candidate, {JACCARD_SQL.format(a=SET_SQL.format('name'), b=SET_SQL.format('candidate'))} AS score FROM n, c)
SELECT name, candidate, round(score, 9) AS score, rank FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY score DESC, candidate) AS rank FROM s) WHERE rank <= 3
""")
def jaccard_match(spark, sf):
    part = table(spark, sf, "part")
    found = catalog.jaccard_match(part.select(F.col("p_name").alias("name")), part.select(F.concat_ws(" ", "p_type", "p_brand").alias("candidate")), 3)
    return found.withColumn("score", F.round("score", 9))


@query(f"""
WITH n AS (SELECT DISTINCT p_name AS name FROM part),
c AS (SELECT DISTINCT 'Report' || lower(p_type)[1:1] || upper(p_type)[2:2] || lower(p_type)[3:] AS candidate, ['Report' || lower(p_type)[1:1], upper(p_type)[2:2] || lower(p_type)[3:]] AS parts FROM part),
s AS (SELECT name, candidate, list_sum(list_transform(parts, lambda p: {JACCARD_SQL.format(a=SET_SQL.format('name'), b=SET_SQL.format('p'))})) AS score FROM n, c)
SELECT name, candidate, round(score, 9) AS score FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY round(score, 12) DESC, candidate) AS rank FROM s) WHERE rank = 1
""")
def camel_jaccard(spark, sf):
    part = table(spark, sf, "part")
    low, up = F.lower("p_type"), F.upper("p_type")
    candidate = F.concat(F.lit("Report"), F.substring(low, 1, 1), F.substring(up, 2, 1), low.substr(F.lit(3), F.length(low)))
    found = catalog.jaccard_match(part.select(F.col("p_name").alias("name")), part.select(candidate.alias("candidate")), 1, parts=X.camel_parts)
    return found.select("name", "candidate", F.round("score", 9).alias("score"))


def pool(spark, sf):
    part = table(spark, sf, "part").withColumn("report_name", F.concat(F.lit("Report_"), "p_partkey"))
    metadata = part.select("report_name", F.col("p_brand").alias("publisher"), F.col("p_type").alias("group"), F.element_at(F.split("p_name", " "), 1).alias("country"), (F.col("p_size") % 4 > 0).alias("is_alive"))
    reading = part.where("p_partkey % 10 > 0").select("report_name", F.lit("other").alias("publisher"), F.when(F.col("p_size") > 5, "xlsx").alias("file_format"))
    timing = part.where("p_partkey % 7 > 0").select("report_name", (F.col("p_size") * 15).alias("resolution_min"))
    return catalog.report_pool(metadata, reading, timing, defaults={"file_format": "csv", "resolution_min": 60})


POOL_SQL = """
SELECT 'Report_' || p_partkey AS report_name, p_brand AS publisher, p_type AS "group", split_part(p_name, ' ', 1) AS country, p_size % 4 > 0 AS is_alive,
       CASE WHEN p_partkey % 10 > 0 AND p_size > 5 THEN 'xlsx' ELSE 'csv' END AS file_format, CASE WHEN p_partkey % 7 > 0 THEN p_size * 15 ELSE 60 END AS resolution_min FROM part
"""


@query(POOL_SQL)
def report_pool(spark, sf):
    return pool(spark, sf)


@query(f"SELECT report_name, publisher, resolution_min FROM ({POOL_SQL}) WHERE file_format = 'csv' AND country = 'red'")
def filter_reports(spark, sf):
    return catalog.filter_reports(pool(spark, sf), ["report_name", "publisher", "resolution_min"], file_format="csv", country="red")


@query(f"""
SELECT report_name, publisher, "group", country FROM ({POOL_SQL}) WHERE lower("group") IN ('economy', 'small') AND lower(publisher) IN ('brand#2', 'brand#17', 'brand#4') AND lower(report_name) NOT IN ('report_0', 'report_2') AND is_alive
""")
def select_reports(spark, sf):
    found = catalog.select_reports(pool(spark, sf), which="all", exclude=["REPORT_0", "report_2"], groups=["economy", "SMALL"], publishers=["Brand#2", "brand#17", "brand#4"], only_ongoing=True)
    return found.select("report_name", "publisher", "group", "country")


@query(f"""SELECT "group", count(*) AS n, string_agg(report_name, ',' ORDER BY report_name) AS reports FROM ({POOL_SQL}) GROUP BY 1""")
def group_listing(spark, sf):
    return catalog.group_listing(pool(spark, sf)).select("group", F.size("reports").alias("n"), F.array_join("reports", ",").alias("reports"))


@query(f"SELECT report AS field, string_agg(DISTINCT file, ',' ORDER BY file) AS files FROM ({LEAVES_SQL}) GROUP BY 1")
def structure_summary(spark, sf):
    return catalog.structure_summary(leaves(spark, sf), "report").select(F.col("report").alias("field"), F.array_join("files", ",").alias("files"))


@query("""
WITH a AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderstatus = 'F'), b AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderpriority = '5-LOW')
SELECT 'intersection' AS part, k FROM (SELECT k FROM a INTERSECT SELECT k FROM b) UNION ALL SELECT 'union', k FROM (SELECT k FROM a UNION SELECT k FROM b)
UNION ALL SELECT 'only_first', k FROM (SELECT k FROM a EXCEPT SELECT k FROM b) UNION ALL SELECT 'only_second', k FROM (SELECT k FROM b EXCEPT SELECT k FROM a)
""")
def set_compare(spark, sf):
    orders = table(spark, sf, "orders")
    a, b = orders.where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("k")), orders.where("o_orderpriority = '5-LOW'").select(F.col("o_custkey").alias("k"))
    out = None
    for part in ("intersection", "union", "only_first", "only_second"):
        one = catalog.set_compare(a, b, part).select(F.lit(part).alias("part"), "k")
        out = one if out is None else out.unionByName(one)
    return out


@query(f"SELECT ts, property, value * 2 AS value FROM ({HOURLY_SQL}) WHERE ts >= TIMESTAMP '2024-01-10'")
def transform_hook(spark, sf):
    sliced = slice_time(hourly(spark, sf), "2024-01-10")
    return catalog.transform_hook(sliced, lambda frame: frame.withColumn("value", F.col("value") * 2))

