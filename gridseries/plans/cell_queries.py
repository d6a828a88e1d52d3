"""Queries that clean and reshape sheets: one sheet per order (its lines are the rows) or conversation."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from gridseries.functions import textparts as X
from gridseries.functions import timeparts as T
from gridseries.operators import calendars, cells
from gridseries.plans.base import HOURLY_SQL, day, events, hourly, query, table

LINE_ORDER = ("l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice")


def lines(spark, sf):
    """``file, row`` and the line's columns: rows of an order numbered from 0."""
    row = F.row_number().over(Window.partitionBy("l_orderkey").orderBy(*LINE_ORDER)) - 1
    return table(spark, sf, "lineitem").withColumn("row", row).withColumnRenamed("l_orderkey", "file")


LINES_SQL = f"SELECT *, l_orderkey AS file, row_number() OVER (PARTITION BY l_orderkey ORDER BY {', '.join(LINE_ORDER)}) - 1 AS row FROM lineitem"


def grid(spark, sf):
    """Cells of five columns: flag, quantity, price, a discount that may be empty, a fraction."""
    text = lambda c: F.col(c).cast("string")
    found = [
        F.concat("l_returnflag", F.lit("_"), "l_linestatus"),
        F.col("l_quantity").cast("int").cast("string"),
        F.when(F.col("l_partkey") % 11 == 0, F.lit("n/a")).otherwise(F.col("l_partkey").cast("string")),
        F.when(F.col("l_discount") > 0, text("l_suppkey")),
        F.concat(F.lit("="), text("l_partkey"), F.lit("/10^"), F.col("l_linenumber").cast("string")),
    ]
    return lines(spark, sf).select("file", "row", F.posexplode(F.array(*found)).alias("col", "cell"))


GRID_SQL = f"""
SELECT file, row, unnest([0, 1, 2, 3, 4]) AS col, unnest([l_returnflag || '_' || l_linestatus, l_quantity::INT::VARCHAR,
  CASE WHEN l_partkey % 11 = 0 THEN 'n/a' ELSE l_partkey::VARCHAR END, CASE WHEN l_discount > 0 THEN l_suppkey::VARCHAR END,
  '=' || l_partkey || '/10^' || l_linenumber]) AS cell FROM ({LINES_SQL})
"""


def sheet_series(spark, sf):
    """The grid transposed: one property per row."""
    return cells.transpose_sheet(grid(spark, sf))


@query(f"""
WITH m AS (SELECT n_name AS raw, 'N' || n_nationkey AS conformed FROM nation),
t AS (SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment || ' (' || c_custkey || ')' ELSE 'NATION_' || c_nationkey END AS cell FROM customer)
SELECT c_custkey, regexp_replace(regexp_replace(coalesce(conformed, cell), '\\s*\\(.*\\)$', ''), 'MACHINERY', 'MACH', 'g') AS cell FROM t LEFT JOIN m ON cell = raw
""")
def replace_values(spark, sf):
    maps = table(spark, sf, "nation").select(F.col("n_name").alias("raw"), F.concat(F.lit("N"), "n_nationkey").alias("conformed"))
    given = F.when(F.col("c_custkey") % 3 == 0, F.concat("c_mktsegment", F.lit(" ("), "c_custkey", F.lit(")"))).otherwise(F.concat(F.lit("NATION_"), "c_nationkey"))
    frame = table(spark, sf, "customer").select("c_custkey", given.alias("cell"))
    return cells.replace_values(frame, maps, [(r"\s*\(.*\)$", ""), ("MACHINERY", "MACH")]).select("c_custkey", "cell")


@query("""
WITH s AS (SELECT p_partkey, p_size AS section, CASE WHEN p_type = 'ECONOMY' THEN 'cheap' ELSE p_name END AS name FROM part),
n AS (SELECT *, lower(regexp_replace(trim(name), '[^A-Za-z0-9]+', '_', 'g')) AS property FROM s)
SELECT p_partkey, section, CASE WHEN min(property) OVER (PARTITION BY section, p_partkey % 50) = max(property) OVER (PARTITION BY section, p_partkey % 50) THEN 'S' || section ELSE property END AS property FROM n
""")
def rename_columns(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", "p_size", (F.col("p_partkey") % 50).alias("file"), F.when(F.col("p_type") == "ECONOMY", F.lit("ECONOMY")).otherwise(F.col("p_name")).alias("property"))
    named = part.withColumn("section", F.concat(F.lit("S"), "p_size"))
    out = cells.rename_properties(named, {"ECONOMY": "cheap", "absent": "x"}, snake=True, section_col="section", keys=("file",))
    return out.select("p_partkey", F.col("p_size").alias("section"), "property")


@query(f"""
WITH g AS ({GRID_SQL}), r AS (SELECT file, row FROM g GROUP BY 1, 2 HAVING count(cell) >= 5), k AS (SELECT g.* FROM g SEMI JOIN r USING (file, row)),
c AS (SELECT file, col FROM k GROUP BY 1, 2 HAVING count(cell) >= 3)
SELECT k.* FROM k SEMI JOIN c USING (file, col)
""")
def drop_sparse(spark, sf):
    return cells.drop_sparse(cells.drop_sparse(grid(spark, sf), "rows", 5), "columns", 3)


@query(f"""
WITH s AS (SELECT g.file, g.row, g.col - 1 AS pos, n.cell AS property, g.cell FROM ({GRID_SQL}) g JOIN ({GRID_SQL}) n ON g.file = n.file AND g.row = n.row AND n.col = 0 WHERE g.col BETWEEN 1 AND 3),
k AS (SELECT * FROM s WHERE property <> 'N_O' AND NOT starts_with(property, 'R') AND NOT regexp_matches(property, '^A.*F$')),
t AS (SELECT file, property FROM k WHERE cell IS NOT NULL AND try_cast(cell AS DOUBLE) IS NULL GROUP BY 1, 2)
SELECT k.* FROM k ANTI JOIN t USING (file, property)
""")
def drop_columns_if(spark, sf):
    return cells.drop_columns_if(sheet_series(spark, sf).where("pos <= 2"), names=["N_O"], prefixes=["R"], patterns=["^A.*F$"], text_valued=True)


@query(f"""
WITH g AS ({GRID_SQL}), h AS (SELECT file, max(col) AS last FROM g WHERE row = 0 AND regexp_matches(cell, '^[0-9]*7[0-9]*$') GROUP BY 1)
SELECT g.* FROM g LEFT JOIN h USING (file) WHERE last IS NULL OR col <= last
""")
def truncate_at_trigger(spark, sf):
    return cells.truncate_at_trigger(grid(spark, sf), "^[0-9]*7[0-9]*$")


@query(f"""
WITH g AS ({GRID_SQL}), f AS (SELECT g.* FROM g SEMI JOIN (SELECT file, row FROM g GROUP BY 1, 2 HAVING count(cell) >= 5) r USING (file, row)),
h AS (SELECT file, min(row) AS head FROM f GROUP BY 1)
SELECT b.file, b.row, b.col, b.cell, n.cell AS property FROM f b JOIN h USING (file) JOIN f n ON n.file = b.file AND n.row = head AND n.col = b.col WHERE b.row > head
""")
def promote_header(spark, sf):
    return cells.promote_header(grid(spark, sf), 5).select("file", "row", "col", "cell", "property")


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_partkey % 7 = 0 THEN NULL ELSE round(l_partkey::DOUBLE / power(10::DOUBLE, l_linenumber), 9) END AS value FROM lineitem
""")
def eval_fractions(spark, sf):
    cell = F.when(F.col("l_partkey") % 7 == 0, F.lit("=no/10")).otherwise(F.concat(F.lit("= "), "l_partkey", F.lit("/10^"), "l_linenumber"))
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.round(X.number(X.eval_fraction(cell)), 9).alias("value"))


def _sql_fold(text: str) -> str:
    out = f"trim({text})"
    for raw, folded in X.DIGRAPHS:
        out = f"replace({out}, '{raw}', '{folded}')"
    return f"translate({out}, '{X.GREEK_FROM + X.LATIN_FROM}', '{X.GREEK_TO + X.LATIN_TO}')"


@query(f"SELECT doc_id, lang, {_sql_fold('text')} AS folded FROM documents")
def transliterate(spark, sf):
    return table(spark, sf, "documents").select("doc_id", "lang", X.transliterate(F.col("text")).alias("folded"))


CUES = [cells.Cue("Ask", "user", "assistant", True, False), cells.Cue("Answer", "assistant", "assistant"), cells.Cue("Rest", None, "last")]


@query("""
WITH r AS (SELECT conv_id AS file, turn AS row, role AS indicator FROM conversations), n AS (SELECT file, count(*) AS n, min(row) AS first, max(row) AS last FROM r GROUP BY 1),
a AS (SELECT file, min(row) FILTER (indicator = 'user') AS s, min(row) FILTER (indicator = 'assistant') AS e FROM r GROUP BY 1),
low1 AS (SELECT file, CASE WHEN s IS NOT NULL AND e IS NOT NULL THEN e ELSE -1 END AS low FROM a),
b AS (SELECT file, min(row) FILTER (indicator = 'assistant' AND row >= low) AS s FROM r JOIN low1 USING (file) GROUP BY 1),
low2 AS (SELECT file, CASE WHEN s IS NOT NULL THEN s + 1 ELSE low END AS low FROM b JOIN low1 USING (file)),
c AS (SELECT file, min(row) FILTER (row >= low) AS s, max(row) FILTER (row >= low) AS e FROM r JOIN low2 USING (file) GROUP BY 1),
bounds AS (
  SELECT file, 'Ask' AS section, s AS f, e - 1 AS t FROM a WHERE s IS NOT NULL AND e IS NOT NULL
  UNION ALL SELECT file, 'Answer', s, s FROM b WHERE s IS NOT NULL UNION ALL SELECT file, 'Rest', s, e FROM c WHERE s IS NOT NULL)
SELECT r.file, row, indicator, section FROM r JOIN bounds USING (file) JOIN n USING (file) WHERE n > 1 AND row BETWEEN f AND t
UNION ALL SELECT r.file, row, indicator, 'whole' FROM r JOIN n USING (file) WHERE n = 1
""")
def split_sections(spark, sf):
    rows = table(spark, sf, "conversations").select(F.col("conv_id").alias("file"), F.col("turn").alias("row"), F.col("role").alias("indicator"))
    return cells.split_sections(rows, CUES, whole_name="whole").select("file", "row", "indicator", "section")


@query(f"""
SELECT g.file, g.row, n.cell AS property, g.col - 2 AS pos, g.cell FROM ({GRID_SQL}) g JOIN ({GRID_SQL}) n ON g.file = n.file AND g.row = n.row AND n.col = 1 WHERE g.col >= 2
""")
def transpose_sheet(spark, sf):
    return cells.transpose_sheet(grid(spark, sf), skip=2).select("file", "row", "property", "pos", "cell")


DAYS_SQL = "SELECT o_orderdate::DATE::TIMESTAMP AS period, count(*) AS n, sum(o_orderkey) AS k FROM orders GROUP BY 1"
EET = "timezone('UTC', timezone('EET', {0}))"
CALENDAR_SQL = f"""
SELECT period, row_number() OVER (PARTITION BY period ORDER BY ts) - 1 AS pos, ts, timezone('EET', timezone('UTC', ts)) AS local_ts FROM (
  SELECT period, unnest(generate_series({EET.format('period')}, {EET.format('period + INTERVAL 1 DAY')} - INTERVAL 1 HOUR, INTERVAL 1 HOUR)) AS ts FROM ({DAYS_SQL}))
"""


def days(spark, sf):
    return table(spark, sf, "orders").groupBy(F.col("o_orderdate").cast("date").alias("period")).agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("k"))


def day_calendar(spark, sf):
    return calendars.period_calendar(days(spark, sf).select("period"), "EET")


@query(f"""
WITH cal AS ({CALENDAR_SQL}), size AS (SELECT period, count(*) AS slots FROM cal GROUP BY 1)
SELECT period, ts, k + CASE WHEN 24 < slots AND pos >= 4 THEN pos - 1 ELSE pos END AS value FROM cal JOIN size USING (period) JOIN ({DAYS_SQL}) USING (period)
WHERE CASE WHEN 24 < slots AND pos >= 4 THEN pos - 1 ELSE pos END < 24
""")
def assign_calendar(spark, sf):
    source = days(spark, sf).select("period", "k", F.explode(F.sequence(F.lit(0), F.lit(23))).alias("pos")).select("period", "pos", (F.col("k") + F.col("pos")).alias("value"))
    return cells.assign_calendar(source, day_calendar(spark, sf)).select(day("period"), "ts", "value")


@query(f"""
SELECT period, ts, row_number() OVER (PARTITION BY period ORDER BY ts) - 1 AS pos FROM ({CALENDAR_SQL}) JOIN ({DAYS_SQL}) USING (period)
WHERE local_ts >= period + to_hours((n % 13)::INT)
""")
def partial_day_align(spark, sf):
    headers = days(spark, sf).select("period", (F.col("period").cast(T.NTZ) + F.make_dt_interval(F.lit(0), (F.col("n") % 13).cast("int"))).alias("header_ts"))
    return cells.partial_day_align(day_calendar(spark, sf), headers).select(day("period"), "ts", "pos")


@query(f"""
WITH s AS (SELECT period, ts, 'A' AS property, k::DOUBLE AS value FROM ({CALENDAR_SQL}) JOIN ({DAYS_SQL}) USING (period) WHERE n % 4 <> 0)
SELECT * FROM s UNION ALL
SELECT period, ts, unnest(['A', 'B']), 0::DOUBLE FROM ({CALENDAR_SQL}) JOIN ({DAYS_SQL}) USING (period) WHERE n % 4 = 0
""")
def fill_empty_frame(spark, sf):
    calendar = day_calendar(spark, sf)
    some = calendar.join(days(spark, sf), "period").where("n % 4 <> 0").select("period", "ts", F.lit("A").alias("property"), F.col("k").cast("double").alias("value"))
    return cells.fill_empty_frame(some, calendar, ["A", "B"]).select(day("period"), "ts", "property", "value")


@query(f"""
SELECT file, row, col, CASE WHEN bool_or(cell IS NOT NULL AND try_cast(cell AS DOUBLE) IS NULL) OVER (PARTITION BY file, col) THEN NULL ELSE coalesce(try_cast(cell AS DOUBLE), 0) END AS value
FROM ({GRID_SQL}) WHERE col BETWEEN 1 AND 3
""")
def to_double_fill0(spark, sf):
    return cells.to_double_fill0(grid(spark, sf).where("col between 1 and 3"), ("file", "col")).select("file", "row", "col", "value")


@query(f"""
WITH h AS (SELECT file, row AS col, CASE WHEN row = 0 OR l_linestatus = 'O' THEN l_returnflag || l_partkey END AS cell FROM ({LINES_SQL})),
f AS (SELECT *, last_value(cell IGNORE NULLS) OVER w AS name0, count(cell) OVER w AS grp FROM h WINDOW w AS (PARTITION BY file ORDER BY col)),
p AS (SELECT *, row_number() OVER (PARTITION BY file, grp ORDER BY col) - 1 AS place FROM f)
SELECT file, col, name0 || ['_GT', '_ST', '_MW'][1 + place % 3] AS name FROM p
""")
def fill_header_names(spark, sf):
    cell = F.when((F.col("row") == 0) | (F.col("l_linestatus") == "O"), F.concat("l_returnflag", "l_partkey"))
    header = lines(spark, sf).select("file", F.col("row").alias("col"), cell.alias("cell"))
    return cells.fill_header_names(header, ["_GT", "_ST", "_MW"]).select("file", "col", "name")


@query("SELECT p_partkey, concat_ws('_', p_brand, p_type, p_size) AS key FROM part")
def combine_keys(spark, sf):
    return cells.combine_keys(table(spark, sf, "part"), ["p_brand", "p_type", "p_size"]).select("p_partkey", "key")


@query("""
SELECT p_partkey, CASE WHEN p_size IN (3, 5, 8) THEN p_type ELSE p_brand END AS p_brand, CASE WHEN p_size IN (3, 5, 8) THEN p_brand ELSE p_type END AS p_type FROM part
""")
def swap_values(spark, sf):
    return cells.swap_values(table(spark, sf, "part"), "p_size", [3, 5, 8], "p_brand", "p_type").select("p_partkey", "p_brand", "p_type")


TYPES = ["click", "error", "purchase", "signup", "view"]
PIVOT_SQL = "SELECT date_trunc('hour', ts)::TIMESTAMP AS ts, " + ", ".join(f"avg(value) FILTER (event_type = '{t}') AS {t}" for t in TYPES) + " FROM events GROUP BY 1"


def rounded(frame, cols, digits=4):
    return frame.withColumns({c: F.round(c, digits) for c in cols})


@query("SELECT ts, " + ", ".join(f"round({t}, 4) AS {t}" for t in TYPES) + f" FROM ({PIVOT_SQL})")
def pivot_mean(spark, sf):
    hours = events(spark, sf).withColumn("ts", F.date_trunc("hour", "ts").cast(T.NTZ))
    return rounded(cells.pivot_mean(hours, ["ts"], "property", TYPES), TYPES)


@query(f"SELECT ts, purchase, signup FROM ({PIVOT_SQL.replace('avg(', 'max(')}) WHERE (purchase IS NOT NULL OR signup IS NOT NULL) AND hour(ts) <> 0")
def clean_pivot(spark, sf):
    hours = events(spark, sf).withColumn("ts", F.date_trunc("hour", "ts").cast(T.NTZ))
    wide = hours.groupBy("ts").pivot("property", ["purchase", "signup"]).agg(F.max("value")).withColumn("sort", F.hour("ts"))
    return cells.clean_pivot(wide, ["ts", "sort"], "sort").select("ts", "purchase", "signup")


@query("""
WITH w AS (SELECT o_orderdate AS ts, o_orderkey AS ord, CASE WHEN o_orderstatus = 'O' THEN o_totalprice END AS a, CASE WHEN o_custkey % 2 = 0 THEN o_custkey::DOUBLE END AS b FROM orders),
m AS (SELECT *, month(ts) = 10 AND dayofweek(ts) = 0 AND month(ts + INTERVAL 7 DAY) = 11 AS autumn FROM w)
SELECT ts, min(ord) AS ord, arg_min(a, ord) FILTER (a IS NOT NULL) AS a, arg_min(b, ord) FILTER (b IS NOT NULL) AS b FROM m WHERE NOT autumn GROUP BY ts
UNION ALL SELECT ts, ord, a, b FROM m WHERE autumn
""")
def coalesce_duplicates(spark, sf):
    wide = table(spark, sf, "orders").select(
        F.col("o_orderdate").alias("ts"), F.col("o_orderkey").alias("ord"), F.when(F.col("o_orderstatus") == "O", F.col("o_totalprice")).alias("a"),
        F.when(F.col("o_custkey") % 2 == 0, F.col("o_custkey").cast("double")).alias("b"),
    )
    return cells.coalesce_duplicates(wide, "ts", "ord")


@query("""
WITH f AS (SELECT l_orderkey AS file, l_linenumber AS pos, max(l_quantity) AS value FROM lineitem GROUP BY 1, 2), n AS (SELECT file, max(pos) AS n FROM f GROUP BY 1),
g AS (SELECT file, unnest(generate_series(1, n)) AS pos FROM n)
SELECT file, pos, coalesce(value, 0) AS value FROM g LEFT JOIN f USING (file, pos)
""")
def reindex_sequence(spark, sf):
    frame = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("file"), F.col("l_linenumber").alias("pos")).agg(F.max("l_quantity").alias("value"))
    return cells.reindex_sequence(frame, ["file"], "pos", ["value"])


LEVELS = [f"{f}|{s}" for f in "ANR" for s in "FO"]
WIDE_SQL = "SELECT l_shipdate AS ts, " + ", ".join(f"min(l_quantity) FILTER (l_returnflag = '{x[0]}' AND l_linestatus = '{x[2]}') AS \"{x}\"" for x in LEVELS) + " FROM lineitem GROUP BY 1"


def wide_levels(spark, sf):
    long = table(spark, sf, "lineitem").select(F.col("l_shipdate").alias("ts"), F.col("l_returnflag").alias("file"), F.col("l_linestatus").alias("property"), F.col("l_quantity").alias("value"))
    return cells.collapse_levels(long, ["ts"], LEVELS)


@query("SELECT l_shipdate AS ts, l_returnflag AS file, l_linestatus AS property, min(l_quantity) AS value FROM lineitem GROUP BY 1, 2, 3")
def expand_levels(spark, sf):
    return cells.expand_levels(wide_levels(spark, sf), ["ts"])


@query(f"SELECT ts, {', '.join(chr(34) + x + chr(34) + ' AS ' + x.replace('|', '_') for x in LEVELS)} FROM ({WIDE_SQL})")
def collapse_levels(spark, sf):
    return wide_levels(spark, sf).toDF("ts", *[x.replace("|", "_") for x in LEVELS])


@query("""
WITH p AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'F' THEN 15 ELSE 60 END AS duration FROM orders)
SELECT * FROM p QUALIFY min(duration) OVER (PARTITION BY o_custkey) = max(duration) OVER (PARTITION BY o_custkey) OR duration = 15
""")
def filter_duration(spark, sf):
    products = table(spark, sf, "orders").select("o_orderkey", "o_custkey", F.when(F.col("o_orderstatus") == "F", 15).otherwise(60).alias("duration"))
    return cells.filter_duration(products, ["o_custkey"])


@query(f"""
WITH s AS (SELECT ts, CASE WHEN property IN ('view', 'click') THEN property || '_MWh' ELSE property END AS property, CASE WHEN value > 1 THEN value END AS value FROM ({HOURLY_SQL}))
SELECT ts, property, round(CASE WHEN property LIKE '%MWh%' THEN value * 0.001 ELSE value END, 6) AS value FROM s WHERE ts IN (SELECT ts FROM s GROUP BY ts HAVING count(value) >= 2)
""")
def scale_units(spark, sf):
    name = F.when(F.col("property").isin("view", "click"), F.concat("property", F.lit("_MWh"))).otherwise(F.col("property"))
    series = hourly(spark, sf).select("ts", name.alias("property"), F.when(F.col("value") > 1, F.col("value")).alias("value"))
    return rounded(cells.scale_units(series, row_keys=["ts"]), ["value"], 6)


@query("""
SELECT year(l_shipdate) AS year, l_returnflag AS file, sum(l_quantity) AS quantity, NULL::DOUBLE AS price FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-01-01' GROUP BY 1, 2
UNION ALL SELECT year(l_shipdate), l_returnflag, sum(l_quantity), max(l_extendedprice) FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-01-01' GROUP BY 1, 2
""")
def join_periods(spark, sf):
    items = table(spark, sf, "lineitem").withColumn("year", F.year("l_shipdate"))
    keys = ["year", F.col("l_returnflag").alias("file")]
    early = items.where("l_shipdate < '1998-01-01'").groupBy(*keys).agg(F.sum("l_quantity").alias("quantity"))
    late = items.where("l_shipdate >= '1998-01-01'").groupBy(*keys).agg(F.sum("l_quantity").alias("quantity"), F.max("l_extendedprice").alias("price"))
    return cells.join_periods(early, late)


@query(f"""
WITH r AS ({LINES_SQL})
SELECT b.file, b.l_shipdate::DATE::TIMESTAMP AS ts, p AS property, CASE p WHEN 'q' || h.l_linenumber THEN b.l_quantity ELSE b.l_partkey END::DOUBLE AS value
FROM r b JOIN r h ON h.file = b.file AND h.row = 0, unnest(['q' || h.l_linenumber, 'part']) u(p) WHERE b.row > 0
""")
def series_with_index(spark, sf):
    head = F.array(F.lit("stamp"), F.concat(F.lit("q"), "l_linenumber"), F.lit("part"))
    body = F.array(F.date_format("l_shipdate", "yyyy-MM-dd"), F.col("l_quantity").cast("string"), F.col("l_partkey").cast("string"))
    sheet = lines(spark, sf).select("file", "row", F.posexplode(F.when(F.col("row") == 0, head).otherwise(body)).alias("col", "cell"))
    return cells.series_with_index(sheet, T.parse_stamp(F.col("cell")))
