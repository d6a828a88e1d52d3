"""Queries of the market operators: the lines of orders are trades and offers."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridseries.functions import timeparts as T
from gridseries.operators import market, validity
from gridseries.plans.base import HOURLY_SQL, day, hourly, query, table
from gridseries.plans.cell_queries import CALENDAR_SQL, DAYS_SQL, day_calendar, days, rounded

SIDE_SQL = "CASE WHEN l_linestatus = 'O' THEN 'Buy' ELSE 'Sell' END"
ASSETS = ["RES", "Lignite", "HV", "LV", "PUMP", "GR-AL", "AL-GR", "GR-IT", "IT-GR"]
ASSET_SQL = "[" + ", ".join(f"'{a}'" for a in ASSETS) + "][1 + l_partkey % 9]"


def trades(spark, sf):
    """``ts, key, side, asset, class, quantity, price`` of every line."""
    asset = F.element_at(F.array(*map(F.lit, ASSETS)), (F.col("l_partkey") % 9 + 1).cast("int"))
    return table(spark, sf, "lineitem").select(
        F.col("l_shipdate").alias("ts"), F.col("l_orderkey").alias("key"), F.col("l_linenumber").alias("line"), "l_partkey", "l_suppkey", F.when(F.col("l_linestatus") == "O", "Buy").otherwise("Sell").alias("side"), asset.alias("asset"),
        F.col("l_returnflag").alias("class"), F.col("l_quantity").alias("quantity"), F.col("l_extendedprice").alias("price"),
    )


TRADES_SQL = f"SELECT l_shipdate AS ts, l_orderkey AS key, l_linenumber AS line, l_partkey, l_suppkey, {SIDE_SQL} AS side, {ASSET_SQL} AS asset, l_returnflag AS class, l_quantity AS quantity, l_extendedprice AS price FROM lineitem"


@query(f"""
SELECT ts, round(avg(quantity) FILTER (class = 'A' AND side = 'Buy'), 4) AS buy_a, round(avg(quantity) FILTER (class = 'N' AND side = 'Buy'), 4) AS buy_n,
       round(avg(quantity) FILTER (class = 'A' AND side = 'Sell'), 4) AS sell_a, round(avg(quantity) FILTER (class = 'N' AND side = 'Sell'), 4) AS sell_n
FROM ({TRADES_SQL}) GROUP BY ts
""")
def side_split(spark, sf):
    found = market.side_split(trades(spark, sf), ["ts"], "class", ["A", "N"], "quantity")
    buy, sell = found["Buy"].toDF("ts", "buy_a", "buy_n"), found["Sell"].toDF("ts", "sell_a", "sell_n")
    return rounded(buy.join(sell, "ts", "full_outer"), ["buy_a", "buy_n", "sell_a", "sell_n"])


@query(f"""
WITH m AS (SELECT date_trunc('month', ts) AS ts, side, asset, sum(quantity) AS value FROM ({TRADES_SQL}) GROUP BY 1, 2, 3),
k AS (SELECT *, CASE WHEN asset IN ('RES', 'Lignite') THEN 'generation' WHEN asset IN ('HV', 'LV', 'PUMP') THEN 'load' WHEN side = 'Sell' AND asset LIKE '%-GR' THEN 'border' WHEN side = 'Buy' AND asset LIKE 'GR%' THEN 'border' END AS kind FROM m),
n AS (SELECT ts, kind, CASE WHEN kind = 'border' AND side = 'Sell' THEN split_part(asset, '-', 2) || '-' || split_part(asset, '-', 1) ELSE asset END AS asset, side,
      CASE WHEN (kind = 'generation') = (side = 'Sell') THEN value ELSE -value END AS v FROM k WHERE kind IS NOT NULL),
net AS (SELECT ts, kind, asset, CASE WHEN kind <> 'border' OR count(DISTINCT side) = 2 THEN sum(v) END AS value FROM n GROUP BY ts, kind, asset)
SELECT ts::TIMESTAMP AS ts, asset, value FROM net
UNION ALL SELECT ts, 'Demand', coalesce(sum(value) FILTER (kind = 'load' AND asset <> 'PUMP'), 0) FROM net GROUP BY ts
UNION ALL SELECT ts, 'Generation', coalesce(sum(value) FILTER (kind = 'generation'), 0) FROM net GROUP BY ts
UNION ALL SELECT ts, 'NetMarketSchedule', coalesce(sum(value) FILTER (kind = 'border'), 0) FROM net GROUP BY ts
""")
def net_positions(spark, sf):
    months = trades(spark, sf).groupBy(F.date_trunc("month", "ts").cast(T.NTZ).alias("ts"), "side", "asset").agg(F.sum("quantity").alias("value"))
    return market.net_positions(months, ["ts"])


@query(f"""
SELECT ts, side, class, round(sum(price * quantity) / sum(quantity) + 1e-7, 4) AS vwap, min(price) AS min_price, max(price) AS max_price, sum(quantity) AS total_trades
FROM ({TRADES_SQL}) GROUP BY 1, 2, 3
""")
def trade_stats(spark, sf):
    stats = market.trade_stats(trades(spark, sf), ["ts", "side", "class"])
    return stats.withColumn("vwap", F.round(F.col("vwap") + 1e-7, 4))  # keeps exact halves from rounding by the engine


@query(f"""
SELECT ts, {', '.join(f"round(avg({p}) FILTER (class = '{c}'), 6) AS {c}_{p}" for c in 'ANR' for p in ('quantity', 'price'))}
FROM ({TRADES_SQL}) GROUP BY ts HAVING 2 * (count(DISTINCT class)) >= 5
""")
def order_tables(spark, sf):
    wide = market.order_tables(trades(spark, sf), ["ts"], "class", ["A", "N", "R"], ["quantity", "price"], least=5)
    return rounded(wide, wide.columns[1:], 6)


@query(f"""
SELECT ts, round(avg(quantity) FILTER (asset = 'RES'), 4) AS zone_res, round(avg(quantity) FILTER (asset = 'HV'), 4) AS zone_hv,
       round(avg(price) FILTER (asset = 'GR-AL'), 4) AS flow_al, round(avg(price) FILTER (asset = 'GR-IT'), 4) AS flow_it FROM ({TRADES_SQL}) GROUP BY ts
""")
def coupling(spark, sf):
    all_trades = trades(spark, sf)
    zones = all_trades.select("ts", F.col("asset").alias("zone"), F.col("quantity").alias("net_position"))
    borders = all_trades.select("ts", F.col("asset").alias("border"), F.col("price").alias("flow"))
    a, b = market.coupling(zones, borders, ["ts"], ["RES", "HV"], ["GR-AL", "GR-IT"])
    wide = a.toDF("ts", "zone_res", "zone_hv").join(b.toDF("ts", "flow_al", "flow_it"), "ts")
    return rounded(wide, wide.columns[1:])


LADDER_SQL = f"SELECT ts AS period, line AS mtu, l_partkey AS aa, side, quantity, price FROM ({TRADES_SQL})"


@query(f"""
WITH m AS (SELECT period, mtu, aa, side, avg(quantity) AS quantity, avg(price) AS price FROM ({LADDER_SQL}) GROUP BY 1, 2, 3, 4)
SELECT period::TIMESTAMP AS period, timezone('UTC', timezone('EET', period)) + to_hours(dense_rank() OVER (PARTITION BY period ORDER BY mtu) - 1) AS ts, aa, side, round(quantity, 4) AS quantity, round(price, 4) AS price FROM m
""")
def supply_curves(spark, sf):
    steps = trades(spark, sf).select(F.col("ts").alias("period"), F.col("line").alias("mtu"), F.col("l_partkey").alias("aa"), "side", "quantity", "price")
    return rounded(market.supply_curves(steps), ["quantity", "price"])


OFFERS_SQL = "SELECT l_shipdate AS ts, CASE WHEN l_linestatus = 'O' THEN 'Up' ELSE 'Dn' END AS direction, ['FCR', 'aFRR', 'mFRR'][1 + l_suppkey % 3] AS service, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice AS price FROM lineitem"
OFFER_ORDER = ["price", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"]


def offers(spark, sf):
    service = F.element_at(F.array(F.lit("FCR"), F.lit("aFRR"), F.lit("mFRR")), (F.col("l_suppkey") % 3 + 1).cast("int"))
    return table(spark, sf, "lineitem").select(
        F.col("l_shipdate").alias("ts"), F.when(F.col("l_linestatus") == "O", "Up").otherwise("Dn").alias("direction"), service.alias("service"),
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", F.col("l_extendedprice").alias("price"),
    )


def _ladder_sql(keys: str) -> str:
    return f"SELECT ts, service, replace(direction, 'Dn', 'Down') AS direction, row_number() OVER (PARTITION BY {keys}, direction ORDER BY {', '.join(OFFER_ORDER)}) - 1 AS step, l_quantity AS quantity, price FROM ({OFFERS_SQL})"


@query(f"SELECT ts, direction, step, quantity, price FROM ({_ladder_sql('ts')})")
def bid_ladder(spark, sf):
    return market.bid_ladder(offers(spark, sf), ["ts"], OFFER_ORDER).select("ts", "direction", "step", F.col("l_quantity").alias("quantity"), "price")


@query(f"SELECT ts, service, direction, step, quantity, price FROM ({_ladder_sql('ts, service')}) WHERE service <> 'FCR'")
def offers_by_service(spark, sf):
    found = market.offers_by_service(offers(spark, sf), ["ts"], OFFER_ORDER)
    return found["aFRR"].unionByName(found["mFRR"]).select("ts", "service", "direction", "step", F.col("l_quantity").alias("quantity"), "price")


def _by_class(spark, sf, side):
    return trades(spark, sf).where(F.col("side") == side).groupBy("ts", F.col("class").alias("unit")).agg(F.sum("quantity").alias("value"))


@query(f"""
WITH s AS (SELECT ts, side, class AS unit, sum(quantity) AS v FROM ({TRADES_SQL}) GROUP BY 1, 2, 3)
SELECT ts, unit, a.v AS scheduled, b.v AS activated, a.v - b.v AS value FROM (SELECT * FROM s WHERE side = 'Buy') a FULL JOIN (SELECT * FROM s WHERE side = 'Sell') b USING (ts, unit)
""")
def market_schedule(spark, sf):
    return market.market_schedule(_by_class(spark, sf, "Buy"), _by_class(spark, sf, "Sell"), ["ts", "unit"])


UNITS = ["ALPHA_GT1", "ALPHA_GT2", "ALPHA_ST", "BETA_GT1", "BETA_ST", "SOLO"]
UNIT_SQL = "[" + ", ".join(f"'{u}'" for u in UNITS) + "][1 + l_partkey % 6]"
SECTION_SQL = "['Lignite', 'Gas', 'Hydro'][1 + l_suppkey % 3]"
PLANTS_SQL = f"SELECT l_shipdate AS ts, {SECTION_SQL} AS section, {UNIT_SQL} AS property, sum(CASE WHEN l_discount > 0.05 THEN l_quantity ELSE 0 END) AS value FROM lineitem GROUP BY 1, 2, 3"


def plants(spark, sf):
    pick = lambda names, k: F.element_at(F.array(*map(F.lit, names)), (k % len(names) + 1).cast("int"))
    return table(spark, sf, "lineitem").groupBy(
        F.col("l_shipdate").alias("ts"), pick(["Lignite", "Gas", "Hydro"], F.col("l_suppkey")).alias("section"), pick(UNITS, F.col("l_partkey")).alias("property")
    ).agg(F.sum(F.when(F.col("l_discount") > 0.05, F.col("l_quantity")).otherwise(0.0)).alias("value"))


@query(f"""
SELECT ts, CASE WHEN section IN ('Lignite', 'Gas') THEN 'Thermal' ELSE section END AS section, regexp_replace(property, '_(GT|ST).*$', '') AS property, sum(value) AS value
FROM ({PLANTS_SQL}) GROUP BY 1, 2, 3
""")
def plant_totals(spark, sf):
    return market.plant_totals(plants(spark, sf), ["ts"], ("Lignite", "Gas"))[0]


@query(f"""
WITH u AS (SELECT ts, section, split_part(property, '_', 1) AS plant, property, value FROM ({PLANTS_SQL}) WHERE property LIKE '%\\_%' ESCAPE '\\'),
c AS (SELECT ts, section, plant, count(*) FILTER (value <> 0 AND property LIKE '%GT%') AS gt, coalesce(bool_or(value <> 0 AND property LIKE '%ST'), false) AS st FROM u GROUP BY 1, 2, 3)
SELECT ts, section, plant, concat_ws('+', CASE WHEN gt > 0 THEN gt || 'GT' END, CASE WHEN st THEN 'ST' END) AS mode FROM c
""")
def plant_modes(spark, sf):
    return market.plant_modes(plants(spark, sf), ["ts", "section"])


@query("""
WITH s AS (SELECT o_orderdate AS ts, ['P1_GT', 'P1_ST', 'P1_MW', 'P2_GT', 'P2_ST', 'P2_MW'][1 + o_orderkey % 6] AS property, max(o_custkey)::VARCHAR AS cell FROM orders GROUP BY 1, 2)
SELECT ts, property[1:2] AS plant, max(cell) FILTER (property LIKE '%GT') || '+' || max(cell) FILTER (property LIKE '%ST') AS mode, max(cell) FILTER (property LIKE '%MW')::DOUBLE AS mw FROM s GROUP BY 1, 2
""")
def mode_pairs(spark, sf):
    name = F.element_at(F.array(*map(F.lit, ["P1_GT", "P1_ST", "P1_MW", "P2_GT", "P2_ST", "P2_MW"])), (F.col("o_orderkey") % 6 + 1).cast("int"))
    series = table(spark, sf, "orders").groupBy(F.col("o_orderdate").alias("ts"), name.alias("property")).agg(F.max("o_custkey").cast("string").alias("cell"))
    return market.mode_pairs(series, ["ts"])


@query("""
SELECT o_orderkey, ['Actual', 'Forecast', 'Reason'][1 + o_custkey % 3] AS kind, (CASE WHEN o_custkey % 3 = 0 AND o_orderkey % 4 <> 3 THEN o_orderdate - INTERVAL 1 DAY ELSE o_orderdate END)::TIMESTAMP AS date FROM orders
""")
def availability_split(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("row"), (F.col("o_orderkey") % 4).alias("run"), F.col("o_orderdate").cast("date").alias("date"))
    return market.availability_split(rows, run_col="run").select("o_orderkey", "kind", day("date"))


@query("SELECT c_custkey, coalesce(CASE WHEN n_regionkey = 1 THEN 'MOVED' END, c_mktsegment) AS section FROM customer JOIN nation ON c_nationkey = n_nationkey")
def reclassify_units(spark, sf):
    moves = table(spark, sf, "nation").where("n_regionkey = 1").select(F.col("n_nationkey").alias("unit"), F.lit("MOVED").alias("to_section"))
    rows = table(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").alias("unit"), F.col("c_mktsegment").alias("section"))
    return market.reclassify_units(rows, moves).select("c_custkey", "section")


@query("""
WITH r AS (SELECT p_partkey, CASE WHEN p_partkey % 9 = 0 THEN p_type ELSE (p_partkey % 160)::VARCHAR END AS cell FROM part)
SELECT p_partkey, 'U' || k AS unit, CASE WHEN try_cast(cell AS DOUBLE) IS NULL THEN cell ELSE least(49, greatest(0, cell::BIGINT - 49 * (k - 1)))::BIGINT::VARCHAR END AS cell FROM r, unnest([1, 2, 3]) t(k)
""")
def allocate_units(spark, sf):
    rows = table(spark, sf, "part").select("p_partkey", F.lit("U").alias("unit"), F.when(F.col("p_partkey") % 9 == 0, F.col("p_type")).otherwise((F.col("p_partkey") % 160).cast("string")).alias("cell"))
    return market.allocate_units(rows, 49, 3)


# windows of some days, and of some years for every 50th order
@query("""
WITH w AS (SELECT o_custkey % 500 AS border, o_orderkey AS ord, o_orderdate::DATE AS f, o_orderdate::DATE + (CASE WHEN o_orderkey % 50 = 0 THEN 30 * (o_custkey % 40) ELSE o_custkey % 9 - 1 END)::INT AS t, o_totalprice AS price FROM orders),
d AS (SELECT border, ord, price, unnest(generate_series(f::TIMESTAMP, t::TIMESTAMP, INTERVAL 1 DAY))::DATE AS day FROM w WHERE f <= t),
b AS (SELECT border, day, max(ord) AS ord, arg_max(price, ord) AS price FROM d GROUP BY 1, 2),
g AS (SELECT *, day - row_number() OVER (PARTITION BY border, ord ORDER BY day)::INT AS island FROM b)
SELECT border, min(day)::TIMESTAMP AS from_date, max(day)::TIMESTAMP AS to_date, ord, any_value(price) AS price FROM g GROUP BY border, ord, island
""")
def validity_segments(spark, sf):
    length = F.when(F.col("o_orderkey") % 50 == 0, 30 * (F.col("o_custkey") % 40)).otherwise(F.col("o_custkey") % 9 - 1)
    windows = table(spark, sf, "orders").select(
        (F.col("o_custkey") % 500).alias("border"), F.col("o_orderkey").alias("ord"), F.col("o_orderdate").cast("date").alias("from_date"),
        F.date_add(F.col("o_orderdate").cast("date"), length.cast("int")).alias("to_date"), F.col("o_totalprice").alias("price"),
    )
    return validity.disjoint_segments(windows, ["border"], ["price"]).select("border", day("from_date"), day("to_date"), "ord", "price")


@query(f"""
WITH w AS (SELECT o_custkey % 20 AS border, o_orderkey AS ord, o_orderdate::DATE AS f, o_orderdate::DATE + (o_custkey % 9)::INT AS t, o_totalprice AS base FROM orders),
d AS (SELECT border, ord, base, unnest(generate_series(f::TIMESTAMP, t::TIMESTAMP, INTERVAL 1 DAY))::DATE AS day FROM w),
b AS (SELECT border, day, arg_max(base, ord) AS base FROM d GROUP BY 1, 2)
SELECT border, c.ts, coalesce(base + hour(local_ts), 0) AS value FROM ({CALENDAR_SQL}) c CROSS JOIN (SELECT DISTINCT border FROM w) LEFT JOIN b USING (border) WHERE (b.day = local_ts::DATE)
UNION ALL
SELECT border, c.ts, 0 FROM ({CALENDAR_SQL}) c CROSS JOIN (SELECT DISTINCT border FROM w) x WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.border = x.border AND b.day = c.local_ts::DATE)
""")
def expand_interval_profile(spark, sf):
    windows = table(spark, sf, "orders").select(
        (F.col("o_custkey") % 20).alias("border"), F.col("o_orderkey").alias("ord"), F.col("o_orderdate").cast("date").alias("from_date"),
        F.date_add(F.col("o_orderdate").cast("date"), (F.col("o_custkey") % 9).cast("int")).alias("to_date"),
        F.transform(F.sequence(F.lit(0), F.lit(23)), lambda h: F.col("o_totalprice") + h).alias("profile"),
    )
    return market.expand_interval_profile(windows, day_calendar(spark, sf), ["border"])


@query(f"""
WITH l AS (SELECT o_orderdate::DATE AS date, arg_max(o_totalprice, o_orderkey) FILTER (o_orderpriority LIKE '%HIGH%') AS import, arg_max(o_totalprice, o_orderkey) FILTER (o_orderpriority LIKE '%LOW%') AS export FROM orders WHERE o_orderpriority LIKE '%HIGH%' OR o_orderpriority LIKE '%LOW%' GROUP BY 1)
SELECT period AS date, import, export FROM ({DAYS_SQL}) LEFT JOIN l ON l.date = period::DATE
""")
def directional_capacity(spark, sf):
    files = table(spark, sf, "orders").where("o_orderpriority like '%HIGH%' or o_orderpriority like '%LOW%'").select(
        F.col("o_orderdate").cast("date").alias("date"), F.col("o_orderkey").alias("ord"), F.col("o_totalprice").alias("value"), "o_orderpriority"
    )
    direction = F.when(F.col("o_orderpriority").contains("HIGH"), "import").otherwise("export")
    calendar = days(spark, sf).select(F.col("period").alias("date"))
    return market.directional_capacity(files, calendar, direction).select(day("date"), "import", "export")


def maintenance(spark, sf):
    text = F.concat(
        F.lit("off_"), (F.col("o_custkey") % 30).cast("string"), F.lit(" days_"), F.date_format("o_orderdate", "d/M/yyyy"), F.lit("_to_"),
        F.when(F.col("o_orderkey") % 10 > 0, F.date_format(F.date_add(F.col("o_orderdate").cast("date"), (F.col("o_custkey") % 30).cast("int")), "d/M/yyyy")).otherwise("open"),
    )
    rows = table(spark, sf, "orders").select("o_orderkey", (F.col("o_custkey") % 40).alias("unit"), F.col("o_orderkey").alias("ord"), (F.col("o_custkey") % 90).cast("double").alias("mw"), text.alias("text"))
    return market.maintenance_extract(rows)


MAINTENANCE_SQL = """
SELECT o_orderkey, o_custkey % 40 AS unit, o_orderkey AS ord, (o_custkey % 90)::DOUBLE AS mw, (o_custkey % 30)::INT AS days, o_orderdate::DATE AS start,
       CASE WHEN o_orderkey % 10 > 0 THEN o_orderdate::DATE + (o_custkey % 30)::INT END AS finish FROM orders
"""


@query(f"SELECT o_orderkey, days, start::TIMESTAMP AS start, finish::TIMESTAMP AS finish FROM ({MAINTENANCE_SQL})")
def maintenance_extract(spark, sf):
    return maintenance(spark, sf).select("o_orderkey", "days", day("start"), day("finish"))


@query(f"""
WITH o AS (SELECT unit, ord, mw, unnest(generate_series(start::TIMESTAMP, finish::TIMESTAMP, INTERVAL 1 DAY))::DATE AS day FROM ({MAINTENANCE_SQL}) WHERE days > 0 AND start <= finish),
b AS (SELECT unit, day, arg_max(mw, ord) AS off FROM o GROUP BY 1, 2), u AS (SELECT DISTINCT o_custkey % 40 AS unit FROM orders)
SELECT unit, period AS day, 100 + unit - coalesce(off, 0) AS available FROM u CROSS JOIN ({DAYS_SQL}) p LEFT JOIN b ON b.unit = u.unit AND b.day = p.period::DATE
""".replace("SELECT unit, period AS day, 100 + unit", "SELECT u.unit AS unit, period AS day, 100 + u.unit"))
def maintenance_to_daily(spark, sf):
    units = table(spark, sf, "orders").select((F.col("o_custkey") % 40).alias("unit")).distinct().withColumn("nominal", 100.0 + F.col("unit"))
    calendar = days(spark, sf).select(F.col("period").alias("day"))
    return market.maintenance_to_daily(maintenance(spark, sf), units, calendar).select("unit", day("day"), "available")


STACK_SQL = f"SELECT ts, CASE WHEN property = 'view' THEN 'Total view' ELSE property END AS property, CASE WHEN property = 'error' THEN 0 WHEN value < 5 THEN 0 ELSE round(value) END AS value FROM ({HOURLY_SQL})"


@query(f"""
WITH s AS ({STACK_SQL}), k AS (SELECT ts, property, nullif(value, 0) AS value FROM s WHERE property IN (SELECT property FROM s GROUP BY 1 HAVING sum(value) <> 0) AND lower(property) NOT LIKE '%total%')
SELECT * FROM k UNION ALL SELECT ts, '_TOTAL', coalesce(sum(value), 0) FROM k GROUP BY ts
""")
def stack_frame(spark, sf):
    value = F.when((F.col("property") == "error") | (F.col("value") < 5), 0.0).otherwise(F.round("value"))
    name = F.when(F.col("property") == "view", F.lit("Total view")).otherwise(F.col("property"))
    return market.stack_frame(hourly(spark, sf).select("ts", name.alias("property"), value.alias("value")), ["ts"])


@query(f"""
WITH l AS (SELECT ts, side, quantity, price, key * 100000 + line * 10000 + l_partkey % 10000 AS aa FROM ({TRADES_SQL})), h AS (SELECT ts, row_number() OVER (ORDER BY ts) - 1 AS hour FROM (SELECT DISTINCT ts FROM l))
SELECT ts, side, aa, quantity, price, row_number() OVER (PARTITION BY ts, side ORDER BY CASE WHEN side = 'Sell' THEN quantity ELSE -quantity END, price, aa) - 1 AS ord,
       quantity + hour * (SELECT max(quantity) FROM l) AS x FROM l JOIN h USING (ts)
""")
def curve_frame(spark, sf):
    aa = F.col("key") * 100000 + F.col("line") * 10000 + F.col("l_partkey") % 10000
    return market.curve_frame(trades(spark, sf).select("ts", "side", aa.alias("aa"), "quantity", "price"))
