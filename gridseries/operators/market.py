"""Market and system analytics over long series: trades, offers, curves, plants, capacities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridseries.functions import timeparts as T
from gridseries.operators import lineage, validity
from gridseries.operators.cells import pivot_mean

#: Assets whose net position is generation or load, and the load that is no demand.
GENERATION = ("RES", "Lignite", "Natural Gas", "Big Hydro", "CRETE CONVENTIONAL", "CRETE RENEWABLES")
LOAD = ("HV", "MV", "LV", "LOSSES", "PUMP", "CRETE LOAD")
NO_DEMAND = ("PUMP",)


def side_split(trades: DataFrame, index: list[str], key: str, keys: list[str], payload: str, side: str = "side", sides: tuple[str, str] = ("Buy", "Sell")) -> dict[str, DataFrame]:
    """Wide mean tables of the two sides. Raises if a side has no trade at all."""
    there = trades.agg(*[F.coalesce(F.bool_or(F.col(side) == s), F.lit(False)).alias(s) for s in sides]).first()
    if not all(there[s] for s in sides):
        raise ValueError(f"trades of one side only: {there.asDict()}")
    return {s: pivot_mean(trades.where(F.col(side) == s), index, key, keys, payload) for s in sides}


def _reversed(border: Column) -> Column:
    return F.array_join(F.reverse(F.split(border, "-")), "-")


def net_positions(
    trades: DataFrame, index: list[str], generation=GENERATION, load=LOAD, no_demand=NO_DEMAND, zone: str = "GR", asset: str = "asset", side: str = "side", value: str = "value"
) -> DataFrame:
    """``asset, value`` of every asset, border and total: generation sells minus buys, load buys minus
    sells, borders exports (bought ``zone-X``) minus imports (sold ``X-zone``, named the other way).

    ``trades`` has one mean per index, side and asset. A side that is absent counts as 0; a border
    with one direction only is null, as its net is not known. Totals skip nulls.
    """
    name, amount = F.col(asset), F.col(value)
    sell = F.col(side) == "Sell"
    kind = (
        F.when(name.isin(*generation), "generation").when(name.isin(*load), "load")
        .when(sell & name.endswith(f"-{zone}"), "border").when(~sell & name.startswith(zone), "border")
    )
    signed = F.when((kind == "generation") == sell, amount).otherwise(-amount)
    named = trades.select(*index, F.when((kind == "border") & sell, _reversed(name)).otherwise(name).alias("asset"), kind.alias("kind"), sell.alias("sell"), signed.alias("signed"))
    named = named.where("kind is not null")
    whole = (F.col("kind") != "border") | ((F.bool_or("sell")) & (F.bool_or(~F.col("sell"))))
    net = named.groupBy(*index, "kind", "asset").agg(F.sum("signed").alias("net"), whole.alias("whole"))
    net = net.withColumn("value", F.when(F.col("whole"), F.col("net")))
    total = net.groupBy(*index).agg(
        *[F.coalesce(F.sum(F.when(c, F.col("value"))), F.lit(0.0)).alias(n) for n, c in (
            ("Demand", (F.col("kind") == "load") & ~F.col("asset").isin(*no_demand)), ("Generation", F.col("kind") == "generation"), ("NetMarketSchedule", F.col("kind") == "border"))]
    ).unpivot(index, ["Demand", "Generation", "NetMarketSchedule"], "asset", "value")
    return net.select(*index, "asset", "value").unionByName(total)


def trade_stats(trades: DataFrame, index: list[str], price: str = "price", quantity: str = "quantity") -> DataFrame:
    """VWAP, lowest and highest price, and traded quantity of each group of a continuous market."""
    value = F.try_divide(F.sum(F.col(price) * F.col(quantity)), F.sum(quantity))
    return trades.groupBy(*index).agg(value.alias("vwap"), F.min(price).alias("min_price"), F.max(price).alias("max_price"), F.sum(quantity).alias("total_trades"))


def order_tables(orders: DataFrame, index: list[str], key: str, keys: list[str], payloads: list[str], least: int | None = None) -> DataFrame:
    """Wide means of several payloads (``<key>_<payload>``); rows with fewer than ``least`` values go."""
    wide = orders.groupBy(*index).pivot(key, keys).agg(*[F.avg(p).alias(p) for p in payloads])
    if len(payloads) == 1:
        wide = wide.withColumnsRenamed({k: f"{k}_{payloads[0]}" for k in keys})
    return wide if least is None else wide.dropna(thresh=least, subset=[c for c in wide.columns if c not in index])


def coupling(zones: DataFrame, borders: DataFrame, index: list[str], zone_names: list[str], border_names: list[str]) -> tuple[DataFrame, DataFrame]:
    """(net position by bidding zone, flow by interconnector), wide."""
    return pivot_mean(zones, index, "zone", zone_names, "net_position"), pivot_mean(borders, index, "border", border_names, "flow")


def supply_curves(steps: DataFrame, period: str = "period", tz: str = "EET", resolution_min: int = 60) -> DataFrame:
    """Ladder ``ts, aa, side, quantity, price`` of the aggregated curves of a local day.

    The hours of a day (``mtu``) are ranked and take the instants from local midnight on.
    """
    means = steps.groupBy(period, "mtu", "aa", "side").agg(F.avg("quantity").alias("quantity"), F.avg("price").alias("price"))
    rank = F.dense_rank().over(Window.partitionBy(period).orderBy("mtu")) - 1
    start = T.local_to_utc(F.col(period).cast(T.NTZ), tz)
    return means.select(period, T.from_seconds(T.seconds(start) + rank * resolution_min * 60).alias("ts"), "aa", "side", "quantity", "price")


def bid_ladder(offers: DataFrame, keys: list[str], order: list[str], direction: str = "direction") -> DataFrame:
    """Offers with ``step`` 0, 1, ... of each direction and period; ``Dn`` is written ``Down``."""
    named = offers.withColumn(direction, F.when(F.col(direction) == "Dn", "Down").otherwise(F.col(direction)))
    return named.withColumn("step", F.row_number().over(Window.partitionBy(*keys, direction).orderBy(*order)) - 1)


def offers_by_service(offers: DataFrame, keys: list[str], order: list[str], service: str = "service", services: tuple[str, ...] = ("FCR", "aFRR", "mFRR")) -> dict[str, DataFrame]:
    """Ladders of every service."""
    laddered = bid_ladder(offers, [*keys, service], order)
    return {s: laddered.where(F.col(service) == s) for s in services}


def market_schedule(schedule: DataFrame, activation: DataFrame, keys: list[str]) -> DataFrame:
    """Market schedule: scheduled minus activated energy of a unit; null if either is missing."""
    a = schedule.select(*keys, F.col("value").alias("scheduled"))
    b = activation.select(*keys, F.col("value").alias("activated"))
    return a.join(b, keys, "full_outer").withColumn("value", F.col("scheduled") - F.col("activated"))


#: A unit is a plant's name, the last ``_GT`` or ``_ST`` and its number, if any.
PLANT_UNIT = r"^(.+)_(GT|ST)\d*$"


def plant_totals(series: DataFrame, index: list[str], families: tuple[str, ...] = (), into: str = "Thermal") -> tuple[DataFrame, DataFrame]:
    """(series with units summed into their plant, units alone). With ``families`` (values of
    ``section``) these sections are one, ``into``, afterwards."""
    plant = F.regexp_extract("property", PLANT_UNIT, 1)
    units = series.where(plant != "")
    total = series.withColumn("property", F.when(plant != "", plant).otherwise(F.col("property")))
    if families:
        total = total.withColumn("section", F.when(F.col("section").isin(*families), F.lit(into)).otherwise(F.col("section")))
    keys = [*index, *(["section"] if families else []), "property"]
    return total.groupBy(*keys).agg(F.sum("value").alias("value"), *lineage.gathered(total)), units


def plant_modes(series: DataFrame, index: list[str]) -> DataFrame:
    """``plant, mode`` of each plant: number of gas turbines that run and the steam turbine, such as
    ``2GT+ST``, ``1GT``, ``ST``, or empty."""
    plant, kind = F.regexp_extract("property", PLANT_UNIT, 1), F.regexp_extract("property", PLANT_UNIT, 2)
    on = F.coalesce(F.col("value") != 0, F.lit(False))
    found = series.where(plant != "").groupBy(*index, plant.alias("plant")).agg(F.count_if(on & (kind == "GT")).alias("gt"), F.coalesce(F.bool_or(on & (kind == "ST")), F.lit(False)).alias("st"))
    mode = F.concat_ws("+", F.when(F.col("gt") > 0, F.concat(F.col("gt").cast("string"), F.lit("GT"))), F.when(F.col("st"), "ST"))
    return found.select(*index, "plant", mode.alias("mode"))


def mode_pairs(series: DataFrame, index: list[str]) -> DataFrame:
    """``plant, mode, mw`` from ``plant_GT, plant_ST`` texts and ``plant_MW``: mode is ``GT+ST``."""
    plant, part = F.regexp_extract("property", "^(.*)_(GT|ST|MW)$", 1), F.regexp_extract("property", "^(.*)_(GT|ST|MW)$", 2)
    pick = lambda k: F.max(F.when(part == k, F.col("cell")))
    return series.where(part != "").groupBy(*index, plant.alias("plant")).agg(
        F.concat(pick("GT"), F.lit("+"), pick("ST")).alias("mode"), pick("MW").try_cast("double").alias("mw")
    )


def availability_split(rows: DataFrame, kinds: tuple[str, ...] = ("Actual", "Forecast", "Reason"), run_col: str | None = None) -> DataFrame:
    """Rows of three-row sections as ``kind``: actual values belong to the day before, but for the third
    intraday run."""
    kind = F.element_at(F.array(*map(F.lit, kinds)), (F.col("row") % len(kinds) + 1).cast("int"))
    back = kind == kinds[0]
    if run_col is not None:
        back = back & (F.col(run_col) != 3)
    return rows.withColumn("kind", kind).withColumn("date", F.when(back, F.date_sub("date", 1)).otherwise(F.col("date")))


def reclassify_units(rows: DataFrame, moves: DataFrame) -> DataFrame:
    """Units (``unit``) listed in ``moves`` (``unit, to_section``) take that section."""
    one = moves.groupBy("unit").agg(F.min("to_section").alias("__to"))
    return rows.join(one, "unit", "left").withColumn("section", F.coalesce("__to", "section")).drop("__to")


def allocate_units(rows: DataFrame, capacity: float, n: int, unit: str = "unit", cell: str = "cell") -> DataFrame:
    """``unit1..unitN, cell``: a total split over equal units in merit order (full, rest, zero), in
    whole numbers; a text is copied to every unit."""
    k = F.col("__k")
    total = F.col(cell).try_cast("double")
    share = F.least(F.lit(capacity), F.greatest(F.lit(0.0), F.floor(total) - capacity * (k - 1)))
    value = F.when(total.isNull(), F.col(cell)).otherwise(share.cast("long").cast("string"))
    return rows.withColumn("__k", F.explode(F.sequence(F.lit(1), F.lit(n)))).withColumn(cell, value).withColumn(unit, F.concat(unit, k.cast("string"))).drop("__k")


def expand_interval_profile(windows: DataFrame, calendar: DataFrame, keys: list[str], default: float = 0.0) -> DataFrame:
    """Continuous hourly series from validity windows (``from_date, to_date``) with a profile of 24 hours.

    ``calendar`` has ``ts`` and ``local_ts``; the hour of the wall clock picks the value, so days of 23
    or 25 hours need no patch. Of overlapping windows the last (``ord``) wins; hours outside all
    windows hold ``default``. Windows are not opened to days (see :mod:`gridseries.operators.validity`).
    """
    slots = calendar.withColumn("day", F.col("local_ts").cast("date")).withColumn("hour", F.hour("local_ts"))
    every = windows.select(*keys).distinct()
    days = slots.select("day").distinct()
    best = validity.holding(windows, days.crossJoin(every) if keys else days, keys, ["profile"]).drop("ord")
    grid = slots.crossJoin(every) if keys else slots  # hours times borders, both from configuration: the result's own size
    return grid.join(best, [*keys, "day"], "left").select(*keys, "ts", F.coalesce(F.try_element_at("profile", F.col("hour") + 1), F.lit(default)).alias("value"))


def directional_capacity(files: DataFrame, calendar: DataFrame, direction: Column, keys: tuple[str, ...] = ("date",)) -> DataFrame:
    """Import and export capacity of each date from the last file of each direction; dates without are null.

    ``files`` has ``date, ord, value``; ``direction`` says ``import`` or ``export`` (by description).
    """
    last = files.withColumn("direction", direction).groupBy(*keys).agg(
        *[F.max_by(F.when(F.col("direction") == d, F.col("value")), F.when(F.col("direction") == d, F.col("ord"))).alias(d) for d in ("import", "export")]
    )
    return calendar.join(last, list(keys), "left")


def maintenance_extract(rows: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``days`` (first number before a blank), ``start`` and ``finish`` (``d/m/y`` dates; finish
    only where there are exactly two)."""
    dates = F.regexp_extract_all(text, F.lit(r"(\d+/\d+/\d+)"))
    parse = lambda k: F.try_to_date(F.try_element_at(dates, F.lit(k)), "d/M/yyyy")
    return rows.withColumns(
        {
            "days": F.regexp_extract(text, r"(\d+) ", 1).try_cast("int"),
            "start": parse(1),
            "finish": F.when(F.size(dates) == 2, parse(2)),
        }
    )


def maintenance_to_daily(intervals: DataFrame, units: DataFrame, calendar: DataFrame) -> DataFrame:
    """``unit, day, available``: nominal capacity, less what is off in the last interval of the day.

    Intervals of no days or without a finish are ignored; they are not opened to days (see
    :mod:`gridseries.operators.validity`).
    """
    windows = intervals.where("days > 0").withColumnsRenamed({"start": "from_date", "finish": "to_date"})
    grid = units.crossJoin(calendar).withColumn("day", F.col("day").cast("date"))  # units times days: the result's own size
    off = validity.holding(windows, grid, ["unit"], ["mw"]).select("unit", "day", F.col("mw").alias("off"))
    return grid.join(off, ["unit", "day"], "left").select("unit", "day", (F.col("nominal") - F.coalesce("off", F.lit(0.0))).alias("available"))


def stack_frame(series: DataFrame, index: list[str]) -> DataFrame:
    """Series behind a stacked chart: without properties that sum to zero or hold "total"; zeros are
    null; ``_TOTAL`` is the sum per index."""
    live = series.groupBy("property").agg(F.sum("value").alias("__s")).where("__s <> 0").drop("__s")
    kept = series.join(live, "property", "left_semi").where(~F.lower("property").contains("total"))
    kept = kept.select(*index, "property", F.nullif(F.col("value"), F.lit(0.0)).alias("value"))
    total = kept.groupBy(*index).agg(F.coalesce(F.sum("value"), F.lit(0.0)).alias("value")).withColumn("property", F.lit("_TOTAL"))
    return kept.unionByName(total.select(*index, "property", "value"))


def curve_frame(ladder: DataFrame, period: str = "ts") -> DataFrame:
    """Ladder with ``x``: sells by rising, buys by falling quantity, moved by the hour's number times
    the greatest quantity; ``ord`` is the place in a curve."""
    # one number per period: the ranks are over periods, not over steps
    hours = ladder.select(period).distinct().withColumn("hour", F.row_number().over(Window.orderBy(period)) - 1)
    widest = ladder.agg(F.max("quantity").alias("widest"))
    sells = F.col("side") == "Sell"
    placed = ladder.withColumn("ord", F.row_number().over(Window.partitionBy(period, "side").orderBy(F.when(sells, F.col("quantity")).otherwise(-F.col("quantity")), "price", "aa")) - 1)
    return placed.join(hours, period).crossJoin(F.broadcast(widest)).withColumn("x", F.col("quantity") + F.col("hour") * F.col("widest")).drop("widest", "hour")
