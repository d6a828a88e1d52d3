"""Report families as data: which operators, in which order, make series of their raw sheets.

A recipe is a list of steps over a cell grid (or a long frame); :func:`run` applies them to all files of
a report at once, so one job covers every date.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridseries.functions import textparts as X
from gridseries.functions import timeparts as T
from gridseries.operators import cells, lake, market

Step = Callable[[DataFrame], DataFrame]


def sections(cues: list[cells.Cue], indicator_col: int = 0) -> Step:
    """Keeps the rows of the cue sections and names their section."""

    def step(grid: DataFrame) -> DataFrame:
        rows = grid.where(F.col("col") == indicator_col).select("file", "row", F.col("cell").alias("indicator"))
        placed = cells.split_sections(rows, cues).select("file", "row", "section")
        return grid.join(placed, ["file", "row"])

    return step


def transposed(skip: int = 1) -> Step:
    """Rows become properties and columns positions; a section, if there is one, stays."""

    def step(grid: DataFrame) -> DataFrame:
        long = cells.transpose_sheet(grid, skip)
        if "section" not in grid.columns:
            return long
        return long.join(grid.select("file", "row", "section").distinct(), ["file", "row"])

    return step


def dated(calendar: DataFrame, periods: DataFrame, secondary: DataFrame | None = None) -> Step:
    """Positions become instants: ``periods`` (``file, period``) says which day a file covers."""

    def step(long: DataFrame) -> DataFrame:
        keyed = long.join(periods, "file")
        return cells.assign_calendar(keyed, calendar, ("period",), secondary=secondary)

    return step


def run(frame: DataFrame, steps: list[Step]) -> DataFrame:
    for step in steps:
        frame = frame.transform(step)
    return frame


def numbers(keys: tuple[str, ...] = ("file",)) -> Step:
    return partial(cells.to_double_fill0, keys=keys)


def schedule(cues: list[cells.Cue], calendar: DataFrame, periods: DataFrame, secondary: DataFrame | None = None) -> list[Step]:
    """Scheduling results: total column and beyond cut off, sections, units over time."""
    return [
        partial(cells.truncate_at_trigger, trigger="^TOTAL", drop_last=True), partial(cells.drop_sparse, axis="columns"), sections(cues), transposed(),
        numbers(("file", "section")), dated(calendar, periods, secondary),
    ]


def forecast(calendar: DataFrame, periods: DataFrame) -> list[Step]:
    """Load and renewable forecasts: empty columns dropped, one property per row."""
    return [partial(cells.drop_sparse, axis="columns"), transposed(), numbers(), dated(calendar, periods)]


def adhoc_schedule(cues: list[cells.Cue], calendar: DataFrame, periods: DataFrame, stamp: str = "d/M/yyyy H:mm:ss") -> list[Step]:
    """Scheduling results of runs within a day: the stamp in the second cell of a sheet's first row says where in the
    day's calendar its columns begin. A sheet without a stamp gives no rows."""

    def step(grid: DataFrame) -> DataFrame:
        heads = grid.where("row = 0 and col = 1").select("file", F.try_to_timestamp("cell", F.lit(stamp)).cast(T.NTZ).alias("header_ts"))
        own = calendar.drop("pos").join(periods.select("file", "period"), "period")
        rest = cells.partial_day_align(own, heads, ("file",))
        long = run(grid, schedule(cues, calendar, periods)[:-1])
        return cells.assign_calendar(long, rest, ("file",))

    return [step]


def reservoirs(calendar: DataFrame, periods: DataFrame, properties: list[str] | None = None) -> list[Step]:
    """Filling rates. With ``properties`` a sheet without any value gives these, null, over its whole period."""

    def filled(long: DataFrame) -> DataFrame:
        own = calendar.join(periods.select("file", "period"), "period")
        full = cells.fill_empty_frame(long, own, properties, float("nan"), ("file", "period"))
        return full.withColumn("value", F.nullif(F.col("value"), F.lit(float("nan"))))

    steps = [partial(cells.drop_sparse, axis="columns", least=5), transposed(), numbers(), dated(calendar, periods)]
    return [*steps, filled] if properties else steps


def requirements(cues: list[cells.Cue], calendar: DataFrame, periods: DataFrame, trigger: str = "23:30") -> list[Step]:
    """System requirements: columns up to the last half hour; names stand in the second column, beside the indicator."""
    return [partial(cells.truncate_at_trigger, trigger=trigger), sections(cues), transposed(2), numbers(("file", "section")), dated(calendar, periods)]


def nominations(calendar: DataFrame, periods: DataFrame, total: str = "Sum") -> list[Step]:
    """Nominated long-term rights, without the row of their sum."""
    return [partial(cells.drop_sparse, axis="columns"), transposed(), partial(cells.drop_columns_if, names=[total]), numbers(), dated(calendar, periods)]


def real_time(calendar: DataFrame, periods: DataFrame, names: list[str], least: int = 5) -> list[Step]:
    """Real-time load and renewables: always 25 columns, of which those beyond the day's hours go. Where a sheet has
    several rows of values besides the dates, they are named by their place."""

    def named(long: DataFrame) -> DataFrame:
        place = F.dense_rank().over(Window.partitionBy("file").orderBy("row"))
        several = F.min("row").over(Window.partitionBy("file")) < F.max("row").over(Window.partitionBy("file"))
        given = F.try_element_at(F.array(*map(F.lit, names)), place)
        return long.withColumn("property", F.when(several, F.coalesce(given, "property")).otherwise(F.col("property")))

    return [partial(cells.drop_sparse, axis="rows", least=least), transposed(), partial(cells.drop_columns_if, names=["Date"]), named, numbers(), dated(calendar, periods)]


def realization(
    replacements: list[tuple[str, str]], cues: list[cells.Cue], calendar: DataFrame, periods: DataFrame, names: dict[str, str] | None = None, modes: bool = False
) -> list[Step]:
    """Metered system realization: repaired cells, sections, plants summed from their units, ASCII names.

    ``names`` renames units first, such as one whose gas turbine bears the plant's name alone. With
    ``modes`` the result is the mode of each plant instead.
    """

    def plants(long: DataFrame) -> DataFrame:
        named = cells.rename_properties(long.withColumn("property", X.transliterate(F.col("property"))), names or {})
        if modes:
            return market.plant_modes(named, ["period", "ts"])
        return market.plant_totals(named, ["period", "ts"], ("Lignite", "Gas", "Oil"))[0]

    return [partial(cells.replace_values, patterns=replacements), sections(cues), transposed(), numbers(("file", "section")), dated(calendar, periods), plants]


def market_balance(scheduled: str, activated: str, keys: tuple[str, ...] = ("period", "ts", "property")) -> list[Step]:
    """After :func:`schedule`: the market schedule of a unit from two sections."""

    def step(series: DataFrame) -> DataFrame:
        pick = lambda name: series.where(F.col("section") == name)
        return market.market_schedule(pick(scheduled), pick(activated), list(keys))

    return [step]


def unit_modes(section: str, index: tuple[str, ...] = ("period", "ts")) -> list[Step]:
    """After :func:`schedule`: mode and energy of the plants that one section holds."""
    return [lambda series: market.mode_pairs(series.where(F.col("section") == section), list(index))]


def unit_availabilities(
    cues: list[cells.Cue], periods: DataFrame, moves: DataFrame, shared: tuple[str, float, int], section: str = "Thermal", irregular: str = "_GT|_ST|_O", run_col: str | None = None
) -> list[Step]:
    """Availability of units: ``date, section, kind, unit, cell`` of sheets with one column for each kind.

    ``periods`` has ``file, date``, ``moves`` the units that stand in a wrong section. Of ``section``
    the units that match ``irregular`` go, as their plants are there too, and the total of ``shared``
    (name, capacity of a unit, number of units) is split.
    """
    name, capacity, n = shared

    def kinds(long: DataFrame) -> DataFrame:
        rows = long.drop("row").withColumnsRenamed({"property": "unit", "pos": "row"}).join(periods, "file")
        return market.availability_split(market.reclassify_units(rows, moves), run_col=run_col)

    def units(rows: DataFrame) -> DataFrame:
        own = rows.where(F.col("section") == section).withColumnRenamed("unit", "property")
        own = cells.drop_columns_if(own, patterns=[irregular]).withColumnRenamed("property", "unit")
        split = market.allocate_units(own.where(F.col("unit") == name), capacity, n)
        return rows.where(F.col("section") != section).unionByName(own.where(F.col("unit") != name)).unionByName(split)

    return [sections(cues), transposed(), kinds, units]


def day_ahead_schedule(cues: list[cells.Cue], calendar: DataFrame, periods: DataFrame, reserves: tuple[str, ...] = (), suffixes: tuple[str, ...] = ("_Up", "_Down"), trigger: str = "^25$") -> list[Step]:
    """Day-ahead scheduling: columns up to the last hour. In the ``reserves`` sections a blank name takes
    the one before it, names take their suffix in turn, and the first position is no hour."""

    def named(long: DataFrame) -> DataFrame:
        if not reserves:
            return long
        held = F.col("section").isin(*reserves)
        header = long.where(held).select("file", "section", F.col("row").alias("col"), F.col("property").alias("cell")).distinct()
        names = cells.fill_header_names(header, list(suffixes), ("file", "section")).select("file", "section", F.col("col").alias("row"), "name")
        moved = long.where(held & (F.col("pos") > 0)).join(names, ["file", "section", "row"])
        moved = moved.withColumns({"property": F.col("name"), "pos": F.col("pos") - 1}).drop("name")
        return long.where(~held).unionByName(moved)

    return [partial(cells.truncate_at_trigger, trigger=trigger), sections(cues), transposed(), named, numbers(("file", "section")), dated(calendar, periods)]


def results_summary(cues: list[cells.Cue], calendar: DataFrame, periods: DataFrame) -> list[Step]:
    """Market summaries: sections, transposed, columns of text dropped."""
    return [partial(cells.drop_sparse, axis="columns"), sections(cues), transposed(), partial(cells.drop_columns_if, text_valued=True), numbers(("file", "section")), dated(calendar, periods)]


def both_sides(by: list[str], side: str = "side", sides: tuple[str, str] = ("Buy", "Sell")) -> Step:
    """Trades of the groups (files) in which both sides trade; a group with one side only is no result and goes."""

    def step(trades: DataFrame) -> DataFrame:
        seen = trades.groupBy(*by).agg(*[F.max(F.col(side) == s).alias(s) for s in sides])
        return trades.join(seen.where(" and ".join(f"`{s}`" for s in sides)).select(*by), by, "left_semi")

    return step


def market_results(where: str = "classification", among: tuple[str, ...] = ("Imports", "Exports"), by: list[str] | None = None) -> list[Step]:
    """Trades (``ts, side, asset, classification, value``) to net positions: cross-border trades are named by
    their asset, the others by class; one mean per side and name. ``by`` names the columns of the file, if files
    of one side are to be left out."""

    def name(trades: DataFrame) -> DataFrame:
        return cells.swap_values(trades, where, list(among), "classification", "asset")

    def means(trades: DataFrame) -> DataFrame:
        return trades.groupBy("ts", "side", F.col("classification").alias("asset")).agg(F.avg("value").alias("value"))

    return [*([both_sides(by)] if by else []), name, means, partial(market.net_positions, index=["ts"])]


def metered(pattern: str = "kWh") -> list[Step]:
    """Wide metering tables in long form: footers dropped, energy in MWh."""
    return [partial(cells.scale_units, pattern=pattern, row_keys=["file", "ts"])]


def balancing(least: int = 3) -> list[Step]:
    """Balancing sheets: header found below blank rows, fractions written out evaluated."""
    return [partial(cells.promote_header, least=least), lambda g: g.withColumn("cell", X.eval_fraction(F.col("cell")))]


def continuous_trades(index: list[str]) -> list[Step]:
    """Continuous intraday market: prices and quantities of each period and zone."""
    return [partial(market.trade_stats, index=index)]


def orders(index: list[str], key: str, keys: list[str], payloads: list[str], least: int | None = None) -> list[Step]:
    """Deliveries, block orders and gas: one column for each key and payload."""
    return [partial(market.order_tables, index=index, key=key, keys=keys, payloads=payloads, least=least)]


def curves(period: str = "period", tz: str = "EET", resolution_min: int = 60) -> list[Step]:
    """Aggregated demand and supply curves as a ladder."""
    return [partial(market.supply_curves, period=period, tz=tz, resolution_min=resolution_min)]


def offers(keys: list[str], order: list[str], service: str | None = None) -> list[Step]:
    """Energy and capacity offers as ladders, those of every ``service`` on their own."""
    return [partial(market.bid_ladder, keys=[*keys, *([service] if service else [])], order=order)]


def coupling(key: str, names: list[str], payload: str, index: list[str]) -> list[Step]:
    """Market coupling: net position by zone, or flow by border, in columns."""
    return [partial(cells.pivot_mean, index=index, key=key, values=names, payload=payload)]


def monthly_capacity(calendar: DataFrame, keys: list[str]) -> list[Step]:
    """Net transfer capacities: windows with a profile of a day, as continuous hours."""
    return [partial(market.expand_interval_profile, calendar=calendar, keys=keys)]


def available_capacity(calendar: DataFrame, direction: Column, keys: tuple[str, ...] = ("date",)) -> list[Step]:
    """Available transfer capacities by direction on the dates of the calendar."""
    return [partial(market.directional_capacity, calendar=calendar, direction=direction, keys=keys)]


def stamped(stamp: Column, skip: int = 0) -> list[Step]:
    """Sheets that bring their own stamps."""
    return [partial(cells.series_with_index, stamp=stamp, skip=skip)]


def maintenance(files: DataFrame, units: DataFrame, calendar: DataFrame) -> list[Step]:
    """Maintenance programmes (``file_name, unit, ord, mw, text``): of every year the last file of
    ``files`` (``file_name, date``), intervals of its texts, available capacity by day."""

    def last(rows: DataFrame) -> DataFrame:
        return rows.join(lake.latest_per_year(files).select("file_name"), "file_name", "left_semi")

    return [last, market.maintenance_extract, partial(market.maintenance_to_daily, units=units, calendar=calendar)]
