"""From sheets to series: cleaning and reshaping of cell grids.

A cell grid is long: one row per cell with the keys of its sheet, ``row``, ``col`` and ``cell``. A
long series has ``property``, a position or stamp, and a value. Both stay long; a wide view is made
at the edge by :func:`pivot_mean` or :func:`collapse_levels` with the columns named.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridseries.functions import textparts as X
from gridseries.operators import lineage

SHEET = ("file",)


def replace_values(cells: DataFrame, whole: DataFrame | None = None, patterns: list[tuple[str, str]] = (), col: str = "cell") -> DataFrame:
    """Cells replaced entire by a map (``raw, conformed``), then by patterns in order."""
    if whole is not None:
        one = whole.groupBy(F.col("raw").alias(col)).agg(F.min("conformed").alias("__to"))
        cells = cells.join(one, col, "left").withColumn(col, F.coalesce("__to", col)).drop("__to")
    value = F.col(col)
    for pattern, replacement in patterns:
        value = F.regexp_replace(value, pattern, replacement)
    return cells.withColumn(col, value)


def rename_properties(series: DataFrame, names: dict[str, str], snake: bool = False, section_col: str | None = None, keys: tuple[str, ...] = ()) -> DataFrame:
    """Property names mapped (absent ones ignored), in snake case if asked; the only property of a
    section takes the section's name."""
    mapped = F.col("property")
    if names:
        mapped = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for p in names.items() for x in p]), mapped), mapped)
    series = series.withColumn("property", X.snake_case(mapped) if snake else mapped)
    if section_col is None:
        return series
    group = Window.partitionBy(*keys, section_col)
    alone = F.min("property").over(group).eqNullSafe(F.max("property").over(group))
    return series.withColumn("property", F.when(alone, F.col(section_col)).otherwise(F.col("property")))


def drop_sparse(cells: DataFrame, axis: str = "rows", least: int = 1, sheet: tuple[str, ...] = SHEET) -> DataFrame:
    """Cells of the rows (or columns) of a sheet that hold at least ``least`` values.

    Counted by a window, so cells are shuffled once at most, and not at all where they are dealt by sheet already.
    """
    line = [*sheet, "row" if axis == "rows" else "col"]
    named = cells.where(" and ".join(f"`{c}` is not null" for c in line))
    return named.withColumn("__n", F.count("cell").over(Window.partitionBy(*line))).where(F.col("__n") >= least).drop("__n")


def drop_columns_if(
    series: DataFrame, names: list[str] = (), prefixes: list[str] = (), patterns: list[str] = (), null_named: bool = True,
    text_valued: bool = False, keys: tuple[str, ...] = SHEET,
) -> DataFrame:
    """Series without the properties that are named, prefixed, matched, nameless or not numeric."""
    drop = F.lit(False)
    if names:
        drop = drop | F.col("property").isin(list(names))
    for prefix in prefixes:
        drop = drop | F.col("property").startswith(prefix)
    for pattern in patterns:
        drop = drop | F.col("property").rlike(pattern)
    drop = F.coalesce(drop, F.lit(False)) | (F.col("property").isNull() if null_named else F.lit(False))
    kept = series.where(~drop)
    if text_valued:
        texts = kept.groupBy(*keys, "property").agg(F.count_if(F.col("cell").isNotNull() & X.number(F.col("cell")).isNull()).alias("__n"))
        kept = kept.join(texts.where("__n > 0").drop("__n"), [*keys, "property"], "left_anti")
    return kept


def truncate_at_trigger(cells: DataFrame, trigger: str, guide_row: int = 0, drop_last: bool = False, sheet: tuple[str, ...] = SHEET) -> DataFrame:
    """Columns up to the last cell of the guide row that matches; a sheet without one stays whole."""
    hit = cells.where((F.col("row") == guide_row) & F.col("cell").rlike(trigger)).groupBy(*sheet).agg(F.max("col").alias("__last"))
    inside = F.col("col") < F.col("__last") if drop_last else F.col("col") <= F.col("__last")
    return cells.join(hit, list(sheet), "left").where(F.col("__last").isNull() | inside).drop("__last")


def promote_header(cells: DataFrame, least: int = 2, sheet: tuple[str, ...] = SHEET) -> DataFrame:
    """Rows with fewer than ``least`` values go; the first left names the columns of the rest (``property``)."""
    marked = drop_sparse(cells, "rows", least, sheet).withColumn("__head", F.min("row").over(Window.partitionBy(*sheet)))
    name = F.max(F.when(F.col("row") == F.col("__head"), F.col("cell"))).over(Window.partitionBy(*sheet, "col"))
    return marked.withColumn("property", name).where("row > __head").drop("__head")


@dataclass(frozen=True)
class Cue:
    """A section between two cue texts of the indicator column.

    ``start`` None is the first row; ``end`` None is the first empty indicator (else the last row),
    ``last`` is the last row.
    """

    name: str
    start: str | None
    end: str | None
    start_included: bool = True
    end_included: bool = True


def section_bounds(rows: DataFrame, cues: list[Cue], sheet: tuple[str, ...] = SHEET, whole_name: str = "sheet") -> DataFrame:
    """``section, ord, from_row, to_row`` of each sheet (null bounds: the section is empty).

    Cues apply in order and consume: each searches the rows after the end of the one before; a cue
    that is not found consumes nothing. A sheet of one row is one section, ``whole_name``. ``rows`` has
    ``row`` and ``indicator``; only these two of one sheet are gathered.
    """
    texts = "name string, start string, end string, start_included boolean, end_included boolean"
    given = F.array(*[F.struct(*[F.lit(getattr(c, n.split()[0])).cast(n.split()[1]).alias(n.split()[0]) for n in texts.split(", ")]) for c in cues])
    sheets = rows.groupBy(*sheet).agg(F.array_sort(F.collect_list(F.struct(F.col("row").cast("long").alias("row"), "indicator"))).alias("__rows"))
    long_null = F.lit(None).cast("long")

    def step(state: Column, cue: Column) -> Column:
        left = F.filter(F.col("__rows"), lambda x: x["row"] >= state["low"])
        numbers = F.transform(left, lambda x: x["row"])
        first_of = lambda text: F.array_min(F.transform(F.filter(left, lambda x: x["indicator"].eqNullSafe(text)), lambda x: x["row"]))
        start = F.when(cue["start"].isNull(), F.array_min(numbers)).otherwise(first_of(cue["start"]))
        end = (
            F.when(cue["end"] == "last", F.array_max(numbers))
            .when(cue["end"].isNull(), F.coalesce(first_of(F.lit(None).cast("string")), F.array_max(numbers)))
            .otherwise(first_of(cue["end"]))
        )
        found = start.isNotNull() & end.isNotNull()
        bound = F.struct(
            cue["name"].alias("section"),
            F.when(found, start + F.when(cue["start_included"], 0).otherwise(1)).alias("from_row"),
            F.when(found, end - F.when(cue["end_included"], 0).otherwise(1)).alias("to_row"),
        )
        low = F.when(found, end + F.when(cue["end_included"], 1).otherwise(0)).otherwise(state["low"])
        return F.struct(low.alias("low"), F.concat(state["bounds"], F.array(bound)).alias("bounds"))

    none = F.array().cast("array<struct<section:string,from_row:bigint,to_row:bigint>>")
    start = F.struct(F.lit(-(2**62)).cast("long").alias("low"), none.alias("bounds"))
    whole = F.array(F.struct(F.lit(whole_name).alias("section"), F.col("__rows")[0]["row"].alias("from_row"), F.col("__rows")[0]["row"].alias("to_row")))
    bounds = F.when(F.size("__rows") == 1, whole).otherwise(F.aggregate(given, start, step)["bounds"])
    out = sheets.select(*sheet, F.posexplode(bounds).alias("ord", "b")).select(*sheet, "ord", "b.*")
    return out.withColumn("from_row", F.coalesce("from_row", long_null))


def split_sections(rows: DataFrame, cues: list[Cue], sheet: tuple[str, ...] = SHEET, whole_name: str = "sheet") -> DataFrame:
    """Rows with the ``section`` they belong to; rows outside all sections go. See :func:`section_bounds`."""
    bounds = section_bounds(rows, cues, sheet, whole_name).where("from_row <= to_row")
    return rows.join(bounds, list(sheet)).where("row between from_row and to_row").drop("ord", "from_row", "to_row")


def transpose_sheet(cells: DataFrame, skip: int = 1, sheet: tuple[str, ...] = SHEET) -> DataFrame:
    """Rows become properties, named by their indicator (the cell of the last skipped column), and the
    columns after it positions ``pos`` 0, 1, ..."""
    name = cells.where(F.col("col") == max(skip - 1, 0)).select(*sheet, "row", F.col("cell").alias("property"))
    return cells.where(F.col("col") >= skip).join(name, [*sheet, "row"]).select(
        *sheet, "row", "property", (F.col("col") - skip).alias("pos"), "cell", *lineage.kept(cells)
    )


def assign_calendar(
    series: DataFrame, calendar: DataFrame, keys: tuple[str, ...] = ("period",), scale: int = 1, secondary: DataFrame | None = None, secondary_scale: int = 4
) -> DataFrame:
    """Stamps by position: row ``pos`` of a period takes the instant of that position.

    A period with 20 rows more than its calendar takes the ``secondary`` (finer) one. Where one hour
    is short (autumn) the hour at index 3 is repeated, where one is too many the last rows go.
    """
    keys = list(keys)
    n_rows = series.groupBy(*keys).agg(F.countDistinct("pos").alias("__rows"))
    size = lambda c: c.groupBy(*keys).agg(F.count("*").alias("__slots"))
    coarse = calendar.withColumn("__scale", F.lit(scale)).withColumn("__fine", F.lit(False))
    plan = n_rows.join(size(calendar), keys, "left")
    use_fine = F.lit(False) if secondary is None else F.col("__rows") > F.coalesce("__slots", F.lit(0)) + 20
    plan = plan.withColumn("__use", use_fine)
    slots = coarse
    if secondary is not None:
        slots = coarse.unionByName(secondary.withColumn("__scale", F.lit(secondary_scale)).withColumn("__fine", F.lit(True)))
        plan = plan.drop("__slots").join(slots.groupBy(*keys, F.col("__fine").alias("__use")).agg(F.count("*").alias("__slots")), [*keys, "__use"])
    slots = slots.withColumnRenamed("pos", "__k").join(plan, keys).where(F.col("__fine") == F.col("__use"))
    short = (F.col("__rows") < F.col("__slots")) & (F.col("__k") >= 4 * F.col("__scale"))
    slots = slots.withColumn("pos", F.when(short, F.col("__k") - F.col("__scale")).otherwise(F.col("__k")))
    helpers = ["__k", "__rows", "__slots", "__scale", "__fine", "__use"]
    return series.join(slots, [*keys, "pos"]).drop("pos").withColumn("pos", F.col("__k")).drop(*helpers)


def partial_day_align(calendar: DataFrame, headers: DataFrame, keys: tuple[str, ...] = ("period",)) -> DataFrame:
    """The calendar of each period from the local stamp ``header_ts`` on, numbered anew."""
    rest = calendar.join(headers, list(keys)).where("local_ts >= header_ts").drop("header_ts")
    return rest.withColumn("pos", F.row_number().over(Window.partitionBy(*keys).orderBy("ts")) - 1)


def fill_empty_frame(series: DataFrame, calendar: DataFrame, properties: list[str], fill: float | None = 0.0, keys: tuple[str, ...] = ("period",)) -> DataFrame:
    """Periods of the calendar without any row get every property with ``fill``; None leaves them empty."""
    if fill is None:
        return series
    empty = calendar.join(series.select(*keys).distinct(), list(keys), "left_anti")
    # the properties are a short list from configuration
    filled = empty.select(*keys, "ts", F.explode(F.array(*map(F.lit, properties))).alias("property")).withColumn("value", F.lit(fill).cast("double"))
    return series.select(*keys, "ts", "property", "value").unionByName(filled)


def to_double_fill0(series: DataFrame, keys: tuple[str, ...] = SHEET) -> DataFrame:
    """Adds ``value``: frames of which every cell is a number or empty become double, empty cells 0; a
    frame with a text stays text (``value`` null)."""
    bad = F.max(F.col("cell").isNotNull() & X.number(F.col("cell")).isNull()).over(Window.partitionBy(*keys))
    return series.withColumn("value", F.when(~bad, F.coalesce(X.number(F.col("cell")), F.lit(0.0))))


def fill_header_names(header: DataFrame, suffixes: list[str] | None = None, sheet: tuple[str, ...] = SHEET) -> DataFrame:
    """Header cells (``col, cell``) named ``name``: a blank one takes the last named one before it, with
    the suffix of its place in the group (in turn), or its number where no suffixes are given."""
    line = Window.partitionBy(*sheet).orderBy("col")
    filled = header.withColumn("__name", F.last(F.nullif(F.trim("cell"), F.lit("")), ignorenulls=True).over(line))
    group = F.count(F.nullif(F.trim("cell"), F.lit(""))).over(line)
    filled = filled.withColumn("__group", group)
    place = F.row_number().over(Window.partitionBy(*sheet, "__group").orderBy("col")) - 1
    filled = filled.withColumn("__place", place)
    if suffixes:
        tail = F.element_at(F.array(*map(F.lit, suffixes)), (F.col("__place") % len(suffixes) + 1).cast("int"))
        name = F.concat("__name", tail)
    else:
        name = F.when(F.col("__place") > 0, F.concat("__name", F.lit("_"), F.col("__place").cast("string"))).otherwise(F.col("__name"))
    return filled.withColumn("name", name).drop("__name", "__group", "__place")


def combine_keys(frame: DataFrame, cols: list[str], into: str = "key", sep: str = "_") -> DataFrame:
    return frame.withColumn(into, F.concat_ws(sep, *[F.col(c).cast("string") for c in cols]))


def swap_values(frame: DataFrame, where: str, among: list, a: str, b: str) -> DataFrame:
    """Columns ``a`` and ``b`` exchanged in the rows whose ``where`` is one of ``among``."""
    hit = F.coalesce(F.col(where).isin(list(among)), F.lit(False))
    return frame.withColumns({a: F.when(hit, F.col(b)).otherwise(F.col(a)), b: F.when(hit, F.col(a)).otherwise(F.col(b))})


def pivot_mean(long: DataFrame, index: list[str], key: str, values: list[str], payload: str = "value") -> DataFrame:
    """Wide means of the payload; the columns are named, so no job is run to find them."""
    return long.groupBy(*index).pivot(key, values).agg(F.avg(payload))


def clean_pivot(wide: DataFrame, index: list[str], order_col: str | None = None) -> DataFrame:
    """Without rows that hold no value, and without those of sort order 0."""
    kept = wide.dropna("all", subset=[c for c in wide.columns if c not in index])
    return kept if order_col is None else kept.where(F.col(order_col) != 0)


def is_autumn_switch_day(day: Column) -> Column:
    """The last Sunday of October."""
    return (F.month(day) == 10) & (F.dayofweek(day) == 1) & (F.month(F.date_add(day.cast("date"), 7)) == 11)


def coalesce_duplicates(wide: DataFrame, key: str, order: str, keep_autumn: bool = True) -> DataFrame:
    """One row per ``key``: of each column the first value that is not null, in ``order``. Rows of the
    autumn switch day are left as they are, since their stamps do repeat."""
    values = [c for c in wide.columns if c not in (key, order)]
    autumn = is_autumn_switch_day(F.col(key)) if keep_autumn else F.lit(False)
    firsts = [F.min_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in values]
    merged = wide.where(~autumn).groupBy(key).agg(F.min(order).alias(order), *firsts)
    return merged.unionByName(wide.where(autumn).select(merged.columns))


def reindex_sequence(frame: DataFrame, keys: list[str], pos: str, values: list[str], fill: float = 0.0) -> DataFrame:
    """Positions 1..n of every group, n its greatest; missing ones hold ``fill``."""
    grid = frame.groupBy(*keys).agg(F.max(pos).alias("__n")).select(*keys, F.explode(F.sequence(F.lit(1).cast("long"), F.col("__n").cast("long"))).alias(pos))
    return grid.join(frame.withColumn(pos, F.col(pos).cast("long")), [*keys, pos], "left").na.fill(fill, values)


def expand_levels(wide: DataFrame, index: list[str], sep: str = "|", parts: tuple[str, ...] = ("file", "property")) -> DataFrame:
    """Columns named by two levels as rows: one column for each level and ``value``; nulls go."""
    columns = [c for c in wide.columns if c not in index]
    long = wide.unpivot(index, columns, "__name", "value").where("value is not null")
    names = F.split("__name", F.lit(f"\\Q{sep}\\E"))
    return long.select(*index, *[names[k].alias(p) for k, p in enumerate(parts)], "value")


def collapse_levels(long: DataFrame, index: list[str], columns: list[str], parts: tuple[str, ...] = ("file", "property"), sep: str = "|") -> DataFrame:
    """The inverse of :func:`expand_levels`, one value per cell (the first by value)."""
    return long.withColumn("__name", F.concat_ws(sep, *parts)).groupBy(*index).pivot("__name", columns).agg(F.min("value"))


def filter_duration(products: DataFrame, keys: list[str], duration: str = "duration", prefer: int = 15) -> DataFrame:
    """Where a group mixes durations only the preferred one stays; other groups stay whole."""
    group = Window.partitionBy(*keys)
    mixed = F.min(duration).over(group) != F.max(duration).over(group)
    return products.withColumn("__mixed", mixed).where(~F.col("__mixed") | (F.col(duration) == prefer)).drop("__mixed")


def scale_units(series: DataFrame, pattern: str = "MWh", factor: float = 0.001, row_keys: list[str] | None = None, least: int = 2) -> DataFrame:
    """Values of properties that match times ``factor``; rows (``row_keys``) with fewer than ``least`` values go."""
    if row_keys:
        full = series.groupBy(*row_keys).agg(F.count("value").alias("__n")).where(F.col("__n") >= least)
        series = series.join(full.drop("__n"), row_keys, "left_semi")
    return series.withColumn("value", F.when(F.col("property").rlike(pattern), F.col("value") * factor).otherwise(F.col("value")))


def join_periods(*frames: DataFrame) -> DataFrame:
    """Frames of several periods under one another; columns are united, missing ones null."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def series_with_index(cells: DataFrame, stamp: Column, skip: int = 0, sheet: tuple[str, ...] = SHEET) -> DataFrame:
    """Long series of sheets that bring their own stamps: column 0 is the stamp (``stamp`` parses it),
    row ``skip`` names the columns, rows before it are left out."""
    body = cells.where(F.col("row") > skip)
    names = cells.where((F.col("row") == skip) & (F.col("col") > 0)).select(*sheet, "col", F.col("cell").alias("property"))
    stamps = body.where("col = 0").select(*sheet, "row", stamp.alias("ts"))
    return body.where("col > 0").join(names, [*sheet, "col"]).join(stamps, [*sheet, "row"]).select(*sheet, "ts", "property", X.number(F.col("cell")).alias("value"))
