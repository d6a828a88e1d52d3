"""Cell lineage: from a stored value back to the cells of the sheet that it was made of.

A cell of a sheet gets a compact id, its row and column in one long. Beside the values of a recipe goes ``origin``,
the ids of the cells that a value comes from: steps that keep a row keep its origin, steps that sum rows gather
theirs (the units of a plant), made-up values have none. Staged rows hold the file too, so the raw cell, the
parsed and the stored value meet by equality of file and id, and of the stored key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridseries.functions import textparts as X

ORIGIN = "origin"
#: Columns of a sheet have numbers below 2 to the power of this; rows take the bits above.
COL_BITS = 20


def cell_id(row: str = "row", col: str = "col") -> Column:
    return F.shiftleft(F.col(row).cast("long"), COL_BITS) + F.col(col)


def stamped(cells: DataFrame) -> DataFrame:
    """The cells (``row, col``), each with itself as ``origin``."""
    return cells.withColumn(ORIGIN, F.array(cell_id()))


def kept(frame: DataFrame) -> list[str]:
    """What a step that picks its columns keeps besides: the origin, if the frame has one."""
    return [ORIGIN] if ORIGIN in frame.columns else []


def gathered(frame: DataFrame) -> list[Column]:
    """The same for a step that sums rows: all origins of a group."""
    return [F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c) for c in kept(frame)]


def compare(cells: DataFrame, parsed: DataFrame, stored: DataFrame, keys: list[str], tolerance: float = 0.0) -> DataFrame:
    """Raw, parsed and stored values side by side, a row for each value and cell of it.

    ``cells`` (``file, row, col, cell``) are the sheets as read, ``parsed`` (``file, keys, value, origin``) what
    the recipe made of them, ``stored`` (``keys, value``) what the store holds. Of the result ``file, row, col, cell,
    keys, parsed, stored`` two columns say what happened. ``parsing``: *same*; *changed*, the value is not the
    cell's number; *text*, a filled cell gave no value; *filled*, a value without a cell, or not zero though its
    cell is empty; *summed*, of several cells; *unread*, a number that no value comes from. ``storing``: *same*;
    *replaced*, the store holds another value; *missing*; *orphan*, stored but not parsed; null where there is
    nothing to store. Empty cells that give 0 or nothing are the same. Keys of parsed and stored rows are not null.
    """
    raw = cells.select("file", cell_id().alias("__id"), "row", "col", "cell")
    opened = parsed.select("file", *keys, F.col("value").alias("parsed"), F.coalesce(F.size(ORIGIN), F.lit(0)).alias("__n"), F.explode_outer(ORIGIN).alias("__id"))
    held = stored.select(*keys, F.col("value").alias("stored"), F.lit(True).alias("__held"))
    near = lambda a, b: F.coalesce((F.col(a) == F.col(b)) | (F.abs(F.col(a) - F.col(b)) <= tolerance), F.col(a).isNull() & F.col(b).isNull())
    met = opened.join(raw, ["file", "__id"], "left").withColumns({"__number": X.number(F.col("cell")), "__blank": F.coalesce(F.trim("cell") == "", F.lit(True))})
    parsing = (
        F.when(F.col("__id").isNull(), "filled").when(F.col("__n") > 1, "summed")
        .when(F.col("__blank"), F.when(F.coalesce("parsed", F.lit(0.0)) == 0, "same").otherwise("filled"))
        .when(F.col("parsed").isNull(), "text").when(near("__number", "parsed"), "same").otherwise("changed")
    )
    both = met.withColumn("parsing", parsing).join(held, keys, "full_outer")
    storing = (
        F.when(F.col("parsing").isNull(), "orphan").when(F.col("parsed").isNull() & F.col("__held").isNull(), None)
        .when(F.col("__held").isNull(), "missing").when(near("parsed", "stored"), "same").otherwise("replaced")
    )
    columns = ["file", "row", "col", "cell", *keys, "parsed", "stored", "parsing", "storing"]
    # numbers that nothing came from have no key: they stay out of the join by key, where they would all meet in one task
    unread = raw.where(X.number(F.col("cell")).isNotNull()).join(opened.select("file", "__id"), ["file", "__id"], "left_anti").withColumn("parsing", F.lit("unread"))
    return both.withColumn("storing", storing).select(columns).unionByName(unread.select("file", "row", "col", "cell", "parsing"), allowMissingColumns=True)


def disagreements(compared: DataFrame) -> DataFrame:
    """The rows of :func:`compare` where any two of raw, parsed and stored value differ."""
    plain = F.col("parsing").isin("same", "summed") & F.coalesce(F.col("storing") == "same", F.lit(True))
    return compared.where(~F.coalesce(plain, F.lit(False)))
