"""The catalogue of stored series, locators, search, combination of series, and the report pool.

A catalogue has one row per node: ``dna`` (names joined by dots), ``parts``, ``name``, ``kind``
(root, publisher, report, field, file, property), ``depth`` and ``path``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridseries.functions import textparts as X
from gridseries.functions import timeparts as T
from gridseries.operators import blocks
from gridseries.operators.names import NameIndex
from gridseries.operators.store import fill_grid

KINDS = ("root", "publisher", "report", "field", "file", "property")


def build_catalog(leaves: DataFrame, levels: list[str], root: str = "root", kinds: tuple[str, ...] = KINDS) -> DataFrame:
    """Catalogue of all nodes above and including the leaves, whose names are in the ``levels`` columns."""
    parts = F.array(F.lit(root), *[F.col(c).cast("string") for c in levels])
    prefixes = F.transform(F.sequence(F.lit(1), F.lit(len(levels) + 1)), lambda n: F.slice(parts, 1, n))
    nodes = leaves.select(F.explode(prefixes).alias("parts")).distinct()
    depth = F.size("parts") - 1
    return nodes.select(
        F.array_join("parts", ".").alias("dna"), "parts", F.element_at("parts", -1).alias("name"),
        F.element_at(F.array(*map(F.lit, kinds)), depth + 1).alias("kind"), depth.alias("depth"), F.array_join("parts", "/").alias("path"),
    )


def find_nodes(catalog: DataFrame, locator: str | None) -> DataFrame:
    """Nodes that a locator may mean: none is the root, a path or dotted name (in any case) is matched
    from the root or as a suffix of whole names; ``name.>>`` is the first file below it."""
    if not locator:
        return catalog.where("depth = 0")
    text = locator.strip("/").replace("/", ".").lower()
    if text.endswith(".>>"):
        above = find_nodes(catalog, locator[:-3]).select(F.col("dna").alias("__above"))
        prefixes = F.transform(F.sequence(F.lit(1), F.size("parts") - 1), lambda n: F.array_join(F.slice("parts", 1, n), "."))
        below = catalog.where("kind = 'file' and size(parts) > 1").withColumn("__above", F.explode(prefixes)).join(above, "__above", "left_semi")
        return below.orderBy("dna").limit(1).drop("__above")
    low = F.lower("dna")
    whole = catalog.where(low == text)
    suffix = catalog.where(low.endswith("." + text))
    # a whole name wins over suffixes
    return whole.unionByName(suffix.join(whole.limit(1).select(F.lit(1).alias("__one")), F.lit(True), "left_anti"))


def resolve_node(catalog: DataFrame, locator: str | None) -> DataFrame:
    """The one node of a locator; raises if there is none or more than one."""
    found = find_nodes(catalog, locator)
    names = [r["dna"] for r in found.select("dna").limit(4).collect()]
    if len(names) != 1:
        raise LookupError(f"{locator!r} is {'ambiguous: ' + ', '.join(names) if names else 'not found'}")
    return found


def resolve_all(catalog: DataFrame, locators: DataFrame, column: str = "locator") -> DataFrame:
    """For many locators at once: ``dna`` of the unique match (null if none) and ``n_matches``.

    Every node is looked up by all suffixes of its name, so this is a join on equality.
    """
    size = F.size("parts")
    suffixes = F.transform(F.sequence(F.lit(1), size), lambda n: F.lower(F.array_join(F.slice("parts", n, size - n + 1), ".")))
    known = catalog.select("dna", F.explode(suffixes).alias("__text"), F.lower("dna").alias("__whole"))
    asked = locators.withColumn("__text", F.lower(F.translate(F.trim(column), "/", ".")))
    joined = asked.join(known, "__text", "left").withColumn("__exact", F.coalesce(F.col("__whole") == F.col("__text"), F.lit(False)))
    best = joined.groupBy(column).agg(
        F.count("dna").alias("n_all"), F.count_if("__exact").alias("n_exact"), F.min(F.when(F.col("__exact"), F.col("dna"))).alias("exact"), F.min("dna").alias("any")
    )
    n = F.when(F.col("n_exact") > 0, F.col("n_exact")).otherwise(F.col("n_all"))
    return best.select(column, n.alias("n_matches"), F.when(n == 1, F.coalesce("exact", "any")).alias("dna"))


def node_relations(catalog: DataFrame, of: DataFrame, relation: str, kind: str | None = None) -> DataFrame:
    """``of_dna, dna, kind`` of children, siblings (itself included), descendants, ascendants (itself
    included, the root last) or the ancestor of a ``kind``, for every node of ``of``."""
    asked = of.select(F.col("dna").alias("of_dna"), F.col("parts").alias("of_parts"))
    parent = lambda parts: F.array_join(F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0))), ".")
    nodes = catalog.select("dna", "kind", "parts")
    if relation == "children":
        out = asked.join(nodes.where("size(parts) > 1").withColumn("__up", parent("parts")), F.col("of_dna") == F.col("__up"))
    elif relation == "siblings":
        out = asked.withColumn("__a", parent("of_parts")).join(nodes.withColumn("__b", parent("parts")), F.col("__a") == F.col("__b"))
    elif relation in ("ascendants", "ancestor"):
        above = F.transform(F.sequence(F.size("of_parts"), F.lit(1), F.lit(-1)), lambda n: F.array_join(F.slice("of_parts", 1, n), "."))
        out = asked.withColumn("__up", F.explode(above)).join(nodes, F.col("__up") == F.col("dna"))
    elif relation == "descendants":
        up = F.transform(F.sequence(F.lit(1), F.size("parts") - 1), lambda n: F.array_join(F.slice("parts", 1, n), "."))
        out = asked.join(nodes.where("size(parts) > 1").withColumn("__up", F.explode(up)), F.col("of_dna") == F.col("__up"))
    else:
        raise ValueError(f"no such relation: {relation}")
    out = out.select("of_dna", "dna", "kind")
    return out if kind is None else out.where(F.col("kind") == kind)


def read_node(store: DataFrame, dna: str, tz: str | None = None, start: str | None = None, end: str | None = None, levels: tuple[str, ...] = KINDS[1:-1]) -> DataFrame:
    """Stored rows below a node (a property of its own, or all of a file or folder), in wall time of
    ``tz`` and sliced. The names become filters on the partition columns, so the scan is pruned.
    A property that the file lacks is null at every stamp of the file (one look for a first row)."""
    from gridseries.operators.calendars import slice_time, to_timezone

    names = dna.split(".")[1:]
    for level, name in zip(levels, names, strict=False):
        store = store.where(F.lower(level) == name.lower())
    if len(names) > len(levels):
        name, file = names[len(levels)], store
        store = file.where(F.lower("property") == name.lower())
        if store.isEmpty():
            nulls = {c: F.lit(None).cast(t) for c, t in file.dtypes if c not in (*levels, "ts")} | {"property": F.lit(name)}
            store = file.select(*levels, "ts").distinct().withColumns(nulls).select(file.columns)
    return to_timezone(slice_time(store, start, end, tz or "UTC"), tz, truncate_tz=True)


def resolution_of(series: DataFrame, keys: list[str] = ()) -> DataFrame:
    """``keys, step_s``: seconds between the first two distinct stamps of each group, 0 if there is one.
    Null stamps are ignored."""
    series = series.where("ts is not null")
    if keys:
        two = series.withColumn("__r", F.dense_rank().over(Window.partitionBy(*keys).orderBy("ts"))).where("__r <= 2")
    else:
        two = series.select("ts").distinct().orderBy("ts").limit(2)
    return two.groupBy(*keys).agg((T.seconds(F.max("ts")) - T.seconds(F.min("ts"))).alias("step_s"))


def upsample_linear(series: DataFrame, keys: list[str], step_s: int, block_s: int | None = None) -> DataFrame:
    """Every group on a finer grid from its first to its last bucket, by straight lines between values.

    Nulls between values are filled too; after the last value it is carried forward; before the first
    stays null. No value is made past the last stamp. Blocks (see :mod:`gridseries.operators.blocks`) hold
    100,000 stamps of the grid by default.
    """
    bucket = series.groupBy(*keys, T.floor_to(F.col("ts"), step_s).alias("ts")).agg(F.avg("value").alias("value"))
    grid = fill_grid(bucket, list(keys), step_s)
    marked = blocks.known_around(grid, list(keys), block_s or 100_000 * step_s)
    b, a, t = F.col("before"), F.col("after"), T.seconds(F.col("ts"))
    line = b["v"] + (a["v"] - b["v"]) * (t - b["t"]) / (a["t"] - b["t"])
    value = F.when(F.col("value").isNotNull() | a.isNull(), F.coalesce("value", b["v"])).when(b.isNotNull(), line)
    return marked.withColumn("value", value).drop("after", "before")


def downsample_mean(series: DataFrame, keys: list[str], step_s: int) -> DataFrame:
    """Mean per bucket of ``step_s``; buckets without rows between the first and the last are null."""
    means = series.groupBy(*keys, T.floor_to(F.col("ts"), step_s).alias("ts")).agg(F.avg("value").alias("value"))
    return fill_grid(means, list(keys), step_s)


def combine(frames: list[DataFrame], suffixes: list[str] | None = None, rename: list[str] | None = None, resolution: str | int = "auto") -> DataFrame:
    """Wide frames with ``ts`` side by side, joined fully on time.

    Columns that occur in two frames or more get ``_1``, ``_2``, ... (or the given suffixes). With
    ``resolution`` auto or min coarser frames are brought to the finest step by straight lines, with max
    or a number of seconds finer ones by means. The steps of all frames are found in one job; a frame
    of fewer than two stamps has no step and stays as it is.
    """
    suffixes = suffixes or [f"_{i}" for i in range(1, len(frames) + 1)]
    columns = [[c for c in f.columns if c != "ts"] for f in frames]
    several = {c for c in set(sum(columns, [])) if sum(c in own for own in columns) > 1}
    asked = [resolution_of(f).select(F.lit(i).alias("i"), "step_s") for i, f in enumerate(frames)]
    found = {r["i"]: r["step_s"] for r in reduce(DataFrame.unionByName, asked).collect()}
    steps = [found[i] for i in range(len(frames))]
    known = [s for s in steps if s]
    wanted = min(known, default=None) if resolution in ("auto", "min") else max(known, default=None) if resolution == "max" else int(resolution)
    out = None
    for frame, own, step, suffix in zip(frames, columns, steps, suffixes, strict=True):
        if step and step != wanted:
            long = frame.unpivot(["ts"], own, "property", "value")
            move = upsample_linear if resolution in ("auto", "min") else downsample_mean
            frame = move(long, ["property"], wanted).groupBy("ts").pivot("property", own).agg(F.first("value"))
        frame = frame.withColumnsRenamed({c: c + suffix for c in own if c in several})
        out = frame if out is None else out.join(frame, "ts", "full_outer")
    return out if rename is None else out.toDF("ts", *rename)


def fuzzy_search(
    catalog: DataFrame, words: list[str], n_best: int = 10, kind: str | None = None, pool: int | None = 500, index: NameIndex | None = None
) -> DataFrame:
    """The nodes most like several words: the word whose best hit lies deepest goes first, each word
    narrows the candidates of the one before to its ``pool`` best. ``kind`` rolls hits up to a level.

    With ``pool`` None no word narrows, so every node is a candidate of the last one. With an ``index`` (see
    :func:`gridseries.operators.names.node_index`) of the same catalogue the first look of each word and the first
    narrowing compare only nodes that share enough with the word; without one they compare all. The rows are the same.
    """
    lowered = [w.lower() for w in words]
    score = lambda w: F.greatest(X.edit_ratio(F.lower("dna"), F.lit(w)), X.edit_ratio(F.lower("name"), F.lit(w)))
    if index is None:
        best = catalog.agg(*[F.max_by("depth", F.struct(score(w), F.col("depth"))).alias(w) for w in set(lowered)]).first().asDict()
    else:
        hits = index.nearest(index.spark.createDataFrame([(w,) for w in lowered], "word string"), 1, ties=True)
        deep = hits.join(catalog.select(F.col("dna").alias("key"), "depth"), "key").groupBy("word").agg(F.max("depth").alias("depth"))
        best = dict.fromkeys(lowered) | {r["word"]: r["depth"] for r in deep.collect()}
    order = sorted(range(len(words)), key=lambda i: (-(best[lowered[i]] or 0), i))
    order = order[-1:] if pool is None and kind is None else order
    left = catalog
    for at, i in enumerate(order):
        if index is not None and at == 0 and (most := n_best if pool is None and kind is None else pool) is not None:
            hits = index.nearest(index.spark.createDataFrame([(lowered[i],)], "word string"), most)
            left = left.join(hits.select(F.col("key").alias("dna"), "score"), "dna")
        else:
            left = left.withColumn("score", score(lowered[i]))
            left = left if pool is None else left.orderBy(F.desc("score"), "dna").limit(pool)
    if kind is not None:
        level = KINDS.index(kind) + 1
        up = F.array_join(F.slice("parts", 1, level), ".")
        left = left.where(F.size("parts") >= level).groupBy(up.alias("dna")).agg(F.max("score").alias("score"))
    return left.orderBy(F.desc("score"), "dna").limit(n_best).select("dna", "score")


#: Classes of names and of candidates that meet in one task's turn, and the most partitions that the turns are dealt to.
MATCH_BLOCK, MOST_MATCH_TASKS = 1024, 10_000


def jaccard_match(
    names: DataFrame, candidates: DataFrame, n_best: int = 1, name: str = "name", candidate: str = "candidate",
    parts: Callable[[Column], Column] | None = None, block: int = MATCH_BLOCK,
) -> DataFrame:
    """``name, candidate, score, rank``: the ``n_best`` most similar candidates of each name.

    Similar are texts that share characters (Jaccard of their refined character sets); with ``parts``, a function of a
    candidate to an array of texts, the similarities of the name with all parts are added up. Of equal scores
    the smaller candidate is first. Nulls and texts without characters score 0. Texts of equal character sets are
    one class, which is scored once. The classes of the names are a query set that meets all classes of
    candidates block by block, joined by block number, so neither side is broadcast or bounded.
    """
    sign = lambda text: F.coalesce(F.array_sort(X.character_set(X.refine(text))), F.array().cast("array<string>"))
    asked = names.select(name).distinct().withColumn("__set", sign(F.col(name)))
    text = F.array(candidate) if parts is None else F.coalesce(parts(F.col(candidate)), F.array().cast("array<string>"))
    listed = candidates.select(candidate).distinct().withColumn("__parts", F.transform(text, sign))
    # a class's first candidate tells its place among classes of one score: the best n_best lie in the best n_best classes
    kinds, lists = asked.select("__set").distinct(), listed.groupBy("__parts").agg(F.min(candidate).alias("__first"))
    n_slices, n_blocks = (-(-max(1, side.count()) // block) for side in (kinds, lists))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    place = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("int")
    turn, tasks = ["__slice", "__block"], min(n_slices * n_blocks, MOST_MATCH_TASKS)
    left = kinds.withColumn("__slice", place("__set", n_slices)).withColumn("__block", every(n_blocks)).repartition(tasks, *turn)
    right = lists.withColumn("__block", place("__parts", n_blocks)).withColumn("__slice", every(n_slices)).repartition(tasks, *turn)
    if parts is None:
        score = X.jaccard(F.col("__set"), F.col("__parts")[0])
    else:  # rounded, as sums of equal terms may differ in the last place
        score = F.round(F.aggregate("__parts", F.lit(0.0), lambda s, part: s + X.jaccard(F.col("__set"), part)), 12)
    best = Window.partitionBy("__set").orderBy(F.desc("score"), "__first")
    met = left.join(right, turn).select("__set", "__parts", "__first", score.alias("score"))
    met = met.withColumn("__place", F.row_number().over(best)).where(F.col("__place") <= n_best).select("__set", "__parts", "score")
    few = Window.partitionBy("__parts").orderBy(candidate)
    firsts = listed.withColumn("__place", F.row_number().over(few)).where(F.col("__place") <= n_best).drop("__place")
    order = Window.partitionBy("__set").orderBy(F.desc("score"), candidate)
    ranked = met.join(firsts, "__parts").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n_best)
    return asked.join(ranked, "__set").select(name, candidate, "score", "rank")


def report_pool(metadata: DataFrame, *settings: DataFrame, defaults: dict | None = None, key: str = "report_name") -> DataFrame:
    """Metadata and settings side by side; of columns that repeat the first stays; empty cells take defaults."""
    out = metadata
    for frame in settings:
        out = out.join(frame.select(key, *[c for c in frame.columns if c not in out.columns]), key, "left")
    return out.na.fill(defaults) if defaults else out


def filter_reports(pool: DataFrame, display: list[str] | None = None, **equal) -> DataFrame:
    """Reports whose columns equal the given values; ``display`` picks the columns shown."""
    for column, value in equal.items():
        pool = pool.where(F.col(column).eqNullSafe(F.lit(value)))
    return pool.select(*display) if display else pool


def select_reports(pool: DataFrame, which=None, exclude=None, groups=None, publishers=None, countries=None, only_ongoing: bool = False, key: str = "report_name") -> DataFrame:
    """Reports that pass all filters, in any case; ``all`` or None is no filter. Raises if none is left."""

    def lowered(values) -> list[str] | None:
        if values is None or values == "all":
            return None
        return [v.lower() for v in ([values] if isinstance(values, str) else values)]

    for column, values in ((key, which), ("group", groups), ("publisher", publishers), ("country", countries)):
        if (wanted := lowered(values)) is not None:
            pool = pool.where(F.lower(column).isin(wanted))
    if (unwanted := lowered(exclude)) is not None:
        pool = pool.where(~F.lower(key).isin(unwanted))
    if only_ongoing:
        pool = pool.where("is_alive")
    if pool.isEmpty():
        raise LookupError("no report passes the filters")
    return pool


def group_listing(pool: DataFrame, group: str = "group", key: str = "report_name") -> DataFrame:
    return pool.groupBy(group).agg(F.sort_array(F.collect_list(key)).alias("reports"))


def structure_summary(series: DataFrame, field: str = "field", file: str = "file") -> DataFrame:
    return series.groupBy(field).agg(F.sort_array(F.collect_set(file)).alias("files"))


def set_compare(first: DataFrame, second: DataFrame, get: str = "intersection") -> DataFrame:
    """Distinct rows of both, either, only the first or only the second of two lists."""
    found: dict[str, Callable[[], DataFrame]] = {
        "intersection": lambda: first.intersect(second),
        "union": lambda: first.union(second).distinct(),
        "only_first": lambda: first.subtract(second),
        "only_second": lambda: second.subtract(first),
    }
    return found[get]()


def transform_hook(frame: DataFrame, function: Callable, schema: str | None = None, keys: list[str] | None = None) -> DataFrame:
    """A user's function on a frame: of DataFrames, or with ``schema`` of the pandas frames of each group."""
    if schema is None:
        return frame.transform(function)
    return frame.groupBy(*keys).applyInPandas(function, schema) if keys else frame.mapInPandas(lambda batches: map(function, batches), schema)
