"""Filter interaction audit: what every order of five filters keeps and removes, step by step.

Native. Each document gives a mask of the filters that it fails. Documents are counted by part, mask and labels
("cells", at most 128 for a part), and only cells meet the orders: each cell is folded across the array of all
120 orders (a constant of the plan) by ``transform`` and ``aggregate``, which gives it 600 structs of counts,
one for each step of each order. The structs are multiplied by the cell's size and added place by place.

The duplicate filter needs the whole table. Only ids, digests of texts, masks and labels are shuffled, first
by id (to the labels), then by digest. A digest may be that of a third of all rows: its rows are counted
before that second shuffle, with their smallest id, so a task gets a few rows of every other task for each digest.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: White space between words, as a pattern.
_SPACE = r"[\x20\x09-\x0D]+"
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
#: Filters: their orders are a constant of the plan, so there are few.
MOST_FILTERS = 6


def text_filters(text: Column) -> dict[str, Column]:
    """The failure conditions of one text: A few words, B few different words, C many capitals, D marks of code."""
    words = F.array_remove(F.split(text, _SPACE), "")
    capitals = F.regexp_count(text, F.lit("[A-Z]"))
    return {
        "A": F.size(words) < 200,
        "B": 100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
        "C": 100 * capitals.cast("long") > 2 * F.char_length(text),
        "D": text.rlike("[#$%&*|]"),
    }


def cells(docs: DataFrame, labels: DataFrame, filters=text_filters, repeated: str = "E") -> DataFrame:
    """``part, mask, good, toxic, n``: how many documents of a part (its source, a null one as an empty string)
    fail which filters. Bit k of the mask is the k-th of ``filters`` and, last, ``repeated``: the text is that of a
    smaller id, anywhere in the table.

    A null text is empty. Rows of one id and text are counted as often, and do not repeat each other. A null id
    is smaller than none and greater than none. A document is good (toxic) if any label row of its id says so.
    Other columns, whatever their names, are left behind.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), text.alias("text"))
    mask = F.lit(0)
    for k, fails in enumerate(filters(F.col("text")).values()):
        mask = mask + F.when(fails, 1 << k).otherwise(0)
    # rows without an id have no labels: they are dealt by their text
    rows = rows.select("id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), mask.alias("mask"))
    rows = rows.withColumn("dealt", F.when(F.col("id").isNull(), F.xxhash64("digest")).otherwise(F.lit(0)))
    marks = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("id"), F.lit(0).cast("long").alias("dealt")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic")
    )
    no = F.lit(False)
    marked = rows.join(marks, ["id", "dealt"], "left").select("id", "dealt", "part", "digest", "mask", F.coalesce("good", no).alias("good"), F.coalesce("toxic", no).alias("toxic"))
    once = marked.groupBy("id", "dealt", "part", "digest", "mask", "good", "toxic").agg(F.count("*").alias("n"))
    known = F.col("id").isNotNull()
    groups = once.groupBy("digest", "part", "mask", "good", "toxic").agg(
        F.sum("n").alias("n"), F.sum(F.when(known, 0).otherwise(F.col("n"))).alias("without"), F.min(F.when(known, F.struct("id", "n"))).alias("first")
    )
    # of one text there are as many groups as parts and labels
    least = F.min("first.id").over(Window.partitionBy("digest"))
    spared = F.col("without") + F.when(F.col("first.id") == F.col("least"), F.col("first.n")).otherwise(0)
    both = groups.withColumn("least", least).withColumn("spared", spared)
    bit = 1 << len(filters(F.lit("")))
    pair = F.array(F.struct(F.col("mask"), F.col("spared").alias("n")), F.struct((F.col("mask") + bit).alias("mask"), (F.col("n") - F.col("spared")).alias("n")))
    split = both.select("part", "good", "toxic", F.explode(pair).alias("x")).where("x.n > 0")
    return split.groupBy("part", F.col("x.mask").alias("mask"), "good", "toxic").agg(F.sum("x.n").alias("n"))


def _steps(orders: list[tuple[int, ...]]) -> Column:
    """For a cell's mask, the structs of all steps of all orders, each multiplied by the cell's ``n``."""
    kinds = ", ".join(f"{c}: bigint" for c in COUNTS)
    start = f"named_struct('failed', false, 'steps', cast(array() as array<struct<{kinds}> >))"
    fails, here = "getbit(mask, f) = 1", "(getbit(mask, f) = 1 and not acc.failed)"
    when = {
        "kept": f"not ({fails} or acc.failed)", "removed": here, "redundant": f"{fails} and acc.failed", "unique_fails": "mask = shiftleft(1, f)",
        "good_lost": f"{here} and good", "toxic_lost": f"{here} and toxic",
    }
    step = "named_struct(" + ", ".join(f"'{c}', if({when[c]}, n, 0L)" for c in COUNTS) + ")"
    each = f"aggregate(o, {start}, (acc, f) -> named_struct('failed', acc.failed or {fails}, 'steps', concat(acc.steps, array({step}))), acc -> acc.steps)"
    table = "array(" + ", ".join(f"array({', '.join(map(str, o))})" for o in orders) + ")"
    return F.expr(f"flatten(transform({table}, o -> {each}))")


def audit(counted: DataFrame, letters: str = "ABCDE") -> DataFrame:
    """For every part, order of the filters and step: the counts of :func:`cells` that are kept after the step,
    removed at it, redundant there (failing its filter, but removed before), failing its filter only, removed
    although good or as toxic ones; and ``shapley``, what the step's filter removes, added over all orders.

    ``letters`` names the filters by the bits of the mask. No cells give an empty table.
    """
    if not 1 <= len(letters) <= MOST_FILTERS:
        raise ValueError(f"between one and {MOST_FILTERS} filters, not {len(letters)}")
    orders = list(permutations(range(len(letters))))
    names = F.array(*[F.lit("".join(letters[k] for k in o)) for o in orders])
    weighted = counted.select("part", F.posexplode(_steps(orders)).alias("place", "x"))
    added = weighted.groupBy("part", "place").agg(*[F.sum(f"x.{c}").alias(c) for c in COUNTS])
    order = F.get(names, F.floor(F.col("place") / len(letters)).cast("int"))
    placed = added.select("part", order.alias("filter_order"), (F.col("place") % len(letters) + 1).cast("int").alias("step"), *COUNTS)
    # 120 rows of each part and filter
    own = Window.partitionBy("part", F.substring(F.col("filter_order"), F.col("step"), F.lit(1)))
    return placed.withColumn("shapley", F.sum("removed").over(own))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders of the five filters over all documents, by source."""
    return audit(cells(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")))


ORACLE = r"""
WITH t AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words, min(doc_id) OVER (PARTITION BY text) AS least FROM t),
l AS (SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic FROM labels GROUP BY 1),
m AS (SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
             map(['A', 'B', 'C', 'D', 'E'], [len(words) < 200, 100 * len(list_distinct(words)) < 50 * len(words), 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text),
                                             regexp_matches(text, '[#$%&*|]'), coalesce(doc_id > least, false)]) AS fails
      FROM w LEFT JOIN l USING (doc_id)),
c AS (SELECT part, good, toxic, fails, count(*) AS n FROM m GROUP BY ALL),
f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM f a, f b, f c, f d, f e WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s AS (SELECT filter_order, step, filter_order[step] AS x, [filter_order[i] FOR i IN range(1, step)] AS before FROM o, (SELECT unnest(range(1, 6)) AS step)),
r AS (SELECT part, good, toxic, n, filter_order, step, x, fails[x] AS hit, len(list_filter(before, lambda y: fails[y])) > 0 AS gone, len(list_filter(map_values(fails), lambda y: y)) AS hits FROM c, s),
g AS (SELECT part, filter_order, step, x, sum(CASE WHEN NOT hit AND NOT gone THEN n ELSE 0 END) AS kept, sum(CASE WHEN hit AND NOT gone THEN n ELSE 0 END) AS removed, sum(CASE WHEN hit AND gone THEN n ELSE 0 END) AS redundant,
             sum(CASE WHEN hit AND hits = 1 THEN n ELSE 0 END) AS unique_fails, sum(CASE WHEN hit AND NOT gone AND good THEN n ELSE 0 END) AS good_lost, sum(CASE WHEN hit AND NOT gone AND toxic THEN n ELSE 0 END) AS toxic_lost
      FROM r GROUP BY 1, 2, 3, 4)
SELECT part, filter_order, step::INTEGER AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, x))::BIGINT AS shapley FROM g
"""
