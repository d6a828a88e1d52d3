"""An index of names by pairs of neighbouring characters, for exact searches by edit ratio.

A text of ``m`` characters, with a mark before and after it, has ``m + 1`` pairs. ``d`` edits spoil at most
``2 d`` of them and move the others by ``d`` places at most. So two texts within ``d`` edits have at least
``m + 1 - 2 d`` pairs in common at nearly the same places, ``m`` being the longer one's length. A search asks
for the rarest pairs of a word only, as many as tell that a text shares too few of all. What is left is
compared character by character, so pairs decide how many texts are compared, never the result.

Names that are numbered share most of their pairs. So the search for the nearest names goes down a tree of
prefixes instead: of the prefixes of a level those stay that some beginning of the word is near enough to, with
what the rests differ in length at least, and only their children are looked at. Where the edits are spent, the rest
of the word must follow as it stands, and its next piece is looked up by equality. No text in reach is left out.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridseries.functions import textparts as X

#: Bounds of the ratio that a search tries in turn. Narrow steps, since each edit more multiplies the texts in reach.
BOUNDS = (95, 90, 85, 80, 75, 70, 60, 50)
#: A text has to share so many of the pairs asked for, or all that it must share if these are fewer.
MATCHES = 3
#: So many different pairs are named in the filter of the postings' scan; more are found by the join alone.
MOST_NAMED = 2_000
#: Texts that meet a word in one task's turn where the pairs cannot help.
SCAN_BLOCK = 50_000
#: A level of prefixes is the longest one with at most so many times the prefixes of the level before.
FANOUT = 10
#: Levels of at most so many prefixes are broadcast: few first prefixes belong to all words, so words are not dealt by them.
MOST_SENT = 50_000
#: Words that one task takes down the tree at most.
WORDS_IN_TASK = 1_000
#: Lengths that a level may have; texts that are equal up to the last one are compared one by one.
LENGTHS = (*range(1, 65), *range(80, 1025, 16))


def pairs(text: Column) -> Column:
    """Array of ``pos, pair`` of all pairs of a text; one pair for an empty text."""
    marked = F.concat(F.lit("\u0002"), text, F.lit("\u0003"))
    at = lambda i: F.struct(i.cast("int").alias("pos"), F.substring(marked, i, F.lit(2)).alias("pair"))
    return F.transform(F.sequence(F.lit(1), F.length(text) + 1), at)


def _edits(longest: Column, percent: int) -> Column:
    """Most edits that a ratio of ``percent`` allows."""
    return F.floor(longest * (100 - percent) / 100).cast("int")


def _levels(texts: DataFrame) -> list[int]:
    """Lengths of prefixes, each level with about ``FANOUT`` times the prefixes of the one before; the texts
    themselves would be the next level. One row per length passes the driver."""
    longest = texts.agg(F.max(F.length("text"))).first()[0] or 0
    lengths = [n for n in LENGTHS if n <= longest]
    if not lengths:
        return []
    opened = texts.select("text", F.explode(F.array(*map(F.lit, lengths))).alias("n"))
    found = opened.groupBy("n").agg(F.approx_count_distinct(F.substring("text", F.lit(1), F.col("n"))).alias("prefixes"))
    counts = {r["n"]: r["prefixes"] for r in found.collect()}
    levels, at, last = [], 0, 1
    while at < lengths[-1] and counts[lengths[-1]] > FANOUT * last:
        longer = [n for n in lengths if n > at]
        at = max((n for n in longer if counts[n] <= FANOUT * last), default=longer[0])
        levels.append(at)
        last = max(last, counts[at])
    return levels


def _ways(percent: int) -> Column:
    """How a text that begins with ``prefix`` may reach the ratio to ``word``: array of ``at, apart``, for so many first
    characters of the word their distance to the prefix, if that and the least difference in length of the rests
    (``least, most``: lengths of the texts) are no more than ``edits``."""
    size, done, edits = F.length("word"), F.length("prefix"), _most_edits(percent)
    begins = F.sequence(F.greatest(F.lit(0), F.least(size, done - edits)), F.least(size, done + edits))
    begins = F.filter(begins, lambda j: F.abs(j - done) + _rest(j) <= edits)
    apart = lambda j: F.call_function("levenshtein", F.substring("word", F.lit(1), j), F.col("prefix"), edits - _rest(j))
    return F.filter(F.transform(begins, lambda j: F.struct(j.alias("at"), apart(j).alias("apart"))), lambda x: x["apart"] >= 0)


def _most_edits(percent: int) -> Column:
    """Most edits that any text of lengths up to ``most`` may need to ``word``."""
    size = F.length("word")
    return _edits(F.greatest(size, F.least("most", F.floor(size * 100 / percent).cast("int"))), percent)


def _rest(at: Column) -> Column:
    """Least difference in length of what follows the first ``at`` characters of the word, and the prefix in the texts."""
    left, done = F.length("word") - at, F.length("prefix")
    return F.greatest(F.lit(0), left - (F.col("most") - done), F.col("least") - done - left)


def _lookups(percent: int, step: int | None) -> Column:
    """What a text's next ``step`` characters (None: all) may be, as keys: ``p`` and the prefix, for anything, or ``x``,
    the prefix and the piece. The latter if no way has an edit left but for characters of the word that the text has not."""
    done, edits = F.length("prefix"), _most_edits(percent)

    def spent(way: Column) -> Column:
        left = F.length("word") - way["at"]
        none = (way["apart"] + _rest(way["at"]) == edits) & (left >= F.col("least") - done)
        return none if step == 1 else none & (left <= F.col("most") - done)

    def keys(ways: Column) -> Column:
        piece = lambda way: F.substring("word", way["at"] + 1, F.length("word") if step is None else F.lit(step))
        fixed = F.forall(ways, spent) if step is None else (F.col("least") >= done + step) & F.forall(ways, spent)
        exact = F.array_distinct(F.transform(ways, lambda way: F.concat(F.lit("x"), "prefix", piece(way))))
        return F.when(F.size(ways) == 0, F.array().cast("array<string>")).when(fixed, exact).otherwise(F.array(F.concat(F.lit("p"), "prefix")))

    # inside a lambda the ways are found once, not for each use
    return F.flatten(F.transform(F.array(_ways(percent)), keys))


class NameIndex:
    """Names and their pairs in a folder: ``names`` (key, text, id), ``postings`` (pair, length, id, pos; in
    files by ranges of pairs and lengths), ``counts`` (pair, n), ``prefixes`` (level, parent, prefix, least, most)."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.names, self.postings, self.counts = (spark.read.parquet(f"{self.path}/{t}") for t in ("names", "postings", "counts"))
        self.prefixes = spark.read.schema("parent string, prefix string, least int, most int, level int").parquet(f"{self.path}/prefixes")
        self.sizes = {r["level"]: r["count"] for r in self.prefixes.groupBy("level").count().collect()}
        self.levels = sorted(self.sizes)

    @classmethod
    def build(cls, entries: DataFrame, path: str, key: str = "key", text: str = "text") -> NameIndex:
        """Writes the index of a table of keys and texts. A key may have several texts and a text several keys.

        Rows with a null key or text are left out, repeated rows count once, other columns are ignored. Texts
        are told apart by case; an empty text is a text.
        """
        spark, path = entries.sparkSession, path.rstrip("/")
        rows = entries.select(F.col(key).alias("key"), F.col(text).alias("text")).where("key is not null and text is not null").distinct()
        rows.withColumn("id", F.xxhash64("text")).write.parquet(f"{path}/names")
        texts = spark.read.parquet(f"{path}/names").select("text", "id").distinct()
        opened = texts.select("id", F.length("text").alias("length"), F.inline(pairs(F.col("text"))))
        opened.repartitionByRange("pair", "length", "id").sortWithinPartitions("pair", "length").write.parquet(f"{path}/postings")
        postings = spark.read.parquet(f"{path}/postings")
        postings.groupBy("pair").count().withColumnRenamed("count", "n").write.parquet(f"{path}/counts")
        levels, start = _levels(texts), lambda n: F.substring("text", F.lit(1), n)
        steps = [F.struct(F.lit(n).alias("level"), F.lit(before).alias("before")) for n, before in zip(levels, [0, *levels], strict=False)]
        steps = F.array(*steps) if steps else F.lit(None).cast("array<struct<level int, before int>>")
        opened = texts.select("text", F.inline(steps)).select("level", start(F.col("before")).alias("parent"), start(F.col("level")).alias("prefix"), F.length("text").alias("n"))
        tree = opened.groupBy("level", "parent", "prefix").agg(F.min("n").alias("least"), F.max("n").alias("most"))
        tree.select("parent", "prefix", "least", "most", "level").write.parquet(f"{path}/prefixes")
        return cls(spark, path)

    def candidates(self, words: DataFrame, percent: int) -> DataFrame:
        """``word, id`` of all texts that reach the ratio, and of some that do not. Needs a bound of 50 or more.

        ``words`` has distinct texts ``word`` without nulls.
        """
        size = F.length("word")
        fewest = lambda m: (m + 1 - 2 * _edits(m, percent)).cast("int")
        asked = words.select("word", size.alias("size"), F.floor(size * 100 / percent).cast("int").alias("longest"))
        asked = asked.withColumn("shared", F.array_min(F.transform(F.sequence("size", "longest"), fewest)))
        asked = asked.withColumn("need", F.least("shared", F.lit(MATCHES)))
        rare = Window.partitionBy("word").orderBy(F.coalesce("n", F.lit(0)), "pos")
        opened = asked.select("*", F.inline(pairs(F.col("word")))).join(self.counts, "pair", "left")
        # of all size + 1 pairs a text may miss size + 1 - shared
        opened = opened.withColumn("turn", F.row_number().over(rare)).where("turn <= size + 1 - shared + need").where("n > 0")
        opened = opened.select("word", "size", "longest", "need", "pair", F.col("pos").alias("at"))
        postings = self.postings
        named = [r["pair"] for r in opened.select("pair").distinct().limit(MOST_NAMED + 1).collect()]
        if len(named) <= MOST_NAMED:  # the scan leaves out files and row groups of other pairs
            postings = postings.where(F.col("pair").isin(named))
        longer = F.greatest("size", "length")
        near = (F.abs(F.col("pos") - F.col("at")) <= _edits(longer, percent)) & (F.col("length") <= F.col("longest"))
        met = postings.join(opened, "pair").where(near & (F.least("size", "length") * 100 >= longer * percent))
        met = met.groupBy("word", "need", "id").agg(F.count_distinct("at").alias("met"))
        return met.where("met >= need").select("word", "id")

    def _scored(self, found: DataFrame, least: float) -> DataFrame:
        """``word, key, score``: the best text of each key, if it reaches the ratio."""
        scored = found.withColumn("score", X.edit_ratio(F.col("text"), F.col("word"))).where(F.col("score") >= least)
        return scored.groupBy("word", "key").agg(F.max("score").alias("score"))

    def within(self, words: DataFrame, percent: int) -> DataFrame:
        """``word, key, score`` of all keys with a text whose edit ratio is ``percent`` (50 to 100) or more."""
        if not 50 <= percent <= 100:
            raise ValueError("pairs tell nothing of ratios below 50")
        words = words.where("word is not null").select("word").distinct()
        return self._scored(self.candidates(words, percent).join(self.names, "id"), percent)

    def walked(self, words: DataFrame, percent: int) -> DataFrame:
        """What :meth:`within` gives, of distinct words without nulls, by the tree of prefixes."""
        if not self.levels:
            return self._scored(self.names.crossJoin(words.select("word")), percent)
        # a number of its own, as Spark would put these few bytes into one task
        tasks = max(self.spark.sparkContext.defaultParallelism, -(-words.count() // WORDS_IN_TASK))
        met = words.select("word").repartition(tasks, "word")
        for level, after in zip(self.levels, [*self.levels[1:], None], strict=True):
            children = self.prefixes.where(F.col("level") == level)
            if level == self.levels[0]:  # about FANOUT prefixes, or the different first characters
                met = met.crossJoin(F.broadcast(children.select("prefix", "least", "most")))
            else:
                keys = F.explode(F.array(F.concat(F.lit("p"), "parent"), F.concat(F.lit("x"), "prefix")))
                children = children.select(keys.alias("key"), "prefix", "least", "most")
                met = met.join(F.broadcast(children) if self.sizes[level] <= MOST_SENT else children.hint("merge"), "key")
            keys = F.explode_outer(_lookups(percent, after and after - level))
            met = met.select("word", keys.alias("key")).where("key is not null")
        path = f"{self.path}/searches/{uuid.uuid4().hex}"
        met.write.parquet(path)
        met = self.spark.read.schema("word string, key string").parquet(path)
        if met.isEmpty():
            return self._scored(self.names.crossJoin(words.select("word").limit(0)), percent)
        rest, parts = met.select("word", F.substring("key", F.lit(2), F.length("key")).alias("begin"), F.substring("key", 1, 1).alias("kind")), []
        for kind, begin in (("p", F.substring("text", F.lit(1), F.lit(self.levels[-1]))), ("x", F.col("text"))):
            asked = rest.where(F.col("kind") == kind).select("word", "begin").hint("merge")
            parts.append(self.names.withColumn("begin", begin).join(asked, "begin").drop("begin"))
        return self._scored(parts[0].unionByName(parts[1]), percent)

    def everything(self, words: DataFrame) -> DataFrame:
        """``word, key, score`` of all keys: the words meet all texts, block by block."""
        blocks = -(-max(1, self.names.count()) // SCAN_BLOCK)
        asked = words.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        # by text and key, so that a text of very many keys is not one block
        dealt = self.names.withColumn("block", F.pmod(F.xxhash64("text", "key"), F.lit(blocks)).cast("int"))
        return self._scored(dealt.join(asked, "block"), 0)

    def nearest(self, words: DataFrame, n: int = 1, ties: bool = False, word: str = "word") -> DataFrame:
        """``word, key, score, rank``: the ``n`` keys nearest to each word, by the best of their texts.

        Of equal scores the smaller key is first; with ``ties`` all keys of the last score stay and share a
        rank. Null words are left out and repeated ones count once; with fewer than ``n`` keys all are given.
        Words are searched at falling bounds until a bound has ``n`` keys; those that have
        fewer at a ratio of 50 meet all texts. Every round is written below the index.
        """
        at, left, parts = f"{self.path}/searches/{uuid.uuid4().hex}", words.select(F.col(word).alias("word")).where("word is not null").distinct(), []
        for bound in (*BOUNDS, 0):
            found = self.walked(left, bound) if bound else self.everything(left)
            found.write.parquet(f"{at}/{bound}")
            found = self.spark.read.parquet(f"{at}/{bound}")
            if not bound:
                parts.append(found)
                break
            settled = found.groupBy("word").count().where(F.col("count") >= n).select("word")
            parts.append(found.join(settled, "word", "left_semi"))
            left.join(settled, "word", "left_anti").write.parquet(f"{at}/left-{bound}")
            left = self.spark.read.parquet(f"{at}/left-{bound}")
            if left.isEmpty():
                break
        place = F.rank() if ties else F.row_number()
        order = Window.partitionBy("word").orderBy(F.desc("score"), *([] if ties else ["key"]))
        ranked = reduce(DataFrame.unionByName, parts).withColumn("rank", place.over(order)).where(F.col("rank") <= n)
        return ranked.select(F.col("word").alias(word), "key", "score", "rank")


def node_index(catalog: DataFrame, path: str) -> NameIndex:
    """Index of a catalogue's nodes: the key is ``dna``, the texts are it and the node's name in lower case."""
    texts = F.explode(F.array(F.lower("dna"), F.lower("name")))
    return NameIndex.build(catalog.select(F.col("dna").alias("key"), texts.alias("text")), path)
