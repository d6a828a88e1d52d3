"""Searches by edit ratio through the index of pairs, against all comparisons."""

import random
import tempfile

import pytest
from pyspark.sql import functions as F

from gridseries.operators import catalog, names


def folder():
    return tempfile.mkdtemp(prefix="spark-", dir="/tmp")


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, before = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[j - 1] + 1, before[j - 1] + (x != y)))
    return row[-1]


def ratio(a, b):
    longest = max(len(a), len(b))
    return 100.0 if not longest else 100.0 * (longest - distance(a, b)) / longest


def drawn(n, seed, letters="abcdé"):
    draw = random.Random(seed)
    return ["".join(draw.choice(letters) for _ in range(draw.randrange(0, 14))) for _ in range(n)]


@pytest.fixture(scope="module")
def entries():
    texts = drawn(220, 1)
    rows = [(f"k{i % 150:03}", t) for i, t in enumerate(texts)]  # keys of two texts
    rows += [(f"z{i:03}", texts[0]) for i in range(30)]  # a text of many keys
    return [*rows, rows[0], (None, "ab"), ("none", None)]


@pytest.fixture(scope="module")
def index(spark, entries):
    frame = spark.createDataFrame(entries, "key string, text string").withColumn("id", F.lit(1)).withColumn("pair", F.lit("x"))
    return names.NameIndex.build(frame, folder())


def all_scores(entries, word):
    best = {}
    for key, text in entries:
        if key is not None and text is not None:
            best[key] = max(best.get(key, 0.0), ratio(text, word))
    return best


WORDS = [*drawn(25, 2), "", "abcdéabcdé", "xyz", "abab" * 9]


@pytest.mark.parametrize("percent", [50, 60, 75, 90, 100])
def test_no_text_within_a_bound_is_missed(spark, index, entries, percent):
    found = index.within(spark.createDataFrame([(w,) for w in WORDS] + [(None,), ("",)], "word string"), percent).collect()
    want = {(w, k): s for w in WORDS for k, s in all_scores(entries, w).items() if s >= percent}
    assert {(r["word"], r["key"]): pytest.approx(r["score"]) for r in found} == want
    assert len(found) == len(want)


@pytest.mark.parametrize("n, ties", [(1, False), (4, False), (1, True), (1000, False)])
def test_nearest_is_exact(spark, index, entries, n, ties):
    found = index.nearest(spark.createDataFrame([(w,) for w in WORDS], "word string"), n, ties).collect()
    got = {}
    for r in found:
        got.setdefault(r["word"], []).append((r["rank"], r["key"], round(r["score"], 9)))
    for word in WORDS:
        ranked = sorted(((-s, k) for k, s in all_scores(entries, word).items()))
        if ties:
            want = [(1, k, round(-s, 9)) for s, k in ranked if s == ranked[0][0]]
        else:
            want = [(i, k, round(-s, 9)) for i, (s, k) in enumerate(ranked[:n], 1)]
        assert sorted(got[word]) == want


def test_an_empty_table_and_no_words(spark, index):
    empty = names.NameIndex.build(spark.createDataFrame([], "key string, text string"), folder())
    assert empty.nearest(spark.createDataFrame([("a",)], "word string")).count() == 0
    assert index.nearest(spark.createDataFrame([], "word string")).count() == 0


def test_few_texts_are_compared(spark):
    known = spark.range(20_000).select(F.concat(F.lit("station#"), F.lpad(F.col("id").cast("string"), 9, "0")).alias("key"))
    index = names.NameIndex.build(known.withColumn("text", F.col("key")), folder())
    words = spark.createDataFrame([("staton#000012345",), ("station#00001733",)], "word string")
    assert index.candidates(words, 90).count() < 2 * 20_000 / 20
    plan = index.within(words, 90)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan and "In(pair" in plan


def test_fuzzy_search_is_the_same_with_an_index(spark):
    rows = [(p, r, f"{r}_{i}") for p in ("North", "South") for r in ("load", "price") for i in range(40)]
    tree = catalog.build_catalog(spark.createDataFrame(rows, "publisher string, report string, field string"), ["publisher", "report", "field"])
    index = names.node_index(tree, folder())
    cases = [(["Price_12"], 5, None), (["south", "LOAD_3"], 500, None), (["nothing like it", "north.price"], 5, "report"), (["a", "A"], None, None)]
    for words, pool, kind in cases:
        plain = catalog.fuzzy_search(tree, words, 7, kind, pool).collect()
        assert catalog.fuzzy_search(tree, words, 7, kind, pool, index).collect() == plain


@pytest.mark.parametrize("percent", [50, 60, 75, 95, 100])
def test_no_text_is_missed_by_prefixes(spark, index, entries, percent, monkeypatch):
    monkeypatch.setattr(names, "FANOUT", 3)
    tall = names.NameIndex.build(spark.createDataFrame(entries, "key string, text string"), folder())
    assert len(tall.levels) > len(index.levels)
    words = spark.createDataFrame([(w,) for w in dict.fromkeys(WORDS)], "word string")
    want = {(w, k): s for w in WORDS for k, s in all_scores(entries, w).items() if s >= percent}
    for one in (index, tall):
        found = one.walked(words, percent).collect()
        assert {(r["word"], r["key"]): pytest.approx(r["score"]) for r in found} == want and len(found) == len(want)


def test_numbered_names_are_met_by_few(spark):
    known = spark.range(20_000).select(F.concat(F.lit("station#"), F.lpad(F.col("id").cast("string"), 9, "0")).alias("key"))
    index = names.NameIndex.build(known.withColumn("text", F.col("key")), folder())
    met = []
    index._scored, scored = lambda found, least: met.append((least, found.count())) or scored(found, least), index._scored
    got = index.nearest(spark.createDataFrame([(f"staton#{i:08}",) for i in range(0, 20_000, 500)], "word string"), 1).collect()
    assert len(got) == 40 and all(r["key"] == f"station#{r['word'][7:]:0>9}" for r in got)
    assert sum(n for _, n in met) < 40 * 500  # by pairs a bound of 75 made nearly all 40 * 20,000 of them


def test_words_are_dealt_to_tasks_and_spent_edits_looked_up(spark, monkeypatch):
    monkeypatch.setattr(names, "WORDS_IN_TASK", 5, raising=False)
    known = spark.range(20_000).select(F.concat(F.lit("station#"), F.lpad(F.col("id").cast("string"), 9, "0")).alias("key"))
    index = names.NameIndex.build(known.withColumn("text", F.col("key")), folder())
    words = spark.createDataFrame([(f"staton#{i:08}",) for i in range(0, 20_000, 400)], "word string")
    index.walked(words, 85)
    written = spark.read.parquet(f"{index.path}/searches/*")
    assert written.select(F.input_file_name()).distinct().count() > 5
    assert written.where("key like 'x%'").count() > written.where("key like 'p%'").count()
