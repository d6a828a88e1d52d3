import re
from itertools import permutations

import pytest

from gridseries.llm import filter_audit as A


def brute(docs, labels):
    """Documents (id, source, text) one by one through every order."""
    rows = []
    for i, source, text in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {
            "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
            "D": re.search(r"[#$%&*|]", text) is not None, "E": i is not None and any(j is not None and j < i and (t or "") == text for j, _, t in docs),
        }
        own = [x for x in labels if x[0] == i and i is not None]
        rows.append((source or "", fails, any(q == 1 for _, q, _ in own), any(t == 1 for _, _, t in own)))
    out, shapley = {}, {}
    for part in {r[0] for r in rows}:
        for order in map("".join, permutations("ABCDE")):
            left = [r for r in rows if r[0] == part]
            every = left
            for step, x in enumerate(order, 1):
                gone = [r for r in left if r[1][x]]
                redundant = sum(r[1][x] for r in every) - len(gone)
                left = [r for r in left if not r[1][x]]
                unique = sum(r[1][x] and sum(r[1].values()) == 1 for r in every)
                out[part, order, step] = (len(left), len(gone), redundant, unique, sum(r[2] for r in gone), sum(r[3] for r in gone))
                shapley[part, x] = shapley.get((part, x), 0) + len(gone)
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def found(frame):
    rows = [((r.part, r.filter_order, r.step), tuple(r[c] for c in (*A.COUNTS, "shapley"))) for r in frame.collect()]
    assert len(dict(rows)) == len(rows)
    return dict(rows)


LONG = " ".join(f"w{k}" for k in range(250))
SAME = "word " * 300
DOCS = [
    (1, "a", LONG), (2, "a", LONG), (3, "b", LONG), (3, "b", LONG), (4, None, LONG), (None, "a", LONG), (5, "a", "SHORT #1"), (6, "", None), (7, "a", ""), (8, None, SAME), (9, "c", SAME + "$"),
    (10, "c", LONG + " ABCDEFGHIJKLMNOPQRSTUVWXYZ ABCDEFGHIJKLMNOPQRSTUVWXYZ"), (11, "c", "é" * 100 + " ÉÀ"), (1, "c", LONG), (12, "d", "one\x0btwo three\x1cfour"), (13, "d", "a b " * 120_000), (None, "d", LONG),
]
LABELS = [(1, 1, 0), (2, 0, 1), (3, 1, None), (3, 0, 1), (5, None, 1), (None, 1, 1), (10, 1, 1), (99, 1, 1)]


def test_against_brute_force(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, source string, text string").selectExpr("*", "1 AS id", "'x' AS part", "2 AS n", "0 AS mask", "true AS good")
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    got = found(A.audit(A.cells(docs, labels)))
    assert got == brute(DOCS, LABELS)
    assert len(got) == 600 * len({s or "" for _, s, _ in DOCS})


def test_empty_tables(spark):
    docs, labels = spark.createDataFrame(DOCS, "doc_id long, source string, text string"), spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    assert A.audit(A.cells(docs.limit(0), labels)).count() == 0
    assert found(A.audit(A.cells(docs, labels.limit(0)))) == brute(DOCS, [])


def test_other_filters(spark):
    docs, labels = spark.createDataFrame(DOCS, "doc_id long, source string, text string"), spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    got = A.audit(A.cells(docs, labels, lambda text: {"S": text == ""}, "R"), "SR").where("part = 'a' and filter_order = 'SR'").orderBy("step").collect()
    assert [(r.kept, r.removed, r.redundant) for r in got] == [(4, 1, 0), (3, 1, 1)]
    with pytest.raises(ValueError, match="filters"):
        A.audit(A.cells(docs, labels), "ABCDEFG")


def test_counts_before_the_digest_shuffle_and_no_python(spark, sf):
    plan = A.op12_filter_audit(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
    assert "partial_min" in plan
