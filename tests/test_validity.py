"""Validity windows against a plain walk over the days."""

import datetime as dt
import random

from gridseries.operators import validity

D = dt.date
SCHEMA = "border string, ord int, from_date date, to_date date, mw double"


def plain(windows):
    """``(border, day) -> (ord, mw)`` of the last window of each day."""
    held = {}
    for border, ord_, a, b, mw in windows:
        if None in (ord_, a, b):
            continue
        for n in range((b - a).days + 1):
            at = (border, a + dt.timedelta(n))
            held[at] = max(held.get(at, (ord_, mw)), (ord_, mw))
    return held


def drawn(seed=3):
    draw = random.Random(seed)
    rows = []
    for ord_ in range(60):
        a = D(1969, 12, 1) + dt.timedelta(draw.randrange(90))
        rows.append((draw.choice(["A", "B", None]), ord_, a, a + dt.timedelta(draw.choice([-2, 0, 1, 3, 8, 40])), float(ord_ % 7)))
    return rows


def test_segments_are_the_days_of_the_last_windows(spark):
    rows = drawn() + [("A", None, D(1970, 1, 1), D(1970, 1, 9), 1.0), ("B", 99, None, D(1970, 1, 9), 1.0), ("A", 98, D(1970, 1, 2), None, 1.0)]
    found = validity.disjoint_segments(spark.createDataFrame(rows, SCHEMA).repartition(7), ["border"], ["mw"]).collect()
    days = [((r["border"], r["from_date"] + dt.timedelta(n)), (r["ord"], r["mw"])) for r in found for n in range((r["to_date"] - r["from_date"]).days + 1)]
    assert len(days) == len(dict(days))  # none twice
    assert dict(days) == plain(rows)
    ends = {(r["border"], r["to_date"]): r["ord"] for r in found}
    assert all(ends.get((r["border"], r["from_date"] - dt.timedelta(1))) != r["ord"] for r in found)  # as few as can be


def test_days_ask_their_window(spark):
    rows = [r for r in drawn(5) if r[0]]
    days = [(b, D(1969, 11, 20) + dt.timedelta(n)) for b in "AB" for n in range(150)]
    found = validity.holding(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(days, "border string, day date"), ["border"], ["mw"]).collect()
    assert {(r["border"], r["day"]): (r["ord"], r["mw"]) for r in found} == {k: v for k, v in plain(rows).items() if k in set(days)}


def test_a_window_of_centuries_is_few_rows(spark):
    rows = [("A", 1, D(1, 1, 1), D(9999, 12, 31), 1.0), ("A", 2, D(2024, 2, 29), D(2024, 2, 29), 2.0), ("A", 3, D(1900, 1, 1), D(1999, 12, 31), 3.0)]
    windows = spark.createDataFrame(rows, SCHEMA)
    assert validity.blocks_of(windows, ["border"], ["mw"]).count() < 90
    found = [tuple(r) for r in validity.disjoint_segments(windows, ["border"], ["mw"]).orderBy("from_date").collect()]
    assert [(r[1], r[2], r[3]) for r in found] == [
        (D(1, 1, 1), D(1899, 12, 31), 1), (D(1900, 1, 1), D(1999, 12, 31), 3), (D(2000, 1, 1), D(2024, 2, 28), 1), (D(2024, 2, 29), D(2024, 2, 29), 2), (D(2024, 3, 1), D(9999, 12, 31), 1),
    ]


def test_no_windows_and_equal_windows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert validity.disjoint_segments(empty, ["border"], ["mw"]).count() == 0
    twice = spark.createDataFrame([("A", 1, D(2024, 1, 1), D(2024, 1, 3), 1.0)] * 2 + [("A", 1, D(2024, 1, 2), D(2024, 1, 2), 5.0)], SCHEMA)
    found = validity.disjoint_segments(twice, ["border"], ["mw"]).orderBy("from_date").collect()
    assert [r["mw"] for r in found] == [1.0, 5.0, 1.0]
