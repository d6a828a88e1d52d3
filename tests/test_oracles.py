"""Every registered query against its SQL, and the shape of the registry."""

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con(sf):
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return con


def rows(frame: pd.DataFrame) -> list[tuple]:
    def text(v):
        if v is None or v is pd.NaT or v is pd.NA or v != v:
            return "null"
        return f"{v:.10g}" if isinstance(v, float) else str(v)

    frame = frame[sorted(frame.columns)]
    return sorted(tuple(map(text, r)) for r in frame.itertuples(index=False))


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query(spark, sf, con, name):
    got, want = entry.queries()[name](spark, sf).toPandas(), con.execute(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_flagship(spark):
    assert entry.entry(spark).count() > 0
