"""Cleaning of sheets that are dealt by file already shuffles no cell again; no task sorts the lines of a ladder."""

from gridseries.operators import cells
from gridseries.plans import cell_queries, source_queries


def shuffles(frame):
    return frame._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_cleaning_keeps_the_deal_by_file(spark, sf):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for run in (cell_queries.drop_sparse, cell_queries.promote_header):
            assert shuffles(run(spark, sf)) == 1, run.__name__
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_unnamed_rows_and_empty_sheets(spark):
    rows = [("a", 0, 0, "x"), ("a", 0, 1, None), ("a", 1, 0, "h"), ("a", 1, 1, "i"), ("a", 2, 0, "1"), ("a", 2, 1, "2"), ("a", 2, 2, "3"), (None, 0, 0, "y"), (None, 0, 1, "z"), ("b", 0, 0, None)]
    grid = spark.createDataFrame(rows, "file string, row int, col int, cell string")
    assert sorted(tuple(r) for r in cells.drop_sparse(grid, "rows", 2).collect()) == rows[2:7]
    got = cells.promote_header(grid, 2).select("file", "row", "col", "cell", "property").collect()
    assert sorted(map(tuple, got)) == [("a", 2, 0, "1", "h"), ("a", 2, 1, "2", "i"), ("a", 2, 2, "3", None)]


def test_every_ladder_file_has_its_two_header_rows_and_no_sort(spark, sf, monkeypatch, tmp_path):
    monkeypatch.setattr(source_queries, "scratch", lambda spark, name: str(tmp_path / name))
    n = source_queries.read_ladder(spark, sf).count()
    files = [p.read_text().splitlines() for p in (tmp_path / "ladder").glob("part-*")]
    assert files and all(f[0].startswith(",,Buy") and f[1].startswith("datetime,AA") and not any(line.startswith((",", "d")) for line in f[2:]) for f in files)
    assert n >= sum(len(f) - 2 for f in files) > 0
