"""Dates in names of files."""

from pyspark.sql import functions as F

from gridseries.operators import lake
from gridseries.plans import base, lake_queries


def test_the_first_digits_of_a_key_are_no_date(spark):
    names = ["undated_LOW_000112310001.xlsx", "20240229_LOW_000112310001.xlsx", "R_20240301120000.xlsx", "k000112310001_20240302.xlsx", "20240230_R.xlsx"]
    got = lake.file_dates(spark.createDataFrame([(n,) for n in names], "file_name string")).collect()
    assert sorted((str(r["date"]), r["file_name"]) for r in got) == [("2024-02-29", names[1]), ("2024-03-01", names[2]), ("2024-03-02", names[3])]


def test_undated_files_of_large_keys_are_left_out(spark, tmp_path):
    keys = [97 * 1_157_836, 97 * 1_157_836 + 1]  # 112310092, so the padded key begins like the 31st of December of year 1
    stamps = spark.createDataFrame([(k, "5-LOW") for k in keys], "o_orderkey long, o_orderpriority string")
    stamps.selectExpr("*", "timestamp '1996-05-01' as o_orderdate").write.parquet(str(tmp_path / "orders.parquet"))
    assert base.files(spark, str(tmp_path)).count() == 2
    assert [r["file_name"] for r in lake_queries.file_dates(spark, str(tmp_path)).collect()] == [f"19960501_LOW_{keys[1]:012}.xlsx"]


def write_orders(spark, folder, rows):
    stamps = spark.createDataFrame([(k, "5-LOW", d) for k, d in rows], "o_orderkey long, o_orderpriority string, day string")
    stamps.selectExpr("o_orderkey", "o_orderpriority", "cast(day as timestamp) as o_orderdate").write.parquet(f"{folder}/orders.parquet")


# of multiples of 97, so undated: the padded keys begin like the first of January of year 0 and the 31st of December of year 1
UNDATED = [97 * 10_413, 97 * 1_157_836]


def test_coverage_is_not_widened_by_undated_files_of_large_keys(spark, tmp_path):
    write_orders(spark, tmp_path, [(1, "1996-05-01"), (2, "2001-08-01"), *((k, "1999-01-01") for k in UNDATED)])
    names = ["min_potential", "max_potential", "min_observed", "max_observed"]
    got = lake_queries.lake_coverage(spark, str(tmp_path)).select(*[F.col(c).cast("date").cast("string") for c in names], "up_to_date").collect()
    assert [tuple(r) for r in got] == [("1996-05-21", "2001-08-01", "1996-05-01", "2001-08-01", True)]


def test_no_version_is_picked_of_undated_files_of_large_keys(spark, tmp_path):
    alike = 97 * 2_057_783_609  # 199605010073, so it would be the second version of a day that has one
    dated = [(1, "1996-05-01"), (2, "1996-05-02"), (3, "1996-05-02"), (4, "1996-05-02")]
    write_orders(spark, tmp_path, [*dated, *((k, "1999-01-01") for k in [*UNDATED, alike])])
    got = lake_queries.pick_version(spark, str(tmp_path)).select(F.col("date").cast("date").cast("string"), "file_name", "true_version").collect()
    assert sorted(tuple(r) for r in got) == [("1996-05-01", "19960501_LOW_000000000001.xlsx", 1), ("1996-05-02", "19960502_LOW_000000000003.xlsx", 2)]
