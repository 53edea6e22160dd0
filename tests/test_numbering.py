"""Row numbers and batches."""

import pytest
from pyspark.sql import functions as F

from tierwell import (
    append_in_batches,
    assign_batches,
    batch_counts,
    new_shared_path,
    number_of_batches,
    number_rows,
    number_table_rows,
)


@pytest.mark.parametrize("partitions", [1, 3, 7])
def test_numbers_follow_arrival_without_gaps(spark, partitions):
    df = spark.range(0, 5001, 1, partitions)
    numbered = number_rows(df)
    assert numbered.columns == ["id", "row_number"]
    assert numbered.filter("row_number <> id + 1").count() == 0
    assert numbered.count() == 5001


def test_staged_table_is_where_the_caller_says(spark, tmp_path):
    path = f"file://{tmp_path}/numbered"
    assert number_rows(spark.range(10), path=path).inputFiles()[0].startswith(f"file://{tmp_path}")
    assert spark.read.parquet(path).count() == 10


def test_uneven_and_empty_partitions(spark):
    df = spark.range(0, 1000, 1, 10).filter("id < 7 or id between 300 and 777")
    numbers = [r[0] for r in number_rows(df).select("row_number").orderBy("row_number").collect()]
    assert numbers == list(range(1, 486))
    assert number_rows(df.filter("id < 0")).count() == 0


def test_given_order_with_a_value_held_by_most_rows(spark):
    df = spark.range(0, 20000, 1, 6).select(
        "id", F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(5).alias("v")
    )
    numbered = number_rows(df, ["v"])
    expected = df.collect()
    expected = {r.id: i for i, r in enumerate(sorted(expected, key=lambda r: (r.v, r.id)), 1)}
    assert {r.id: r.row_number for r in numbered.collect()} == expected


def test_stored_tables_are_numbered_by_file_and_place(spark):
    path = new_shared_path(spark, "table")
    spark.range(0, 5000, 1, 7).selectExpr("id", "id % 3 as v").write.parquet(path)
    append_in_batches(spark.range(5000, 9999, 1, 2).selectExpr("id", "0L as v"), path, 700)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4KB")
    try:
        numbered = number_table_rows(spark.read.parquet(path))
        assert numbered.columns == ["id", "v", "row_number"]
        found = numbered.collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted(r.row_number for r in found) == list(range(1, 10000))
    by_id = {r.id: r.row_number for r in found}
    assert all(by_id[i + 1] == by_id[i] + 1 for i in range(5000, 5600))
    again = number_table_rows(spark.read.parquet(path)).select("id").join(numbered, "id")
    assert again.count() == 9999


def test_batches_are_full_but_for_the_last(spark):
    batched = assign_batches(number_rows(spark.range(0, 4321, 1, 5)), 1000)
    counts = {r.batch_id: r.records for r in batch_counts(batched).collect()}
    assert counts == {0: 1000, 1: 1000, 2: 1000, 3: 1000, 4: 321}
    assert number_of_batches(spark.range(4321), 1000).first().batches == 5
    assert number_of_batches(spark.range(0), 1000).first().batches == 0


def test_batched_append_caps_files_and_keeps_rows(spark):
    path = new_shared_path(spark, "batched")
    df = spark.range(0, 15000, 1, 1)
    append_in_batches(df, path, 1000)
    append_in_batches(df, path, 1000)
    files = (
        spark.read.parquet(path).groupBy(F.col("_metadata.file_path")).count().collect()
    )
    assert sorted(r["count"] for r in files) == [1000] * 30
