"""Tasks that fail after part of their output: results stay whole."""

from pyspark import TaskContext
from pyspark.sql import functions as F

from tierwell import absent_rows, append_in_batches, first_per_key, new_shared_path, number_rows


def rows_of_failing_tasks(spark):
    """20,000 rows; every third task passes rows on and then fails in its first attempt."""

    def failing(batches):
        task = TaskContext.get()
        for batch in batches:
            yield batch
            if task.attemptNumber() == 0 and task.partitionId() % 3 == 0:
                raise RuntimeError("lost")

    rows = spark.range(0, 20000, 1, 8).selectExpr("id", "id % 3 AS v")
    return rows.mapInArrow(failing, rows.schema)


def numbers(numbered):
    columns = ["id", "row_number"]
    distinct = [F.count_distinct(c) for c in columns]
    return tuple(numbered.agg(F.count("*"), *distinct, F.max("row_number")).first())


def test_numbers_stay_dense(spark):
    assert numbers(number_rows(rows_of_failing_tasks(spark))) == (20000,) * 4


def test_numbers_in_order_stay_dense(spark):
    numbered = number_rows(rows_of_failing_tasks(spark), ["v"])
    assert numbers(numbered) == (20000,) * 4
    assert numbered.filter("v = 0").agg(F.max("row_number")).first()[0] == 6667


def test_appended_rows_are_there_once(spark):
    path = new_shared_path(spark, "appended")
    append_in_batches(rows_of_failing_tasks(spark), path, 100)
    table = spark.read.parquet(path)
    assert table.count() == table.distinct().count() == 20000


def test_merge_stays_whole(spark):
    source = rows_of_failing_tasks(spark)
    target = spark.range(100)
    assert absent_rows(source, target, ["id"]).count() == 19900
    first = first_per_key(source, ["v"], ["id"])
    assert sorted(tuple(r) for r in first.collect()) == [(0, 0), (1, 1), (2, 2)]
