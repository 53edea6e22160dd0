"""Row numbers over loads."""

from pyspark.sql import Window
from pyspark.sql import functions as F
from test_loads import base, source  # noqa: F401

from tierwell import DEPARTMENT, append_in_batches, compact, number_loads
from tierwell import checks
from tierwell.plans.loads import write_raw
from tierwell.sources.layers import RAW, drop_unpublished, published


def load(spark, base, tmp_path, load_id, start, n, max_records=None):
    text = "\n".join(f"{start + i},{load_id}" for i in range(n))
    write_raw(spark, DEPARTMENT, source(tmp_path, text, f"{load_id}.csv"), base, load_id, max_records)


def numbers(df):
    return sorted((r.row_number, r.ID) for r in df.collect())


def test_numbers_go_on(spark, base, tmp_path):
    load(spark, base, tmp_path, "a", 100, 5)
    first = numbers(number_loads(spark, base, DEPARTMENT))
    load(spark, base, tmp_path, "b", 0, 7, max_records=2)
    load(spark, base, tmp_path, "c", 50, 3)
    every = numbers(number_loads(spark, base, DEPARTMENT))
    assert every == list(enumerate([*range(100, 105), *range(7), *range(50, 53)], 1))
    assert every[:5] == first and numbers(number_loads(spark, base, DEPARTMENT, "b")) == every[5:12]
    # Run again a load keeps its place; with more rows those behind it move.
    load(spark, base, tmp_path, "b", 0, 7)
    assert numbers(number_loads(spark, base, DEPARTMENT)) == every
    load(spark, base, tmp_path, "b", 0, 9)
    assert numbers(number_loads(spark, base, DEPARTMENT, "c")) == [(15, 50), (16, 51), (17, 52)]
    compact(spark, base, RAW, DEPARTMENT)
    drop_unpublished(spark, base, RAW, "department")
    packed = numbers(number_loads(spark, base, DEPARTMENT))
    assert packed == list(enumerate([*range(100, 105), *range(9), *range(50, 53)], 1))


def test_one_load_reads_no_other(spark, base, tmp_path):
    load(spark, base, tmp_path, "a", 0, 5)
    load(spark, base, tmp_path, "b", 10, 5)
    read = number_loads(spark, base, DEPARTMENT, "b").inputFiles()
    assert not any("load_id=a" in f for f in read)
    assert {a.rows for a in published(spark, base, RAW, "department").values()} == {5}


def test_no_loads_no_numbers(spark, base):
    assert number_loads(spark, base, DEPARTMENT).collect() == []
    append_in_batches(number_loads(spark, base, DEPARTMENT), f"{base}/none")


def numbered(spark, files=("x", "y")):
    """Numbers 1..n of one load over three stretches, in two files that take turns, with steps back within a stretch and
    between two, a null, and one number twice."""
    n = 70_000
    rows = spark.range(1, n + 1).selectExpr(
        "'a' AS load_id",
        f"IF(id % 2 = 0, '{files[0]}', '{files[1]}') AS source_file",
        "CASE WHEN id IN (11, 32769, 65540) THEN '0' WHEN id = 101 THEN NULL ELSE lpad(id, 9, '0') END AS DATETIME",
        "id AS row_number",
    )
    return rows.unionByName(rows.filter("row_number = 7").withColumn("source_file", F.lit("z"))), n


def test_check_of_numbers_by_stretches_is_that_by_files(spark):
    rows, n = numbered(spark)
    per_file = Window.partitionBy("load_id", "source_file").orderBy("row_number")
    back = (F.col("DATETIME") < F.lag("DATETIME").over(per_file)).cast("int")
    expected = rows.withColumn("back", back).groupBy("load_id").agg(
        F.min("row_number"), F.max("row_number"), F.count_distinct("row_number"), F.count("*"), F.sum("back")
    )
    made = checks._numbers_of_loads(rows, n).collect()
    assert [tuple(r) for r in made] == [tuple(r) for r in expected.collect()] == [("a", 1, n, n, n + 1, 3)]


def test_check_of_numbers_sends_no_whole_file_to_a_task(spark, monkeypatch):
    monkeypatch.setattr(checks, "ROWS_A_TASK", 1 << 15)
    rows, n = numbered(spark, ("x", "x"))
    plan = checks._numbers_of_loads(rows, n)._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert len(windows) == 2 and "source_file" in windows[1] and "stretch" in windows[1].split("], [")[1]
    assert "hashpartitioning(load_id" in plan and f", {-(-n // (1 << 15))}), REPARTITION_BY_NUM" in plan
