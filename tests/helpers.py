"""Fixtures with rows small enough to check by hand."""

from tierwell import Dimension, parse_timestamp

HIRES = [
    (1, "a", "2021-01-01T00:00:00Z", 1, 1),
    (2, "b", "2021-12-31T00:00:00Z", 1, 1),
    (3, "c", "2021-12-31T00:00:01Z", 1, 1),
    (4, "d", "2021-05-01T00:00:00Z", 99, 99),
    (5, "e", "2021-05-01T00:00:00Z", None, 2),
    (None, "f", "2021-08-01T00:00:00Z", 2, 2),
    (7, "g", "2020-12-31T23:59:59Z", 2, 2),
    (8, "h", "2021-05-01T00:00:00Z", 3, 1),
    (9, "i", None, 1, 1),
]
HIRES_DDL = "ID int, NAME string, DATETIME string, DEPARTMENT_ID int, JOB_ID int"
DEPARTMENTS = [(1, "Sales"), (2, "Legal"), (3, "UNKNOWN"), (4, "Empty")]
JOBS = [(1, "Dev"), (2, "Ops")]


def hires(spark, rows=HIRES):
    df = spark.createDataFrame(rows, HIRES_DDL)
    return df.withColumn("DATETIME", parse_timestamp("DATETIME"))


def departments(spark, rows=DEPARTMENTS):
    return Dimension(spark.createDataFrame(rows, "ID int, DEPARTMENT string"), "ID", "DEPARTMENT")


def jobs(spark, rows=JOBS):
    return Dimension(spark.createDataFrame(rows, "ID int, JOB string"), "ID", "JOB")


def rows(df):
    return [tuple(r) for r in df.collect()]


def plan(df):
    return df._jdf.queryExecution().toString()
