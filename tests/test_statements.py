"""Statements on the layers, and trusted tables laid out by key."""

import pytest
from helpers import plan, rows
from pyspark.sql import functions as F
from test_loads import ENTITIES, FILES, base, source, sources, trusted  # noqa: F401

from tierwell import (
    DEPARTMENT,
    HIRED_EMPLOYEE,
    Entity,
    create_tables,
    hires_by_quarter,
    load_entity,
    merge_into_trusted,
    read_layer,
    run_statement,
)
from tierwell.plans import loads
from tierwell.sources import catalogue
from tierwell.sources.layers import TRUSTED, drop_unpublished

INSERT_DEPARTMENTS = """
    INSERT INTO TRUSTED.DEPARTMENT (ID, DEPARTMENT)
    SELECT r.ID, r.DEPARTMENT FROM RAW.DEPARTMENT AS r
    WHERE NOT EXISTS (SELECT 1 FROM TRUSTED.DEPARTMENT AS t WHERE t.ID = r.ID)
"""
INSERT_HIRES = """
    INSERT INTO trusted.hired_employee (ID, NAME, DATETIME, DEPARTMENT_ID, JOB_ID)
    SELECT ID, NAME, to_timestamp_ntz(DATETIME), DEPARTMENT_ID, JOB_ID FROM raw.hired_employee r
    WHERE NOT EXISTS (SELECT 1 FROM trusted.hired_employee t WHERE t.ID = r.ID)
"""


def written(df):
    return [(r.layer, r.entity, r.rows) for r in df.collect()]


def test_insert_if_absent_as_a_statement(spark, base, tmp_path):
    loads.write_raw(spark, DEPARTMENT, source(tmp_path, "1,a\n2,b\n,none"), base, "one")
    # Without the policies of a load: a null key enters each time.
    assert written(run_statement(spark, base, INSERT_DEPARTMENTS)) == [("trusted", "department", 3)]
    assert written(run_statement(spark, base, INSERT_DEPARTMENTS)) == [("trusted", "department", 1)]
    loads.write_raw(spark, DEPARTMENT, source(tmp_path, "2,changed\n3,c", "two.csv"), base, "two")
    assert written(run_statement(spark, base, INSERT_DEPARTMENTS))[0][2] == 2
    assert trusted(spark, base, DEPARTMENT) == [(1, "a"), (2, "b"), (3, "c")] + [(None, "none")] * 3


def test_a_failed_statement_leaves_no_row(spark, base, tmp_path):
    text = "\n".join(f"{k},{'x' if k == 700 else k}" for k in range(1000))
    loads.write_raw(spark, DEPARTMENT, source(tmp_path, text), base, "one")
    bad = "INSERT INTO trusted.department (ID, DEPARTMENT) SELECT ID, CAST(DEPARTMENT AS INT) FROM raw.department"
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        run_statement(spark, base, bad)
    assert trusted(spark, base, DEPARTMENT) == []
    create_tables(spark, base)
    assert spark.table("trusted.department").count() == 0
    run_statement(spark, base, INSERT_DEPARTMENTS)
    assert len(trusted(spark, base, DEPARTMENT)) == 1000


def test_a_statement_run_again_replaces_its_rows(spark, base, tmp_path):
    loads.write_raw(spark, DEPARTMENT, source(tmp_path, "1,a\n2,b"), base, "one")
    for _ in range(2):
        assert written(run_statement(spark, base, INSERT_DEPARTMENTS, "s"))[0][2] == 2
    assert trusted(spark, base, DEPARTMENT) == [(1, "a"), (2, "b")]
    assert drop_unpublished(spark, base, TRUSTED, "department") == 1
    with pytest.raises(ValueError, match="a statement"):
        merge_into_trusted(spark, DEPARTMENT, base, "s")
    with pytest.raises(ValueError, match="not written by a statement"):
        run_statement(spark, base, INSERT_DEPARTMENTS, "one")


def test_hires_by_statement_are_in_their_years(spark, base, sources):
    for name, entity in ENTITIES.items():
        if name != "hired_employee":
            load_entity(spark, entity, sources[name], base, on_error="raise")
    loads.write_raw(spark, HIRED_EMPLOYEE, sources["hired_employee"], base, "one", null_keys="insert")
    run_statement(spark, base, INSERT_HIRES)
    report = rows(hires_by_quarter(spark, base, 2021))
    other = f"{base}-loaded"
    for name, entity in ENTITIES.items():
        load_entity(spark, entity, sources[name], other, on_error="raise", null_keys="insert", source_duplicates="keep")
    assert report == rows(hires_by_quarter(spark, other, 2021)) and report
    folders = spark.table("trusted.hired_employee").select("event_year").distinct()
    assert sorted(r.event_year or 0 for r in folders.collect()) == [0, 2020, 2021]


def test_tables_of_others_are_left_alone(spark, base):
    spark.sql("CREATE DATABASE IF NOT EXISTS trusted")
    spark.sql("DROP TABLE IF EXISTS trusted.department")
    spark.sql("CREATE TABLE trusted.department (x INT) USING parquet")
    try:
        with pytest.raises(ValueError, match="left alone"):
            create_tables(spark, base)
    finally:
        spark.sql("DROP TABLE trusted.department")


# --- layout by key -------------------------------------------------------------------------------

BUCKETED = Entity("department", DEPARTMENT.schema, buckets=8)
HIRES = Entity(
    "hired_employee", HIRED_EMPLOYEE.schema, timestamps=("DATETIME",), year_of="DATETIME", buckets=8
)


def test_bucketed_loads_give_the_same_rows(spark, base, tmp_path, sources):
    plain = f"{base}-plain"
    texts = ["1,a\n2,b\n2,c\n,x", "2,d\n3,e", "1,z\n9,y\n3,q"]
    for folder, entity in ((base, BUCKETED), (plain, DEPARTMENT)):
        counts = []
        for k, text in enumerate([*texts, texts[1]]):
            path = source(tmp_path, text, f"{k}.csv")
            load_id = f"l{1 if k == 3 else k}"
            counts.append(load_entity(spark, entity, path, folder, load_id=load_id, on_error="raise").first().rows_trusted)
        assert counts == [2, 1, 1, 1]
    assert trusted(spark, base, BUCKETED) == trusted(spark, plain, DEPARTMENT)
    for folder, entity in ((base, HIRES), (plain, HIRED_EMPLOYEE)):
        load_entity(spark, entity, sources["hired_employee"], folder, load_id="h", on_error="raise")
    assert trusted(spark, base, HIRES) == trusted(spark, plain, HIRED_EMPLOYEE)


def test_a_bucketed_merge_moves_only_its_source(spark, base, tmp_path, no_broadcast):
    for load_id, start in (("a", 0), ("b", 50)):
        text = "\n".join(f"{k},d{k}" for k in range(start, start + 100))
        load_entity(spark, BUCKETED, source(tmp_path, text, f"{load_id}.csv"), base, load_id=load_id, on_error="raise")
    new = spark.range(100, 400).select(F.col("id").cast("int").alias("ID"), F.lit("n").alias("DEPARTMENT"))
    with catalogue.registered(spark, base, TRUSTED, BUCKETED) as table:
        absent = loads.absent_rows(new, spark.table(table), ["ID"], source_duplicates="first", order_by=["DEPARTMENT"])
        text = absent._jdf.queryExecution().executedPlan().toString()
        assert absent.count() == 250
    target = text[text.index("FileScan") - 600 :]
    assert "Bucketed: true" in target and text.count("Exchange hashpartitioning") == 1
    # Read by path, as reports do, the target would be moved as well.
    others = read_layer(spark, base, TRUSTED, "department", DEPARTMENT.trusted_table_schema)
    moved = plan(loads.absent_rows(new, others, ["ID"], source_duplicates="first", order_by=["DEPARTMENT"]))
    assert moved[moved.index("Physical Plan") :].count("Exchange hashpartitioning") == 2


def test_each_bucket_is_sorted_and_holds_its_keys(spark, base, tmp_path):
    text = "\n".join(f"{k * 7 % 1000},d" for k in range(1000))
    load_entity(spark, BUCKETED, source(tmp_path, text), base, load_id="a", on_error="raise")
    rows_ = read_layer(spark, base, TRUSTED, "department", BUCKETED.trusted_table_schema)
    placed = rows_.select(
        "ID", F.pmod(F.hash("ID"), F.lit(8)).alias("bucket"),
        F.regexp_extract(F.col("_metadata.file_name"), r"_(\d{5})\.c", 1).cast("int").alias("file"),
    )
    assert placed.filter("bucket <> file").count() == 0 and placed.select("file").distinct().count() == 8
    in_order = rows_.select("ID", F.col("_metadata.file_name").alias("f"), F.col("_metadata.row_index").alias("i"))
    files = {}
    for r in in_order.orderBy("f", "i").collect():
        files.setdefault(r.f, []).append(r.ID)
    assert sum(map(len, files.values())) == 1000 and all(ids == sorted(ids) for ids in files.values())
