"""What the plans must look like to hold on large tables."""

import re

import pytest
from helpers import plan
from pyspark.sql import functions as F

from tierwell import (
    HIRED_EMPLOYEE,
    Dimension,
    absent_rows,
    first_per_key,
    groups_above_mean,
    hires_by_quarter,
    load_entity,
    new_shared_path,
    number_rows,
    number_table_rows,
    quarterly_counts,
)
from tierwell.operators import counts
from tierwell.plans import loads

FOLDER = "/root/testdata/sf0.01"
SHIPPED = {"ts": "l_shipdate", "department_id": "l_suppkey", "year": 1997}


@pytest.fixture
def lineitem(spark):
    return spark.read.parquet(f"{FOLDER}/lineitem.parquet")


@pytest.fixture
def supplier(spark):
    return Dimension(spark.read.parquet(f"{FOLDER}/supplier.parquet"), "s_suppkey", "s_name")


@pytest.fixture
def part(spark):
    return Dimension(spark.read.parquet(f"{FOLDER}/part.parquet"), "p_partkey", "p_brand")


def physical(df):
    return plan(df).split("== Physical Plan ==")[1]


def test_year_and_columns_reach_the_scan(lineitem, supplier, part):
    report = quarterly_counts(lineitem, supplier, part, job_id="l_partkey", **SHIPPED)
    text = physical(report)
    scan = next(line for line in text.splitlines() if "l_shipdate" in line and "FileScan" in line)
    assert "GreaterThanOrEqual(l_shipdate,1997-01-01T00:00)" in scan
    assert "ReadSchema: struct<l_partkey:bigint,l_suppkey:bigint,l_shipdate:timestamp_ntz>" in scan


def test_fact_is_counted_before_it_is_moved(lineitem, supplier, part, no_broadcast):
    report = quarterly_counts(lineitem, supplier, part, job_id="l_partkey", **SHIPPED)
    lines = physical(report).splitlines()
    scan = next(i for i, line in enumerate(lines) if "FileScan" in line and "l_shipdate" in line)
    above = [line for line in lines[:scan] if "Exchange" in line or "partial_count" in line]
    assert "partial_count" in above[-1] and "Exchange" in above[-2]


def test_mean_reads_the_fact_once(lineitem, supplier):
    report = groups_above_mean(lineitem, supplier, row_id="l_orderkey", **SHIPPED)
    report.collect()
    final = physical(report).split("== Initial Plan ==")[0]
    scans = [
        line for line in final.splitlines() if "FileScan" in line and "l_shipdate" in line
    ]
    assert len(scans) == 1
    assert "ReusedExchange" in final


def test_numbering_has_no_window_over_the_rows(lineitem):
    text = physical(number_rows(lineitem.select("l_returnflag"), ["l_returnflag"]))
    assert "Window" not in text  # the starts are staged


def test_stored_rows_are_numbered_where_they_are(lineitem):
    text = physical(number_table_rows(lineitem.select("*")))
    rows_side = text.split("BroadcastHashJoin")[1].split("BroadcastExchange")[0]
    assert "Exchange" not in rows_side and "Window" not in rows_side
    assert "ReadSchema: struct<_file:string,_start:bigint>" in text.split("BroadcastExchange")[1]


def test_merge_is_one_anti_join(spark, lineitem, no_broadcast):
    """All but a few rows share one key: the join leaves them to AQE, which splits the left side."""
    source = lineitem.selectExpr(
        "if(l_orderkey > 100, 7, l_orderkey) as k", "l_linenumber", "l_shipdate"
    )
    target = spark.range(5).selectExpr("id as k")
    absent = absent_rows(source, target, ["k"], null_keys="reject")
    assert absent.count() == source.filter("k >= 5").count()
    text = physical(absent)
    assert "SortMergeJoin" in text and "LeftAnti" in text and "BroadcastExchange" not in text


def test_first_of_a_large_source_meets_the_target_in_place(lineitem, no_broadcast):
    source = lineitem.select("l_orderkey", "l_linenumber")
    text = physical(
        absent_rows(
            source,
            lineitem,
            ["l_orderkey"],
            null_keys="reject",
            source_duplicates="first",
            order_by=["l_linenumber"],
        )
    )
    assert len(re.findall("Exchange hashpartitioning", text)) == 2


def test_first_per_key_combines_before_the_shuffle(lineitem):
    text = physical(first_per_key(lineitem, ["l_returnflag"], ["l_shipdate"]))
    assert "partial_min(struct" in text and "Window" not in text


def test_report_opens_only_the_year(spark, tmp_path):
    base = new_shared_path(spark, "layers")
    (tmp_path / "h.csv").write_text(
        "\n".join(f"{i},n,{2015 + i % 8}-05-01T00:00:00Z,1,1" for i in range(80))
    )
    load_entity(spark, HIRED_EMPLOYEE, f"file://{tmp_path}/h.csv", base, on_error="raise")
    report = hires_by_quarter(spark, base, 2021)
    text = physical(report)
    assert re.search(r"PartitionFilters: \[[^\]]*event_year#\d+ = 2021", text)
    assert [tuple(r) for r in report.collect()] == [("UNKNOWN", "UNKNOWN", 0, 10, 0, 0)]


def test_hot_id_with_many_pairs_is_split(spark, lineitem, supplier, part, no_broadcast):
    """Half of the pairs share one job: AQE splits them, the settings scaled to the data."""
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    fact = lineitem.selectExpr(
        "l_orderkey as l_suppkey", "if(l_orderkey % 2 = 0, 1, l_partkey) l_partkey", "l_shipdate"
    )
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        report = quarterly_counts(fact, supplier, part, job_id="l_partkey", **SHIPPED)
        total = sum(sum(r[2:]) for r in report.collect())
        final = physical(report).split("== Initial Plan ==")[0]
    finally:
        for key in settings:
            spark.conf.unset(key)
    assert total == fact.filter("year(l_shipdate) = 1997").count()
    assert "SortMergeJoin(skew=true)" in final


def test_null_and_hot_ids_are_spread_without_aqe(spark, lineitem, supplier, part, no_broadcast):
    """Rows without an id match nothing and needn't meet; a hot department is counted per job label
    before it is joined."""
    fact = lineitem.selectExpr(
        "l_orderkey",
        "if(l_linenumber % 3 = 0, null, l_partkey) as l_partkey",
        "if(l_orderkey % 2 = 0, 1, l_suppkey) as l_suppkey",
        "l_shipdate",
    )
    report = quarterly_counts(fact, supplier, part, job_id="l_partkey", **SHIPPED)
    text = physical(report)
    assert re.search(r"SortMergeJoin \[_job_id#\w+, _spread#\d+\]", text)
    assert re.search(r"SortMergeJoin \[_department_id#\w+, _spread#\d+\]", text)
    assert re.search(r"keys=\[_department_id#\w+, _job#\d+\], functions=\[partial_sum", text)
    total = sum(sum(r[2:]) for r in report.collect())
    assert total == fact.filter("year(l_shipdate) = 1997").count()

    keyless = lineitem.selectExpr("if(l_orderkey < 0, l_partkey, null) as id", "l_orderkey as other")
    joined = counts._left_join_spreading_nulls(
        keyless, part.named("key", "label"), "id", "key", "other"
    )
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = joined.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert len(sizes) == 8 and max(r[1] for r in sizes) < lineitem.count() / 4


def test_years_are_rebalanced_before_they_are_written(lineitem):
    text = physical(loads._by_year(lineitem.select("l_orderkey", "l_shipdate"), "l_shipdate"))
    assert "REBALANCE_PARTITIONS_BY_COL" in text
