"""Reports on rows checked by hand, and properties that must hold for any rows."""

import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from helpers import DEPARTMENTS, HIRES, departments, hires, jobs, rows

from tierwell import (
    Dimension,
    groups_above_mean,
    groups_above_mean_literal,
    in_year,
    parse_timestamp,
    mean_of_counts,
    quarterly_counts,
    quarterly_counts_literal,
    report_status,
    yearly_counts,
)
from tierwell.functions.times import between_year_dates

QUARTERLY = [
    ("Legal", "Ops", 0, 0, 1, 0),
    ("Sales", "Dev", 1, 0, 0, 2),
    ("UNKNOWN", "Dev", 0, 1, 0, 0),
    ("UNKNOWN", "Ops", 0, 1, 0, 0),
    ("UNKNOWN", "UNKNOWN", 0, 1, 0, 0),
]


def test_quarterly_counts(spark):
    report = quarterly_counts(hires(spark), departments(spark), jobs(spark))
    assert report.columns == ["DEPARTMENT", "JOB", "Q1", "Q2", "Q3", "Q4"]
    assert rows(report) == QUARTERLY


def test_literal_range_loses_the_last_day(spark):
    report = quarterly_counts_literal(hires(spark), departments(spark), jobs(spark))
    assert rows(report) == [
        ("Sales", "Dev", 1, 0, 0, 1) if r[:2] == ("Sales", "Dev") else r for r in QUARTERLY
    ]


def test_label_that_reads_unknown_stays_apart_from_a_missing_one(spark):
    more = [*HIRES, (10, "j", "2021-02-01T00:00:00Z", 98, 1)]
    report = quarterly_counts(hires(spark, more), departments(spark), jobs(spark))
    both = [r for r in rows(report) if r[:2] == ("UNKNOWN", "Dev")]
    assert sorted(both) == [("UNKNOWN", "Dev", 0, 1, 0, 0), ("UNKNOWN", "Dev", 1, 0, 0, 0)]


def test_shared_label_is_one_group_by_label_and_two_by_id(spark):
    named = [*DEPARTMENTS, (5, "Sales")]
    more = [*HIRES, (10, "j", "2021-02-01T00:00:00Z", 5, 1)]
    report = quarterly_counts(hires(spark, more), departments(spark, named), jobs(spark))
    assert ("Sales", "Dev", 2, 0, 0, 2) in rows(report)
    counts = rows(yearly_counts(hires(spark, more), departments(spark, named)))
    assert {(1, "Sales", 3), (5, "Sales", 1)} <= set(counts)


def test_repeated_dimension_ids_multiply_counts(spark):
    twice = [*DEPARTMENTS, (1, "Sales"), (2, "Law")]
    report = rows(quarterly_counts(hires(spark), departments(spark, twice), jobs(spark)))
    assert ("Sales", "Dev", 2, 0, 0, 4) in report
    assert ("Legal", "Ops", 0, 0, 1, 0) in report and ("Law", "Ops", 0, 0, 1, 0) in report
    counts = rows(yearly_counts(hires(spark), departments(spark, twice)))
    assert (1, "Sales", 6) in counts


def test_yearly_counts_and_mean(spark):
    counts = yearly_counts(hires(spark), departments(spark))
    assert sorted(rows(counts)) == [(1, "Sales", 3), (2, "Legal", 0), (3, "UNKNOWN", 1)]
    assert rows(mean_of_counts(counts)) == [(pytest.approx(4 / 3),)]


def test_empty_groups_count_zero_and_lower_the_mean(spark):
    counts = yearly_counts(hires(spark), departments(spark), include_empty_groups=True)
    assert (4, "Empty", 0) in rows(counts)
    assert rows(mean_of_counts(counts)) == [(1.0,)]


def test_groups_above_mean(spark):
    assert rows(groups_above_mean(hires(spark), departments(spark))) == [(1, "Sales", 3)]
    literal = groups_above_mean_literal(hires(spark), departments(spark))
    assert rows(literal) == [(1, "Sales", 3), (3, "UNKNOWN", 1), (2, "Legal", 0)]


def test_count_equal_to_the_mean_is_not_above_it(spark):
    even = [(i, "x", "2021-03-01T00:00:00Z", 1 + i % 2, 1) for i in range(10)]
    assert rows(groups_above_mean(hires(spark, even), departments(spark))) == []


def test_year_without_rows(spark):
    report = quarterly_counts(hires(spark), departments(spark), jobs(spark), year=1999)
    assert report_status(report) == "EMPTY"
    assert report.columns == ["DEPARTMENT", "JOB", "Q1", "Q2", "Q3", "Q4"]
    assert report_status(groups_above_mean(hires(spark), departments(spark))) == "OK"


@pytest.mark.parametrize("broadcast", ["10MB", "-1"])
@pytest.mark.parametrize("seed", [1, 2])
def test_reports_match_brute_force_on_skewed_rows(spark, seed, broadcast):
    """A third of the rows share one department, another part has none."""
    rng = random.Random(seed)
    facts = []
    for i in range(3000):
        department = rng.choice([1, 1, None, rng.randrange(30), 77])
        when = datetime(2020, 12, 1) + timedelta(hours=rng.randrange(24 * 420))
        fact_id = None if rng.random() < 0.1 else i
        facts.append((fact_id, "n", when.isoformat(), department, rng.randrange(40)))
    dims = [(i, f"d{i % 7}") for i in range(30)] + [(3, "d3"), (4, "other")]
    titles = [(i, f"j{i % 5}") for i in range(0, 40, 2)]

    inside = [
        (f[0], datetime.fromisoformat(f[2]), f[3], f[4]) for f in facts if f[2][:4] == "2021"
    ]
    quarters = Counter()
    totals = Counter()
    for fact_id, when, department, job in inside:
        for d in [label for key, label in dims if key == department] or [None]:
            for j in [label for key, label in titles if key == job] or [None]:
                quarters[(d, j, (when.month - 1) // 3)] += 1
        for key, label in dims:
            if key == department:
                totals[(key, label)] += fact_id is not None
    pairs = {(d, j) for d, j, _ in quarters}
    expected = sorted(
        (d or "UNKNOWN", j or "UNKNOWN", *[quarters[(d, j, q)] for q in range(4)])
        for d, j in pairs
    )
    mean = sum(totals.values()) / len(totals)
    above = sorted((k, label, n) for (k, label), n in totals.items() if n > mean)

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        fact = hires(spark, facts)
        report = rows(quarterly_counts(fact, departments(spark, dims), jobs(spark, titles)))
        assert sorted(report) == expected
        assert [r[:2] for r in report] == sorted(r[:2] for r in report)
        listed = rows(groups_above_mean(fact, departments(spark, dims)))
        assert sorted(listed) == above
        assert [r[2] for r in listed] == sorted((r[2] for r in listed), reverse=True)
        everything = rows(groups_above_mean_literal(fact, departments(spark, dims)))
        assert set(listed) <= set(everything) and len(everything) == len(totals)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_quarters_add_up_to_the_rows_of_the_year(spark):
    fact = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet")
    supplier = spark.read.parquet("/root/testdata/sf0.01/supplier.parquet")
    part = spark.read.parquet("/root/testdata/sf0.01/part.parquet")
    report = quarterly_counts(
        fact,
        Dimension(supplier, "s_suppkey", "s_name"),
        Dimension(part, "p_partkey", "p_brand"),
        ts="l_shipdate",
        department_id="l_suppkey",
        job_id="l_partkey",
        year=1997,
    )
    total = report.selectExpr("sum(Q1 + Q2 + Q3 + Q4)").first()[0]
    assert total == fact.filter("year(l_shipdate) = 1997").count()


def test_year_must_be_a_year_and_time_a_time(spark):
    with pytest.raises(ValueError):
        quarterly_counts(hires(spark), departments(spark), jobs(spark), year=0)
    text = spark.createDataFrame(HIRES, "ID int, NAME string, DATETIME string, a int, b int")
    with pytest.raises(TypeError):
        yearly_counts(text, departments(spark), department_id="a")


@pytest.mark.parametrize("dtype", ["date", "timestamp", "timestamp_ntz"])
def test_time_types(spark, dtype):
    texts = ["2020-12-31 23:59:59", "2021-01-01", "2021-12-31", "2021-12-31 23:59:59", "2022-01-01"]
    days = spark.createDataFrame([(t,) for t in texts], "t string")
    fact = days.selectExpr(f"cast(t as {dtype}) as DATETIME", "1 as ID", "1 as DEPARTMENT_ID")
    assert rows(yearly_counts(fact, departments(spark))) == [(1, "Sales", 3)]
    literal = fact.filter(between_year_dates(fact, "DATETIME", 2021)).count()
    assert literal == (3 if dtype == "date" else 2)


def test_bounds_of_the_calendar(spark):
    fact = spark.createDataFrame(
        [("0001-01-01",), ("9998-12-31",), ("9999-12-31",), (None,)], "t string"
    ).selectExpr("cast(t as timestamp_ntz) as DATETIME")
    assert fact.filter(in_year(fact, "DATETIME", 1)).count() == 1
    assert fact.filter(in_year(fact, "DATETIME", 9998)).count() == 1
    assert fact.filter(in_year(fact, "DATETIME", 9999)).count() == 1
    with pytest.raises(ValueError):
        in_year(fact, "DATETIME", 10_000)


def test_timestamps_with_a_format(spark):
    df = spark.createDataFrame([("07/27/2021", "1627401728"), ("x", "y")], "t string, e string")
    made = df.select(
        parse_timestamp("t", format="MM/dd/yyyy").alias("t"),
        parse_timestamp("e", format="epoch").alias("e"),
    )
    assert [(str(r.t), str(r.e)) for r in made.collect()] == [
        ("2021-07-27 00:00:00", "2021-07-27 16:02:08"),
        ("None", "None"),
    ]
