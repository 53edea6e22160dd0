"""Every check query against its SQL in DuckDB, on whole tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from tierwell import checks

FOLDER = "/root/testdata/sf0.01"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


def canonical(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def value(v):
        return round(v, 9) if isinstance(v, float) and not math.isnan(v) else v

    def key(row):
        return [(v is not None, str(v)) for v in row]

    return sorted((tuple(value(r[i]) for i in order) for r in rows), key=key)


def test_every_query_has_an_oracle():
    assert set(checks.QUERIES) == set(checks.ORACLES)


@pytest.mark.parametrize("name", sorted(checks.QUERIES))
def test_query_matches_sql(spark, duck, name):
    df = entry.queries()[name](spark, FOLDER)
    result = duck.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    mine = canonical([tuple(r) for r in df.collect()], df.columns)
    theirs = canonical(result.fetchall(), columns)
    assert len(mine) > 0
    assert mine == theirs


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["DEPARTMENT", "JOB", "Q1", "Q2", "Q3", "Q4"]
    assert df.count() > 0
