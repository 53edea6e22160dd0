"""Append that is stopped and goes on."""

from pathlib import Path

import pytest
from pyspark import TaskContext
from pyspark.sql import functions as F

from tierwell import append_resumably, new_shared_path, read_appended
from tierwell.sources import appends


@pytest.fixture
def source(spark):
    path = new_shared_path(spark, "source")
    spark.range(0, 10_000, 1, 6).selectExpr("id", "id % 7 AS v").write.parquet(path)
    return spark.read.parquet(path)


def ranges(df):
    return [(r.first_row, r.last_row, r.batches) for r in df.orderBy("first_row").collect()]


def test_a_stopped_append_goes_on(spark, source):
    path = new_shared_path(spark, "out")
    made = append_resumably(source, path, 100, 15, commits=2)
    assert ranges(made) == [(1, 1500, 15), (1501, 3000, 15)]
    assert read_appended(spark, path, source.schema).count() == 3000
    assert len(ranges(append_resumably(source, path, 100, 15))) == 5
    assert ranges(append_resumably(source, path, 100, 15)) == []
    rows = read_appended(spark, path, source.schema)
    assert rows.count() == rows.select("id").distinct().count() == 10_000
    per_file = rows.groupBy(F.col("_metadata.file_path")).count()
    assert per_file.agg(F.max("count")).first()[0] <= 100


def test_a_range_that_failed_leaves_nothing_and_is_written_again(spark, source, monkeypatch):
    path = new_shared_path(spark, "out")
    append_resumably(source, path, 100, 40, commits=1)
    whole = appends.number_table_rows

    def breaking(table, *names, **options):
        numbered = whole(table, *names, **options)

        def work(batches):
            for batch in batches:
                yield batch
            if TaskContext.get().partitionId() == 1:
                raise RuntimeError("lost")

        return numbered.mapInArrow(work, numbered.schema)

    monkeypatch.setattr(appends, "number_table_rows", breaking)
    with pytest.raises(Exception, match="lost"):
        append_resumably(source, path, 100, 40)
    assert read_appended(spark, path, source.schema).count() == 4000
    monkeypatch.setattr(appends, "number_table_rows", whole)
    assert ranges(append_resumably(source, path, 100, 40)) == [(4001, 8000, 40), (8001, 10_000, 20)]
    rows = read_appended(spark, path, source.schema)
    assert rows.count() == rows.distinct().count() == 10_000


def test_another_source_is_refused(spark, source):
    path = new_shared_path(spark, "out")
    append_resumably(source, path, 100, 40, commits=1)
    other = new_shared_path(spark, "source")
    spark.range(10).selectExpr("id", "id AS v").write.parquet(other)
    with pytest.raises(ValueError, match="another source"):
        append_resumably(spark.read.parquet(other), path, 100, 40)
    with pytest.raises(ValueError, match="another source"):
        append_resumably(source, path, 200, 40)


def test_an_empty_table_appends_nothing(spark, source):
    path, empty = new_shared_path(spark, "out"), new_shared_path(spark, "source")
    source.limit(0).write.parquet(empty)
    assert ranges(append_resumably(spark.read.parquet(empty), path)) == []
    assert read_appended(spark, path, source.schema).collect() == []


def test_only_files_of_the_range_are_read(spark, source, monkeypatch):
    path = new_shared_path(spark, "out")
    append_resumably(source, path, 100, 40, commits=1)
    known = source.sparkSession.createDataFrame(appends.file_starts(source).collect())
    monkeypatch.setattr(appends, "file_starts", lambda table: known)
    # Of six files the first holds rows of the first range only; without it the others can be written.
    Path(sorted(source.inputFiles())[0].removeprefix("file://")).unlink()
    assert ranges(append_resumably(source, path, 100, 40))[0] == (4001, 8000, 40)
