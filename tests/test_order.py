"""Order behind a sink, and loads at the same time."""

import json
import threading
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from test_loads import ENTITIES, base, source, sources  # noqa: F401

from tierwell import load_together, run_pipeline, write_ordered
from tierwell.plans import loads


@pytest.fixture
def many_files(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_json_lines_in_files_by_name_are_in_order(spark, tmp_path, many_files):
    rows = spark.range(0, 1000, 1, 7).selectExpr("(id * 37) % 1000 AS n", "CASE WHEN id % 3 > 0 THEN 'x' END AS label")
    write_ordered(rows, f"file://{tmp_path}/out", [F.desc("n")])
    files = sorted(Path(f"{tmp_path}/out").glob("part-*"))
    lines = [json.loads(line) for f in files for line in f.read_text().splitlines()]
    assert len(files) > 1
    assert [r["rank"] for r in lines] == list(range(1, 1001))
    assert [r["n"] for r in lines] == list(range(999, -1, -1))
    assert all("label" in r for r in lines)


def test_loads_run_at_the_same_time(spark, base, sources, monkeypatch):
    meeting, whole, pools = threading.Barrier(3, timeout=120), loads.load_entity, []

    def waiting(spark, entity, *rest, **options):
        meeting.wait()
        pools.append(spark.sparkContext.getLocalProperty("spark.scheduler.pool"))
        return whole(spark, entity, *rest, **options)

    monkeypatch.setattr(loads, "load_entity", waiting)
    result = run_pipeline(spark, sources, base, 2021)
    assert result["status"] == "OK" and sorted(pools) == sorted(ENTITIES)
    assert [r.entity for r in result["outcomes"].collect()] == ["hired_employee", "department", "job"]
    assert spark.sparkContext.getLocalProperty("spark.scheduler.pool") is None
    assert spark.read.parquet(f"{base}/load_log").count() == 3


def test_a_failing_load_leaves_the_others(spark, base, sources, tmp_path):
    sources["department"] = source(tmp_path, "x,y,z", "bad.csv")
    outcomes = load_together(spark, ENTITIES, sources, base, mode="FAILFAST")
    status = {name: df.first().status for name, df in outcomes.items()}
    assert status["department"] == "ERROR" and status["job"] == "OK"
    with pytest.raises(Exception, match="MALFORMED"):
        load_together(spark, ENTITIES, sources, f"{base}-raise", mode="FAILFAST", on_error="raise")
    assert spark.read.parquet(f"{base}-raise/load_log").filter("status = 'OK'").count() >= 1
