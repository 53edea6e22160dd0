"""Small attempts packed, swapped in at once."""

from dataclasses import replace

import pytest
from helpers import rows
from hypothesis import given
from hypothesis import strategies as st
from test_loads import ENTITIES, base, source, sources, trusted  # noqa: F401

from tierwell import DEPARTMENT, HIRED_EMPLOYEE, compact, hires_by_quarter, load_entity, read_layer, run_statement
from tierwell.plans.loads import merge_into_trusted
from tierwell.sources import compaction
from tierwell.sources.layers import RAW, TRUSTED, drop_unpublished


def load_many(spark, base, tmp_path, entity=DEPARTMENT, loads=6):
    for k in range(loads):
        text = "\n".join(f"{k * 10 + i},d{k}" for i in range(10))
        load_entity(spark, entity, source(tmp_path, text, f"{k}.csv"), base, load_id=f"l{k}", on_error="raise")


def files(spark, base, layer, entity):
    schema = entity.raw_table_schema if layer == RAW else entity.trusted_table_schema
    return len(read_layer(spark, base, layer, entity.name, schema).inputFiles())


@given(st.lists(st.integers(1, 100), max_size=30), st.integers(10, 120))
def test_bins_hold_each_file_once_within_the_target(sizes, target):
    named = [(str(k), size) for k, size in enumerate(sizes)]
    made = compaction.bins(named, target)
    assert sorted(n for b in made for n in b) == sorted(n for n, _ in named)
    for b in made:
        assert len(b) == 1 or sum(sizes[int(n)] for n in b) <= target
    # No two bins would fit in one: first fit leaves at most one that is half empty.
    assert sum(2 * sum(sizes[int(n)] for n in b) <= target for b in made) <= 1


def test_the_same_rows_in_fewer_files(spark, base, tmp_path):
    load_many(spark, base, tmp_path)
    before = trusted(spark, base, DEPARTMENT)
    for layer in (RAW, TRUSTED):
        many = files(spark, base, layer, DEPARTMENT)
        outcome = compact(spark, base, layer, DEPARTMENT).first()
        assert (outcome.loads, outcome.files_before) == (6, many) and outcome.files_after == 1
        assert files(spark, base, layer, DEPARTMENT) == 1
        assert compact(spark, base, layer, DEPARTMENT).first().loads == 0
        assert drop_unpublished(spark, base, layer, "department") == 6
    assert trusted(spark, base, DEPARTMENT) == before and len(before) == 60
    # A load's rows are found in the copies, its raw rows merge again, a new load sees all keys.
    one = read_layer(spark, base, RAW, "department", DEPARTMENT.raw_table_schema, "l2")
    assert sorted(r.ID for r in one.collect()) == list(range(20, 30))
    assert merge_into_trusted(spark, DEPARTMENT, base, "l2") == 10
    assert load_entity(spark, DEPARTMENT, source(tmp_path, "5,x\n99,y", "n.csv"), base, on_error="raise").first().rows_trusted == 1
    assert trusted(spark, base, DEPARTMENT) == [*before, (99, "y")]


def test_a_load_run_again_leaves_its_copies_out(spark, base, tmp_path):
    load_many(spark, base, tmp_path, loads=3)
    compact(spark, base, TRUSTED, DEPARTMENT)
    load_entity(spark, DEPARTMENT, source(tmp_path, "10,new\n500,new", "again.csv"), base, load_id="l1", on_error="raise")
    now = [(k, f"d{k // 10}") for k in [*range(10), *range(20, 30)]] + [(10, "new"), (500, "new")]
    assert sorted(trusted(spark, base, DEPARTMENT)) == sorted(now)
    drop_unpublished(spark, base, TRUSTED, "department")
    assert sorted(trusted(spark, base, DEPARTMENT)) == sorted(now)
    with pytest.raises(ValueError, match="run again"):
        run_statement(spark, base, "INSERT INTO trusted.department (ID) SELECT 7")


@pytest.mark.parametrize("step", ["staged", "manifest_path", "enter_compaction"])
def test_stopped_midway_nothing_changes(spark, base, tmp_path, monkeypatch, step):
    load_many(spark, base, tmp_path, loads=3)
    before, many = trusted(spark, base, DEPARTMENT), files(spark, base, TRUSTED, DEPARTMENT)

    def stop(*_, **__):
        raise RuntimeError("stopped")

    with monkeypatch.context() as patch:
        patch.setattr(compaction, step, stop)
        with pytest.raises(RuntimeError, match="stopped"):
            compact(spark, base, TRUSTED, DEPARTMENT)
    assert trusted(spark, base, DEPARTMENT) == before and files(spark, base, TRUSTED, DEPARTMENT) == many
    drop_unpublished(spark, base, TRUSTED, "department")
    assert compact(spark, base, TRUSTED, DEPARTMENT).first().files_after == 1
    assert trusted(spark, base, DEPARTMENT) == before


def test_years_are_outermost_and_statements_read_the_copies(spark, base, sources, tmp_path):
    for name, entity in ENTITIES.items():
        load_entity(spark, entity, sources[name], base, on_error="raise")
    more = source(tmp_path, "50,x,2021-03-01T00:00:00Z,1,1\n51,y,2020-03-01T00:00:00Z,1,1\n52,z,,1,1", "m.csv")
    load_entity(spark, HIRED_EMPLOYEE, more, base, on_error="raise")
    before, report = trusted(spark, base, HIRED_EMPLOYEE), rows(hires_by_quarter(spark, base, 2021))
    compact(spark, base, TRUSTED, HIRED_EMPLOYEE)
    drop_unpublished(spark, base, TRUSTED, "hired_employee")
    assert trusted(spark, base, HIRED_EMPLOYEE) == before and rows(hires_by_quarter(spark, base, 2021)) == report
    read = read_layer(spark, base, TRUSTED, "hired_employee", HIRED_EMPLOYEE.trusted_table_schema)
    years = sorted({f.split("event_year=")[1].split("/")[0] for f in read.inputFiles()})
    assert years == ["2020", "2021", "__HIVE_DEFAULT_PARTITION__"] and len(read.inputFiles()) == 3
    run_statement(spark, base, "INSERT INTO trusted.hired_employee (ID, DATETIME) SELECT max(ID) + 1, max(DATETIME) FROM trusted.hired_employee")
    assert len(trusted(spark, base, HIRED_EMPLOYEE)) == len(before) + 1


def test_tables_laid_out_by_key_are_refused(spark, base):
    with pytest.raises(ValueError, match="by key"):
        compact(spark, base, TRUSTED, replace(DEPARTMENT, buckets=4))


def test_packing_matches_no_path_of_a_row(spark):
    """A row's file is found by the end of its path, cut off: no regular expression for every row."""
    from tierwell.sources import compaction

    paths = ["file:/b/raw/t/load_id=l/attempt=a1/event_year=1997/p.parquet", "file:///b/raw/t/load_id=l/attempt=a2/p.parquet"]
    df = spark.createDataFrame([(p,) for p in paths], "p string").select(compaction._own_name("p").alias("n"))
    assert [r.n for r in df.collect()] == ["a1/event_year=1997/p.parquet", "a2/p.parquet"]
    assert "regexp" not in df._jdf.queryExecution().optimizedPlan().toString()
