"""Reports from counts kept with the loads."""

from dataclasses import replace

import pytest
from helpers import rows
from test_loads import ENTITIES, base, source, sources  # noqa: F401

from tierwell import HIRED_EMPLOYEE, departments_above_mean, hires_by_quarter, load_entity, run_statement
from tierwell.plans.partials import read_partials
from tierwell.sources.layers import TRUSTED, drop_unpublished

COUNTED = replace(HIRED_EMPLOYEE, counted_by=("DEPARTMENT_ID", "JOB_ID"))
KEPT = {**ENTITIES, "hired_employee": COUNTED}
POLICY = {"null_keys": "insert", "source_duplicates": "keep", "on_error": "raise"}


def load_all(spark, base, sources, hires=COUNTED, load_id="a"):
    for name, entity in {**ENTITIES, "hired_employee": hires}.items():
        load_entity(spark, entity, sources[name], base, load_id=load_id, **POLICY)


def reports(spark, base, entities, literal=False):
    return [
        rows(hires_by_quarter(spark, base, 2021, literal=literal, entities=entities)),
        rows(departments_above_mean(spark, base, 2021, literal=literal, entities=entities)),
        rows(departments_above_mean(spark, base, 2021, literal=literal, include_empty_groups=True, entities=entities)),
        rows(hires_by_quarter(spark, base, 1999, literal=literal, entities=entities)),
    ]


@pytest.mark.parametrize("literal", [False, True])
def test_kept_counts_give_the_reports_of_the_rows(spark, base, sources, tmp_path, literal):
    load_all(spark, base, sources)
    more = source(tmp_path, "20,x,2021-12-31T00:00:00Z,2,1\n21,y,2021-12-31T10:00:00Z,2,9\n1,z,2021-02-02,2,2", "m.csv")
    load_entity(spark, COUNTED, more, base, load_id="b", **POLICY)
    # Null ids enter again, so the same load again must replace its counts.
    load_entity(spark, COUNTED, sources["hired_employee"], base, load_id="a", **POLICY)
    assert reports(spark, base, KEPT, literal) == reports(spark, base, ENTITIES, literal)
    assert reports(spark, base, KEPT, literal)[0]
    assert drop_unpublished(spark, base, TRUSTED, "hired_employee") == 1
    assert reports(spark, base, KEPT, literal) == reports(spark, base, ENTITIES, literal)


def test_loads_from_before_are_counted_from_their_rows(spark, base, sources, tmp_path):
    load_all(spark, base, sources, hires=HIRED_EMPLOYEE)
    more = source(tmp_path, "20,x,2021-12-31T00:00:00Z,2,1", "m.csv")
    load_entity(spark, COUNTED, more, base, load_id="b", **POLICY)
    assert reports(spark, base, KEPT) == reports(spark, base, ENTITIES)


def test_no_row_of_the_fact_is_read(spark, base, sources):
    load_all(spark, base, sources)
    read = hires_by_quarter(spark, base, 2021, entities=KEPT).inputFiles()
    assert any("/counts/hired_employee/" in f for f in read)
    assert not any("/trusted/hired_employee/" in f for f in read)
    assert read_partials(spark, base, COUNTED).agg({"rows": "sum"}).first()[0] == 8


def test_statements_keep_counts_too(spark, base, sources):
    load_all(spark, base, sources)
    again = """INSERT INTO trusted.hired_employee (ID, NAME, DATETIME, DEPARTMENT_ID, JOB_ID)
               SELECT ID + 100, NAME, to_timestamp_ntz(DATETIME), DEPARTMENT_ID, JOB_ID FROM raw.hired_employee"""
    run_statement(spark, base, again, entities=KEPT)
    assert reports(spark, base, KEPT) == reports(spark, base, ENTITIES)
    read = hires_by_quarter(spark, base, 2021, entities=KEPT).inputFiles()
    assert not any("/trusted/hired_employee/" in f for f in read)


def test_no_loads_no_counts(spark, base):
    assert reports(spark, base, KEPT) == reports(spark, base, ENTITIES) == [[], [], [], []]
