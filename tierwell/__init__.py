"""Layered loading and yearly reports on dated facts, as PySpark DataFrame operators."""

from tierwell.entities import DEPARTMENT, DETECT, ENTITIES, HIRED_EMPLOYEE, JOB, Entity
from tierwell.functions.formats import detect, read_detected
from tierwell.functions.records import json_records, write_json, write_ordered
from tierwell.functions.times import between_dates, in_year, parse_timestamp
from tierwell.operators.counts import (
    Dimension,
    groups_above_mean,
    groups_above_mean_literal,
    label_or_default,
    mean_of_counts,
    quarterly_counts,
    quarterly_counts_literal,
    yearly_counts,
)
from tierwell.operators.merge import absent_rows, first_per_key, insert_if_absent
from tierwell.operators.numbering import (
    assign_batches,
    batch_counts,
    number_of_batches,
    number_rows,
    number_table_rows,
)
from tierwell.plans.loads import load_entity, load_together, merge_into_trusted, run_pipeline
from tierwell.plans.numbers import number_loads
from tierwell.plans.reports import (
    create_views,
    departments_above_mean,
    hires_by_quarter,
    report_status,
)
from tierwell.plans.statements import create_tables, run_statement
from tierwell.session import new_shared_path, session, shared_folder, staged
from tierwell.sources.appends import append_resumably, read_appended
from tierwell.sources.compaction import compact
from tierwell.sources.csvs import (
    accepted_rows,
    csv_status,
    parse_csv_column,
    quarantined_rows,
    read_csv,
    without_corrupt,
)
from tierwell.sources.jdbc import append_jdbc, read_jdbc
from tierwell.sources.layers import append_in_batches, layer_path, read_layer

__all__ = [
    "DEPARTMENT",
    "DETECT",
    "Dimension",
    "ENTITIES",
    "Entity",
    "HIRED_EMPLOYEE",
    "JOB",
    "absent_rows",
    "accepted_rows",
    "append_in_batches",
    "append_jdbc",
    "append_resumably",
    "assign_batches",
    "batch_counts",
    "between_dates",
    "compact",
    "create_tables",
    "create_views",
    "csv_status",
    "departments_above_mean",
    "detect",
    "first_per_key",
    "groups_above_mean",
    "groups_above_mean_literal",
    "hires_by_quarter",
    "in_year",
    "insert_if_absent",
    "json_records",
    "label_or_default",
    "layer_path",
    "load_entity",
    "load_together",
    "mean_of_counts",
    "merge_into_trusted",
    "new_shared_path",
    "number_loads",
    "number_of_batches",
    "number_rows",
    "number_table_rows",
    "parse_csv_column",
    "parse_timestamp",
    "quarantined_rows",
    "quarterly_counts",
    "quarterly_counts_literal",
    "read_appended",
    "read_csv",
    "read_detected",
    "read_jdbc",
    "read_layer",
    "report_status",
    "run_pipeline",
    "run_statement",
    "session",
    "shared_folder",
    "staged",
    "without_corrupt",
    "write_json",
    "write_ordered",
    "yearly_counts",
]
