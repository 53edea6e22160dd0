"""The three loads and two reports as a Spark job.

    spark-submit job.py --base s3a://lake load department s3a://drop/raw/departments.csv
    spark-submit job.py --base s3a://lake load hired_employee s3a://drop/raw/hired.csv --load-id 7
    spark-submit job.py --base s3a://lake report hires_by_quarter s3a://lake/out/q --year 2021

A load prints its outcome, which also goes to ``<base>/load_log``. A report is written as JSON
lines, one object per row. The exit code is 0 if the status is OK, 1 if there was no data and 2
after an error.
"""

from __future__ import annotations

import argparse
import sys
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tierwell import (  # noqa: E402
    ENTITIES,
    departments_above_mean,
    hires_by_quarter,
    load_entity,
    report_status,
    session,
    write_json,
)
from tierwell.functions.times import DEFAULT_YEAR  # noqa: E402

REPORTS = {
    "hires_by_quarter": hires_by_quarter,
    "departments_above_mean": departments_above_mean,
}
EXIT = {"OK": 0, "EMPTY": 1, "MISSING": 1, "ERROR": 2}


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("--base", required=True, help="folder of the layers")
    actions = parser.add_subparsers(dest="action", required=True)
    load = actions.add_parser("load")
    load.add_argument("entity", choices=sorted(ENTITIES))
    load.add_argument("source", help="CSV file or folder")
    load.add_argument("--load-id", help="give the id of a failed load to run it again")
    report = actions.add_parser("report")
    report.add_argument("name", choices=sorted(REPORTS))
    report.add_argument("out", help="folder for the JSON lines")
    report.add_argument("--year", type=int, default=DEFAULT_YEAR)
    report.add_argument("--layer", choices=("raw", "trusted"), default="trusted")
    report.add_argument("--literal", action="store_true", help="the literal reading, see README")
    return parser.parse_args(argv)


def run(spark: SparkSession, args: argparse.Namespace) -> str:
    """Does what the arguments say; returns the status."""
    if args.action == "load":
        entity = ENTITIES[args.entity]
        outcome = load_entity(spark, entity, args.source, args.base, load_id=args.load_id).first()
        print(outcome.asDict())
        return outcome.status
    report = REPORTS[args.name](
        spark, args.base, args.year, layer=args.layer, literal=args.literal
    )
    # Written first and looked at after, so the report is computed once.
    write_json(report, args.out, mode="overwrite")
    status = report_status(spark.read.text(args.out))
    print({"report": args.name, "year": args.year, "status": status})
    return status


if __name__ == "__main__":
    parsed = arguments()
    sys.exit(EXIT[run(session("tierwell"), parsed)])
