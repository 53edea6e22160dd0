"""Entities: fixed schemas of the loaded tables and how they enter the trusted layer."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import (
    DataType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)


#: As a format: find it from the data.
DETECT = "detect"


@dataclass(frozen=True)
class Entity:
    """A table loaded from a headerless CSV file.

    ``schema`` gives the columns by position, ``keys`` what the merge compares, ``timestamps``
    the text columns that become timestamps in the trusted layer. ``year_of`` names the timestamp
    by whose year the trusted table is partitioned. ``formats`` names the format of timestamps that
    are not ISO text: a pattern, ``epoch``, or ``DETECT`` to find it from the data. ``buckets`` lays the
    trusted table out by hash of the key in so many files a load (and year), sorted; it must not
    change once rows are there. ``counted_by`` names the ids of department and job, if counts per ids are to be kept
    with each load for the reports.
    """

    name: str
    schema: StructType
    keys: tuple[str, ...] = ("ID",)
    timestamps: tuple[str, ...] = ()
    year_of: str | None = None
    formats: tuple[tuple[str, str], ...] = ()
    buckets: int | None = None
    counted_by: tuple[str, ...] = ()

    def format_of(self, name: str) -> str | None:
        return dict(self.formats).get(name)

    @property
    def detected(self) -> list[str]:
        """The timestamps whose format is found from the data."""
        return [name for name in self.timestamps if self.format_of(name) == DETECT]

    @property
    def trusted_schema(self) -> StructType:
        def trusted(field: StructField) -> DataType:
            return TimestampNTZType() if field.name in self.timestamps else field.dataType

        return StructType([StructField(f.name, trusted(f), True) for f in self.schema])

    @property
    def raw_table_schema(self) -> StructType:
        """Columns as received, then where a row came from and why it was set aside, if so."""
        return StructType(
            [
                *self.schema,
                StructField("corrupt_record", StringType(), True),
                StructField("reject_reason", StringType(), True),
                StructField("source_file", StringType(), True),
                StructField("source_offset", LongType(), True),
                StructField("arrival", LongType(), True),
                StructField("load_sequence", LongType(), True),
                StructField("load_id", StringType(), True),
            ]
        )

    @property
    def trusted_table_schema(self) -> StructType:
        fields = [*self.trusted_schema, StructField("load_id", StringType(), True)]
        if self.year_of:
            fields.append(StructField("event_year", IntegerType(), True))
        return StructType(fields)


# Names, order and types of the columns of the three files.

DEPARTMENT = Entity(
    "department",
    StructType(
        [
            StructField("ID", IntegerType(), True),
            StructField("DEPARTMENT", StringType(), True),
        ]
    ),
)

JOB = Entity(
    "job",
    StructType(
        [
            StructField("ID", IntegerType(), True),
            StructField("JOB", StringType(), True),
        ]
    ),
)

HIRED_EMPLOYEE = Entity(
    "hired_employee",
    StructType(
        [
            StructField("ID", IntegerType(), True),
            StructField("NAME", StringType(), True),
            StructField("DATETIME", StringType(), True),
            StructField("DEPARTMENT_ID", IntegerType(), True),
            StructField("JOB_ID", IntegerType(), True),
        ]
    ),
    timestamps=("DATETIME",),
    year_of="DATETIME",
)

ENTITIES = {e.name: e for e in (DEPARTMENT, JOB, HIRED_EMPLOYEE)}
