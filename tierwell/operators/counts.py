"""Yearly counts by label and the comparison with their mean."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierwell.functions.times import DEFAULT_YEAR, between_year_dates, in_year

QUARTERS = (1, 2, 3, 4)
# Fixed value: the label of ids without one.
UNKNOWN = "UNKNOWN"
MEAN = "mean_of_counts"


@dataclass(frozen=True)
class Dimension:
    """A table that labels ids. Ids and labels may repeat."""

    rows: DataFrame
    key: str = "ID"
    label: str = "LABEL"

    def named(self, key: str, label: str) -> DataFrame:
        return self.rows.select(F.col(self.key).alias(key), F.col(self.label).alias(label))


def label_or_default(label: Column | str, default: str = UNKNOWN) -> Column:
    return F.coalesce(F.col(label) if isinstance(label, str) else label, F.lit(default))


def quarterly_counts(
    fact: DataFrame,
    department: Dimension,
    job: Dimension,
    ts: str = "DATETIME",
    department_id: str = "DEPARTMENT_ID",
    job_id: str = "JOB_ID",
    year: int = DEFAULT_YEAR,
) -> DataFrame:
    """Rows per department and job label in each quarter of the year, sorted by the labels.

    Rows whose id has no label count as ``UNKNOWN``.
    """
    rows = fact.filter(in_year(fact, ts, year))
    return _per_quarter(rows, department, job, ts, department_id, job_id)


def quarterly_counts_literal(
    fact: DataFrame,
    department: Dimension,
    job: Dimension,
    ts: str = "DATETIME",
    department_id: str = "DEPARTMENT_ID",
    job_id: str = "JOB_ID",
    year: int = DEFAULT_YEAR,
) -> DataFrame:
    """As ``quarterly_counts``, but of Dec 31 only the first instant counts."""
    rows = fact.filter(between_year_dates(fact, ts, year))
    return _per_quarter(rows, department, job, ts, department_id, job_id)


def _left_join_spreading_nulls(
    left: DataFrame, right: DataFrame, key: str, right_key: str, spread_by: str
) -> DataFrame:
    """The left join on ``key``; rows without one, which match nothing, are spread by another column."""
    left = left.withColumn(
        "_spread", F.when(F.col(key).isNull(), F.hash(spread_by)).otherwise(F.lit(0))
    )
    # Computed from the key, so that it stays a column to be joined on.
    right = right.withColumn("_none", F.col(right_key).isNull().cast("int"))
    matches = (F.col(key) == F.col(right_key)) & (F.col("_spread") == F.col("_none"))
    return left.join(right, matches, "left")


def _per_quarter(
    rows: DataFrame,
    department: Dimension,
    job: Dimension,
    ts: str,
    department_id: str,
    job_id: str,
) -> DataFrame:
    # Counting per pair of ids before the joins leaves one narrow row per pair, quarter and task to
    # shuffle, so neither a hot id nor a hot orphan is moved row by row. A sum of counts over
    # matching dimension rows equals the count of joined rows, also where dimension ids repeat.
    per_ids = rows.groupBy(
        F.col(department_id).alias("_department_id"),
        F.col(job_id).alias("_job_id"),
        F.quarter(ts).alias("_quarter"),
    ).agg(F.count(F.lit(1)).alias("_rows"))
    return _per_labels(per_ids, department, job)


def _per_labels(per_ids: DataFrame, department: Dimension, job: Dimension) -> DataFrame:
    # Counted again between the joins, a hot department has one row for each job label left.
    with_job = _left_join_spreading_nulls(
        per_ids, job.named("_job_key", "_job"), "_job_id", "_job_key", "_department_id"
    )
    per_job = with_job.groupBy("_department_id", "_job").agg(
        *[
            F.sum(F.when(F.col("_quarter") == q, F.col("_rows")).otherwise(0)).alias(f"Q{q}")
            for q in QUARTERS
        ]
    )
    labelled = _left_join_spreading_nulls(
        per_job, department.named("_department_key", "_department"),
        "_department_id", "_department_key", "_job",
    )
    # Grouped by the label as stored: a label that reads UNKNOWN stays apart from a missing one.
    per_labels = labelled.groupBy("_department", "_job").agg(
        *[F.sum(f"Q{q}").alias(f"Q{q}") for q in QUARTERS]
    )
    return per_labels.select(
        label_or_default("_department").alias("DEPARTMENT"),
        label_or_default("_job").alias("JOB"),
        *[f"Q{q}" for q in QUARTERS],
    ).orderBy("DEPARTMENT", "JOB")


# --- counts that add up --------------------------------------------------------------------------


def partial_counts(
    fact: DataFrame,
    ts: str = "DATETIME",
    department_id: str = "DEPARTMENT_ID",
    job_id: str = "JOB_ID",
    row_id: str = "ID",
) -> DataFrame:
    """What all reports need of some rows of the fact: counts per year, quarter and pair of ids.

    ``rows``, those with an id (``with_id``), and those up to the first instant of Dec 31 (``upto_literal``). Counts of
    parts of the fact are added up by the reports, so a part is counted once, when it comes.
    """
    last_day = (F.month(ts) == 12) & (F.dayofmonth(ts) == 31)
    midnight = F.col(ts) == F.date_trunc("day", ts).cast(fact.schema[ts].dataType)
    return (
        fact.filter(F.col(ts).isNotNull())
        .groupBy(
            F.year(ts).alias("year"),
            F.quarter(ts).alias("quarter"),
            F.col(department_id).alias("department_id"),
            F.col(job_id).alias("job_id"),
        )
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.count(row_id).alias("with_id"),
            F.count_if(~last_day | midnight).alias("upto_literal"),
        )
    )


def quarterly_from_partials(
    partials: DataFrame,
    department: Dimension,
    job: Dimension,
    year: int = DEFAULT_YEAR,
    literal: bool = False,
) -> DataFrame:
    """``quarterly_counts``, or its literal form, of the rows that the partial counts are of."""
    per_ids = (
        partials.filter(F.col("year") == year)
        .groupBy(
            F.col("department_id").alias("_department_id"),
            F.col("job_id").alias("_job_id"),
            F.col("quarter").alias("_quarter"),
        )
        .agg(F.sum("upto_literal" if literal else "rows").alias("_rows"))
        .filter("_rows > 0")
    )
    return _per_labels(per_ids, department, job)


def yearly_from_partials(
    partials: DataFrame,
    department: Dimension,
    year: int = DEFAULT_YEAR,
    include_empty_groups: bool = False,
) -> DataFrame:
    """``yearly_counts`` of the rows that the partial counts are of."""
    per_id = (
        partials.filter(F.col("year") == year)
        .groupBy(F.col("department_id").alias("_department_id"))
        .agg(F.sum("with_id").alias("_hired"))
    )
    return _counts_of_departments(per_id, department, include_empty_groups)


def groups_above_mean_from_partials(
    partials: DataFrame, department: Dimension, literal: bool = False, **arguments
) -> DataFrame:
    """``groups_above_mean``, or its literal form, of the rows that the partial counts are of."""
    counts = yearly_from_partials(partials, department, **arguments)
    return _compared_with_mean(counts, "left" if literal else "inner")


def yearly_counts(
    fact: DataFrame,
    department: Dimension,
    ts: str = "DATETIME",
    department_id: str = "DEPARTMENT_ID",
    row_id: str = "ID",
    year: int = DEFAULT_YEAR,
    include_empty_groups: bool = False,
) -> DataFrame:
    """Rows with an id per department id and label in the year.

    Departments without rows are left out, or count 0 with ``include_empty_groups``.
    """
    rows = fact.filter(in_year(fact, ts, year))
    per_id = rows.groupBy(F.col(department_id).alias("_department_id")).agg(
        F.count(row_id).alias("_hired")
    )
    return _counts_of_departments(per_id, department, include_empty_groups)


def _counts_of_departments(
    per_id: DataFrame, department: Dimension, include_empty_groups: bool
) -> DataFrame:
    how = "left" if include_empty_groups else "inner"
    labelled = department.named("ID", "DEPARTMENT").join(
        per_id, F.col("ID") == F.col("_department_id"), how
    )
    hired = F.sum(F.coalesce(F.col("_hired"), F.lit(0)))
    return labelled.groupBy("ID", "DEPARTMENT").agg(hired.alias("HIRED"))


def mean_of_counts(counts: DataFrame, count: str = "HIRED") -> DataFrame:
    """One row: the mean over all groups."""
    return counts.agg(F.avg(count).alias(MEAN))


def _compared_with_mean(counts: DataFrame, how: str) -> DataFrame:
    # The mean is one row, so its broadcast does not grow; the counts' shuffle is run once and
    # read by both sides.
    above = F.col("HIRED") > F.col(MEAN)
    return (
        counts.join(F.broadcast(mean_of_counts(counts)), above, how)
        .select("ID", "DEPARTMENT", "HIRED")
        .orderBy(F.desc("HIRED"), "ID")
    )


def groups_above_mean(fact: DataFrame, department: Dimension, **arguments) -> DataFrame:
    """Departments whose yearly count exceeds the mean of all counts, largest first.

    Arguments are those of ``yearly_counts``.
    """
    return _compared_with_mean(yearly_counts(fact, department, **arguments), "inner")


def groups_above_mean_literal(fact: DataFrame, department: Dimension, **arguments) -> DataFrame:
    """The comparison as an outer join, which drops no department: all counts, largest first."""
    return _compared_with_mean(yearly_counts(fact, department, **arguments), "left")
