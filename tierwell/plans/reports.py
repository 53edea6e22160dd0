"""The two yearly reports over the layer tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierwell.entities import ENTITIES, Entity
from tierwell.functions.times import DEFAULT_YEAR
from tierwell.operators.counts import (
    Dimension,
    groups_above_mean,
    groups_above_mean_from_partials,
    groups_above_mean_literal,
    quarterly_counts,
    quarterly_counts_literal,
    quarterly_from_partials,
)
from tierwell.plans.partials import read_partials
from tierwell.sources import evidence
from tierwell.sources.layers import RAW, TRUSTED, read_layer


def _table(spark: SparkSession, base: str, layer: str, entity: Entity) -> DataFrame:
    raw = layer.lower() == RAW
    schema = entity.raw_table_schema if raw else entity.trusted_table_schema
    rows = read_layer(spark, base, layer, entity.name, schema)
    if raw:
        rows = rows.filter(F.col("reject_reason").isNull())
        detected = evidence.detected_formats(spark, base, entity)
        for name in entity.timestamps:
            rows = rows.withColumn(name, evidence.time_of(entity, name, detected))
    return rows


def create_views(
    spark: SparkSession,
    base: str,
    layer: str = TRUSTED,
    entities: Mapping[str, Entity] | None = None,
) -> list[str]:
    """Temporary views ``<layer>_<table>`` for statements in SQL; returns their names."""
    names = []
    for entity in (entities or ENTITIES).values():
        names.append(f"{layer.lower()}_{entity.name}")
        _table(spark, base, layer, entity).createOrReplaceTempView(names[-1])
    return names


def _hires(
    spark: SparkSession, base: str, layer: str, entity: Entity, year: int
) -> DataFrame:
    hires = _table(spark, base, layer, entity)
    # The folder of the year; the reports' own filter on the timestamp stays what decides.
    return hires.filter(F.col("event_year") == year) if "event_year" in hires.columns else hires


def hires_by_quarter(
    spark: SparkSession,
    base: str,
    year: int = DEFAULT_YEAR,
    layer: str = TRUSTED,
    literal: bool = False,
    entities: Mapping[str, Entity] | None = None,
) -> DataFrame:
    """DEPARTMENT, JOB, Q1..Q4: hires of the year per department and job, sorted by label.

    Of hires whose counts are kept with each load (``counted_by``) only those counts are read."""
    entities = entities or ENTITIES
    hires = entities["hired_employee"]
    department = Dimension(_table(spark, base, layer, entities["department"]), "ID", "DEPARTMENT")
    job = Dimension(_table(spark, base, layer, entities["job"]), "ID", "JOB")
    if hires.counted_by and layer.lower() == TRUSTED:
        return quarterly_from_partials(read_partials(spark, base, hires), department, job, year, literal)
    report = quarterly_counts_literal if literal else quarterly_counts
    return report(_hires(spark, base, layer, hires, year), department, job, year=year)


def departments_above_mean(
    spark: SparkSession,
    base: str,
    year: int = DEFAULT_YEAR,
    layer: str = TRUSTED,
    literal: bool = False,
    include_empty_groups: bool = False,
    entities: Mapping[str, Entity] | None = None,
) -> DataFrame:
    """ID, DEPARTMENT, HIRED: departments that hired more than the mean, largest first.

    Of hires whose counts are kept with each load (``counted_by``) only those counts are read."""
    entities = entities or ENTITIES
    hires = entities["hired_employee"]
    department = Dimension(_table(spark, base, layer, entities["department"]), "ID", "DEPARTMENT")
    options = {"year": year, "include_empty_groups": include_empty_groups}
    if hires.counted_by and layer.lower() == TRUSTED:
        partials = read_partials(spark, base, hires)
        return groups_above_mean_from_partials(partials, department, literal, **options)
    report = groups_above_mean_literal if literal else groups_above_mean
    return report(_hires(spark, base, layer, hires, year), department, **options)


def report_status(report: DataFrame) -> str:
    """``EMPTY`` if the year has no data, else ``OK``."""
    return "OK" if report.take(1) else "EMPTY"
