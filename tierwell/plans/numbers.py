"""Row numbers that go on over the loads of a raw table."""

from __future__ import annotations

from functools import reduce
from itertools import accumulate

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierwell.entities import Entity
from tierwell.operators.numbering import number_rows, number_table_rows
from tierwell.sources.layers import RAW, attempt_path, layer_path, no_rows, placed_attempts, published, read_layer


def load_rows(spark: SparkSession, base: str, entity: Entity) -> dict[str, int]:
    """The rows of each load, in order of arrival, from the counts in the publications."""
    rows = {}
    for a in sorted(published(spark, base, RAW, entity.name).values(), key=lambda a: (a.sequence, a.load_id)):
        if a.rows is None:  # published before counts were kept
            rows[a.load_id] = read_layer(spark, base, RAW, entity.name, entity.raw_table_schema, a.load_id).count()
        else:
            rows[a.load_id] = a.rows
    return rows


def load_starts(spark: SparkSession, base: str, entity: Entity) -> dict[str, int]:
    """The rows of all loads that arrived before each."""
    rows = load_rows(spark, base, entity)
    return {load_id: end - rows[load_id] for load_id, end in zip(rows, accumulate(rows.values()), strict=True)}


def number_loads(
    spark: SparkSession, base: str, entity: Entity, load_id: str | None = None, name: str = "row_number"
) -> DataFrame:
    """The raw rows of all loads, or of one, with dense numbers 1..n in order of arrival: of the loads, then of
    the rows in each.

    A load's numbers begin behind the counts of the loads before it, which their publications keep, so
    numbering the rows of one load reads no row of another, and a new load changes no number. A load that is run
    again keeps its place; only if it has another number of rows do those after it move. Rows are numbered where they
    are, by file and place; those of a load that was packed into larger files are put in order by their arrival.
    """
    starts = load_starts(spark, base, entity)
    own = {a.load_id: a for a in placed_attempts(spark, base, RAW, entity.name)[0]}
    columns = entity.raw_table_schema.names
    parts = [no_rows(spark, entity.raw_table_schema.add(name, "long"))]
    for one, start in starts.items():
        if load_id not in (None, one):
            continue
        if one in own:
            reader = spark.read.schema(entity.raw_table_schema)
            reader = reader.option("basePath", layer_path(base, RAW, entity.name))
            rows = reader.parquet(attempt_path(base, RAW, entity.name, one, own[one].attempt))
            numbered = number_table_rows(rows, name)
        else:
            rows = read_layer(spark, base, RAW, entity.name, entity.raw_table_schema, one)
            numbered = number_rows(rows, ["arrival"], name)
        parts.append(numbered.select(*columns, (F.col(name) + start).alias(name)))
    return reduce(DataFrame.unionByName, parts)
