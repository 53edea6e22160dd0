"""Counts kept with each published attempt of a fact, which the reports add up.

They lie under ``<base>/counts``, one folder an attempt as in the layer, written before the attempt
is published: a load adds its counts, and a load that is run again replaces them. A report then reads a row
per year, quarter and pair of ids of each load, and no row of the fact.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from tierwell.entities import Entity
from tierwell.operators.counts import partial_counts
from tierwell.sources.layers import TRUSTED, attempt_path, layer_path, no_rows, path_exists, published, read_layer


def partials_schema(entity: Entity) -> StructType:
    ids = [entity.schema[name].dataType for name in entity.counted_by]
    return StructType(
        [
            StructField("year", IntegerType()),
            StructField("quarter", IntegerType()),
            StructField("department_id", ids[0]),
            StructField("job_id", ids[1]),
            StructField("rows", LongType()),
            StructField("with_id", LongType()),
            StructField("upto_literal", LongType()),
        ]
    )


def _path(base: str, entity: Entity, load_id: str, attempt: str) -> str:
    return f"{base.rstrip('/')}/counts/{entity.name}/load_id={load_id}/attempt={attempt}"


def _counted(rows: DataFrame, entity: Entity) -> DataFrame:
    department_id, job_id = entity.counted_by
    return partial_counts(rows, entity.year_of, department_id, job_id, entity.keys[0])


def keep_partials(spark: SparkSession, base: str, entity: Entity, load_id: str, attempt: str) -> None:
    """Count a complete attempt that is not published yet, if the entity has its counts kept."""
    if entity.counted_by:
        reader = spark.read.schema(entity.trusted_table_schema)
        reader = reader.option("basePath", layer_path(base, TRUSTED, entity.name))
        rows = reader.parquet(attempt_path(base, TRUSTED, entity.name, load_id, attempt))
        counts = _counted(rows, entity)
        counts.write.parquet(_path(base, entity, load_id, attempt))


def read_partials(spark: SparkSession, base: str, entity: Entity) -> DataFrame:
    """The counts of all published attempts; one from before counts were kept is counted from its rows."""
    schema = partials_schema(entity)
    attempts = published(spark, base, TRUSTED, entity.name).values()
    paths = {_path(base, entity, a.load_id, a.attempt): a for a in attempts}
    kept = [path for path in paths if path_exists(spark, path)]
    parts = [spark.read.schema(schema).parquet(*kept)] if kept else [no_rows(spark, schema)]
    for path, a in paths.items():
        if path not in kept:
            rows = read_layer(spark, base, TRUSTED, entity.name, entity.trusted_table_schema, a.load_id)
            parts.append(_counted(rows, entity).select(*schema.names))
    return reduce(DataFrame.unionByName, parts)
