"""Statements in SQL that read and write the layers."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tierwell.entities import ENTITIES, Entity
from tierwell.plans.loads import checked_load_id, write_trusted
from tierwell.plans.partials import keep_partials
from tierwell.sources import catalogue
from tierwell.sources.layers import (
    RAW,
    TRUSTED,
    attempt_path,
    layer_path,
    next_sequence,
    path_exists,
    publish,
    published,
)

WRITTEN = StructType(
    [
        StructField("layer", StringType(), False),
        StructField("entity", StringType(), False),
        StructField("load_id", StringType(), False),
        StructField("rows", LongType(), False),
    ]
)
STATEMENT = "statement"


def create_tables(
    spark: SparkSession,
    base: str,
    entities: Mapping[str, Entity] | None = None,
    into: tuple[str, str] | None = None,
    hidden: str | None = None,
) -> list[str]:
    """Catalogue tables ``raw.<entity>`` and ``trusted.<entity>`` of what is published now.

    They are for reading; rows inserted into them directly are never published, see
    ``run_statement``. Tables of these names that were not made here are refused."""
    names = []
    for layer in (RAW, TRUSTED):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")
        for entity in (entities or ENTITIES).values():
            names.append(f"{layer}.{entity.name}")
            left_out = hidden if layer == TRUSTED else None
            catalogue.register(spark, base, layer, entity, names[-1], into, left_out)
    return names


def run_statement(
    spark: SparkSession,
    base: str,
    statement: str,
    load_id: str | None = None,
    entities: Mapping[str, Entity] | None = None,
) -> DataFrame:
    """Run one ``INSERT INTO raw.<entity> | trusted.<entity> (columns) SELECT ...``, and publish what it
    wrote as an attempt of the load ``load_id`` (a new one if not given).

    The statement is Spark SQL and may read both layers, as in ``... SELECT ID, DEPARTMENT FROM RAW.DEPARTMENT
    AS r WHERE NOT EXISTS (SELECT 1 FROM TRUSTED.DEPARTMENT AS t WHERE t.ID = r.ID)``. List the columns: load and
    attempt are filled in. Rows become visible together when it is done; if it fails none does, and the error is raised. Run
    again with the same ``load_id``, it doesn't see the trusted rows it wrote before and replaces them. Returns a row of layer,
    entity, load and rows written for each table written to. One statement or merge of a table at a time.
    """
    entities = entities or ENTITIES
    load_id, attempt = checked_load_id(load_id), uuid.uuid4().hex
    tables = [(layer, entity) for layer in (RAW, TRUSTED) for entity in entities.values()]
    for layer, entity in tables:
        before = published(spark, base, layer, entity.name).get(load_id)
        if before and before.policy != STATEMENT:
            raise ValueError(f"load {load_id!r} of {layer}.{entity.name} was not written by a statement")
    create_tables(spark, base, entities, (load_id, attempt), load_id)
    spark.sql(statement)
    written = []
    for layer, entity in tables:
        path = attempt_path(base, layer, entity.name, load_id, attempt)
        if not path_exists(spark, path):
            continue
        schema = catalogue.table_schema(entity, layer)
        reader = spark.read.schema(schema).option("basePath", layer_path(base, layer, entity.name))
        rows, final = reader.parquet(path), attempt
        if layer == TRUSTED and entity.year_of:
            # The statement can't know the folders of the years: its rows are written to them now.
            final = uuid.uuid4().hex
            write_trusted(spark, rows.select(*entity.trusted_schema.names), entity, base, load_id, final)
        if layer == TRUSTED:
            keep_partials(spark, base, entity, load_id, final)
        count = rows.count()
        sequence = next_sequence(spark, base, layer, entity.name, load_id)
        publish(spark, base, layer, entity.name, load_id, final, sequence, STATEMENT, count)
        written.append((layer, entity.name, load_id, count))
    create_tables(spark, base, entities)
    made = spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in WRITTEN])
    for values in written:
        row = [F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(values, WRITTEN, strict=True)]
        made = made.unionByName(spark.range(1).select(*row))
    return made
