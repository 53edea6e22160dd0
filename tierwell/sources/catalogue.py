"""Layer tables in Spark's catalogue, for statements that read and write them.

A table lies at its layer folder, parted by load and attempt as the folder is, and has the published
attempts as its partitions and no others. The partition columns' defaults name the next attempt, so an
``INSERT`` that lists the table's own columns lands in a folder of its own, which readers see only
when it is published: a statement that fails leaves no row.

Tables of an entity with ``buckets`` hold each attempt's rows by hash of the key, sorted. Spark then
knows where a key lies, and a merge moves only its source.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tierwell.entities import Entity
from tierwell.sources.layers import (
    RAW,
    attempt_path,
    compacted_path,
    compactions,
    layer_path,
    placed_attempts,
)

#: Property that marks tables made here, and says for which folder.
OWNER = "tierwell.base"
PARTS = ("load_id", "attempt")
#: What statements see as the load of rows in a compaction.
COMPACTED = "~compacted"


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _name(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def table_schema(entity: Entity, layer: str) -> StructType:
    """The table's own columns, then those that part it: load, attempt and, if there is one, year."""
    whole = entity.raw_table_schema if layer.lower() == RAW else entity.trusted_table_schema
    year = [f for f in whole if f.name == "event_year"]
    own = [f for f in whole if f.name not in ("load_id", "event_year")]
    return StructType([*own, *[StructField(p, StringType()) for p in PARTS], *year])


def _partitions(spark: SparkSession, base: str, layer: str, entity: Entity, hidden: str | None):
    """(values, folder) of each published attempt and compaction, or of each year of it."""
    own, copied = placed_attempts(spark, base, layer, entity.name)
    places = [
        (a.load_id, a.attempt, attempt_path(base, layer, entity.name, a.load_id, a.attempt))
        for a in own
        if a.load_id != hidden
    ]
    held = compactions(spark, base, layer, entity.name)
    for name, attempts in copied.items():
        if len(attempts) < len(held[name]) or hidden in {a.load_id for a in attempts}:
            raise ValueError(
                f"{layer}.{entity.name}: a compaction holds rows of a load that was run again or is hidden; "
                "a catalogue table can't leave out a part of its files"
            )
        places.append((COMPACTED, name, compacted_path(base, layer, entity.name, name)))
    by_year = "event_year" in table_schema(entity, layer).names
    for load_id, attempt, path in places:
        values = f"load_id={_quoted(load_id)}, attempt={_quoted(attempt)}"
        if not by_year:
            yield values, path
            continue
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
        for status in files.globStatus(spark._jvm.org.apache.hadoop.fs.Path(folder, "event_year=*")):
            year = status.getPath().getName().split("=")[1]
            yield f"{values}, event_year={year if year.lstrip('-').isdigit() else 'NULL'}", status.getPath().toString()


def register(
    spark: SparkSession,
    base: str,
    layer: str,
    entity: Entity,
    name: str,
    into: tuple[str, str] | None = None,
    hidden: str | None = None,
) -> None:
    """Make the catalogue table ``name`` of a layer table, in place of a former one made here.

    ``into`` is the load and attempt that inserted rows go to; ``hidden`` a load whose rows are left
    out. Attempts published later are not seen until the table is registered again.
    """
    if spark.catalog.tableExists(name):
        properties = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
        if OWNER not in properties:
            raise ValueError(f"table {name} is not one of a layer; it is left alone")
        spark.sql(f"DROP TABLE {name}")
    schema = table_schema(entity, layer)
    defaults = dict(zip(PARTS, into, strict=True)) if into else {}
    columns = ", ".join(
        f"{_name(f.name)} {f.dataType.simpleString()}"
        + (f" DEFAULT {_quoted(defaults[f.name])}" if f.name in defaults else "")
        for f in schema
    )
    parts = ", ".join(_name(n) for n in schema.names if n in (*PARTS, "event_year"))
    keys = ", ".join(map(_name, entity.keys))
    buckets = ""
    if entity.buckets and layer.lower() != RAW:
        buckets = f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {entity.buckets} BUCKETS"
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet PARTITIONED BY ({parts}) {buckets} "
        f"LOCATION {_quoted(layer_path(base, layer, entity.name))} "
        f"TBLPROPERTIES ({_quoted(OWNER)} = {_quoted(base)})"
    )
    found = [f"PARTITION ({v}) LOCATION {_quoted(p)}" for v, p in _partitions(spark, base, layer, entity, hidden)]
    for at in range(0, len(found), 500):
        spark.sql(f"ALTER TABLE {name} ADD {' '.join(found[at : at + 500])}")


@contextmanager
def registered(spark: SparkSession, base: str, layer: str, entity: Entity, **options) -> Iterator[str]:
    """A catalogue table under a name of its own, as long as the block runs."""
    name = f"default.{_name(f'{entity.name}_{uuid.uuid4().hex}')}"
    register(spark, base, layer, entity, name, **options)
    try:
        yield name
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def insert(rows: DataFrame, name: str, load_id: str, attempt: str) -> None:
    """Append rows to an attempt of a registered table, in the table's layout; what Spark does not
    say of a year column is that of the rows."""
    spark = rows.sparkSession
    own = rows.withColumns({"load_id": F.lit(load_id), "attempt": F.lit(attempt)})
    own.select(*spark.table(name).columns).write.insertInto(name)
