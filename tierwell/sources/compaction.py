"""Small attempts of a layer packed into files of a target size, year outermost.

A compaction copies the rows of published attempts, with their load ids, into one folder
``<base>/<layer>/<table>-compacted/attempt=<name>``, writes a list of the attempts it holds beside
it, and is then entered in the publications by one empty file. Until that file is there readers see
the attempts as they were; from then on the copies. A load that is run again is published as an attempt that
no compaction holds, so its old copies are left out.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tierwell.entities import Entity
from tierwell.session import staged
from tierwell.sources.layers import (
    RAW,
    Attempt,
    attempt_path,
    compacted_path,
    enter_compaction,
    layer_path,
    manifest_path,
    placed_attempts,
)

TARGET_BYTES = 256 << 20

PACKED = StructType(
    [
        StructField("loads", LongType(), False),
        StructField("files_before", LongType(), False),
        StructField("files_after", LongType(), False),
    ]
)


def _files(spark: SparkSession, folder: str) -> list[tuple[str, int]]:
    """Data files below a folder with their bytes."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    found, listed = [], files.listFiles(path, True)
    while listed.hasNext():
        status = listed.next()
        if not status.getPath().getName().startswith(("_", ".")):
            found.append((status.getPath().toString(), status.getLen()))
    return found


def bins(sizes: list[tuple[str, int]], target: int) -> list[list[str]]:
    """First fit, the largest first: names in bins of at most ``target``, larger ones alone."""
    made: list[list] = []
    for name, size in sorted(sizes, key=lambda f: (-f[1], f[0])):
        place = next((b for b in made if b[0] + size <= target), None)
        if place is None:
            made.append(place := [0, []])
        place[0] += size
        place[1].append(name)
    return [names for _, names in made]


def _own_name(path: Column | str) -> Column:
    """Attempt, year if there is one, and name of a file: its own among all attempts, where whole paths can be
    written in several ways. Cut off, not matched, since it is done for every row."""
    return F.substring_index(path, "/attempt=", -1)


def _year(file: str) -> str:
    parts = [p for p in file.split("/") if p.startswith("event_year=")]
    return parts[0] if parts else ""


def compact(
    spark: SparkSession, base: str, layer: str, entity: Entity, target_bytes: int = TARGET_BYTES
) -> DataFrame:
    """Pack the attempts whose files are on average below half the target; returns how many loads and files
    it took and how many files it made, all 0 if nothing would become fewer.

    Files are packed by their size, those of one year together, and each bin is written by one task. The driver
    holds an entry for each small file. The copied attempts' folders stay until ``drop_unpublished``. Not while
    a load of the table runs. Tables with ``buckets`` keep their files and are refused.
    """
    if entity.buckets and layer.lower() != RAW:
        raise ValueError(f"{entity.name} is laid out by key; its files can't be packed")
    small: list[tuple[Attempt, list[tuple[str, int]]]] = []
    for a in placed_attempts(spark, base, layer, entity.name)[0]:
        files = _files(spark, attempt_path(base, layer, entity.name, a.load_id, a.attempt))
        if files and 2 * sum(size for _, size in files) < target_bytes * len(files):
            small.append((a, files))
    sizes = [f for _, files in small for f in files]
    by_year: dict[str, list[tuple[str, int]]] = {}
    for file in sizes:
        by_year.setdefault(_year(file[0]), []).append(file)
    packed = [names for year in sorted(by_year) for names in bins(by_year[year], target_bytes)]
    if len(packed) >= len(sizes):
        return _outcome(spark, 0, 0, 0)

    schema = entity.raw_table_schema if layer.lower() == RAW else entity.trusted_table_schema
    paths = [attempt_path(base, layer, entity.name, a.load_id, a.attempt) for a, _ in small]
    rows = (
        spark.read.schema(schema).option("basePath", layer_path(base, layer, entity.name)).parquet(*paths)
    )
    place = [(name, k) for k, names in enumerate(packed) for name in names]
    where = staged(spark.createDataFrame(place, "file string, bin int"), "bins")
    rows = rows.withColumn("_file", _own_name(F.col("_metadata.file_path")))
    rows = rows.join(where.withColumn("_file", _own_name("file")), "_file")
    name = uuid.uuid4().hex
    folders = ["event_year"] if "event_year" in schema.names else []
    rows.repartitionById(len(packed), "bin").select(*schema.names).write.partitionBy(*folders).parquet(
        compacted_path(base, layer, entity.name, name)
    )
    held = spark.createDataFrame([(a.load_id, a.attempt) for a, _ in small], "load_id string, attempt string")
    held.coalesce(1).write.json(manifest_path(base, layer, entity.name, name))
    enter_compaction(spark, base, layer, entity.name, name)
    return _outcome(spark, len(small), len(sizes), len(_files(spark, compacted_path(base, layer, entity.name, name))))


def _outcome(spark: SparkSession, *values: int) -> DataFrame:
    fields = zip(values, PACKED, strict=True)
    return spark.range(1).select(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in fields])
