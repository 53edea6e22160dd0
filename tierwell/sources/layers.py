"""Layer tables: Parquet folders ``<base>/<layer>/<table>/load_id=<id>/attempt=<name>``.

Every attempt of a load writes a folder of its own. An empty file in ``<base>/published`` names the
attempt that counts, so a load that fails, or is run again, never takes away rows that readers see.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Fixed value: rows per batch.
BATCH_ROWS = 1000

RAW = "raw"
TRUSTED = "trusted"


def layer_path(base: str, layer: str, table: str) -> str:
    return f"{base.rstrip('/')}/{layer.lower()}/{table}"


def no_rows(spark: SparkSession, schema: StructType) -> DataFrame:
    """An empty table that the optimizer sees to be empty, so joins with it vanish."""
    nulls = [F.lit(None).cast(field.dataType).alias(field.name) for field in schema]
    return spark.range(1).select(*nulls).filter(F.lit(False))


@dataclass(frozen=True)
class Attempt:
    """One published attempt of a load: its place among all publications of the table, the load's
    number among the loads, the folder's name, how the load was merged, and its rows (None if an
    earlier release published it)."""

    place: int
    sequence: int
    load_id: str
    attempt: str
    policy: str
    rows: int | None = None

    @property
    def entry(self) -> str:
        fields = [f"{self.place:012d}", self.sequence, self.load_id, self.attempt, self.policy]
        return "=".join(map(str, fields if self.rows is None else [*fields, self.rows]))


def _entries(spark: SparkSession, base: str, layer: str, table: str):
    """The folder of publications as a Hadoop path, and its file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{base.rstrip('/')}/published/{layer.lower()}/{table}")
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def published(spark: SparkSession, base: str, layer: str, table: str) -> dict[str, Attempt]:
    """The attempt of each load that counts: the last one published. One entry a load."""
    path, files = _entries(spark, base, layer, table)
    if not files.exists(path):
        return {}
    names = sorted(status.getPath().getName() for status in files.listStatus(path))
    found = {}
    for name in names:
        place, sequence, load_id, attempt, policy, *rows = name.split("=")
        count = int(rows[0]) if rows else None
        found[load_id] = Attempt(int(place), int(sequence), load_id, attempt, policy, count)
    return found


def next_sequence(spark: SparkSession, base: str, layer: str, table: str, load_id: str) -> int:
    """A load's number in order of arrival; one that is run again keeps its own."""
    loads = published(spark, base, layer, table)
    if load_id in loads:
        return loads[load_id].sequence
    return 1 + max((a.sequence for a in loads.values()), default=0)


def publish(
    spark: SparkSession,
    base: str,
    layer: str,
    table: str,
    load_id: str,
    attempt: str,
    sequence: int,
    policy: str = "own",
    rows: int | None = None,
) -> None:
    """Make a complete attempt the one that readers see, by creating one empty file.

    Until then, and if anything fails before, readers see the attempt before it.
    """
    path, files = _entries(spark, base, layer, table)
    loads = published(spark, base, layer, table)
    place = 1 + max((a.place for a in loads.values()), default=0)
    entry = Attempt(place, sequence, load_id, attempt, policy, rows).entry
    files.mkdirs(path)
    files.create(spark._jvm.org.apache.hadoop.fs.Path(path, entry), False).close()
    if load_id in loads:
        files.delete(spark._jvm.org.apache.hadoop.fs.Path(path, loads[load_id].entry), False)


def attempt_path(base: str, layer: str, table: str, load_id: str, attempt: str) -> str:
    return f"{layer_path(base, layer, table)}/load_id={load_id}/attempt={attempt}"


# --- compactions: copies of several attempts in one folder, see `compaction` ---------------------


def compacted_path(base: str, layer: str, table: str, name: str) -> str:
    return f"{layer_path(base, layer, table)}-compacted/attempt={name}"


def manifest_path(base: str, layer: str, table: str, name: str) -> str:
    return f"{base.rstrip('/')}/published/held/{layer.lower()}/{table}/attempt={name}"


def enter_compaction(spark: SparkSession, base: str, layer: str, table: str, name: str) -> None:
    """Make a complete compaction one that readers see, by creating one empty file."""
    path, files = _entries(spark, base, layer, f"{table}-compacted")
    files.mkdirs(path)
    files.create(spark._jvm.org.apache.hadoop.fs.Path(path, name), False).close()


@lru_cache(maxsize=1024)
def _held(spark: SparkSession, path: str) -> frozenset[tuple[str, str]]:
    """The (load, attempt) pairs of a compaction; its list never changes."""
    rows = spark.read.schema("load_id string, attempt string").json(path).collect()
    return frozenset((r.load_id, r.attempt) for r in rows)


def compactions(
    spark: SparkSession, base: str, layer: str, table: str
) -> dict[str, frozenset[tuple[str, str]]]:
    """The (load, attempt) pairs that each entered compaction holds."""
    path, files = _entries(spark, base, layer, f"{table}-compacted")
    if not files.exists(path):
        return {}
    names = sorted(status.getPath().getName() for status in files.listStatus(path))
    return {name: _held(spark, manifest_path(base, layer, table, name)) for name in names}


def placed_attempts(
    spark: SparkSession, base: str, layer: str, table: str
) -> tuple[list[Attempt], dict[str, list[Attempt]]]:
    """Published attempts that are read from their own folders, and those read from each compaction."""
    own, copied = [], {}
    held = compactions(spark, base, layer, table)
    for a in published(spark, base, layer, table).values():
        name = next((n for n, pairs in held.items() if (a.load_id, a.attempt) in pairs), None)
        if name is None:
            own.append(a)
        else:
            copied.setdefault(name, []).append(a)
    return own, copied


def read_layer(
    spark: SparkSession,
    base: str,
    layer: str,
    table: str,
    schema: StructType,
    load_id: str | None = None,
    without: str | None = None,
) -> DataFrame:
    """A layer table, one load's rows of it, or those of all loads but one; a table that was never
    written has no rows. Only published attempts are read, or their copies in a compaction.

    The schema is given, so no file is opened to infer it and partition values keep their type.
    """
    own, copied = placed_attempts(spark, base, layer, table)

    def wanted(a: Attempt) -> bool:
        return a.load_id != without and load_id in (None, a.load_id)

    parts = []
    paths = [attempt_path(base, layer, table, a.load_id, a.attempt) for a in own if wanted(a)]
    if paths:
        reader = spark.read.schema(schema).option("basePath", layer_path(base, layer, table))
        parts.append(reader.parquet(*paths).select(*schema.names))
    for name, attempts in copied.items():
        ids = sorted(a.load_id for a in attempts if wanted(a))
        if ids:
            rows = spark.read.schema(schema).parquet(compacted_path(base, layer, table, name))
            held = {i for i, _ in _held(spark, manifest_path(base, layer, table, name))}
            left_out = sorted(held.difference(ids))
            if left_out:
                some = F.col("load_id").isin(ids) if len(ids) <= len(left_out) else ~F.col("load_id").isin(left_out)
                rows = rows.filter(some)
            parts.append(rows.select(*schema.names))
    return reduce(DataFrame.unionByName, parts) if parts else no_rows(spark, schema)


#: What is kept beside the attempts of a layer, in folders named as theirs.
BESIDE = {RAW: "evidence", TRUSTED: "counts"}


def drop_unpublished(spark: SparkSession, base: str, layer: str, table: str) -> int:
    """Delete the folders of attempts that failed, were replaced or are read from a compaction, and what is
    kept beside the first two; returns how many attempts. Not while a load or a report of the table
    runs."""
    own, copied = placed_attempts(spark, base, layer, table)
    there = {a.attempt for a in own}
    known = there | {a.attempt for attempts in copied.values() for a in attempts}
    jvm = spark._jvm.org.apache.hadoop.fs.Path

    def clear(folder: str, pattern: str, keep: set[str]) -> int:
        root = jvm(folder)
        files = root.getFileSystem(spark._jsc.hadoopConfiguration())
        found = files.globStatus(jvm(root, pattern))
        old = [s.getPath() for s in found or () if s.getPath().getName().split("=")[1] not in keep]
        for path in old:
            files.delete(path, True)
        return len(old)

    clear(layer_path(base, BESIDE[layer.lower()], table), "load_id=*/attempt=*", known)
    entered = compactions(spark, base, layer, table).keys()
    clear(f"{layer_path(base, layer, table)}-compacted", "attempt=*", set(entered))
    return clear(layer_path(base, layer, table), "load_id=*/attempt=*", there)


def append_in_batches(df: DataFrame, path: str, max_records: int | None = None) -> None:
    """Append in files of at most ``max_records`` rows (without it, a file a task), all tasks
    writing at once. Give a cap that makes files of some hundred megabytes."""
    df.write.option("maxRecordsPerFile", max_records or 0).mode("append").parquet(path)
