"""Batched append that can be resumed.

Rows of a stored table are numbered where they are; ranges of numbers are written one after the other, each by
all tasks at once, and each range that is complete gets an entry in a ledger. A run that finds entries
writes only the ranges without one, so a job that stopped and is run again appends each row once.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tierwell.operators.numbering import file_starts, number_table_rows
from tierwell.sources.layers import BATCH_ROWS, no_rows

#: Hidden from Spark's listing of the table by its first letter.
LEDGER = "_committed"

RANGES = StructType(
    [
        StructField("first_row", LongType(), False),
        StructField("last_row", LongType(), False),
        StructField("batches", LongType(), False),
    ]
)


def _ledger(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{LEDGER}")
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def _entries(spark: SparkSession, path: str) -> tuple[str | None, dict[tuple[int, int], str]]:
    """The source that the ledger is of, and the attempt that wrote each range. If two runs at once
    wrote a range, the one that is first by name counts: both hold the same rows."""
    folder, files = _ledger(spark, path)
    source, found = None, {}
    if files.exists(folder):
        for name in sorted(s.getPath().getName() for s in files.listStatus(folder)):
            if name.startswith("source="):
                source = source or name.removeprefix("source=")
            else:
                first, last, attempt = name.split("-")
                found.setdefault((int(first), int(last)), attempt)
    return source, found


def _enter(spark: SparkSession, path: str, name: str) -> None:
    folder, files = _ledger(spark, path)
    files.mkdirs(folder)
    files.create(spark._jvm.org.apache.hadoop.fs.Path(folder, name), False).close()


def _range_path(path: str, first: int, last: int, attempt: str) -> str:
    return f"{path.rstrip('/')}/rows={first}-{last}/attempt={attempt}"


def append_resumably(
    table: DataFrame,
    path: str,
    batch_rows: int = BATCH_ROWS,
    batches_per_commit: int = 10_000,
    commits: int | None = None,
) -> DataFrame:
    """Append a stored Parquet table, as read and before any filter, in files of at most ``batch_rows`` rows.

    Each commit is one job over ``batches_per_commit`` batches; choose them so that a commit is worth
    losing. ``commits`` bounds the commits of this run. Only files of the source that hold a range's rows
    are read for it; the driver holds one entry for each file and each range. A source whose files or
    row counts differ from those that the ledger is of is refused. Returns the ranges that this run wrote; none if the
    table is empty or all of it is there.
    """
    spark = table.sparkSession
    placed = file_starts(table)
    starts = [(r["_file"], r["_start"], r["_size"]) for r in placed.orderBy("_file").collect()]
    own = hashlib.sha256(repr([batch_rows, batches_per_commit, starts]).encode()).hexdigest()
    source, done = _entries(spark, path)
    if source not in (None, own):
        raise ValueError(f"{path} was begun with another source, or other batches")
    if source is None and starts:
        _enter(spark, path, f"source={own}")
    total = sum(size for _, _, size in starts)
    step = batch_rows * batches_per_commit
    ranges = [(first, min(first + step - 1, total)) for first in range(1, total + 1, step)]
    missing = [r for r in ranges if r not in done][:commits]
    for first, last in missing:
        files = [f for f, start, size in starts if start < last and start + size >= first]
        read = table.filter(F.col("_metadata.file_path").isin(files))
        rows = number_table_rows(read, "_number", placed).filter(F.col("_number").between(first, last))
        attempt = uuid.uuid4().hex
        rows.select(*table.columns).write.option("maxRecordsPerFile", batch_rows).parquet(
            _range_path(path, first, last, attempt)
        )
        _enter(spark, path, f"{first}-{last}-{attempt}")
    made = no_rows(spark, RANGES)
    for first, last in missing:
        values = (first, last, -(-(last - first + 1) // batch_rows))
        row = [F.lit(v).cast("long").alias(f.name) for v, f in zip(values, RANGES, strict=True)]
        made = made.unionByName(spark.range(1).select(*row))
    return made


def read_appended(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The rows of all committed ranges; those of a range that was not finished are not seen."""
    _, done = _entries(spark, path)
    if not done:
        return no_rows(spark, schema)
    paths = [_range_path(path, first, last, attempt) for (first, last), attempt in done.items()]
    return spark.read.schema(schema).parquet(*paths)
