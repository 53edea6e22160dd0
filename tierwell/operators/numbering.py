"""Dense row numbers and batches of bounded size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tierwell.operators.merge import PLACE_BITS
from tierwell.session import staged
from tierwell.sources.layers import BATCH_ROWS


def number_rows(
    df: DataFrame,
    order_by: Sequence[str | Column] = (),
    name: str = "row_number",
    path: str | None = None,
) -> DataFrame:
    """Dense numbers 1..n in order of arrival, or in the given order with ties by arrival.

    No window over all rows: rows are tagged with partition and place, staged once, and each
    partition's number range follows from the partition sizes, one row per task of the staging
    job; they are staged too, so that Spark knows their size when it chooses the join. With ``order_by`` the input is sorted by
    range first; arrival is part of the sort key, so a value shared by many rows is spread over
    partitions. Arrival is the order of the input's partitions and of the rows in them: for an
    order that is the same in every run, number a stored table, or stage the input.

    The result reads the staged table: give ``path`` to say where it is, and clear it when done.
    """
    if order_by:
        df = df.withColumn("_arrival", F.monotonically_increasing_id())
        df = df.orderBy(*order_by, "_arrival").drop("_arrival")
    tagged = df.withColumn("_position", F.monotonically_increasing_id())
    tagged = staged(tagged, "numbered", path)

    place = F.col("_position").bitwiseAND((1 << PLACE_BITS) - 1)
    numbered = tagged.withColumn("_partition", F.shiftright("_position", PLACE_BITS))
    sizes = numbered.groupBy("_partition").agg(F.count(F.lit(1)).alias("_size"))
    before = F.sum("_size").over(Window.orderBy("_partition")) - F.col("_size")
    starts = staged(sizes.select("_partition", before.alias("_start")), "starts")
    return (
        numbered.join(starts, "_partition")
        .withColumn(name, F.col("_start") + place + 1)
        .drop("_partition", "_position", "_start")
    )


def file_starts(table: DataFrame) -> DataFrame:
    """For each file of a stored table the number of rows, and of those in the files before it, by
    name. One row per file, staged, so that Spark knows its size when it chooses a join."""
    file = F.col("_metadata.file_path").alias("_file")
    sizes = table.select(file).groupBy("_file").agg(F.count(F.lit(1)).alias("_size"))
    before = F.sum("_size").over(Window.orderBy("_file")) - F.col("_size")
    return staged(sizes.select("_file", "_size", before.alias("_start")), "starts")


def number_table_rows(
    table: DataFrame, name: str = "row_number", starts: DataFrame | None = None
) -> DataFrame:
    """Dense numbers 1..n for the rows of a stored Parquet table, by file and place in the file.

    ``table`` is as read, before any filter. No row is staged: Parquet knows each row's place, and a
    scan without columns counts the rows per file. The order of files is that of their names. Some files of
    a table get the numbers they have in it if ``starts`` are the ``file_starts`` of the whole.
    """
    starts = (file_starts(table) if starts is None else starts).select("_file", "_start")
    file = F.col("_metadata.file_path").alias("_file")
    placed = table.select("*", file, F.col("_metadata.row_index").alias("_place"))
    return (
        placed.join(starts, "_file")
        .withColumn(name, F.col("_start") + F.col("_place") + 1)
        .drop("_file", "_place", "_start")
    )


def assign_batches(
    numbered: DataFrame,
    max_records: int = BATCH_ROWS,
    number: str = "row_number",
    name: str = "batch_id",
) -> DataFrame:
    """Batch ids from 0, each batch with ``max_records`` rows but for the last."""
    return numbered.withColumn(name, F.expr(f"(`{number}` - 1) div {int(max_records)}"))


def batch_counts(batched: DataFrame, name: str = "batch_id") -> DataFrame:
    """Rows per batch."""
    return batched.groupBy(name).agg(F.count(F.lit(1)).alias("records"))


def number_of_batches(df: DataFrame, max_records: int = BATCH_ROWS) -> DataFrame:
    """How many batches the rows make, from their count alone."""
    rows = F.count(F.lit(1))
    return df.agg(F.ceil(rows / F.lit(int(max_records))).alias("batches"))
