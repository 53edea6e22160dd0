"""Database tables through JDBC. The driver jar and the database belong to the caller."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tierwell.sources.layers import BATCH_ROWS


def read_jdbc(
    spark: SparkSession,
    url: str,
    query: str,
    properties: dict[str, str] | None = None,
    partition_column: str | None = None,
    bounds: tuple[object, object] | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Rows of a query that the database runs.

    Without ``partition_column`` one connection reads everything, which suits report-sized
    results. With it, ``partitions`` tasks each read a stride between ``bounds``; rows outside
    the bounds and rows with a null there are still read, by the edge partitions.
    """
    reader = spark.read.format("jdbc").options(**(properties or {})).option("url", url)
    if partition_column is None:
        return reader.option("query", query).load()
    if bounds is None or partitions is None:
        raise ValueError("a partitioned read needs bounds and partitions")
    lower, upper = bounds
    return reader.options(
        dbtable=f"({query}) source",
        partitionColumn=partition_column,
        lowerBound=str(lower),
        upperBound=str(upper),
        numPartitions=partitions,
    ).load()


def append_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    properties: dict[str, str] | None = None,
    max_records: int = BATCH_ROWS,
    writers: int | None = None,
) -> None:
    """Append in batches of at most ``max_records`` rows, from at most ``writers`` connections.

    Each task is one transaction. A task that is run again after its commit got lost inserts its
    rows again, so load a staging table and merge from it by key where that matters.
    """
    options = {**(properties or {}), "url": url, "dbtable": table, "batchsize": max_records}
    if writers is not None:
        options["numPartitions"] = writers
    df.write.format("jdbc").options(**options).mode("append").save()
