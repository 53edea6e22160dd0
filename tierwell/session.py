"""Session settings and the shared folder for staged tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the operators count on: AQE merges small shuffle partitions and splits hot ones. How wide
# a shuffle starts is for the caller to set, see README.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def session(app: str = "tierwell", master: str | None = None, **settings: str) -> SparkSession:
    """A session with SETTINGS; ``settings`` (underscores for dots) override and extend them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in settings.items():
        builder = builder.config(key.replace("_", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``, else the warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return (folder or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")


def new_shared_path(spark: SparkSession, name: str) -> str:
    """An unused path for a table in the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str = "staged", path: str | None = None) -> DataFrame:
    """``df`` written to the shared folder, or to ``path``, and read back.

    Cuts the lineage and fixes values that depend on the partitioning. The table outlives lost
    executors; like a checkpoint it stays where it is until its owner clears it.
    """
    path = path or new_shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
