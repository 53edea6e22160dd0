"""What the operators share: tables, stable copies, per-document work in Arrow batches."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Documents that a task turns into Python objects at a time.
ROWS_AT_ONCE = 256

#: White space that ends a word: `bytes.split()` splits at just these.
SPACE = "[\\x20\\x09-\\x0D]+"
WORD = "[^\\x20\\x09-\\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def quoted(name: str) -> str:
    """A column's name as `F.col` takes it, dots and backticks included."""
    return "`" + name.replace("`", "``") + "`"


def row_hash(df: DataFrame) -> F.Column:
    """A hash of all columns of a row, maps included."""
    plain = [c for c in df.columns if "map<" not in df.schema[c].dataType.simpleString()]
    maps = [F.to_json(F.struct(F.col(quoted(c)))) for c in df.columns if c not in plain]
    return F.xxhash64(*[F.col(quoted(c)) for c in plain], *maps)


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors reach: `spark.checkpoint.dir`, else the session's warehouse."""
    return (
        spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    ).rstrip("/")


def stable(df: DataFrame) -> DataFrame:
    """Writes ``df`` to the shared folder once and reads it back.

    Cuts lineage: a lost executor costs a read of these files, not the work before them. The
    folder goes when the session ends.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(jvm_path)
    return spark.read.schema(df.schema).parquet(path)


def per_batch(
    df: DataFrame, schema: T.StructType | str, make: Callable[[], Callable[..., dict]]
) -> DataFrame:
    """Maps batches of rows. ``make`` is called once in a task; what it returns gets one list for
    each column of ``df`` and returns a list (or array) for each column of ``schema``."""
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(start, ROWS_AT_ONCE)
                made = work(*(column.to_pylist() for column in part.columns))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(made[f.name], f.type) for f in arrow], schema=arrow
                )

    return df.mapInArrow(run, schema)


def spread(spark: SparkSession) -> int:
    """Tasks of a shuffle."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def held_out(doc_id) -> F.Column:
    """True for the fifth of the documents whose labels are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))
