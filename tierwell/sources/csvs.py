"""Headerless CSV with fixed schemas."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

CORRUPT = "corrupt_record"


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType,
    mode: str = "PERMISSIVE",
    corrupt_column: str | None = None,
    multi_line: bool = False,
    line_separator: str | None = None,
    encoding: str = "UTF-8",
) -> DataFrame:
    """Typed scan of headerless CSV files, read in splits by the executors.

    Under PERMISSIVE an unreadable value or missing field becomes null and the row stays;
    ``corrupt_column`` then holds the text of each row that did not fit the schema.
    ``multi_line`` lets quoted fields hold line ends, but makes each file one split; give
    ``line_separator`` too where a file mixes line ends.
    """
    reader = spark.read.options(
        header=False, sep=",", quote='"', encoding=encoding, mode=mode, multiLine=multi_line
    )
    if line_separator:
        reader = reader.option("lineSep", line_separator)
    if corrupt_column is None:
        return reader.schema(schema).csv(path)

    marked = StructType([*schema, StructField(corrupt_column, StringType(), True)])
    df = reader.option("columnNameOfCorruptRecord", corrupt_column).schema(marked).csv(path)
    # Only columns that a query uses are parsed, and a fault in another would go unseen; so the
    # mark uses them all. The condition always holds.
    nulls = reduce(add, [F.col(name).isNull().cast("int") for name in schema.names])
    return df.withColumn(corrupt_column, F.when(nulls >= 0, F.col(corrupt_column)))


def csv_status(
    spark: SparkSession, path: str | list[str], schema: StructType, **options
) -> str:
    """``MISSING`` if the path does not exist, ``EMPTY`` if it holds no rows, else ``OK``."""
    try:
        # One column of one row: taken from the first split that has any, not from every split.
        first = read_csv(spark, path, schema, **options).select(schema.names[0]).take(1)
        return "OK" if first else "EMPTY"
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return "MISSING"
        raise


def parse_csv_column(
    text: Column | str, schema: StructType, corrupt_column: str | None = None
) -> Column:
    """CSV text held in a column as a struct, one record per value."""
    options = {"sep": ",", "quote": '"', "mode": "PERMISSIVE"}
    if corrupt_column:
        schema = StructType([*schema, StructField(corrupt_column, StringType(), True)])
        options["columnNameOfCorruptRecord"] = corrupt_column
    return F.from_csv(text, schema.toDDL(), options)


def accepted_rows(df: DataFrame, corrupt_column: str = CORRUPT) -> DataFrame:
    """Rows that fit the schema."""
    return df.filter(F.col(corrupt_column).isNull())


def quarantined_rows(df: DataFrame, corrupt_column: str = CORRUPT) -> DataFrame:
    """Rows that did not fit the schema, with their text."""
    return df.filter(F.col(corrupt_column).isNotNull())


def without_corrupt(df: DataFrame, corrupt_column: str = CORRUPT) -> DataFrame:
    """Rows that fit the schema, in the schema's columns only."""
    return accepted_rows(df, corrupt_column).drop(corrupt_column)
