"""Rows as JSON objects."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierwell.operators.numbering import number_rows


def json_records(df: DataFrame, keep_nulls: bool = False) -> DataFrame:
    """One column ``json`` with one object per row; null fields are left out unless kept."""
    options = {"ignoreNullFields": str(not keep_nulls).lower()}
    return df.select(F.to_json(F.struct("*"), options).alias("json"))


def write_json(df: DataFrame, path: str, keep_nulls: bool = False, mode: str = "error") -> None:
    """The same objects as JSON lines, written by the executors."""
    options = {"ignoreNullFields": str(not keep_nulls).lower()}
    df.write.options(**options).mode(mode).json(path)


def write_ordered(
    df: DataFrame,
    path: str,
    order_by: Sequence[str | Column],
    rank: str = "rank",
    format: str = "json",
    mode: str = "error",
    **options,
) -> None:
    """Rows in an order that outlives the sink: each has its rank, 1 and so on, and files in order of their
    names hold the rows in order. All tasks sort and write; ties are in order of arrival.

    JSON objects keep null fields, so that each row has all of them."""
    numbered = number_rows(df, order_by, name=rank).orderBy(rank)
    options = {"ignoreNullFields": "false", **options} if format == "json" else options
    numbered.select(rank, *df.columns).write.format(format).options(**options).mode(mode).save(path)
