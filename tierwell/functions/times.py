"""Year windows and timestamp parsing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, TimestampNTZType, TimestampType

# Fixed value: the year of a report that names none.
DEFAULT_YEAR = 2021


def _time_type(df: DataFrame, ts: str) -> DataType:
    dtype = df.schema[ts].dataType
    if not isinstance(dtype, (DateType, TimestampNTZType, TimestampType)):
        raise TypeError(f"{ts} is {dtype.simpleString()}, not a date or timestamp")
    return dtype


def _check_year(year: int) -> None:
    if not 1 <= year <= 9999:
        raise ValueError(f"year {year} is outside 1..9999")


def in_window(df: DataFrame, ts: str, start: str, end: str) -> Column:
    """``start <= ts < end``, with bounds of the type of ``ts`` so that the scan can skip data."""
    dtype = _time_type(df, ts)
    return (F.col(ts) >= F.lit(start).cast(dtype)) & (F.col(ts) < F.lit(end).cast(dtype))


def in_year(df: DataFrame, ts: str, year: int = DEFAULT_YEAR) -> Column:
    """The whole year, as a range: ``year(ts) = Y`` would not reach the scan as a filter."""
    _check_year(year)
    dtype = _time_type(df, ts)
    first = F.lit(f"{year:04d}-01-01").cast(dtype)
    # Folded to a literal, also behind the last year that text can name.
    return (F.col(ts) >= first) & (F.col(ts) < first + F.expr("INTERVAL 1 YEAR"))


def between_dates(df: DataFrame, ts: str, first: str, last: str) -> Column:
    """``BETWEEN`` two dates: of the last day only its first instant is inside."""
    dtype = _time_type(df, ts)
    return F.col(ts).between(F.lit(first).cast(dtype), F.lit(last).cast(dtype))


def between_year_dates(df: DataFrame, ts: str, year: int = DEFAULT_YEAR) -> Column:
    """``BETWEEN 'Y-01-01' AND 'Y-12-31'``, which loses Dec 31 but for its first instant."""
    _check_year(year)
    return between_dates(df, ts, f"{year:04d}-01-01", f"{year:04d}-12-31")


def parse_timestamp(
    text: Column | str, strict: bool = False, format: str | None = None
) -> Column:
    """Text to a timestamp without zone; a zone in the text is dropped, not converted.

    Unreadable text gives null, or fails the query if ``strict``. ``format`` is a datetime pattern
    such as ``MM/dd/yyyy``, or ``epoch`` for seconds since 1970; without it ISO text is read.
    """
    column = F.col(text) if isinstance(text, str) else text
    if format == "epoch":
        seconds = column.cast("bigint") if strict else column.try_cast("bigint")
        start = F.lit("1970-01-01").cast(TimestampNTZType())
        return start + F.make_dt_interval(secs=seconds.try_cast("decimal(18,6)"))
    if format is not None:
        if strict:
            return F.to_timestamp_ntz(column, F.lit(format))
        return F.try_to_timestamp(column, F.lit(format)).cast(TimestampNTZType())
    return F.to_timestamp_ntz(column) if strict else column.try_cast(TimestampNTZType())
