"""Timestamp formats found from the data.

A value's shape decides how it is read: ISO text, a whole number of time units since 1970, a date with the
month's name, or a numeric date `7/27/2021`, `27.7.2021`, `7-27-2021`. Only of the last the shape leaves
something open, whether month or day comes first, and that is decided per separator by all values
of the column: one value above 12 in either place proves the order.

What is counted for that is a row of sums, so evidence of tasks, files and loads adds up.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

# The marks that part a numeric date, and the names under which they are counted.
SEPARATORS = {"/": "slash", ".": "dot", "-": "dash"}
# A whole number below the bound is in units of which so many make a second, as
# databases guess it; beyond all bounds it is nanoseconds.
UNITS = ((31_536_000_000, 1), (31_536_000_000_000, 1_000), (31_536_000_000_000_000, 1_000_000))
NANOS = 1_000_000_000

#: Two numbers and a year, parted by one mark, and what follows: a time, as ISO text has it.
NUMERIC = r"^\s*(\d{1,2})([/.-])(\d{1,2})\2(\d{4})((?:[ T].*)?)$"
#: A day, the month's name (or its first letters) and a year, after a weekday or none.
NAMED = r"^\s*(?:[A-Za-z]{3,9},? +)?(\d{1,2})[- ]([A-Za-z]{3})[A-Za-z]*[- ,]+(\d{4})((?:[ T].*)?)$"
WHOLE = r"^\s*[+-]?\d{1,18}\s*$"
# Fixed value: first letters of the months' names.
MONTHS = "janfebmaraprmayjunjulaugsepoctnovdec"

DAY_FIRST, MONTH_FIRST = "day", "month"
#: What is counted of a separator: values that only one order can read, and those that both can.
EVIDENCE = ("day", "month", "either")

OK, AMBIGUOUS, CONFLICTING = "OK", "AMBIGUOUS", "CONFLICTING"


def _iso(text: Column) -> Column:
    return text.try_cast(TimestampNTZType())


def _numeric(text: Column, order: str) -> Column:
    return _iso(F.regexp_replace(text, NUMERIC, "$4-$1-$3$5" if order == MONTH_FIRST else "$4-$3-$1$5"))


def _named(text: Column) -> Column:
    day, name, year, rest = (F.regexp_extract(text, NAMED, k) for k in range(1, 5))
    at = F.position(F.lower(name), F.lit(MONTHS))
    month = F.when(at % 3 == 1, F.floor((at + 2) / 3).cast("string"))
    zone = r"\s*(?:GMT|UTC|[+-]\d{2}:?\d{2})$"
    return _iso(F.concat(year, F.lit("-"), month, F.lit("-"), day, F.regexp_replace(rest, zone, "")))


def _whole(text: Column) -> Column:
    number = F.trim(text).try_cast("decimal(20,0)")
    units = reduce(
        lambda more, bound: F.when(F.abs(number) < bound[0], F.lit(bound[1])).otherwise(more),
        reversed(UNITS),
        F.lit(NANOS),
    )
    seconds = (number / units).cast("decimal(18,6)")
    return F.lit("1970-01-01").cast(TimestampNTZType()) + F.make_dt_interval(secs=seconds)


def _separator(text: Column) -> Column:
    """The mark of a numeric date, or empty."""
    return F.regexp_extract(text, NUMERIC, 2)


def evidence_names(name: str) -> list[str]:
    return [f"{name}.{mark}.{kind}" for mark in SEPARATORS.values() for kind in EVIDENCE]


def _of_mark(mark: Column, text: Column, order: str) -> Column:
    return F.when(mark != "", _numeric(text, order))


def with_readings(df: DataFrame, text: str, prefix: str) -> DataFrame:
    """The mark of each value's numeric date, or empty, and its times with the day and with the month first, in
    columns ``<prefix>_mark``, ``<prefix>_day`` and ``<prefix>_month``: matched once a row, for ``proof`` and ``readable``."""
    column, mark = F.col(text), F.col(f"{prefix}_mark")
    df = df.withColumn(f"{prefix}_mark", _separator(column))
    return df.withColumns(
        {f"{prefix}_{order}": _of_mark(mark, column, order) for order in (DAY_FIRST, MONTH_FIRST)}
    )


def _proof(mark: Column, day: Column, month: Column) -> Column:
    """What a value tells of the order of day and month, as a number by separator and kind; null if nothing."""
    kind = (
        F.when(month.isNull(), F.when(day.isNotNull(), 0))
        .when(day.isNull(), 1)
        # 3/3/2021 is the same day in both orders.
        .when(day != month, 2)
    )
    return F.position(mark, F.lit("".join(SEPARATORS))) * len(EVIDENCE) + kind


def proof(prefix: str) -> Column:
    """The proof of a value with readings, to be counted by ``evidence_of``."""
    return _proof(*[F.col(f"{prefix}_{k}") for k in ("mark", DAY_FIRST, MONTH_FIRST)])


def evidence_of(proofs: Column | str, name: str) -> list[Column]:
    """Counts of proofs that decide the order of day and month: aggregates to be taken over all rows, or observed."""
    column = F.col(proofs) if isinstance(proofs, str) else proofs
    return [
        F.count_if(F.coalesce(column == (at * len(EVIDENCE) + k), F.lit(False))).alias(f"{name}.{called}.{kind}")
        for at, called in enumerate(SEPARATORS.values(), 1)
        for k, kind in enumerate(EVIDENCE)
    ]


def evidence(text: Column | str, name: str) -> list[Column]:
    """The same straight from the text, which is then matched for each of the counts."""
    column = F.col(text) if isinstance(text, str) else text
    mark = _separator(column)
    return evidence_of(_proof(mark, *[_of_mark(mark, column, order) for order in (DAY_FIRST, MONTH_FIRST)]), name)


def added(*parts: Mapping[str, int]) -> dict[str, int]:
    """Evidence of several parts of a column."""
    names = {name for part in parts for name in part}
    return {name: sum(part.get(name, 0) for part in parts) for name in sorted(names)}


@dataclass(frozen=True)
class Detected:
    """The order of day and month for each separator (None: no value needs one), and whether the
    values decide it."""

    orders: tuple[tuple[str, str | None], ...]
    status: str
    message: str | None = None

    def order(self, separator: str) -> str:
        return dict(self.orders)[separator] or MONTH_FIRST


def decided(counts: Mapping[str, int], name: str) -> Detected:
    """``AMBIGUOUS`` if values can be read in both orders and none proves one, ``CONFLICTING`` if both
    are proved, else ``OK``."""
    orders, status, said = [], OK, []
    for separator, called in SEPARATORS.items():
        day, month, either = (counts.get(f"{name}.{called}.{kind}", 0) for kind in EVIDENCE)
        if day and month:
            status = CONFLICTING
            said.append(f"of dates with {separator!r} {day} prove the day first, {month} the month")
        elif either and not day and not month:
            status = AMBIGUOUS if status == OK else status
            said.append(f"{either} dates with {separator!r} can be read in both orders")
        orders.append((separator, DAY_FIRST if day else MONTH_FIRST if month else None))
    message = f"{name}: {'; '.join(said)}" if said else None
    return Detected(tuple(orders), status, message)


def detect(df: DataFrame, text: str) -> Detected:
    """The format of a column, from one aggregate over all its rows."""
    read = with_readings(df.select(text), text, "_read")
    return decided(read.select(proof("_read").alias("_proof")).agg(*evidence_of("_proof", text)).first().asDict(), text)


def read_detected(text: Column | str, detected: Detected) -> Column:
    """Text to a timestamp without zone by its shape; null if no shape fits or the day doesn't exist.

    Digits only are a number of seconds, milli-, micro- or nanoseconds since 1970, by magnitude. A zone
    in the text is dropped, not converted.
    """
    column = F.col(text) if isinstance(text, str) else text
    numeric = column  # as ISO text; what has no such date stays as it is
    for order, places in ((DAY_FIRST, "$4-$3-$1$5"), (MONTH_FIRST, "$4-$1-$3$5")):
        marks = "".join(s for s in SEPARATORS if detected.order(s) == order)
        if marks:
            numeric = F.regexp_replace(numeric, NUMERIC.replace("".join(SEPARATORS), marks), places)
    made = F.when(column.rlike(WHOLE), _whole(column)).when(column.rlike(NAMED), _named(column))
    return made.otherwise(_iso(numeric))


def readable(text: Column | str, prefix: str) -> Column:
    """Whether a value with readings can be read in any order of day and month."""
    column = F.col(text) if isinstance(text, str) else text
    mark, day, month = (F.col(f"{prefix}_{k}") for k in ("mark", DAY_FIRST, MONTH_FIRST))
    made = F.when(mark != "", F.coalesce(day, month)).when(column.rlike(WHOLE), _whole(column))
    return made.when(column.rlike(NAMED), _named(column)).otherwise(_iso(column)).isNotNull()
