"""Insert-if-absent merge by key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    ByteType,
    DateType,
    IntegerType,
    LongType,
    ShortType,
    StringType,
    TimestampNTZType,
    TimestampType,
)
from pyspark.sql.window import Window

from tierwell.session import staged

# Fixed value: monotonically_increasing_id() keeps the row's place in its partition in the low
# 33 bits and the partition's number above them.
PLACE_BITS = 33

# Types that a hash aggregate can change in place; not those with two zeros or several NaN, which keys would lose.
FIXED_WIDTH = (ByteType, ShortType, IntegerType, LongType, BooleanType, DateType, TimestampType, TimestampNTZType)


def any_null(columns: Sequence[str]) -> Column:
    return reduce(or_, [F.col(c).isNull() for c in columns])


def all_present(columns: Sequence[str]) -> Column:
    return reduce(and_, [F.col(c).isNotNull() for c in columns])


def _first_of_keyed(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    # An aggregate, so each task sends one row per key: a hot key does not collect in one task.
    # The keys stay columns of their own, so that a join on them finds the rows in place.
    named = {c.lower() for c in (*keys, *order_by)}
    others = [c for c in df.columns if c.lower() not in named]
    if not order_by and not others:
        return df.distinct()
    least = F.min(F.struct(*order_by, *others)).alias("_least")
    first = df.groupBy(*keys).agg(least)
    ordered = [c for c in order_by if c.lower() not in {k.lower() for k in keys}]
    return first.select(
        *keys, *[F.col("_least")[c].alias(c) for c in (*ordered, *others)]
    ).select(*df.columns)


def first_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The row of each key that is least in the columns ``order_by``; rows without a key all stay.

    Nulls come first, as in an ascending sort. Ties go to the row that is least in its other
    columns, so the result is the same in every run; all columns must be of types with an order.
    """
    keyed = _first_of_keyed(df.filter(all_present(keys)), keys, order_by)
    return keyed.unionByName(df.filter(any_null(keys)))


def with_place(
    df: DataFrame, parts: Sequence[str], within: str, name: str = "_place"
) -> DataFrame:
    """A long that is different for all rows and in order of ``parts``, then of ``within``.

    ``parts`` name where a row comes from, such as file and split, and have few different values: they are
    ranked, one row each, and staged, so that Spark knows their size when it chooses the join. ``within`` is
    a number below 2**33, or one whose low 33 bits are, that differs within a part.
    """
    order = Window.orderBy(*parts)
    ranks = df.select(*parts).distinct().withColumn("_rank", F.row_number().over(order))
    ranks = staged(ranks.select(*[F.col(p).alias(f"_part{k}") for k, p in enumerate(parts)], "_rank"), "ranks")
    same = reduce(and_, [F.col(p).eqNullSafe(F.col(f"_part{k}")) for k, p in enumerate(parts)])
    low = F.col(within).bitwiseAND((1 << PLACE_BITS) - 1)
    place = F.shiftleft(F.col("_rank").cast("long"), PLACE_BITS).bitwiseOR(low)
    return df.join(ranks, same).select(*df.columns, place.alias(name))


def _fits_hash(df: DataFrame, keys: Sequence[str], place: str) -> bool:
    """Whether a hash aggregate by the keys can hold the rows and gives the keys back as they are."""
    named = {k.lower() for k in keys}
    others = [f.dataType for f in df.schema if f.name.lower() not in named]
    kept = [f.dataType for f in df.schema if f.name.lower() in named]
    return all(isinstance(t, FIXED_WIDTH) for t in others) and all(
        isinstance(t, (*FIXED_WIDTH, StringType)) for t in kept
    )


def _first_by_place(df: DataFrame, known: DataFrame, keys: Sequence[str], place: str) -> DataFrame:
    if _fits_hash(df, keys, place):
        # Rows of fixed width are aggregated whole, by hash: one scan and one shuffle, of a row a key and task.
        named = {k.lower() for k in (*keys, place)}
        others = [F.min_by(c, place).alias(c) for c in df.columns if c.lower() not in named]
        first = df.groupBy(*keys).agg(F.min(place).alias(place), *others)
        return first.join(known.distinct(), list(keys), "left_anti")
    # Only keys and places are aggregated, by hash, and meet the target's keys; the rows follow for the
    # places that are left, each found once. Places differ, so no task of that join can be hot.
    least = df.groupBy(*keys).agg(F.min(place).alias("_least"))
    least = least.join(known.distinct(), list(keys), "left_anti").select("_least")
    return df.join(least.hint("shuffle_hash"), F.col(place) == F.col("_least"), "left_semi")


def absent_rows(
    source: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    null_keys: str = "insert",
    source_duplicates: str = "keep",
    order_by: Sequence[str] = (),
    place: str | None = None,
) -> DataFrame:
    """Source rows whose key is not in the target.

    ``null_keys``: a null key equals nothing, so such rows are absent every time (``insert``) or
    are left out (``reject``). ``source_duplicates``: rows of the source that share a key all
    count as absent (``keep``), or only the ``first`` in ``order_by`` does.

    One plan for all sizes and keys: an anti join with the target's distinct keys. Spark's own
    statistics decide if those are broadcast; else both sides meet on the key, of the target each
    key once per task, and AQE splits a hot key's rows. ``first`` aggregates before that, so a
    task sends one row per key. ``place`` names a column of different longs in the order that decides,
    in place of ``order_by``: then only keys and places are aggregated, and the rows are
    fetched at the end; rows whose other columns are of fixed width are aggregated whole.
    """
    if null_keys not in ("insert", "reject"):
        raise ValueError(f"null_keys={null_keys!r}")
    if source_duplicates not in ("keep", "first"):
        raise ValueError(f"source_duplicates={source_duplicates!r}")
    if source_duplicates == "first" and not order_by and not place:
        raise ValueError("source_duplicates='first' needs order_by or place")

    # Rows without a key skip the join: they would all hash to one partition.
    keyed = source.filter(all_present(keys))
    known = target.filter(all_present(keys)).select(*keys)
    if source_duplicates == "first" and place:
        absent = _first_by_place(keyed, known, keys, place)
    else:
        if source_duplicates == "first":
            keyed = _first_of_keyed(keyed, keys, order_by)
        absent = keyed.join(known.distinct(), list(keys), "left_anti")
    absent = absent.select(*source.columns)

    if null_keys == "insert":
        absent = absent.unionByName(source.filter(any_null(keys)))
    return absent


def insert_if_absent(
    source: DataFrame, target: DataFrame, keys: Sequence[str], **policy
) -> DataFrame:
    """The target after the merge: its own rows, never changed, and the ``absent_rows``."""
    return target.unionByName(absent_rows(source, target, keys, **policy).select(*target.columns))
