"""What the values of a raw load tell of their timestamp formats, kept beside each attempt.

A row of sums per attempt under ``<base>/evidence``, written before the attempt is published, so a
replaced attempt's evidence goes with it. The sums of several loads add up: a date that only one
order of day and month can read decides for the loads after it too.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierwell.entities import DETECT, Entity
from tierwell.functions.formats import (
    OK,
    Detected,
    added,
    decided,
    evidence_names,
    evidence_of,
    proof,
    read_detected,
    readable,
    with_readings,
)
from tierwell.functions.times import parse_timestamp
from tierwell.sources.layers import RAW, published


class UndecidedFormat(ValueError):
    """The values of the loads so far don't decide how a timestamp is read."""

    def __init__(self, status: str, message: str):
        super().__init__(message)
        self.status = status


def time_of(entity: Entity, name: str, detected: Mapping[str, Detected] | None = None) -> Column:
    """The timestamp of a text column: by its detected format, a given one, or as ISO text."""
    given = entity.format_of(name)
    if given == DETECT:
        return read_detected(name, (detected or {})[name])
    return parse_timestamp(name, format=given)


def _prefix(name: str) -> str:
    return f"_read_{name}"


def read_once(rows: DataFrame, entity: Entity) -> DataFrame:
    """Rows with what ``can_be_read`` and ``proofs`` need of timestamps to be detected."""
    for name in entity.detected:
        rows = with_readings(rows, name, _prefix(name))
    return rows


def can_be_read(entity: Entity, name: str) -> Column:
    """Whether the text can become a timestamp, whatever order of day and month will be found; of rows that were
    ``read_once``."""
    return readable(name, _prefix(name)) if entity.format_of(name) == DETECT else time_of(entity, name).isNotNull()


def proofs(entity: Entity, where: Column) -> dict[str, Column]:
    """What the rows where the condition holds tell of formats, by names of columns to be ``counted``; of rows that
    were ``read_once``."""
    return {f"_proof_{name}": F.when(where, proof(_prefix(name))) for name in entity.detected}


def counted(entity: Entity) -> list[Column]:
    """Aggregates over the ``proofs`` of a load's rows."""
    return [c for name in entity.detected for c in evidence_of(f"_proof_{name}", name)]


def _names(entity: Entity) -> list[str]:
    return [n for name in entity.detected for n in evidence_names(name)]


def _path(base: str, entity: Entity, load_id: str, attempt: str) -> str:
    return f"{base.rstrip('/')}/evidence/{entity.name}/load_id={load_id}/attempt={attempt}"


def keep(
    spark: SparkSession, base: str, entity: Entity, load_id: str, attempt: str, facts: Mapping
) -> None:
    """Write an attempt's counts, if the entity has timestamps to be detected."""
    if entity.detected:
        row = spark.range(1).select(
            *[F.lit(facts[n]).cast("long").alias(n.replace(".", "_")) for n in _names(entity)]
        )
        row.coalesce(1).write.json(_path(base, entity, load_id, attempt))


def detected_formats(
    spark: SparkSession, base: str, entity: Entity, upto: str | None = None
) -> dict[str, Detected]:
    """How the timestamps of the raw loads are read: by the evidence of all published loads, or of
    those up to the load ``upto`` in order of arrival. Raises ``UndecidedFormat`` if that is open."""
    if not entity.detected:
        return {}
    loads = published(spark, base, RAW, entity.name)
    last = loads[upto].sequence if upto else None
    paths = [
        _path(base, entity, a.load_id, a.attempt)
        for a in loads.values()
        if last is None or a.sequence <= last
    ]
    names = _names(entity)
    found: list[DataFrame] = []
    if paths:
        ddl = ", ".join(f"`{n.replace('.', '_')}` long" for n in names)
        sums = [F.sum(n.replace(".", "_")).alias(n) for n in names]
        found = [spark.read.schema(ddl).json(paths).agg(*sums)]
    counts = added(*[{k: v or 0 for k, v in df.first().asDict().items()} for df in found])
    formats = {name: decided(counts, name) for name in entity.detected}
    open_ = [d for d in formats.values() if d.status != OK]
    if open_:
        raise UndecidedFormat(open_[0].status, "; ".join(d.message for d in open_))
    return formats
