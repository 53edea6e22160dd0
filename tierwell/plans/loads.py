"""Loads: CSV file to raw layer to trusted layer, with a logged outcome."""

from __future__ import annotations

import re
import threading
import uuid
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from contextlib import ExitStack
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tierwell.entities import DEPARTMENT, HIRED_EMPLOYEE, JOB, Entity
from tierwell.functions.formats import Detected
from tierwell.functions.times import DEFAULT_YEAR
from tierwell.operators.merge import absent_rows, any_null, with_place
from tierwell.plans.partials import keep_partials
from tierwell.plans.reports import departments_above_mean, hires_by_quarter
from tierwell.sources import catalogue, evidence
from tierwell.sources.csvs import CORRUPT, read_csv
from tierwell.sources.layers import (
    RAW,
    TRUSTED,
    attempt_path,
    next_sequence,
    publish,
    published,
    read_layer,
)

OUTCOME = StructType(
    [
        StructField("entity", StringType(), False),
        StructField("load_id", StringType(), False),
        StructField("status", StringType(), False),
        StructField("rows_read", LongType(), False),
        StructField("rows_quarantined", LongType(), False),
        StructField("batches", LongType(), False),
        StructField("rows_raw", LongType(), False),
        StructField("rows_trusted", LongType(), False),
        StructField("message", StringType(), True),
    ]
)

# Order of arrival, kept in the raw table: file, then split, then place in the split.
ARRIVAL = ("source_file", "source_offset", "arrival")


class SourceMissing(Exception):
    """There is nothing at the path of a load's source."""


def to_trusted(
    rows: DataFrame, entity: Entity, detected: Mapping[str, Detected] | None = None, *others: str
) -> DataFrame:
    """The entity's columns with their trusted types, and ``others`` as they are; ``detected`` says how timestamps
    are read whose format is found from the data."""

    def trusted(name: str) -> Column:
        if name not in entity.timestamps:
            return F.col(name)
        return evidence.time_of(entity, name, detected).alias(name)

    return rows.select(*[trusted(f.name) for f in entity.schema], *others)


def _reject_reason(entity: Entity, null_keys: str, keep_malformed: bool) -> Column:
    reason = F.lit(None).cast("string")
    if null_keys == "reject":
        reason = F.when(any_null(entity.keys), "null key").otherwise(reason)
    if not keep_malformed:
        for name in entity.timestamps:
            bad = F.col(name).isNotNull() & ~evidence.can_be_read(entity, name)
            reason = F.when(bad, "bad timestamp").otherwise(reason)
        reason = F.when(F.col(CORRUPT).isNotNull(), "malformed").otherwise(reason)
    return reason


def _checked(csv_options: Mapping) -> None:
    if str(csv_options.get("mode", "PERMISSIVE")).upper() == "DROPMALFORMED":
        raise ValueError("a load counts every row: DROPMALFORMED is refused, see reject_reason")


def write_raw(
    spark: SparkSession,
    entity: Entity,
    source: str | list[str],
    base: str,
    load_id: str,
    max_records: int | None = None,
    null_keys: str = "reject",
    keep_malformed: bool = False,
    **csv_options,
) -> dict:
    """One scan of the source into a new attempt of the load, rejected rows marked in place.

    Returns what was seen on the way: rows and rejected rows, and the range of the accepted first
    keys, and what the values tell of formats to be found from the data. The attempt is published
    when it is complete, unless the source had no rows.
    """
    _checked(csv_options)
    try:
        rows = read_csv(spark, source, entity.schema, corrupt_column=CORRUPT, **csv_options)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise SourceMissing(str(source)) from error
        raise
    sequence = next_sequence(spark, base, RAW, entity.name, load_id)
    attempt, seen = uuid.uuid4().hex, Observation()
    reason = F.col("reject_reason")
    key = F.when(reason.isNull(), F.col(entity.keys[0]))
    proofs = evidence.proofs(entity, F.col(CORRUPT).isNull())
    raw = evidence.read_once(rows, entity).select(
        *entity.schema.names,
        CORRUPT,
        _reject_reason(entity, null_keys, keep_malformed).alias("reject_reason"),
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_block_start").alias("source_offset"),
        F.monotonically_increasing_id().alias("arrival"),
        F.lit(sequence).cast("long").alias("load_sequence"),
        *[proof.alias(name) for name, proof in proofs.items()],
    ).observe(
        seen,
        F.count(F.lit(1)).alias("rows"),
        F.count(reason).alias("rejected"),
        F.min(key).alias("low"),
        F.max(key).alias("high"),
        *evidence.counted(entity),
    ).drop(*proofs)
    path = attempt_path(base, RAW, entity.name, load_id, attempt)
    raw.write.option("maxRecordsPerFile", max_records or 0).parquet(path)
    facts = dict(seen.get)
    if facts["rows"]:
        evidence.keep(spark, base, entity, load_id, attempt, facts)
        publish(spark, base, RAW, entity.name, load_id, attempt, sequence, rows=facts["rows"])
    return facts


def _by_year(rows: DataFrame, ts: str) -> DataFrame:
    """Rows with their year, brought together to be written to one folder per year.

    Rebalancing keeps each task from writing to every year and splits a year of many rows.
    """
    return rows.withColumn("event_year", F.year(ts)).hint("rebalance", "event_year")


def write_trusted(
    spark: SparkSession,
    rows: DataFrame,
    entity: Entity,
    base: str,
    load_id: str,
    attempt: str,
    table: str | None = None,
) -> int:
    """Write rows of the trusted schema to an attempt, in the entity's layout; returns how many.
    ``table`` is the catalogue table of a bucketed entity, if there is one already."""
    seen = Observation()
    folders: tuple[str, ...] = ()
    if entity.year_of:
        rows = _by_year(rows, entity.year_of)
        folders = ("event_year",)
    rows = rows.observe(seen, F.count(F.lit(1)).alias("rows"))
    if not entity.buckets:
        path = attempt_path(base, TRUSTED, entity.name, load_id, attempt)
        rows.write.partitionBy(*folders).parquet(path)
    elif table:
        catalogue.insert(rows, table, load_id, attempt)
    else:
        with catalogue.registered(spark, base, TRUSTED, entity) as table:
            catalogue.insert(rows, table, load_id, attempt)
    return seen.get["rows"]


def _merged_before(
    spark: SparkSession, base: str, entity: Entity, without: str, table: str | None
) -> DataFrame:
    """The trusted rows of all loads but one: by key where the table is laid out so."""
    if table:
        return spark.table(table)
    schema = entity.trusted_table_schema
    return read_layer(spark, base, TRUSTED, entity.name, schema, without=without)


def _arrived(spark: SparkSession, base: str, entity: Entity, load_id: str | None) -> bool:
    """Whether all raw rows came from files, so that their arrival is known: not by a statement."""
    loads = published(spark, base, RAW, entity.name).values()
    return all(a.policy == "own" for a in loads if load_id in (None, a.load_id))


def merge_into_trusted(
    spark: SparkSession,
    entity: Entity,
    base: str,
    load_id: str,
    null_keys: str = "reject",
    source_duplicates: str = "first",
    whole_raw: bool = False,
    facts: Mapping | None = None,
) -> int:
    """Insert the accepted raw rows whose key the trusted table lacks; returns how many.

    By default only the rows of this load are compared; ``whole_raw`` compares the rows of all
    loads, in order of the loads' arrival, so that it also picks up loads that stopped half way. New
    rows go to a new attempt of this load and are compared with all other loads, so a repeated
    merge replaces its own rows and inserts nothing twice. A load merged with ``whole_raw`` holds
    rows of other loads: it is refused without it, and the other way round. Two merges of one
    entity must not run at once.

    Timestamps whose format is found from the data are read by the evidence of this load and those
    before it (``whole_raw``: of all); if that leaves it open, ``UndecidedFormat`` is raised.
    """
    detected = evidence.detected_formats(spark, base, entity, None if whole_raw else load_id)
    policy = "whole" if whole_raw else "own"
    before = published(spark, base, TRUSTED, entity.name).get(load_id)
    if before and before.policy != policy:
        how = {"own": "whole_raw=False", "whole": "whole_raw=True"}.get(before.policy, "a statement")
        raise ValueError(f"load {load_id!r} was merged with {how}")
    order_by = ("load_sequence", "load_id", *ARRIVAL) if whole_raw else ARRIVAL
    one = None if whole_raw else load_id
    raw = read_layer(spark, base, RAW, entity.name, entity.raw_table_schema, one)
    accepted = raw.filter(F.col("reject_reason").isNull())
    accepted = accepted.select(*entity.schema.names, *order_by)
    place = None
    if source_duplicates == "first" and _arrived(spark, base, entity, one):
        accepted = with_place(accepted, order_by[:-1], order_by[-1])
        place = "_place"
    # Timestamps in place of their text let the rows be aggregated whole.
    typed = place is not None and not set(entity.keys) & set(entity.timestamps)
    if typed:
        accepted = to_trusted(accepted, entity, detected, place)

    attempt = uuid.uuid4().hex
    with ExitStack() as stack:
        table = None
        if entity.buckets:
            table = stack.enter_context(
                catalogue.registered(spark, base, TRUSTED, entity, hidden=load_id)
            )
        others = _merged_before(spark, base, entity, load_id, table)
        if facts and not whole_raw and len(entity.keys) == 1 and facts["low"] is not None:
            # Row groups outside the load's key range need not be read.
            others = others.filter(F.col(entity.keys[0]).between(facts["low"], facts["high"]))
        absent = absent_rows(
            accepted,
            others,
            entity.keys,
            null_keys=null_keys,
            source_duplicates=source_duplicates,
            order_by=order_by,
            place=place,
        )
        fresh = absent.select(*entity.schema.names) if typed else to_trusted(absent, entity, detected)
        inserted = write_trusted(spark, fresh, entity, base, load_id, attempt, table)
    keep_partials(spark, base, entity, load_id, attempt)
    sequence = next_sequence(spark, base, TRUSTED, entity.name, load_id)
    publish(spark, base, TRUSTED, entity.name, load_id, attempt, sequence, policy, inserted)
    return inserted


LOG = threading.Lock()


def _outcome(spark: SparkSession, base: str, *values) -> DataFrame:
    fields = zip(values, OUTCOME.fields, strict=True)
    outcome = spark.range(1).select(
        *[F.lit(value).cast(field.dataType).alias(field.name) for value, field in fields]
    )
    with LOG:  # two appends to one folder at once would clear away each other's work
        outcome.coalesce(1).write.mode("append").parquet(f"{base.rstrip('/')}/load_log")
    return outcome


def checked_load_id(load_id: str | None) -> str:
    """The load's name, a new one if there is none."""
    load_id = load_id or uuid.uuid4().hex
    if not re.fullmatch(r"[A-Za-z0-9_.-]+", load_id):
        raise ValueError(f"load_id {load_id!r} names a folder: letters, digits, '_', '.', '-' only")
    return load_id


def load_entity(
    spark: SparkSession,
    entity: Entity,
    source: str | list[str],
    base: str,
    load_id: str | None = None,
    max_records: int | None = None,
    null_keys: str = "reject",
    source_duplicates: str = "first",
    keep_malformed: bool = False,
    whole_raw: bool = False,
    on_error: str = "record",
    **csv_options,
) -> DataFrame:
    """CSV to raw to trusted. Returns the outcome, one row that is also kept in ``load_log``.

    The status is ``OK``, ``MISSING`` or ``EMPTY`` (no such source, or no rows in it; nothing is
    written), ``AMBIGUOUS`` or ``CONFLICTING`` with a message if the format of a timestamp is to be found
    from the data and isn't decided by them (the raw rows are kept, none enters the trusted table), or
    ``ERROR`` with a message, unless ``on_error='raise'``. The counts are those reached until then.

    The defaults are safe to repeat: give the ``load_id`` of a load that failed, and the same
    source, to run it again. Readers see its former rows until the new ones are complete.
    ``rows_read`` is counted at the source, ``rows_raw`` in the raw table. Rows that do not fit the schema, rows without a key and rows with an
    unreadable timestamp stay in the raw table with a ``reject_reason``, and of rows that share a
    key the first enters. ``null_keys='insert'``, ``source_duplicates='keep'``,
    ``keep_malformed=True`` and ``whole_raw=True`` turn these off one by one.

    ``max_records`` bounds the rows of a raw file, the batch of this sink; without it a split of the
    source becomes one file.
    """
    load_id = checked_load_id(load_id)
    _checked(csv_options)
    status, message = "OK", None
    facts: Mapping = {"rows": 0, "rejected": 0}
    files = rows_raw = inserted = 0
    try:
        facts = write_raw(
            spark,
            entity,
            source,
            base,
            load_id,
            max_records,
            null_keys=null_keys,
            keep_malformed=keep_malformed,
            **csv_options,
        )
        if facts["rows"]:
            raw = read_layer(spark, base, RAW, entity.name, entity.raw_table_schema, load_id)
            files, rows_raw = len(raw.inputFiles()), raw.count()
            inserted = merge_into_trusted(
                spark,
                entity,
                base,
                load_id,
                null_keys=null_keys,
                source_duplicates=source_duplicates,
                whole_raw=whole_raw,
                facts=facts,
            )
        else:
            status = "EMPTY"
    except SourceMissing:
        status = "MISSING"
    except evidence.UndecidedFormat as undecided:
        status, message = undecided.status, str(undecided)
    except Exception as error:
        if on_error == "raise" or isinstance(error, ValueError):
            raise
        status = "ERROR"
        message = str(error).strip().splitlines()[0] if str(error).strip() else repr(error)
    counts = (facts["rows"], facts["rejected"], files, rows_raw, inserted)
    return _outcome(spark, base, entity.name, load_id, status, *counts, message)


def quarantine(spark: SparkSession, base: str, entity: Entity) -> DataFrame:
    """Raw rows that were set aside, with text and reason."""
    raw = read_layer(spark, base, RAW, entity.name, entity.raw_table_schema)
    return raw.filter(F.col("reject_reason").isNotNull())


def load_together(
    spark: SparkSession,
    entities: Mapping[str, Entity],
    sources: Mapping[str, str | list[str]],
    base: str,
    **load_options,
) -> dict[str, DataFrame]:
    """The loads of several entities at the same time: outcomes by name, in the order of ``entities``.

    They write different tables, so none waits for another; each runs in a thread of its own and in a
    scheduler pool of its name, which share the executors fairly under ``spark.scheduler.mode=FAIR`` (without it, what
    one load leaves idle the next takes). A load that fails leaves the others alone; with ``on_error='raise'`` the first error is
    raised when all have ended.
    """

    def load(name: str) -> DataFrame:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", name)
        return load_entity(spark, entities[name], sources[name], base, **load_options)

    with ThreadPoolExecutor(len(entities)) as threads:
        started = {name: threads.submit(inheritable_thread_target(spark)(load), name) for name in entities}
    return {name: future.result() for name, future in started.items()}


def run_pipeline(
    spark: SparkSession,
    sources: Mapping[str, str],
    base: str,
    year: int = DEFAULT_YEAR,
    entities: Mapping[str, Entity] | None = None,
    **load_options,
) -> dict[str, DataFrame]:
    """The three loads, at the same time, then both reports.

    ``sources`` maps ``hired_employee``, ``department`` and ``job`` to CSV paths. Returns the
    ``status``, the ``outcomes`` and the reports ``hires_by_quarter`` and
    ``departments_above_mean``. Over a load that isn't OK there is no report: the status is then
    ``INCOMPLETE`` and both reports are None.
    """
    entities = entities or {e.name: e for e in (HIRED_EMPLOYEE, DEPARTMENT, JOB)}
    loaded = {name: entities[name] for name in ("hired_employee", "department", "job")}
    outcomes = load_together(spark, loaded, sources, base, **load_options).values()
    outcomes = reduce(DataFrame.unionByName, outcomes)
    complete = not outcomes.filter("status <> 'OK'").take(1)
    reports = {"hires_by_quarter": hires_by_quarter, "departments_above_mean": departments_above_mean}
    return {
        "status": "OK" if complete else "INCOMPLETE",
        "outcomes": outcomes,
        **{
            name: report(spark, base, year, entities=entities) if complete else None
            for name, report in reports.items()
        },
    }
