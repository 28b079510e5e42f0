"""The batch jobs: reconcile the newest persona of every member with the member's newest row."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldthread.functions.calendar import BATCH_MONTH, PARTITIONS, with_run_partitions
from goldthread.functions.extract import with_json_value
from goldthread.functions.paths import split_path
from goldthread.operators.latest import latest_per_key, newest
from goldthread.operators.mapping import MappingColumns, compile_mapping, latest_snapshot, map_records
from goldthread.operators.normalize import Formats, cast_present, normalize_to_schema
from goldthread.operators.reconcile import choose_values, row_hash
from goldthread.operators.sizing import BROADCAST_ROWS, fits
from goldthread.session import shared_dir
from goldthread.sources.sinks import write_parquet
from goldthread.sources.state import newer_than_mark, newest_value, read_mark, save_mark

MEMBER = "__member_id"
PERIOD = "2 hours"


@dataclass(frozen=True)
class BatchJob:
    """Column names and rules of a reconcile run.

    ``persona_order`` and ``member_order`` rank the rows of a member, newest first; rows that are equal in them are
    ranked by a hash of their columns. ``mode`` names the flag by which new rows are mapped, ``flag`` the one by which
    the new or the old value is chosen, the same if it is not given.
    """

    schema: T.StructType
    pk: str = "member_number"
    document: str = "profiles"
    member_path: Sequence[str] = ("memberId",)
    timestamp: str = "timestamp"
    persona_order: Sequence[str] = ("timestamp",)
    member_order: Sequence[str] = ("updated_date",)
    mode: str = "reconcile"
    flag: str | None = None
    mapping: MappingColumns = field(default_factory=MappingColumns)
    formats: Formats = field(default_factory=Formats)
    # Extra steps on the mapped new rows, each a frame-to-frame function.
    steps: Sequence[Callable[[DataFrame], DataFrame]] = ()


def in_period(ts: str, now: Column, period: str = PERIOD) -> Column:
    """Whether ``ts`` lies in the period that ends at ``now``, both ends included."""
    return F.col(ts).between(now - F.expr(f"INTERVAL {period}"), now)


def incremental(
    personas: DataFrame,
    members: DataFrame,
    mapping: DataFrame,
    job: BatchJob,
    now: Column | None = None,
    period: str = PERIOD,
    broadcast_rows: int | None = BROADCAST_ROWS,
) -> DataFrame:
    """Reconcile the personas of the last period.

    A period names few members, so their keys are counted and, when they are that few, broadcast
    to cut the member table down before it is shuffled.
    """
    reference = F.current_timestamp() if now is None else now
    recent = personas.filter(in_period(job.timestamp, reference, period))
    return _recent(recent, members, mapping, job, broadcast_rows)


def _recent(
    personas: DataFrame, members: DataFrame, mapping: DataFrame, job: BatchJob, broadcast_rows: int | None,
) -> DataFrame:
    recent = with_member_id(personas, job)
    if broadcast_rows is not None:
        # Written, so the rows are read and parsed for their keys once and not for the count and the broadcast again.
        path = shared_dir(personas.sparkSession, "period-keys")
        recent.select(F.col(MEMBER).alias(job.pk)).filter(F.col(job.pk).isNotNull()).distinct().write.parquet(path)
        keys = personas.sparkSession.read.parquet(path)
        if fits(keys, broadcast_rows):
            members = members.join(F.broadcast(keys), job.pk, "left_semi")
    return _reconciled(recent, members, mapping, job)


def run_since_mark(
    personas: DataFrame,
    members: DataFrame,
    mapping: DataFrame,
    job: BatchJob,
    mark_path: str,
    path: str,
    run_time: datetime,
    shards: int | None = None,
    broadcast_rows: int | None = BROADCAST_ROWS,
) -> None:
    """Reconcile the personas that are newer than the high-water mark, write the run, and raise the mark.

    The rows of a run end at the newest timestamp there is when it starts, so what arrives meanwhile is left to the
    next run. The mark is raised after the write: a run that dies is done again by the next call, which replaces the
    folder if its run time is the same. Without newer rows nothing is written and the mark stays.
    """
    spark = personas.sparkSession
    newer = newer_than_mark(personas, job.timestamp, read_mark(spark, mark_path))
    until = newest_value(newer, job.timestamp)
    if until is None:
        return
    rows = _recent(newer.filter(F.col(job.timestamp) <= until), members, mapping, job, broadcast_rows)
    write_run(rows, path, run_time, shards)
    save_mark(spark.range(1).select(until.alias("newest")), "newest", mark_path)


def backfill(
    personas: DataFrame, members: DataFrame, mapping: DataFrame, job: BatchJob, cutoff: Column,
) -> DataFrame:
    """Reconcile all personas up to a cut-off that carry a member id."""
    known = with_member_id(personas.filter(F.col(job.timestamp) <= cutoff), job)
    return _reconciled(known.filter(F.col(MEMBER) != ""), members, mapping, job)


def with_member_id(personas: DataFrame, job: BatchJob) -> DataFrame:
    return with_json_value(personas, MEMBER, F.col(job.document), job.member_path)


def _reconciled(personas: DataFrame, members: DataFrame, mapping: DataFrame, job: BatchJob) -> DataFrame:
    rows = compile_mapping(latest_snapshot(mapping, job.mapping), job.mapping)
    # Number columns need the JSON type: 12.9 is cut to 12 and true is 1, but the text "12.9" is null.
    typed = {f.name for f in job.schema.fields if isinstance(f.dataType, (T.LongType, T.DoubleType))}
    order = newest(*job.persona_order, row_hash(personas))
    latest_members = latest_per_key(members, [job.pk], newest(*job.member_order, row_hash(members)))

    pk_path = next((split_path(r.path) for r in rows if r.dest == job.pk and r.applies(job.mode)), [])
    if pk_path == [job.document, *job.member_path]:
        # The key column is the member id itself: the rows are unique on it and already lie in
        # its hash partitions, so the join with the members needs no further shuffle. Members
        # that were not seen fall out of the join.
        known = personas.filter(F.col(MEMBER).isNotNull())
        keyed = latest_per_key(known, [MEMBER], order).withColumnRenamed(MEMBER, job.pk)
        new = map_records(keyed, rows, job.mode, keep=[job.pk], typed=typed)
    else:
        # The member id only ranks the personas here; those without one are one group.
        latest_personas = latest_per_key(personas, [MEMBER], order)
        seen = latest_personas.select(F.col(MEMBER).alias(job.pk))
        latest_members = latest_members.join(seen, job.pk, "left_semi")
        ranks = {f"__order_{i}": c for i, c in enumerate([*map(F.col, job.persona_order), row_hash(personas)])}
        mapped = map_records(latest_personas.withColumns(ranks), rows, job.mode, keep=list(ranks),
                             typed=typed - {job.pk}, filtered=[job.pk])
        if job.pk not in mapped.columns:
            raise ValueError(f"the mapping gives no column {job.pk}")
        key_schema = T.StructType([T.StructField(job.pk, members.schema[job.pk].dataType)])
        keyed = cast_present(mapped, key_schema).filter(F.col(job.pk).isNotNull())
        new = latest_per_key(keyed, [job.pk], newest(*ranks)).drop(*ranks)
    for step in job.steps:
        new = new.transform(step)
    chosen = choose_values(
        cast_present(new, job.schema, job.formats), cast_present(latest_members, job.schema, job.formats),
        rows, job.pk, job.flag or job.mode)
    return normalize_to_schema(chosen, job.schema, job.formats)


def write_run(
    df: DataFrame, path: str, run_time: datetime, shards: int | None = None, month: str = BATCH_MONTH,
) -> None:
    """Write a run under its ``par_month=/par_day=/par_hour=/run_dt=`` folder; a rerun replaces it."""
    framed = with_run_partitions(df, run_time, month)
    # All rows go to one folder, so there is nothing to gather by.
    write_parquet(framed, path, shards=shards, partition_by=PARTITIONS, gather=())
