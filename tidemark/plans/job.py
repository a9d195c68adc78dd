"""Running a job: every table, in order, by the way it is kept."""

from __future__ import annotations

import logging
import threading
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.util import inheritable_thread_target

from tidemark.config import DEFAULT_FORMAT, ChangeSpec, JobSpec, TableSpec
from tidemark.operators.latest import latest_per_pk
from tidemark.operators.hot_keys import hot_keys
from tidemark.operators.merge import NOTHING, merge_parts
from tidemark.operators.staging import stage_batch
from tidemark.sinks import buckets, lakehouse, slices, tables
from tidemark.sources.landed import drop_op, read_landed

logger = logging.getLogger(__name__)

MERGE = "merge"
OVERWRITE = "overwrite"
ALL = "all"
SKIPPED = "skipped"


def run_job(
    spark: SparkSession, job: JobSpec | Mapping[str, Any], mode: str = ALL, at_once: int = 1
) -> list[tuple[str, str]]:
    """Apply the job's tables in list order; return (table name, what was done).

    ``mode`` takes every table, only the keyed ones (``merge``) or only the
    others (``overwrite``). The first failure is logged and raised: tables done
    before it stay done, later ones are not started. The session is the
    caller's and is left running.

    With ``at_once`` above 1 so many tables are worked on side by side, started in
    list order, each in a session of its own with the caller's settings and a
    scheduler pool named after it. After a failure no further table is started,
    those that are running are finished, and the failure that comes first in the
    list is raised. Targets must then differ from each other.
    """
    if mode not in (ALL, MERGE, OVERWRITE):
        raise ValueError(f"unknown mode {mode!r}")
    if at_once < 1:
        raise ValueError(f"at_once is {at_once}")
    if not isinstance(job, JobSpec):
        job = JobSpec.from_dict(job)
    wanted = [t for t in job.tables if mode == ALL or bool(t.has_pk) == (mode == MERGE)]
    if mode == OVERWRITE:  # takes every table that is not said to have a key
        wanted = [replace(t, has_pk=False) for t in wanted]

    def apply(session: SparkSession, table: TableSpec) -> tuple[str, str]:
        logger.info("%s: start", table.name)
        try:
            action = apply_table(
                session, table, job.changes, job.create_tables, skip_empty=mode == ALL
            )
        except Exception:
            logger.exception("%s: failed", table.name)
            raise
        logger.info("%s: %s", table.name, action)
        return table.name, action

    if at_once == 1:
        return [apply(spark, table) for table in wanted]
    same = {t.target.lower() for t in wanted}
    if len(same) < len(wanted):
        raise ValueError("tables that are worked on side by side must have targets of their own")
    return _side_by_side(spark, wanted, apply, at_once)


def _side_by_side(
    spark: SparkSession,
    wanted: list[TableSpec],
    apply: Callable[[SparkSession, TableSpec], tuple[str, str]],
    at_once: int,
) -> list[tuple[str, str]]:
    failed = threading.Event()

    def work(table: TableSpec) -> tuple[str, str] | None:
        if failed.is_set():
            return None
        try:
            session = _session_like(spark)
            session.sparkContext.setLocalProperty("spark.scheduler.pool", table.name)
            return apply(session, table)
        except BaseException:
            failed.set()
            raise

    with ThreadPoolExecutor(max_workers=at_once) as pool:
        # Properties of a job belong to the thread that starts it.
        running = [pool.submit(inheritable_thread_target(spark)(work), t) for t in wanted]
    # All have ended; of those that failed the first in the list raises here.
    return [done for done in (r.result() for r in running) if done]


def _session_like(spark: SparkSession) -> SparkSession:
    """A session of its own with the same settings, catalog and current database."""
    session = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if session.conf.get(key, None) != value and session.conf.isModifiable(key):
            session.conf.set(key, value)
    session.catalog.setCurrentDatabase(spark.catalog.currentDatabase())
    return session


def apply_table(
    spark: SparkSession,
    table: TableSpec,
    changes: ChangeSpec,
    create: bool = True,
    skip_empty: bool = True,
) -> str:
    """Apply one table's landed changes; return what was done.

    A keyed table is merged. Any other is replaced by its landed rows, whose
    operation code is dropped without being looked at. A source that has none
    of the requested columns is skipped with a warning, or raises if
    ``skip_empty`` is false.
    """
    if table.has_pk is None:
        raise ValueError(f"{table.name}: has_pk is not set")
    landed = read_landed(
        spark,
        table.source_path,
        changes.format,
        table.columns,
        schema=table.schema,
        options=changes.options,
    )
    if not landed.columns:
        if not skip_empty:
            raise ValueError(f"{table.name}: none of the columns {list(table.columns)} was landed")
        logger.warning("%s: none of the columns %s was landed", table.name, list(table.columns))
        return SKIPPED
    if table.has_pk:
        _merge(spark, table, changes, landed, create)
        return MERGE
    _overwrite(spark, table, changes, landed, create)
    return OVERWRITE


def _target_format(spark: SparkSession, table: TableSpec) -> str:
    """How the target is kept: what the job says, or what the catalog knows.

    A target that exists in another format than Parquet is merged by its own
    MERGE if the format has one, and refused if it is not known to have one.
    """
    said = table.target_format.lower()
    known = tables.provider(spark, table.target)
    if said != DEFAULT_FORMAT or known in (None, DEFAULT_FORMAT):
        return said
    if known in lakehouse.ROW_LEVEL:
        return known
    raise ValueError(f"{table.name}: the target is kept as {known!r}; name its target_format")


def _merge(
    spark: SparkSession, table: TableSpec, changes: ChangeSpec, landed: DataFrame, create: bool
) -> None:
    op_col = changes.op_column
    if op_col not in landed.columns:
        raise ValueError(f"{table.name}: no operation column {op_col!r} in {landed.columns}")
    latest = latest_per_pk(landed, table.pk, changes.ts_column, changes.tie_columns)
    unique = latest is not landed
    schema = latest.schema
    fmt = _target_format(spark, table)
    if fmt != DEFAULT_FORMAT:
        lakehouse.ensure_table(spark, table.target, schema, fmt, op_col, create)
    elif table.slice_by:
        slices.ensure_table(
            spark, table.target, schema, table.pk, table.slice_by, op_col, create
        )
    elif table.bucket_by:
        buckets.ensure_table(
            spark, table.target, schema, table.pk, table.bucket_by, op_col, create
        )
    else:
        tables.ensure_table(spark, table.target, schema, op_col, create)

    batch = stage_batch(latest, table.pk)
    hot = None
    try:
        if not batch.count:
            logger.info("%s: nothing to merge", table.name)
        elif fmt != DEFAULT_FORMAT:
            lakehouse.merge_into(table.target, batch.rows, table.pk, op_col, changes.ops)
        elif table.slice_by:
            slices.merge(
                spark,
                table.target,
                batch,
                table.pk,
                op_col,
                changes.ops,
                staged_unique=unique,
                broadcast_bytes=table.broadcast_bytes,
            )
        elif buckets.is_target(spark, table.target):
            buckets.merge(
                spark, table.target, batch, table.pk, op_col, changes.ops, staged_unique=unique
            )
        else:
            target = spark.table(table.target)
            sent = batch.broadcast(table.broadcast_bytes)
            if sent == NOTHING and unique:
                hot = hot_keys(target, table.pk)
            in_place, moved = merge_parts(
                target,
                batch.rows,
                table.pk,
                op_col,
                changes.ops,
                staged_unique=unique,
                broadcast=sent,
                key_range=batch.key_range,
                hot=hot.keys if hot else None,
            )
            tables.publish(spark, table.target, in_place, moved)
    finally:
        batch.release()
        if hot:
            hot.release()


def _overwrite(
    spark: SparkSession, table: TableSpec, changes: ChangeSpec, landed: DataFrame, create: bool
) -> None:
    rows = drop_op(landed, changes.op_column)
    fmt = _target_format(spark, table)
    if fmt != DEFAULT_FORMAT:
        lakehouse.ensure_table(spark, table.target, rows.schema, fmt, enabled=create)
        lakehouse.overwrite_partitions(table.target, rows)
        return
    if buckets.is_target(spark, table.target):
        buckets.overwrite(spark, table.target, rows)
        return
    tables.ensure_table(spark, table.target, rows.schema, enabled=create)
    tables.overwrite_partitions(spark, table.target, rows)
