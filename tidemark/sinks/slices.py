"""Targets far larger than their batches: only the slices a batch touches move.

The rows of ``db.orders`` lie in the ordinary table ``db.orders__slices``,
partitioned by slice; ``db.orders`` is a view that leaves the slice out. A slice
is a function of the key columns, given as a SQL expression: ``order_id div
10000000`` suits growing keys whose changes are mostly recent,
``pmod(xxhash64(order_id), 1024)`` spreads any key. As a key has exactly one
slice, a batch can only match rows in the slices of its own keys. A merge finds
them by a join with the batch's distinct slices, which prunes the partitions
that are read, and replaces them by a dynamic partition overwrite.

Partitions are exchanged one after the other: a merge that breaks off leaves
some slices merged and others not, and is repaired by merging the same batch
again. That holds for batches of one row a key only, so others are refused.

Rows without a full key match nothing. They have a partition of their own to
which a batch's are appended, last; merging a batch again appends them again.
One writer per table is assumed.
"""

from __future__ import annotations

import json
import logging
import re
from collections.abc import Iterator, Sequence
from itertools import islice

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.config import DEFAULT_BROADCAST_BYTES, DEFAULT_OP_COLUMN, OpCodes
from tidemark.functions.columns import all_set, named, no_rows, quoted
from tidemark.operators.hot_keys import hot_keys
from tidemark.operators.merge import NOTHING, merge_parts
from tidemark.operators.staging import StagedBatch, stage_batch
from tidemark.sinks import snapshots
from tidemark.sinks.snapshots import literal, sql_name
from tidemark.sinks.tables import in_target_order, session_conf, table_schema

logger = logging.getLogger(__name__)

_SLICE = "__slice"
_SLICE_BY = "tidemark.slice_by"
_KEY = "tidemark.key"
_ZONE = "tidemark.time_zone"

# Keyed slices have a prefix, so that no value can be taken for the other.
_KEYED = "k_"
_KEYLESS = "keyless"

#: Text in quotes, and names of what depends on when or by whom a query is run.
_QUOTED = re.compile(r"'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\"")
_CLOCKS = re.compile(r"\b(now|curdate|localtimestamp|current_\w+|session_user|user)\b", re.IGNORECASE)

#: Emptied partitions dropped by one command; bounds what the driver holds.
_DROP_AT_ONCE = 500


def ensure_table(
    spark: SparkSession,
    ident: str,
    schema: T.StructType,
    pk: Sequence[str],
    slice_by: str,
    op_col: str | None = None,
    enabled: bool = True,
) -> bool:
    """Create the target, empty, if it does not exist; say whether it did.

    The key, the expression and, for keys that are instants, the session's time
    zone stay with the table: rows found by one rule must not be looked for by
    another. An expression of other columns than the key's, or one that may change
    between two runs, is refused, and so is a store without its view that holds
    rows. An empty one is from a creation that broke off, which is repeated.
    """
    if not enabled:
        logger.info("%s: table creation is off", ident)
        return False
    if spark.catalog.tableExists(ident):
        return False
    stored = table_schema(schema, op_col)
    _check_rule(no_rows(spark, stored).select(*map(named, pk)), slice_by)
    store = sql_name(_store(ident))
    if spark.catalog.tableExists(_store(ident)):
        left = spark.table(store)
        if _SLICE_BY not in snapshots.properties(spark, _store(ident)) or not left.isEmpty():
            raise ValueError(f"{ident}: {_store(ident)} exists without its view")
        spark.sql(f"DROP TABLE {store}")
    rule = {
        _KEY: json.dumps(list(pk)),
        _SLICE_BY: slice_by,
        _ZONE: spark.conf.get("spark.sql.session.timeZone"),
    }
    with_slice = T.StructType([*stored.fields, T.StructField(_SLICE, T.StringType())])
    snapshots.create_table(spark, _store(ident), with_slice, [_SLICE], rule)
    columns = ", ".join(quoted(f.name) for f in stored.fields)
    spark.sql(f"CREATE VIEW {sql_name(ident)} AS SELECT {columns} FROM {store}")
    logger.info("%s: created", ident)
    return True


def overwrite(spark: SparkSession, ident: str, rows: DataFrame) -> None:
    """Replace the whole contents; ``rows`` must not read the target."""
    sliced = _sliced(spark, ident, in_target_order(spark, ident, rows))
    with session_conf(spark, "spark.sql.sources.partitionOverwriteMode", "static"):
        _grouped(sliced).write.insertInto(sql_name(_store(ident)), overwrite=True)


def merge(
    spark: SparkSession,
    ident: str,
    batch: StagedBatch,
    pk: Sequence[str],
    op_col: str = DEFAULT_OP_COLUMN,
    ops: OpCodes = OpCodes(),
    staged_unique: bool = False,
    broadcast_bytes: int = DEFAULT_BROADCAST_BYTES,
) -> None:
    """Merge a staged batch, reading and writing only the slices of its keys.

    The effects are those of :func:`tidemark.operators.merge.merge_cdc`. A batch
    that may have several rows of one key raises ``ValueError``.
    """
    key, _ = _rule(spark, ident)
    if sorted(key) != sorted(pk):
        raise ValueError(f"{ident}: kept by key {key}, not by {list(pk)}")
    if not staged_unique:
        raise ValueError(f"{ident}: a sliced target takes batches of one row a key only")
    if not batch.count:
        return
    store = spark.table(_store(ident))
    types = _types(spark, ident)
    in_effect = batch.rows.filter(named(op_col).isin(ops.insert, ops.update, ops.delete))
    keyed = in_effect.filter(all_set(pk))
    # Keys take the stored type first: a hash depends on it.
    keys = keyed.select(*[named(k).cast(types[k.lower()]).alias(k) for k in pk])
    touched = stage_batch(_sliced(spark, ident, keys).select(_SLICE).distinct(), [_SLICE])
    emptied = hot = None
    try:
        wanted = touched.rows
        if touched.size_bytes <= broadcast_bytes:
            wanted = F.broadcast(wanted)
        scope = store.join(wanted, _SLICE, "left_semi").select(*store.columns)
        sent = batch.broadcast(broadcast_bytes)
        if sent == NOTHING:
            hot = hot_keys(scope, pk)
        in_place, moved = merge_parts(
            scope.drop(_SLICE),
            keyed,
            pk,
            op_col,
            ops,
            True,
            sent,
            batch.key_range,
            hot.keys if hot else None,
        )
        after = _sliced(spark, ident, in_place.unionByName(moved)).select(_SLICE).distinct()
        before = scope.select(_SLICE).distinct()
        emptied = stage_batch(before.join(after, _SLICE, "left_anti"), [_SLICE])

        # Rows that were not moved are still grouped by slice, as they were read.
        merged = _sliced(spark, ident, in_place).unionByName(
            _grouped(_sliced(spark, ident, moved))
        )
        with session_conf(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
            merged.write.insertInto(sql_name(_store(ident)), overwrite=True)
        _drop(spark, ident, (r[_SLICE] for r in emptied.rows.toLocalIterator()))

        keyless = in_effect.filter(~all_set(pk) & named(op_col).isin(ops.insert, ops.update))
        added = in_target_order(spark, ident, _filled(keyless.drop(op_col), store))
        added.withColumn(_SLICE, F.lit(_KEYLESS)).write.insertInto(sql_name(_store(ident)))
    finally:
        for staged in (touched, emptied, hot):
            if staged is not None:
                staged.release()


def _filled(rows: DataFrame, store: DataFrame) -> DataFrame:
    """``rows`` with NULL for the target's columns they lack."""
    have = {c.lower() for c in rows.columns}
    missing = [c for c in store.columns if c != _SLICE and c.lower() not in have]
    return rows.select("*", *[F.lit(None).alias(c) for c in missing])


def _sliced(spark: SparkSession, ident: str, rows: DataFrame) -> DataFrame:
    """Rows of the target's types with their slice, as text.

    Keys that the join takes for one have one slice: -0.0 counts as 0.0.
    """
    pk, slice_by = _rule(spark, ident)
    types = _types(spark, ident)
    if any(isinstance(types[k.lower()], T.TimestampType) for k in pk):
        zone, kept = spark.conf.get("spark.sql.session.timeZone"), _properties(spark, ident)[_ZONE]
        if zone != kept:
            raise ValueError(f"{ident}: kept in time zone {kept}, the session has {zone}")
    floats = [k for k in pk if isinstance(types[k.lower()], (T.FloatType, T.DoubleType))]
    raw = {f"__raw_{i}": named(k) for i, k in enumerate(floats)}
    plain = {
        k: F.when(named(k) == 0, F.lit(0).cast(types[k.lower()])).otherwise(named(k))
        for k in floats
    }
    name = F.concat(F.lit(_KEYED), F.coalesce(F.expr(slice_by).cast("string"), F.lit("null")))
    value = F.when(all_set(pk), name).otherwise(_KEYLESS)
    out = rows.withColumns(raw).withColumns(plain).withColumn(_SLICE, value)
    return out.withColumns({k: F.col(r) for k, r in zip(floats, raw)}).drop(*raw)


def _types(spark: SparkSession, ident: str) -> dict[str, T.DataType]:
    return {f.name.lower(): f.dataType for f in spark.table(_store(ident)).schema.fields}


def _grouped(sliced: DataFrame) -> DataFrame:
    return sliced.hint("rebalance", named(_SLICE))


def _drop(spark: SparkSession, ident: str, names: Iterator[str]) -> None:
    """Drop partitions, some at a time."""
    while some := list(islice(names, _DROP_AT_ONCE)):
        specs = ", ".join(f"PARTITION ({_SLICE} = {literal(p)})" for p in some)
        spark.sql(f"ALTER TABLE {sql_name(_store(ident))} DROP IF EXISTS {specs}")


def _check_rule(keys: DataFrame, slice_by: str) -> None:
    """Refuse an expression whose value depends on more than the key."""
    if _CLOCKS.search(_QUOTED.sub("", slice_by)):
        raise ValueError(f"slice_by {slice_by!r} may change between two runs")
    other = keys.limit(0).select(F.lit(1).alias("__one"))
    try:
        # Spark takes no expression for a join's condition that may change from row to row.
        keys.join(other, F.expr(slice_by).cast("string") == F.col("__one").cast("string")).schema
    except AnalysisException as refused:
        if "INVALID_NON_DETERMINISTIC_EXPRESSIONS" in str(refused):
            raise ValueError(f"slice_by {slice_by!r} may change between two runs") from None
        raise ValueError(f"slice_by {slice_by!r} is not an expression of the key: {refused}") from None


def _properties(spark: SparkSession, ident: str) -> dict[str, str]:
    if not spark.catalog.tableExists(_store(ident)):
        raise ValueError(f"{ident}: not a target kept in slices")
    return snapshots.properties(spark, _store(ident))


def _rule(spark: SparkSession, ident: str) -> tuple[list[str], str]:
    """The key and the slice expression the target was created with."""
    properties = _properties(spark, ident)
    return json.loads(properties[_KEY]), properties[_SLICE_BY]


def _store(ident: str) -> str:
    return f"{ident}__slices"
