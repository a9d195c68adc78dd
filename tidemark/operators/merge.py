"""Merging a change batch into a target, as DataFrames.

What a staged row does, by its operation and whether its key is in the target:

=====================  ============  ===================
operation              key matched   key absent or NULL
=====================  ============  ===================
insert                 nothing       inserted
update                 row updated   inserted
delete                 row deleted   nothing
anything else, NULL    nothing       nothing
=====================  ============  ===================

Target rows the batch does not mention stay as they are. Timestamps of the
batch are not compared with those of the target.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.config import DEFAULT_OP_COLUMN, OpCodes
from tidemark.functions.columns import all_set, named, op_is, quoted, require_columns
from tidemark.operators.key_range import KeyRange, in_range

# What of a batch is sent to every task.
ROWS = "rows"
KEYS = "keys"
NOTHING = "nothing"

_OP = "__op"
_COPIES = "__copies"
_IN_TARGET = "__in_target"
_PARTS = "__parts"
_PART = "__part_of_key"

#: Rows of a batch in memory, of one bucket, that a task may build a hash table of.
HASHED_BYTES = 64 * 1024 * 1024


def merge_cdc(
    target: DataFrame,
    staged: DataFrame,
    pk: Sequence[str],
    op_col: str = DEFAULT_OP_COLUMN,
    ops: OpCodes = OpCodes(),
    staged_unique: bool = False,
    broadcast: str = NOTHING,
    key_range: KeyRange = (),
    hot: DataFrame | None = None,
) -> DataFrame:
    """The target's rows after the batch is applied, in the target's schema.

    ``broadcast`` says what of the batch has been measured to fit into every
    task, see :meth:`StagedBatch.broadcast
    <tidemark.operators.staging.StagedBatch.broadcast>`:

    * ``"rows"``: one full scan of the target is joined with the updates and
      deletes, one scan of its key columns tells inserts from matches. The
      target is not shuffled.
    * ``"keys"``: target rows the batch does not change are passed on where
      they are read; only the others are shuffled to meet their change. Costs
      one more scan.
    * ``"nothing"``: one full outer join of the target and the batch, both
      shuffled by key. Rows of the ``hot`` keys (see :func:`hot_keys
      <tidemark.operators.hot_keys.hot_keys>`) are dealt to several tasks, each
      of which gets the key's change.

    Target rows that can have no key of the batch are not shuffled: those
    without a full key, and those outside of ``key_range``, see
    :class:`StagedBatch <tidemark.operators.staging.StagedBatch>`, which is also
    pushed into the scan of the target's keys. It must hold for the rows that
    are passed.

    ``staged`` is read more than once and must give the same rows each time.
    Pass ``staged_unique`` if it has at most one row per non-NULL key;
    otherwise a duplicated key that matches a target row raises at run time,
    while unmatched duplicates are all inserted. Such a batch takes two joins in
    place of the full outer one, and ``hot`` is not looked at: adaptive execution
    splits a frequent key there.

    Target columns the batch lacks keep their value on update and are NULL on
    insert. Batch columns the target lacks raise ``ValueError``.
    """
    in_place, moved = merge_parts(
        target, staged, pk, op_col, ops, staged_unique, broadcast, key_range, hot
    )
    return in_place.unionByName(moved)


def merge_parts(
    target: DataFrame,
    staged: DataFrame,
    pk: Sequence[str],
    op_col: str = DEFAULT_OP_COLUMN,
    ops: OpCodes = OpCodes(),
    staged_unique: bool = False,
    broadcast: str = NOTHING,
    key_range: KeyRange = (),
    hot: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """The rows of :func:`merge_cdc` in two parts.

    Those of the first are still in the task that read them from the target,
    those of the second went through a shuffle. A writer that groups rows needs
    to do so for the second part only.
    """
    batch = _align(target, staged, pk, op_col, key_range)
    if broadcast == NOTHING and staged_unique:
        reached = batch.reach if batch.reach is not None else all_set(batch.target_keys)
        met = _met(target.filter(reached), batch, ops, hot)
        return target.filter(~reached), met.unionByName(_without_key(target, batch, ops))
    in_place, moved = _kept(target, batch, ops, staged_unique, broadcast)
    inserted = _inserted(target, batch, ops, staged_unique, broadcast)
    return in_place, inserted if moved is None else moved.unionByName(inserted)


def merge_effects(
    target: DataFrame,
    staged: DataFrame,
    pk: Sequence[str],
    op_col: str = DEFAULT_OP_COLUMN,
    ops: OpCodes = OpCodes(),
    staged_unique: bool = False,
    broadcast: str = NOTHING,
    key_range: KeyRange = (),
) -> DataFrame:
    """How many staged rows delete, update, insert or do nothing: (effect, n)."""
    batch = _align(target, staged, pk, op_col, key_range)
    present = _present(target, batch, batch.rows, staged_unique, broadcast)
    flagged = present.withColumn(_IN_TARGET, F.lit(True))
    matched = F.coalesce(F.col(_IN_TARGET), F.lit(False))
    op = F.col(_OP)
    effect = (
        F.when(matched & op_is(op, ops.delete), "delete")
        .when(matched & op_is(op, ops.update), "update")
        .when(~matched & op_is(op, ops.insert, ops.update), "insert")
        .otherwise("ignored")
    )
    return (
        batch.rows.select(_OP, *batch.keys)
        .join(flagged, batch.keys, "left")
        .groupBy(effect.alias("effect"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


@dataclass(frozen=True)
class _Batch:
    """Staged rows under names that cannot clash with the target's.

    ``keys`` are the key columns, in the order of ``target_keys``; ``values``
    maps each target column the batch carries to its staged column; ``reach``
    says of a target row whether it can have one of the batch's keys, as far as
    is known from their range.
    """

    rows: DataFrame
    keys: list[str]
    target_keys: list[str]
    values: dict[str, str]
    reach: Column | None = None


def _align(
    target: DataFrame,
    staged: DataFrame,
    pk: Sequence[str],
    op_col: str,
    key_range: KeyRange = (),
) -> _Batch:
    if not pk:
        raise ValueError("merge: no key columns")
    require_columns(staged, [op_col], "merge")
    if not isinstance(staged.schema[op_col].dataType, T.StringType):
        raise ValueError(f"merge: operation column {op_col!r} is not text")

    same_case = target.sparkSession.conf.get("spark.sql.caseSensitive") == "true"

    def fold(name: str) -> str:
        return name if same_case else name.lower()

    in_target = {fold(c): c for c in target.columns}
    in_staged = {fold(c): c for c in staged.columns if c != op_col}
    unknown = [c for f, c in in_staged.items() if f not in in_target]
    if unknown:
        raise ValueError(f"merge: batch column(s) {unknown} are not in the target")
    for key in pk:
        if fold(key) not in in_target or fold(key) not in in_staged:
            raise ValueError(f"merge: key column {key!r} must be in target and batch")

    keys = [f"__key_{i}" for i, _ in enumerate(pk)]
    key_of = {fold(k): name for k, name in zip(pk, keys)}
    out = [named(op_col).alias(_OP)]
    values = {}
    for i, (folded, source) in enumerate(in_staged.items()):
        alias = key_of.get(folded, f"__new_{i}")
        values[in_target[folded]] = alias
        out.append(named(source).alias(alias))
    rows, target_keys = staged.select(*out), [in_target[fold(k)] for k in pk]
    column_of = {fold(k): c for k, c in zip(pk, target_keys)}
    limits = in_range(target, lambda key: column_of.get(fold(key)), key_range)
    reach = None if limits is None else all_set(target_keys) & limits
    return _Batch(rows, keys, target_keys, values, reach)


def _kept(
    target: DataFrame, batch: _Batch, ops: OpCodes, unique: bool, broadcast: str
) -> tuple[DataFrame, DataFrame | None]:
    """Target rows that survive, updated where the batch says so.

    In two parts, see :func:`merge_parts`; the second may be missing.
    """
    if unique:
        changes = batch.rows.filter(F.col(_OP).isin(ops.update, ops.delete))
        op = F.col(_OP)
    else:
        # One row per key, so that a repeated key cannot multiply target rows;
        # the repeat itself is an error only if the key is in the target.
        changes = (
            batch.rows.filter(all_set(batch.keys))
            .groupBy(*batch.keys)
            .agg(
                *[F.any_value(c).alias(c) for c in batch.rows.columns if c not in batch.keys],
                F.count(F.lit(1)).alias(_COPIES),
            )
        )
        repeated = F.raise_error(F.lit("merge: several batch rows match one target row"))
        op = F.when(F.col(_COPIES) > 1, repeated).otherwise(F.col(_OP))

    def on(other: DataFrame) -> list[Column]:
        return [target[quoted(c)] == other[k] for c, k in zip(batch.target_keys, batch.keys)]

    if broadcast == ROWS:
        in_place, rows = None, target
        changes = F.broadcast(changes)
    elif broadcast == KEYS:
        changed = F.broadcast(changes.select(*batch.keys).filter(all_set(batch.keys)))
        in_place = target.join(changed, on(changed), "left_anti")
        near = target if batch.reach is None else target.filter(batch.reach)
        rows = near.join(changed, on(changed), "left_semi")
    else:
        # Rows without a full key match nothing: however many, none is moved.
        reached = all_set(batch.target_keys) if batch.reach is None else batch.reach
        in_place, rows = target.filter(~reached), target.filter(reached)
    # Always an outer join: above it a repeat is looked at for matches only.
    joined = rows.join(changes, on(changes), "left")

    updated = op_is(F.col(_OP), ops.update)
    kept = joined.filter(~op_is(op, ops.delete)).select(
        *[_updated_value(f, batch, updated).alias(f.name) for f in target.schema.fields]
    )
    return (kept, None) if broadcast == ROWS else (in_place, kept)


def _updated_value(field: T.StructField, batch: _Batch, updated: Column) -> Column:
    old = named(field.name)
    new = batch.values.get(field.name)
    if new is None or field.name in batch.target_keys:
        return old
    return F.when(updated, F.col(new).cast(field.dataType)).otherwise(old)


def _inserted(
    target: DataFrame, batch: _Batch, ops: OpCodes, unique: bool, broadcast: str
) -> DataFrame:
    """Inserts and updates whose key the target does not hold."""
    arrivals = batch.rows.filter(F.col(_OP).isin(ops.insert, ops.update))
    present = _present(target, batch, arrivals, unique, broadcast)
    if broadcast == NOTHING:
        full = all_set(batch.keys)
        absent = arrivals.filter(full).join(present, batch.keys, "left_anti")
        absent = absent.unionByName(arrivals.filter(~full))
    else:
        absent = arrivals.join(present, batch.keys, "left_anti")
    return _as_target(target, batch, absent)


def _as_target(target: DataFrame, batch: _Batch, rows: DataFrame) -> DataFrame:
    """Rows of the batch as rows of the target."""
    return rows.select(
        *[
            (F.col(batch.values[f.name]) if f.name in batch.values else F.lit(None))
            .cast(f.dataType)
            .alias(f.name)
            for f in target.schema.fields
        ]
    )


def _without_key(target: DataFrame, batch: _Batch, ops: OpCodes) -> DataFrame:
    """Inserts and updates without a full key, which are always inserted."""
    arrivals = batch.rows.filter(F.col(_OP).isin(ops.insert, ops.update))
    return _as_target(target, batch, arrivals.filter(~all_set(batch.keys)))


def keyless_inserts(
    target: DataFrame,
    staged: DataFrame,
    pk: Sequence[str],
    op_col: str = DEFAULT_OP_COLUMN,
    ops: OpCodes = OpCodes(),
) -> DataFrame:
    """The rows that a merge inserts because they have no full key, as the target's."""
    return _without_key(target, _align(target, staged, pk, op_col), ops)


def merge_buckets(
    target: DataFrame,
    staged: DataFrame,
    pk: Sequence[str],
    buckets: int,
    size_bytes: int,
    op_col: str = DEFAULT_OP_COLUMN,
    ops: OpCodes = OpCodes(),
) -> DataFrame:
    """:func:`merge_cdc` for a target table that lies in ``buckets`` by its key.

    The batch is dealt out like the target and the target stays where it is.
    Both have one type for each key column; the batch has one row a key and no
    rows without a full key. The batch's rows of a bucket are looked up in a hash
    table if their even share of ``size_bytes`` allows, or else sorted.
    """
    batch = _align(target, staged, pk, op_col)
    way = "shuffle_hash" if size_bytes <= buckets * HASHED_BYTES else "merge"
    dealt = batch.rows.repartition(buckets, *batch.keys).hint(way)
    return _met(target, replace(batch, rows=dealt), ops)


def _met(
    target: DataFrame, batch: _Batch, ops: OpCodes, hot: DataFrame | None = None
) -> DataFrame:
    """The merged rows of target rows with a full key and a batch of one row a key.

    One full outer join. Rows of a hot key go to one of its parts each, its
    change to all of them. The key is in the target, so that a change which
    meets no row in its part is not inserted.
    """
    changes = batch.rows.filter(
        F.col(_OP).isin(ops.insert, ops.update, ops.delete) & all_set(batch.keys)
    )
    rows = target.withColumn(_IN_TARGET, F.lit(True))
    on = [named(c) == F.col(k) for c, k in zip(batch.target_keys, batch.keys)]
    if hot is not None:
        held = [f"__hot_{i}" for i, _ in enumerate(batch.keys)]
        parts = F.broadcast(hot.toDF(*held, _PARTS))
        rows = rows.join(parts, [named(c) == F.col(h) for c, h in zip(batch.target_keys, held)], "left")
        any_part = F.pmod(F.monotonically_increasing_id(), F.col(_PARTS)).cast("int")
        rows = rows.withColumn(_PART, F.coalesce(any_part, F.lit(0))).drop(*held, _PARTS)
        changes = changes.join(parts, [F.col(k) == F.col(h) for k, h in zip(batch.keys, held)], "left")
        last = F.coalesce(F.col(_PARTS), F.lit(1)) - 1
        each = F.explode(F.sequence(F.lit(0), last)).alias("__each")
        changes = changes.select(*batch.rows.columns, _PARTS, each)
        on.append(F.col(_PART) == F.col("__each"))
    joined = rows.join(changes, on, "full_outer")

    old = F.coalesce(F.col(_IN_TARGET), F.lit(False))
    inserted = ~old & op_is(F.col(_OP), ops.insert, ops.update)
    if hot is not None:
        inserted = inserted & F.col(_PARTS).isNull()
    stays = old & ~op_is(F.col(_OP), ops.delete)
    fresh = ~old | op_is(F.col(_OP), ops.update)

    def value(field: T.StructField) -> Column:
        new = batch.values.get(field.name)
        if new is None:
            return named(field.name)
        taken = ~old if field.name in batch.target_keys else fresh
        return F.when(taken, F.col(new).cast(field.dataType)).otherwise(named(field.name))

    return joined.filter(stays | inserted).select(
        *[value(f).alias(f.name) for f in target.schema.fields]
    )


def _present(
    target: DataFrame, batch: _Batch, rows: DataFrame, unique: bool, broadcast: str
) -> DataFrame:
    """Those keys of ``rows`` that the target holds, each once.

    Never larger than the batch, whatever the size of the target. The range of
    the batch's keys is pushed into the scan, and a broadcast batch filters the
    target's keys where they are read, before they are made distinct; what is
    then shuffled has been made distinct first, so that a key with very many rows
    leaves each map task once.
    """
    wanted = rows.select(*batch.keys).filter(all_set(batch.keys))
    if not unique:
        wanted = wanted.distinct()
    near = target if batch.reach is None else target.filter(batch.reach)
    held = near.select(*[named(c).alias(k) for c, k in zip(batch.target_keys, batch.keys)])
    if broadcast != NOTHING:
        present = held.join(F.broadcast(wanted), batch.keys, "left_semi").distinct()
        return F.broadcast(present)
    return held.filter(all_set(batch.keys)).distinct().join(wanted, batch.keys, "left_semi")
