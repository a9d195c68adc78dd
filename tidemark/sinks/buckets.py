"""Targets kept by their key, for batches too large to be broadcast.

The versions of such a target (see :mod:`tidemark.sinks.snapshots`) are bucketed
and sorted by the key. A merge deals the batch out to the same buckets and joins
it with the target where that lies: of the two only the batch moves, and what
comes out is written as it is, one file a bucket.

A bucket is read by one task, so rows that would crowd one are kept apart, in a
partition of their own that is not read by bucket: those without a full key,
which match nothing, and those of keys with more than a bucket's even share. The
latter are fewer keys than there are buckets, so what a batch has of them is
small and is broadcast.

The column that tells the two partitions apart is not part of the view. One
writer per table is assumed.
"""

from __future__ import annotations

import json
import logging
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.config import DEFAULT_OP_COLUMN, OpCodes
from tidemark.functions.columns import all_set, named, quoted
from tidemark.operators.hot_keys import LEAST_ROWS, PARTS, hot_keys
from tidemark.operators.merge import ROWS, keyless_inserts, merge_buckets, merge_cdc
from tidemark.operators.staging import StagedBatch
from tidemark.sinks import snapshots
from tidemark.sinks.snapshots import sql_name
from tidemark.sinks.tables import in_target_order, table_schema

logger = logging.getLogger(__name__)

_KEY = "tidemark.bucket_key"
_BUCKETS = "tidemark.buckets"

_PLACE = "__place"
_BY_KEY = "by_key"
_APART = "apart"


def ensure_table(
    spark: SparkSession,
    ident: str,
    schema: T.StructType,
    pk: Sequence[str],
    buckets: int,
    op_col: str | None = None,
    enabled: bool = True,
) -> bool:
    """Create the target, empty, if it does not exist; say whether it did.

    The key and the number of buckets stay with the target. As many buckets as
    the merge should have tasks: a bucket of the whole target, with its batch,
    is what one of them reads. A creation that broke off is repeated.
    """
    if not enabled:
        logger.info("%s: table creation is off", ident)
        return False
    if spark.catalog.tableExists(ident):
        return False
    stored = table_schema(schema, op_col)
    fields = {f.name.lower(): f.name for f in stored.fields}
    unknown = [k for k in pk if k.lower() not in fields]
    if unknown or not pk:
        raise ValueError(f"{ident}: key column(s) {unknown} are not in the target")
    keys = [fields[k.lower()] for k in pk]
    snapshots.clear_broken_creation(spark, ident)
    first = snapshots.following(spark, ident)
    by = ", ".join(map(quoted, keys))
    snapshots.create_table(
        spark,
        snapshots.name(ident, first),
        T.StructType([*stored.fields, T.StructField(_PLACE, T.StringType())]),
        [_PLACE],
        snapshots.owned(ident),
        f"CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS",
    )
    _show(spark, ident, first, stored.names, keys, buckets)
    logger.info("%s: created", ident)
    return True


def is_target(spark: SparkSession, ident: str) -> bool:
    """Whether ``ident`` is a target of this kind."""
    if not spark.catalog.tableExists(ident):
        return False
    if spark.catalog.getTable(ident).tableType != "VIEW":
        return False
    return _BUCKETS in snapshots.properties(spark, ident)


def overwrite(
    spark: SparkSession, ident: str, rows: DataFrame, least_rows: int = LEAST_ROWS
) -> None:
    """Replace the whole contents; ``rows`` are read several times.

    ``least_rows`` is how many rows of a key a bucket takes whatever the others
    have.
    """
    pk, buckets = _rule(spark, ident)
    rows = in_target_order(spark, ident, rows)
    hot = hot_keys(rows, pk, buckets, least_rows)
    try:
        crowded = F.lit(False)
        if hot:
            rows = rows.join(F.broadcast(hot.keys.select(*map(named, pk), PARTS)), list(pk), "left")
            crowded = F.col(PARTS).isNotNull()
        placed = rows.withColumn(_PLACE, F.when(all_set(pk) & ~crowded, _BY_KEY).otherwise(_APART))
        by_key = placed.filter(F.col(_PLACE) == _BY_KEY).repartition(buckets, *map(named, pk))
        _write(spark, ident, by_key.unionByName(placed.filter(F.col(_PLACE) == _APART)))
    finally:
        if hot:
            hot.release()


def merge(
    spark: SparkSession,
    ident: str,
    batch: StagedBatch,
    pk: Sequence[str],
    op_col: str = DEFAULT_OP_COLUMN,
    ops: OpCodes = OpCodes(),
    staged_unique: bool = False,
) -> None:
    """Merge a staged batch; the target's rows stay in the tasks that read them.

    The effects are those of :func:`tidemark.operators.merge.merge_cdc`. A batch
    that may have several rows of one key raises ``ValueError``. Its keys take the
    target's types before they are compared.
    """
    keys, buckets = _rule(spark, ident)
    if sorted(k.lower() for k in keys) != sorted(k.lower() for k in pk):
        raise ValueError(f"{ident}: kept by key {keys}, not by {list(pk)}")
    if not staged_unique:
        raise ValueError(f"{ident}: a bucketed target takes batches of one row a key only")
    if not batch.count:
        return
    _write(spark, ident, merged_rows(spark, ident, batch, op_col, ops))


def merged_rows(
    spark: SparkSession,
    ident: str,
    batch: StagedBatch,
    op_col: str = DEFAULT_OP_COLUMN,
    ops: OpCodes = OpCodes(),
) -> DataFrame:
    """What the target holds after the merge, with the place of each row."""
    pk, buckets = _rule(spark, ident)
    store = spark.table(sql_name(snapshots.name(ident, snapshots.current(spark, ident))))
    names = [c for c in store.columns if c != _PLACE]
    by_key = store.filter(F.col(_PLACE) == _BY_KEY).select(*map(named, names))
    apart = store.filter(F.col(_PLACE) == _APART).select(*map(named, names))
    kinds = {f.name.lower(): f.dataType for f in store.schema.fields}
    rows = batch.rows.withColumns({k: named(k).cast(kinds[k.lower()]) for k in pk})
    full = all_set(pk)
    # Keys with rows apart: fewer than there are buckets, see overwrite().
    crowded = apart.filter(full).select(*map(named, pk)).distinct()
    keyed = rows.filter(full)
    theirs = keyed.join(F.broadcast(crowded), list(pk), "left_semi")
    others = keyed.join(F.broadcast(crowded), list(pk), "left_anti")
    met = merge_buckets(by_key, others, pk, buckets, batch.size_bytes, op_col, ops)
    beside = merge_cdc(apart, theirs, pk, op_col, ops, staged_unique=True, broadcast=ROWS)
    added = keyless_inserts(apart, rows, pk, op_col, ops)
    return met.withColumn(_PLACE, F.lit(_BY_KEY)).unionByName(
        beside.unionByName(added).withColumn(_PLACE, F.lit(_APART))
    )


def _write(spark: SparkSession, ident: str, rows: DataFrame) -> None:
    """The next version, shown when it is written."""
    pk, buckets = _rule(spark, ident)
    version = snapshots.current(spark, ident)
    existing = snapshots.versions(spark, ident)
    number = snapshots.following(spark, ident)
    new = snapshots.create_like(spark, ident, number, snapshots.name(ident, version))
    names = spark.table(sql_name(new)).columns
    rows.select(*map(named, names)).write.insertInto(sql_name(new))
    _show(spark, ident, number, [c for c in names if c != _PLACE], pk, buckets)
    snapshots.drop(spark, ident, [v for v in existing if v != version])


def _show(
    spark: SparkSession,
    ident: str,
    version: int,
    columns: Sequence[str],
    pk: Sequence[str],
    buckets: int,
) -> None:
    rule = {_KEY: json.dumps(list(pk)), _BUCKETS: str(buckets)}
    snapshots.point_view(spark, ident, version, columns, rule)


def _rule(spark: SparkSession, ident: str) -> tuple[list[str], int]:
    """The key and the number of buckets the target was created with."""
    said = snapshots.properties(spark, ident)
    if _BUCKETS not in said:
        raise ValueError(f"{ident}: not a target kept in buckets")
    return json.loads(said[_KEY]), int(said[_BUCKETS])
