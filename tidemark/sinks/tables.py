"""Target tables in Spark's own catalog, kept as snapshots behind a view.

A plain Parquet table cannot be rewritten while it is being read. So a target
``db.orders`` is a view over one of the managed tables ``db.orders__v0``,
``db.orders__v1``, ...; a change writes the next snapshot and then repoints the
view. Readers see the old contents or the new ones, a failed write changes
nothing, and running readers keep the previous snapshot. The exception is
:func:`overwrite_partitions`, which exchanges partitions inside the current
snapshot. Snapshots carry a table property that names their target; tables
without it are never touched, whatever their name. One writer per table is
assumed.

Where the files lie is decided by the location of the database, which must
exist.
"""

from __future__ import annotations

import json
import logging
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from itertools import islice
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.functions.columns import named, quoted
from tidemark.sinks import snapshots
from tidemark.sinks.snapshots import literal, sql_name

logger = logging.getLogger(__name__)

_FINISHED = "tidemark.finished"
#: Of a snapshot without files of its own: the versions that have them, in order.
_HOLDERS = "tidemark.holders"
#: Partitions named by one command.
_AT_ONCE = 500
_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def table_schema(schema: T.StructType, op_col: str | None = None) -> T.StructType:
    """The target schema for a batch: its columns without the operation code.

    All columns are nullable.
    """
    return T.StructType(
        [T.StructField(f.name, f.dataType, True) for f in schema.fields if f.name != op_col]
    )


def ensure_table(
    spark: SparkSession,
    ident: str,
    schema: T.StructType,
    op_col: str | None = None,
    enabled: bool = True,
    partition_by: Sequence[str] = (),
) -> bool:
    """Create the target, empty, if it does not exist; say whether it did.

    An existing target is left alone, whatever its schema. With ``enabled``
    false nothing is created and the target must exist already. A creation that
    broke off is repeated.
    """
    if not enabled:
        logger.info("%s: table creation is off", ident)
        return False
    if spark.catalog.tableExists(ident):
        _finish(spark, ident)
        return False
    snapshots.clear_broken_creation(spark, ident)
    first = snapshots.following(spark, ident)
    snapshots.create_table(
        spark,
        snapshots.name(ident, first),
        table_schema(schema, op_col),
        partition_by,
        snapshots.owned(ident),
    )
    snapshots.point_view(spark, ident, first)
    logger.info("%s: created", ident)
    return True


def provider(spark: SparkSession, ident: str) -> str | None:
    """The format of an existing table in lower case; None for a view or none at all."""
    if not spark.catalog.tableExists(ident):
        return None
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {sql_name(ident)}").collect()
    return next((r["data_type"].lower() for r in described if r["col_name"] == "Provider"), None)


def publish(
    spark: SparkSession, ident: str, rows: DataFrame, moved: DataFrame | None = None
) -> None:
    """Replace the target's contents by ``rows``, which may read the target.

    ``moved`` holds further rows of the result that went through a shuffle
    already; for a partitioned target only these are grouped for the writer, if
    they are given apart. All rows are written once. A target that is an
    ordinary table rather than a view over snapshots is filled from a finished
    copy of the result, since it cannot be overwritten while it is read. Should
    that fail, the copy is left and :func:`ensure_table` repeats it.
    """
    version = snapshots.current(spark, ident)
    if version is None and _finished(spark, ident):
        raise ValueError(f"{ident}: an overwrite was interrupted; call ensure_table first")
    partition_by = _partition_columns(spark, ident)
    rows = in_target_order(spark, ident, rows)
    if moved is not None:
        moved = in_target_order(spark, ident, moved)
    if partition_by:
        keys = [named(c) for c in partition_by]
        if moved is None:
            rows = rows.hint("rebalance", *keys)
        else:
            moved = moved.hint("rebalance", *keys)
    if moved is not None:
        rows = rows.unionByName(moved)

    existing = snapshots.versions(spark, ident)
    latest = snapshots.following(spark, ident)
    like = ident if version is None else snapshots.name(ident, version)
    # Registered before it is filled: what a failed write leaves is known by
    # name, not used again, and dropped after the next success.
    new = snapshots.create_like(spark, ident, latest, like)
    _fill(rows, new)
    if version is None:
        spark.sql(f"ALTER TABLE {sql_name(new)} SET TBLPROPERTIES ('{_FINISHED}' = 'true')")
        _finish(spark, ident)
        snapshots.drop(spark, ident, existing)
    else:
        used = {version, *_holders(spark, ident, version)}
        snapshots.point_view(spark, ident, latest)
        snapshots.drop(spark, ident, [v for v in existing if v not in used])


def _fill(rows: DataFrame, table: str) -> None:
    rows.write.insertInto(sql_name(table))


def _finished(spark: SparkSession, ident: str) -> list[int]:
    """Complete copies that a plain table was to be filled from."""
    return [
        v
        for v in snapshots.versions(spark, ident)
        if _FINISHED in snapshots.properties(spark, snapshots.name(ident, v))
    ]


def _finish(spark: SparkSession, ident: str) -> None:
    """Fill a plain table from the finished copy that stands ready for it, if one does."""
    if spark.catalog.getTable(ident).tableType == "VIEW":
        return
    for version in sorted(_finished(spark, ident)):
        copy = snapshots.name(ident, version)
        with session_conf(spark, "spark.sql.sources.partitionOverwriteMode", "static"):
            spark.table(sql_name(copy)).write.insertInto(ident, overwrite=True)
        spark.sql(f"DROP TABLE {sql_name(copy)}")


def overwrite(spark: SparkSession, ident: str, rows: DataFrame) -> None:
    """Truncate and load: the target holds ``rows`` afterwards, even if none."""
    publish(spark, ident, rows)


def overwrite_partitions(spark: SparkSession, ident: str, rows: DataFrame) -> None:
    """Replace the partitions that ``rows`` has rows for; keep the others.

    A target without partitions is replaced as a whole. ``rows`` are shuffled so
    that each partition is written by few tasks, and adaptive execution splits
    the ones that are large. Readers see all partitions exchanged or none, and a
    frame made before keeps its rows until the load after this one. A plain table
    has its partitions exchanged in place, one after the other, and ``rows`` must
    not read it.
    """
    partition_by = _partition_columns(spark, ident)
    if not partition_by:
        publish(spark, ident, rows)
        return
    version = snapshots.current(spark, ident)
    grouped = in_target_order(spark, ident, rows).hint(
        "rebalance", *[named(c) for c in partition_by]
    )
    if version is None:
        with session_conf(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
            grouped.write.insertInto(ident, overwrite=True)
    else:
        _load_partitions(spark, ident, version, grouped)


def _load_partitions(spark: SparkSession, ident: str, version: int, rows: DataFrame) -> None:
    """Write ``rows`` to a new holder and show its partitions with the others."""
    existing = snapshots.versions(spark, ident)
    shown = snapshots.name(ident, version)
    number = snapshots.following(spark, ident)
    _fill(rows, snapshots.create_like(spark, ident, number, shown))

    if not _partitions(spark, snapshots.name(ident, number)):
        snapshots.drop(spark, ident, [number])
        return
    before = _holders(spark, ident, version) or [version]
    places = _places(spark, ident, [*before, number])
    # A holder all of whose partitions are in newer ones is not used any more.
    used = [v for v in (*before, number) if any(holder == v for holder, _ in places.values())]
    root = _location(spark, snapshots.name(ident, number))
    linked = snapshots.create_like(
        spark, ident, number + 1, shown, {_HOLDERS: json.dumps(used)}, f"{root}__shown"
    )
    specs = iter(f"{_spec(p)} LOCATION {literal(at)}" for p, (_, at) in places.items())
    while some := " ".join(islice(specs, _AT_ONCE)):
        spark.sql(f"ALTER TABLE {sql_name(linked)} ADD {some}")
    snapshots.point_view(spark, ident, number + 1)
    snapshots.drop(spark, ident, [v for v in existing if v not in {version, *before, *used}])
    _drop_replaced(spark, ident, before, places, _places(spark, ident, before))


def _drop_replaced(spark: SparkSession, ident: str, holders: list[int], *shown: dict) -> None:
    """Drop partitions of ``holders`` that are in none of the ``shown`` places."""
    for v in holders:
        table = snapshots.name(ident, v)
        kept = {p for places in shown for p, (holder, _) in places.items() if holder == v}
        specs = iter(_spec(p) for p in _partitions(spark, table) if p not in kept)
        while some := ", ".join(islice(specs, _AT_ONCE)):
            spark.sql(f"ALTER TABLE {sql_name(table)} DROP IF EXISTS {some}")


def _holders(spark: SparkSession, ident: str, version: int) -> list[int]:
    """The versions whose files a snapshot shows; none if it has files of its own."""
    said = snapshots.properties(spark, snapshots.name(ident, version)).get(_HOLDERS)
    return json.loads(said) if said else []


def _places(spark: SparkSession, ident: str, holders: list[int]) -> dict[str, tuple[int, str]]:
    """Partition -> (holder, folder), of the newest holder that has it.

    The names of all partitions pass through the driver, as they do when Spark
    plans a scan of the table.
    """
    out = {}
    for v in holders:
        table = snapshots.name(ident, v)
        root = _location(spark, table)
        out.update({p: (v, f"{root}/{p}") for p in _partitions(spark, table)})
    return out


def _partitions(spark: SparkSession, table: str) -> list[str]:
    return [row[0] for row in spark.sql(f"SHOW PARTITIONS {sql_name(table)}").collect()]


def _spec(partition: str) -> str:
    """``a=1/b=x%2Fy`` as SQL names it."""
    pairs = (part.partition("=") for part in partition.split("/"))
    values = (
        f"{quoted(unquote(k))} = {'NULL' if v == _NO_VALUE else literal(unquote(v))}"
        for k, _, v in pairs
    )
    return f"PARTITION ({', '.join(values)})"


def _location(spark: SparkSession, table: str) -> str:
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {sql_name(table)}").collect()
    return next(r["data_type"] for r in described if r["col_name"] == "Location").rstrip("/")


def in_target_order(spark: SparkSession, ident: str, rows: DataFrame) -> DataFrame:
    """``rows`` with the target's columns, by name, cast to its types.

    Columns the target does not have raise: a load does not change a schema.
    """
    fields = spark.table(ident).schema.fields
    known = {f.name.lower() for f in fields}
    unknown = [c for c in rows.columns if c.lower() not in known]
    if unknown:
        raise ValueError(f"{ident}: column(s) {unknown} are not in the target")
    return rows.select(
        *[named(f.name).cast(f.dataType).alias(f.name) for f in fields]
    )


def _partition_columns(spark: SparkSession, ident: str) -> list[str]:
    version = snapshots.current(spark, ident)
    store = ident if version is None else snapshots.name(ident, version)
    return [c.name for c in spark.catalog.listColumns(store) if c.isPartition]


@contextmanager
def session_conf(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """Set a session setting for the length of one write."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)
