"""Versions of a target: ordinary tables behind a view.

A target ``db.orders`` is a view over one of the tables ``db.orders__v0``,
``db.orders__v1``, ... A change writes a new one and then repoints the view. The
tables carry a property that names their target; tables without it are never
touched, whatever their name. A property of the view says which it shows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from tidemark.functions.columns import quoted, sql_type

VERSION = "tidemark.version"
SNAPSHOT_OF = "tidemark.snapshot_of"


def sql_name(ident: str) -> str:
    return ".".join(quoted(part.strip("`")) for part in ident.split("."))


def literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def listed(properties: Mapping[str, str]) -> str:
    return ", ".join(f"{literal(k)} = {literal(v)}" for k, v in properties.items())


def owned(ident: str) -> dict[str, str]:
    """The property that makes a table one of the target's."""
    return {SNAPSHOT_OF: ident.replace("`", "").replace("'", "").lower()}


def properties(spark: SparkSession, table: str) -> dict[str, str]:
    rows = spark.sql(f"SHOW TBLPROPERTIES {sql_name(table)}").collect()
    return {row["key"]: row["value"] for row in rows}


def name(ident: str, version: int) -> str:
    return f"{ident}__v{version}"


def taken(spark: SparkSession, ident: str) -> list[int]:
    """Versions whose name is in use, by whomever."""
    database, _, table = ident.rpartition(".")
    prefix = f"{table}__v".lower()
    within = f" IN {sql_name(database)}" if database else ""
    found = spark.sql(f"SHOW TABLES{within} LIKE '{prefix}*'").collect()
    tails = [
        row["tableName"][len(prefix):]
        for row in found
        if row["tableName"].lower().startswith(prefix)
    ]
    # Only what name() would write: no leading zeros.
    return [int(tail) for tail in tails if tail.isdigit() and str(int(tail)) == tail]


def versions(spark: SparkSession, ident: str) -> list[int]:
    """Own versions that exist, the current one and any left by a failed run."""
    mine = owned(ident)[SNAPSHOT_OF]
    return [
        v
        for v in taken(spark, ident)
        if properties(spark, name(ident, v)).get(SNAPSHOT_OF) == mine
    ]


def following(spark: SparkSession, ident: str) -> int:
    """A version number that is not in use and greater than all that are."""
    return max(taken(spark, ident), default=-1) + 1


def current(spark: SparkSession, ident: str) -> int | None:
    """The version the view shows; None for an ordinary table."""
    if spark.catalog.getTable(ident).tableType != "VIEW":
        return None
    shown = properties(spark, ident).get(VERSION)
    if shown is None:
        raise ValueError(f"{ident}: a view that is not over snapshots cannot be a target")
    return int(shown)


def point_view(
    spark: SparkSession,
    ident: str,
    version: int,
    columns: Sequence[str] = (),
    extra: Mapping[str, str] | None = None,
) -> None:
    """Show ``version`` from now on; all of its columns if none are named."""
    wanted = ", ".join(map(quoted, columns)) or "*"
    spark.sql(
        f"CREATE OR REPLACE VIEW {sql_name(ident)} "
        f"TBLPROPERTIES ({listed({VERSION: str(version), **(extra or {})})}) "
        f"AS SELECT {wanted} FROM {sql_name(name(ident, version))}"
    )


def create_table(
    spark: SparkSession,
    table: str,
    schema: T.StructType,
    partition_by: Sequence[str],
    properties: Mapping[str, str],
    clause: str = "",
) -> None:
    """Create an empty table, with its properties, by one command."""
    columns = ", ".join(f"{quoted(f.name)} {sql_type(f.dataType)}" for f in schema.fields)
    by = f" PARTITIONED BY ({', '.join(map(quoted, partition_by))})" if partition_by else ""
    spark.sql(
        f"CREATE TABLE {sql_name(table)} ({columns}) USING parquet{by} {clause} "
        f"TBLPROPERTIES ({listed(properties)})"
    )


def create_like(
    spark: SparkSession,
    ident: str,
    version: int,
    like: str,
    extra: Mapping[str, str] | None = None,
    location: str | None = None,
) -> str:
    """A new, empty version made like the table ``like``; its name."""
    new = name(ident, version)
    at = f" LOCATION {literal(location)}" if location else ""
    spark.sql(
        f"CREATE TABLE {sql_name(new)} LIKE {sql_name(like)} USING parquet"
        f" TBLPROPERTIES ({listed({**owned(ident), **(extra or {})})}){at}"
    )
    return new


def clear_broken_creation(spark: SparkSession, ident: str) -> None:
    """Drop what a creation that broke off left: own versions without a view and rows.

    Own versions that hold rows are not from a creation. They are kept, and the
    target is refused.
    """
    left = versions(spark, ident)
    filled = [v for v in left if not spark.table(sql_name(name(ident, v))).isEmpty()]
    if filled:
        raise ValueError(
            f"{ident}: snapshots {filled} exist without their view; create the view again or drop them"
        )
    drop(spark, ident, left)


def drop(spark: SparkSession, ident: str, which: Sequence[int]) -> None:
    for v in which:
        spark.sql(f"DROP TABLE IF EXISTS {sql_name(name(ident, v))}")
