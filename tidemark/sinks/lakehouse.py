"""Targets in a catalog whose tables can change rows themselves.

A table format with row-level operations (Iceberg, for one) runs the merge
inside Spark's own MERGE command and rewrites only the files it touches, which
is the way to go for a target far larger than its batches. The format's jar and
its catalog are deployment settings of the session.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.config import OpCodes
from tidemark.functions.columns import no_rows, quoted
from tidemark.sinks.tables import table_schema

logger = logging.getLogger(__name__)

#: Formats whose tables run MERGE.
ROW_LEVEL = frozenset({"iceberg", "delta", "hudi"})


def ensure_table(
    spark: SparkSession,
    ident: str,
    schema: T.StructType,
    fmt: str,
    op_col: str | None = None,
    enabled: bool = True,
) -> bool:
    """Create the target in format ``fmt`` if missing; say whether it was."""
    if not enabled:
        logger.info("%s: table creation is off", ident)
        return False
    if spark.catalog.tableExists(ident):
        return False
    no_rows(spark, table_schema(schema, op_col)).writeTo(ident).using(fmt).create()
    logger.info("%s: created", ident)
    return True


def merge_into(
    ident: str, staged: DataFrame, pk: Sequence[str], op_col: str, ops: OpCodes
) -> None:
    """Run the merge as one MERGE command on the table."""
    table = ident.split(".")[-1].strip("`")

    def target(name: str):
        return F.col(f"{quoted(table)}.{quoted(name)}")

    def source(name: str):
        return F.col(f"s.{quoted(name)}")

    stored = [c for c in staged.columns if c != op_col]
    updates = {quoted(c): source(c) for c in stored if c not in pk}
    matched = reduce(lambda a, b: a & b, [target(k) == source(k) for k in pk])
    op = source(op_col)

    merge = staged.alias("s").mergeInto(ident, matched)
    merge = merge.whenMatched(op == F.lit(ops.delete)).delete()
    if updates:
        merge = merge.whenMatched(op == F.lit(ops.update)).update(updates)
    merge = merge.whenNotMatched(op.isin(ops.insert, ops.update)).insert(
        {quoted(c): source(c) for c in stored}
    )
    merge.merge()


def overwrite_partitions(ident: str, rows: DataFrame) -> None:
    """Dynamic overwrite: everything if the table has no partitions."""
    rows.writeTo(ident).overwritePartitions()
