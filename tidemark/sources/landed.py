"""Reading landed change files."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from tidemark.config import DEFAULT_FORMAT, DEFAULT_OP_COLUMN
from tidemark.functions.columns import named


def read_landed(
    spark: SparkSession,
    path: str | list[str],
    fmt: str = DEFAULT_FORMAT,
    columns: Sequence[str] | None = None,
    schema=None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Scan a landed path in any registered format.

    The format's name is passed on as it is given: Spark takes short names in
    any case, class names exactly. ``columns`` keeps the
    requested columns that exist, see :func:`select_existing`. Without
    ``schema`` the types are inferred: from a file footer for Parquet and ORC,
    but by a pass over all the data for JSON, so give a schema for large text
    sources.
    """
    reader = spark.read.format(fmt).options(**dict(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    return select_existing(reader.load(path), columns)


def select_existing(df: DataFrame, columns: Sequence[str] | None) -> DataFrame:
    """Keep the requested columns that exist, in the requested order.

    Names are compared with their case. An empty request keeps everything; a
    request that names no existing column leaves a frame without columns.
    """
    if not columns:
        return df
    found = set(df.columns)
    return df.select(*[named(c) for c in columns if c in found])


def drop_op(df: DataFrame, op_col: str = DEFAULT_OP_COLUMN) -> DataFrame:
    """Every column but the operation code (exact case)."""
    return df.select(*[named(c) for c in df.columns if c != op_col])
