"""The least and the greatest key of a batch, and what a target's scan can leave out."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import named

#: (key column, type, least value, greatest value)
KeyRange = tuple[tuple[str, T.DataType, Any, Any], ...]

#: Types whose order is that of Parquet's statistics and survives Python.
_ORDERED = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DecimalType, T.DateType)


def _rangeable(kind: T.DataType) -> bool:
    # Text of the default collation only: other collations have another order.
    return isinstance(kind, (*_ORDERED, T.TimestampType)) or kind == T.StringType()


def bounds(df: DataFrame, keys: Sequence[str]) -> list[Column]:
    """Aggregates for :func:`measured_range`, of the key columns that can have a range."""
    out = []
    for i, key in enumerate(keys):
        kind, value = df.schema[key].dataType, named(key)
        if _rangeable(kind):
            # Instants as numbers: they mean the same in every time zone.
            value = F.unix_micros(value) if isinstance(kind, T.TimestampType) else value
            out += [F.min(value).alias(f"low_{i}"), F.max(value).alias(f"high_{i}")]
    return out


def measured_range(df: DataFrame, keys: Sequence[str], seen: Mapping[str, Any]) -> KeyRange:
    """The ranges that the aggregates of :func:`bounds` found; none of a column without values."""
    return tuple(
        (key, df.schema[key].dataType, seen[f"low_{i}"], seen[f"high_{i}"])
        for i, key in enumerate(keys)
        if seen.get(f"low_{i}") is not None
    )


def in_range(
    target: DataFrame, column_of: Callable[[str], str | None], key_range: KeyRange
) -> Column | None:
    """Whether a row of ``target`` may have a key of the batch; None if nothing is known.

    ``column_of`` names the target's column for one of the batch's. Comparisons
    with literals, so that they reach the scan and row groups (and partitions)
    without such keys are not read. NULL for rows without a key. Columns of
    another type than the batch's are left out.
    """

    def literal(kind: T.DataType, value: Any) -> Column:
        if isinstance(kind, T.TimestampType):
            return F.timestamp_micros(F.lit(value))
        return F.lit(value).cast(kind)

    parts = []
    for key, kind, low, high in key_range:
        column = column_of(key)
        if column is not None and target.schema[column].dataType == kind:
            parts += [named(column) >= literal(kind, low), named(column) <= literal(kind, high)]
    return reduce(lambda a, b: a & b, parts) if parts else None
