"""Newest change per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import named, resolved

_RANK = "__tidemark_rank"


def latest_per_pk(
    df: DataFrame,
    pk: Sequence[str],
    ts_col: str | None,
    tie_cols: Sequence[str] = (),
) -> DataFrame:
    """Keep one row per key, the one with the greatest ``ts_col``.

    Key and tie columns are found as SQL finds names, ``ts_col`` by exact case.

    Rows without a timestamp rank last but are kept if a key has no other; all
    NULL keys are one group. Without ``ts_col``, or when the frame has no such
    column, the frame is returned as it is. Equal timestamps are decided by
    ``tie_cols`` (greatest first) and arbitrarily beyond them.

    A filter on ``row_number() = 1`` is planned with a group limit on both
    sides of the shuffle, so at most one row per key leaves each map task: a
    key that holds a large share of the log costs one row per task, not a
    large partition.
    """
    if not pk:
        raise ValueError("latest_per_pk: no key columns")
    if not ts_col or ts_col not in df.columns:
        return df
    keys = resolved(df, pk, "latest_per_pk")
    ties = resolved(df, tie_cols, "latest_per_pk")
    newest_first = [named(c).desc() for c in (ts_col, *ties)]
    window = Window.partitionBy(*[named(c) for c in keys]).orderBy(*newest_first)
    return (
        df.withColumn(_RANK, F.row_number().over(window))
        .filter(F.col(_RANK) == 1)
        .drop(_RANK)
    )
