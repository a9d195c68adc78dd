"""Keys of which a table holds so many rows that one task should not take them all."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import all_set, named
from tidemark.operators.staging import StagedBatch, stage_batch

#: Rows that a task takes whatever the others have.
LEAST_ROWS = 1_000_000
#: What the sketch keeps apart, for each task: its error is then far below an even share.
ITEMS_PER_TASK = 20
MOST_ITEMS = 1_000_000

PARTS = "__parts"
_HASH = "__hash"


@dataclass(frozen=True)
class HotKeys:
    """Keys of a table, and in how many parts the rows of each should be joined.

    ``keys`` has the key columns under their names and ``__parts``. There are
    fewer keys than ``tasks``, as each has more than an even share of the rows.
    """

    staged: StagedBatch
    keys: DataFrame

    def release(self) -> None:
        self.staged.release()


def hot_keys(
    table: DataFrame, pk: Sequence[str], tasks: int | None = None, least_rows: int = LEAST_ROWS
) -> HotKeys | None:
    """The keys with more rows than an even share of ``table``; None if there are none.

    An even share is that of ``tasks``, as many as a shuffle has partitions
    unless said otherwise, and ``least_rows`` at least. Rows without a full key
    do not count. Reads the key columns once, for ``approx_top_k``, and only if
    that finds keys again, to count their rows.
    """
    spark = table.sparkSession
    tasks = tasks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = table.select(*map(named, pk)).filter(all_set(pk))
    hashed = keyed.withColumn(_HASH, F.xxhash64(*map(named, pk)))
    items = min(MOST_ITEMS, max(1000, ITEMS_PER_TASK * tasks))
    most = min(tasks, items)
    seen = hashed.agg(
        F.count(F.lit(1)).alias("rows"),
        F.expr(f"approx_top_k({_HASH}, {most}, {items})").alias("top"),
    ).first()
    share = max(seen["rows"] / tasks, least_rows)
    often = [t["item"] for t in seen["top"] or () if t["count"] > share]
    if not often:
        return None
    counted = (
        hashed.filter(F.col(_HASH).isin(often))
        .groupBy(*map(named, pk))
        .agg(F.count(F.lit(1)).alias("held"))
        .filter(F.col("held") > share)
        .withColumn(PARTS, F.least(F.ceil(F.col("held") / share), F.lit(tasks)).cast("int"))
        .drop("held")
    )
    staged = stage_batch(counted, pk)
    if not staged.count:
        staged.release()
        return None
    return HotKeys(staged, staged.rows)
