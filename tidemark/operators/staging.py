"""Materialising a change batch before it is merged."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.columns import named, resolved, row_bytes
from tidemark.operators.key_range import KeyRange, bounds, measured_range
from tidemark.operators.merge import KEYS, NOTHING, ROWS

_CHECKPOINT_DIR = "spark.checkpoint.dir"
_local_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, named by ``spark.checkpoint.dir``.

    Only a session that is known to run in one process may do without the
    setting; it gets a fresh temporary folder, one per application.
    """
    configured = spark.conf.get(_CHECKPOINT_DIR, None)
    if configured:
        return configured.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", None) or ""):
        raise RuntimeError(f"set {_CHECKPOINT_DIR} to a folder all executors can reach")
    app = spark.conf.get("spark.app.id", "local")
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="tidemark-")
    return _local_dirs[app]


@dataclass(frozen=True)
class StagedBatch:
    """A change batch written to the shared folder, with its measured size.

    ``key_range`` has the least and the greatest value of key columns whose type
    allows for it.
    """

    rows: DataFrame
    database: str
    count: int
    size_bytes: int
    key_bytes: int
    key_range: KeyRange = ()

    def broadcast(self, limit: int) -> str:
        """What of the batch may be broadcast: at most ``limit`` bytes of it."""
        if self.size_bytes <= limit:
            return ROWS
        return KEYS if self.key_bytes <= limit else NOTHING

    def release(self) -> None:
        """Drop the copy and its files."""
        self.rows.sparkSession.sql(f"DROP DATABASE IF EXISTS {self.database} CASCADE")


def stage_batch(df: DataFrame, pk: Sequence[str]) -> StagedBatch:
    """Write the changes ``df`` of a table with key ``pk``, and read them back.

    A merge reads its batch more than once. Staging fixes which row won among
    tied timestamps, cuts the lineage in a way that survives lost executors,
    and lets later reads prune columns and push filters. The row count, the
    sizes in memory and the range of the keys are measured by the same job, as
    the rows are written; a task that has to be run again may count twice, which
    errs on the safe side.
    """
    keys = resolved(df, pk, "stage_batch")
    spark = df.sparkSession
    # A database of its own, so that its files go when it is dropped.
    database = f"tidemark_staged_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{shared_dir(spark)}/{database}'")
    seen = Observation()
    measured = df.observe(
        seen,
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum(row_bytes(df.schema)), F.lit(0)).alias("size"),
        F.coalesce(F.sum(row_bytes(df.select(*map(named, keys)).schema)), F.lit(0)).alias("keys"),
        *bounds(df, keys),
    )
    measured.write.format("parquet").saveAsTable(f"{database}.batch")
    totals = seen.get
    rows = spark.table(f"{database}.batch")
    return StagedBatch(
        rows,
        database,
        totals["n"],
        totals["size"],
        totals["keys"],
        measured_range(df, keys, totals),
    )
