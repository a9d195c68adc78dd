"""Keep analytical tables in step with an operational database, on Spark."""

from tidemark.config import ChangeSpec, JobSpec, OpCodes, TableSpec
from tidemark.operators.latest import latest_per_pk
from tidemark.operators.merge import merge_cdc, merge_effects
from tidemark.operators.staging import StagedBatch, stage_batch
from tidemark.plans.job import apply_table, run_job
from tidemark.sources.landed import drop_op, read_landed, select_existing

__all__ = [
    "ChangeSpec",
    "JobSpec",
    "OpCodes",
    "StagedBatch",
    "TableSpec",
    "apply_table",
    "drop_op",
    "latest_per_pk",
    "merge_cdc",
    "merge_effects",
    "read_landed",
    "run_job",
    "select_existing",
    "stage_batch",
]
