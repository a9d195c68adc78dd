"""Job description: which tables to keep, from which landed changes."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Any

DEFAULT_OP_COLUMN = "op"
DEFAULT_FORMAT = "parquet"

# A batch measured at or below this many bytes in memory is broadcast to the
# target's scan tasks; a larger one is shuffle-joined.
DEFAULT_BROADCAST_BYTES = 128 * 1024 * 1024
# Spark broadcasts no table of 8 GB or more.
MAX_BROADCAST_BYTES = 8 * 1024**3 - 1


@dataclass(frozen=True)
class OpCodes:
    """The text that marks each operation, compared exactly."""

    insert: str = "I"
    update: str = "U"
    delete: str = "D"


@dataclass(frozen=True)
class ChangeSpec:
    """How changes are landed."""

    format: str = DEFAULT_FORMAT
    op_column: str = DEFAULT_OP_COLUMN
    ops: OpCodes = field(default_factory=OpCodes)
    ts_column: str | None = None
    tie_columns: tuple[str, ...] = ()
    options: Mapping[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class TableSpec:
    """One table: where its changes land and which target they go to.

    ``slice_by`` is for targets far larger than their batches, see
    :mod:`tidemark.sinks.slices`; ``bucket_by``, a number of buckets, for batches
    too large to be broadcast, see :mod:`tidemark.sinks.buckets`.
    """

    name: str
    source_path: str
    target: str
    has_pk: bool | None
    pk: tuple[str, ...] = ()
    columns: tuple[str, ...] = ()
    schema: Any = None
    target_format: str = DEFAULT_FORMAT
    slice_by: str | None = None
    bucket_by: int = 0
    broadcast_bytes: int = DEFAULT_BROADCAST_BYTES

    def __post_init__(self) -> None:
        if self.has_pk and not self.pk:
            raise ValueError(f"{self.name}: a keyed table needs at least one key column")
        if not 0 <= self.broadcast_bytes <= MAX_BROADCAST_BYTES:
            raise ValueError(f"{self.name}: broadcast_bytes must be below 8 GB")
        if self.slice_by and not (self.has_pk and self.target_format.lower() == DEFAULT_FORMAT):
            raise ValueError(f"{self.name}: slice_by is for keyed {DEFAULT_FORMAT} targets")
        if self.bucket_by and not (self.has_pk and self.target_format.lower() == DEFAULT_FORMAT):
            raise ValueError(f"{self.name}: bucket_by is for keyed {DEFAULT_FORMAT} targets")
        if self.bucket_by < 0 or (self.bucket_by and self.slice_by):
            raise ValueError(f"{self.name}: bucket_by is a number of buckets, without slice_by")


@dataclass(frozen=True)
class JobSpec:
    """Every table of a job, in the order in which they are applied."""

    changes: ChangeSpec
    tables: tuple[TableSpec, ...]
    create_tables: bool = True

    @classmethod
    def from_dict(cls, cfg: Mapping[str, Any]) -> "JobSpec":
        """Build from a nested dict.

        Fixed values, the section and key names of the job format:
        ``catalog`` (``enable_catalog``), ``dms`` (``format``, ``op_column``,
        ``ops``, ``ts_column``) and ``tables`` (``name``, ``source_path``,
        ``target_identifier``, ``has_pk``, ``pk``, ``select_columns``).
        """
        landed = cfg.get("dms", {})
        ops = landed.get("ops", {})
        changes = ChangeSpec(
            format=landed.get("format", DEFAULT_FORMAT),
            op_column=landed.get("op_column", DEFAULT_OP_COLUMN),
            ops=OpCodes(**ops),
            ts_column=landed.get("ts_column"),
            tie_columns=tuple(landed.get("tie_columns", ())),
            options=dict(landed.get("options", {})),
        )
        tables = []
        for entry in cfg["tables"]:
            keyed = entry.get("has_pk")
            extra = {
                key: entry[key]
                for key in ("schema", "target_format", "slice_by", "bucket_by", "broadcast_bytes")
                if key in entry
            }
            tables.append(
                TableSpec(
                    name=entry["name"],
                    source_path=entry["source_path"],
                    target=entry["target_identifier"],
                    has_pk=keyed,
                    pk=tuple(entry.get("pk") or ()) if keyed else (),
                    columns=tuple(entry.get("select_columns") or ()),
                    **extra,
                )
            )
        return cls(
            changes=changes,
            tables=tuple(tables),
            create_tables=cfg.get("catalog", {}).get("enable_catalog", True),
        )
