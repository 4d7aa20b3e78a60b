"""Where a load keeps its tables, and the choices a load can make."""

from __future__ import annotations

from collections.abc import Collection
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

from changeloom.functions.keys import CHANGE_TIME
from changeloom.operators.audit import JOB_NAME
from changeloom.operators.quality import QualityOptions
from changeloom.plans.specs import TargetSpec
from changeloom.sinks.format_table import FormatTable
from changeloom.sinks.keyed_table import KeyedTable
from changeloom.sinks.partitioned_table import PartitionedTable

# Audit tables and their database.
AUDIT_DATABASE = "db_raw"
RUN_LOG_TABLE = "etl_control"
METRICS_TABLE = "data_quality_metrics"
SKETCHES_TABLE = "column_sketches"
PROGRESS_TABLE = "stream_progress"


@dataclass(frozen=True)
class LoadOptions:
    """Choices shared by batch and streaming loads.

    sequence_column: orders changes that share a change time.
    buckets: hash buckets of a new table; None derives them from the size of the first load.
    layout: ``keyed`` buckets a target by its key; ``partitioned`` keeps it in folders by its partition
        columns, if it has any, and rewrites the folders that a batch touches; ``format`` keeps it by the
        format its spec names, which must have row-level operations to take a second batch.
    cache: keep a validated input instead of scanning it again. None decides by mode: a
        micro-batch is bounded and kept, a full load is not.
    compact_every: batches a stream leaves waiting before it merges them or folds them into the
        table (see ``KeyedTable.maintain``); 0 leaves that to a job of its own.
    compact_ratio: share of the table's bytes the waiting batches must reach to be folded in.
    on_error: ``stop`` ends a multi-table load at the first failure, ``continue`` goes on.
    count_effects: also count the keys a load inserts, updates and deletes.
    sketch_columns: leave a sketch of every column of the valid rows (see ``operators.sketches``).
    tombstone_retention: an interval such as ``30 days``. When a keyed table is folded, deleted keys go whose
        delete is older than the table's newest change by more than this; a change that arrives later still
        is taken for a new row. None keeps them for good.
    strict_audit: a failure to write an audit row fails the run instead of being logged.
    """

    quality: QualityOptions = field(default_factory=QualityOptions)
    sequence_column: str | None = None
    buckets: int | None = None
    cache: bool | None = None
    layout: str = "keyed"
    compact_every: int = 50
    compact_ratio: float = 0.1
    on_error: str = "stop"
    count_effects: bool = False
    sketch_columns: bool = False
    tombstone_retention: str | None = None
    strict_audit: bool = False
    job_name: str = JOB_NAME

    def order_by(self, columns: Collection[str]) -> list[str]:
        """Change time, then the sequence for tables that have one."""
        return [CHANGE_TIME, *([self.sequence_column] if self.sequence_column in columns else [])]


@dataclass(frozen=True)
class Lake:
    """Folder that holds target tables, rejects and audit tables.

    In the catalog they have the names of their specs. If several lakes use one name, it means the table
    that was written last; a handle always means its own lake.
    """

    root: str

    def table_path(self, target: TargetSpec) -> str:
        return f"{self.root}/{target.database or 'default'}/{target.table}"

    def rejects_path(self, target: TargetSpec) -> str:
        named = target.rejected_location
        return named.rstrip("/") if named else f"{self.root}/rejected/{target.database}/{target.table}"

    run_log_name = f"{AUDIT_DATABASE}.{RUN_LOG_TABLE}"
    metrics_name = f"{AUDIT_DATABASE}.{METRICS_TABLE}"
    sketches_name = f"{AUDIT_DATABASE}.{SKETCHES_TABLE}"
    progress_name = f"{AUDIT_DATABASE}.{PROGRESS_TABLE}"

    @property
    def run_log_path(self) -> str:
        return f"{self.root}/{AUDIT_DATABASE}/{RUN_LOG_TABLE}"

    @property
    def metrics_path(self) -> str:
        return f"{self.root}/{AUDIT_DATABASE}/{METRICS_TABLE}"

    @property
    def sketches_path(self) -> str:
        return f"{self.root}/{AUDIT_DATABASE}/{SKETCHES_TABLE}"

    @property
    def progress_path(self) -> str:
        return f"{self.root}/{AUDIT_DATABASE}/{PROGRESS_TABLE}"

    def table(self, spark: SparkSession, target: TargetSpec, layout: str = "keyed") -> KeyedTable | PartitionedTable | FormatTable:
        """Handle on a target. A spec without a table name has no name in the catalog; ``format`` needs one."""
        name = ".".join(filter(None, [target.database, target.table]))
        folders = [key.name for key in target.partition_keys]
        if layout == "format":
            path = f"{self.table_path(target)}_{target.format}"
            return FormatTable(spark, path, target.format, folders, name=name, compression=target.compression)
        if layout == "partitioned" and folders:
            path = f"{self.table_path(target)}_partitioned"
            return PartitionedTable(spark, path, folders, name=name or None, compression=target.compression)
        return KeyedTable(spark, self.table_path(target), name=name or None, compression=target.compression)
