"""Change-data loading on Spark: declare a table once, load it in batch or as a stream."""

from changeloom.plans.specs import (
    CdcSpec,
    ColumnSpec,
    LoadPlan,
    PartitionSpec,
    SourceSpec,
    TargetSpec,
)

__all__ = ["CdcSpec", "ColumnSpec", "LoadPlan", "PartitionSpec", "SourceSpec", "TargetSpec"]
