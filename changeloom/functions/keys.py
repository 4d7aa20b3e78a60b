"""Merge keys, partition values and CDC column names."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeloom.functions.casts import safe_casts
from changeloom.functions.columns import ref
from changeloom.functions.types import resolve_type
from changeloom.plans.specs import SourceSpec, TargetSpec

logger = logging.getLogger(__name__)

# Names a target table uses for its key and CDC columns.
MERGE_KEY = "cod_unique"
OPERATION = "cdc_operation"
CHANGE_TIME = "cdc_timestamp"
EVENT_DATE = "event_date"


class KeyColumnMissing(ValueError):
    """A column that the merge key is built from is not in the input."""


def match_columns(target: TargetSpec, columns: Sequence[str]) -> list[str]:
    """Columns that identify a row: a ready-made merge key, else the columns it is built from."""
    if MERGE_KEY in columns:
        return [MERGE_KEY]
    parts = list(target.key_columns)
    missing = [name for name in parts if name not in columns]
    if missing or not parts:
        raise KeyColumnMissing(
            f"{target.table}: key columns {parts} need {missing or 'a declared primary key'}"
        )
    return parts


def with_merge_key(df: DataFrame, target: TargetSpec) -> DataFrame:
    """Add the text merge key unless the input has one. NULL parts are left out of the text."""
    if MERGE_KEY in df.columns:
        return df
    parts = match_columns(target, df.columns)
    text = [ref(name).cast("string") for name in parts]
    return df.withColumn(MERGE_KEY, F.concat_ws(target.key_separator, *text))


def with_partition_columns(
    df: DataFrame, target: TargetSpec, source: SourceSpec | None = None
) -> DataFrame:
    """Add the partition columns the input lacks.

    A declared source column gives the date; ``event_date`` without one comes from the change
    time. Any other name cannot be derived and is left out.
    """
    time_column = source.cdc.timestamp_column if source and source.cdc else None
    derived = {}
    for key in target.partition_keys:
        if key.name in df.columns:
            continue
        if key.source_column and key.source_column in df.columns:
            derived[key.name] = _as_date(df, key.source_column)
        elif key.name == EVENT_DATE and time_column in df.columns:
            derived[key.name] = _as_date(df, time_column)
        else:
            logger.warning("%s: partition column %r cannot be derived", target.table, key.name)
    return df.withColumns(derived) if derived else df


def _as_date(df: DataFrame, column: str):
    return safe_casts(df, {column: T.DateType()})[column]


def cdc_names(source: SourceSpec | None) -> dict[str, str]:
    """Source CDC column names mapped to their target names."""
    if source is None or source.cdc is None:
        return {}
    pairs = {source.cdc.op_column: OPERATION, source.cdc.timestamp_column: CHANGE_TIME}
    return {old: new for old, new in pairs.items() if old and old != new}


def rename_cdc_columns(df: DataFrame, source: SourceSpec | None) -> DataFrame:
    """Give the CDC columns their target names; columns that are not there are ignored."""
    names = {old: new for old, new in cdc_names(source).items() if old in df.columns}
    return df.withColumnsRenamed(names) if names else df


def declared_types(target: TargetSpec, source: SourceSpec | None = None) -> dict[str, T.DataType]:
    """Declared columns, CDC columns under their target names, with their types."""
    names = cdc_names(source)
    return {names.get(n, n): resolve_type(column.type) for n, column in target.schema.items() if names.get(n, n) != OPERATION}


def project_to_target(
    changes: DataFrame, target_columns: Sequence[str], op: str | None = OPERATION
) -> DataFrame:
    """Keep the columns the target has, plus the operation column the merge needs to see."""
    wanted = set(target_columns)
    return changes.select(*[ref(c) for c in changes.columns if c in wanted or c == op])


def prepare_for_target(
    df: DataFrame, target: TargetSpec, source: SourceSpec | None = None
) -> DataFrame:
    """Merge key, then partition columns, then CDC names: the shape a target table stores."""
    keyed = with_merge_key(df, target)
    return rename_cdc_columns(with_partition_columns(keyed, target, source), source)


def key_text(shape: Sequence[T.StructField], keys: Sequence[str]) -> Column:
    """The key as one text: never NULL, equal for equal keys and for no others, in any session."""
    types, parts = {f.name: f.dataType for f in shape}, []
    for name in keys:
        value = ref(name)
        if isinstance(types[name], T.TimestampType):
            value = F.unix_micros(value)
        elif isinstance(types[name], T.BinaryType):
            value = F.hex(value)
        elif isinstance(types[name], (T.FloatType, T.DoubleType)):
            value = value + F.lit(0).cast(types[name])  # -0.0 equals 0.0
        text = value.cast("string")
        parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.concat(*parts)
