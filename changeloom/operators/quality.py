"""Row validation in one pass.

Every row gets the name of the first rule it breaks, or NULL. The rules are plain column
expressions over the cast columns, so the whole check is one projection inside the scan stage:
no shuffle, no action and no union of per-rule frames.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeloom.functions.casts import safe_casts
from changeloom.functions.columns import ref
from changeloom.functions.keys import cdc_names
from changeloom.functions.types import resolve_type
from changeloom.plans.specs import SourceSpec, TargetSpec

logger = logging.getLogger(__name__)

RULE = "_rule"
RAW = "_reject_raw"
_GIVEN = "_given_"

# Rule names and reject metadata columns.
TYPE_CAST = "type_cast"
NULL_CHECK = "null_check"
ENUM_CHECK = "enum_check"
TIMESTAMP_CHECK = "timestamp_check"
REJECT_TABLE = "_reject_table"
REJECT_RULE = "_reject_rule"
REJECT_TIMESTAMP = "_reject_timestamp"

REJECT_METADATA = T.StructType(
    [
        T.StructField(REJECT_TABLE, T.StringType()),
        T.StructField(REJECT_RULE, T.StringType()),
        T.StructField(REJECT_TIMESTAMP, T.TimestampType()),
    ]
)


@dataclass(frozen=True)
class QualityOptions:
    """How strictly rows are judged.

    casts: ``lenient`` lets a bad value in an optional column become NULL; ``strict`` rejects it.
    keep_raw: keep the uncast input of a rejected row as JSON text.
    validate_deletes: apply every rule to delete records too; otherwise they only need their key.
    """

    casts: str = "lenient"
    keep_raw: bool = False
    validate_deletes: bool = True

    def __post_init__(self) -> None:
        if self.casts not in ("lenient", "strict"):
            raise ValueError(f"casts must be lenient or strict, not {self.casts!r}")


def declared_present(df: DataFrame, target: TargetSpec) -> list[str]:
    """Declared columns that the input has, in declared order. Names match by exact case."""
    columns = set(df.columns)
    absent = [name for name in target.schema if name not in columns]
    if absent:
        logger.warning("%s: declared columns not in the input: %s", target.table, absent)
    return [name for name in target.schema if name in columns]


def cast_to_schema(df: DataFrame, target: TargetSpec) -> DataFrame:
    """Declared columns cast to their types in declared order, then all other input columns."""
    return _select_cast(df, _casts(df, target), {})


def tag_rules(
    df: DataFrame,
    target: TargetSpec,
    source: SourceSpec | None = None,
    options: QualityOptions = QualityOptions(),
) -> DataFrame:
    """Cast the input and add ``_rule``: the first rule a row breaks, NULL for a valid row."""
    hidden: dict[str, Column] = {}
    casts = _casts(df, target)
    declared = list(casts)
    if options.keep_raw:
        hidden[RAW] = F.to_json(F.struct(*[ref(c) for c in df.columns]))
    bad_value, bad_time = "_bad_value", "_bad_time"
    if options.casts == "strict":
        hidden |= {_GIVEN + n: ref(n) for n in declared}

    cast = _select_cast(df, casts, hidden)
    if options.casts == "strict":  # in a projection of its own, so that no cast is made twice
        lost = {n: ref(_GIVEN + n).isNotNull() & ref(n).isNull() for n in declared}
        times = {n for n in declared if isinstance(resolve_type(target.schema[n].type), T.TimestampType)}
        found = {
            bad_value: _any([cond for n, cond in lost.items() if n not in times]),
            bad_time: _any([cond for n, cond in lost.items() if n in times]),
        }
        cast = cast.withColumns(found).drop(*(_GIVEN + n for n in declared))
    is_delete = _is_delete(cast, source) if not options.validate_deletes else F.lit(False)
    required = [n for n in declared if not target.schema[n].nullable]
    key_required = [n for n in required if n in target.primary_key]

    rules = [(TYPE_CAST, _missing_key(cast, target, declared))]
    if options.casts == "strict":
        rules[0] = (TYPE_CAST, rules[0][1] | (ref(bad_value) & ~is_delete))
    rules += [
        (NULL_CHECK, F.when(is_delete, _any_null(key_required)).otherwise(_any_null(required))),
        (ENUM_CHECK, _bad_enum(cast, target, source) & ~is_delete),
    ]
    if options.casts == "strict":
        rules.append((TIMESTAMP_CHECK, ref(bad_time) & ~is_delete))

    first_broken = F.coalesce(*[F.when(broken, F.lit(name)) for name, broken in rules])
    return cast.withColumn(RULE, first_broken).drop(bad_value, bad_time)


def valid_rows(tagged: DataFrame) -> DataFrame:
    """Rows that broke no rule, without the bookkeeping columns."""
    return tagged.where(ref(RULE).isNull()).drop(RULE, RAW)


def rejected_rows(tagged: DataFrame, target: TargetSpec, rejected_at: datetime) -> DataFrame:
    """Rows that broke a rule, with the table, the rule and one time for the whole run."""
    return (
        tagged.where(ref(RULE).isNotNull())
        .withColumns(
            {
                REJECT_TABLE: F.lit(target.table),
                REJECT_RULE: ref(RULE),
                REJECT_TIMESTAMP: F.lit(rejected_at.replace(microsecond=0)).cast("timestamp"),
            }
        )
        .drop(RULE)
    )


def validate(
    df: DataFrame,
    target: TargetSpec,
    source: SourceSpec | None = None,
    *,
    rejected_at: datetime,
    options: QualityOptions = QualityOptions(),
) -> tuple[DataFrame, DataFrame]:
    """Split the input into valid rows and rejects. Both are lazy; nothing runs here."""
    tagged = tag_rules(df, target, source, options)
    return valid_rows(tagged), rejected_rows(tagged, target, rejected_at)


def rule_counts(tagged: DataFrame) -> DataFrame:
    """Rows per rule, NULL for valid rows: partial counts are merged, so the shuffle is tiny."""
    return tagged.groupBy(RULE).agg(F.count(F.lit(1)).alias("n_rows"))


def combine_rejects(frames: Sequence[DataFrame]) -> DataFrame:
    """Rejects of several tables in one frame, by name, with NULL where a table lacks a column."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _casts(df: DataFrame, target: TargetSpec) -> dict[str, Column]:
    declared = declared_present(df, target)
    return safe_casts(df, {name: resolve_type(target.schema[name].type) for name in declared})


def _select_cast(df: DataFrame, casts: dict[str, Column], extra: dict[str, Column]) -> DataFrame:
    others = [ref(c) for c in df.columns if c not in casts]
    return df.select(*casts.values(), *others, *[e.alias(name) for name, e in extra.items()])


def _missing_key(cast: DataFrame, target: TargetSpec, declared: Sequence[str]) -> Column:
    if not declared or not target.primary_key:
        return F.lit(False)
    first = target.primary_key[0]
    if first not in cast.columns:
        raise ValueError(f"{target.table}: primary key column {first!r} is not in the input")
    return ref(first).isNull()


def _bad_enum(cast: DataFrame, target: TargetSpec, source: SourceSpec | None) -> Column:
    """True where an enum column holds a value outside its list. NULL passes.

    A rule may use the target name of a CDC column; it is then looked up under its source name.
    """
    types = {field.name: field.dataType for field in cast.schema.fields}
    source_names = {new: old for old, new in cdc_names(source).items()}
    broken = []
    for name, allowed in target.enum_columns.items():
        column = name if name in types else source_names.get(name)
        if column not in types or not allowed:
            continue
        text = ref(column) if isinstance(types[column], T.StringType) else ref(column).cast("string")
        broken.append(text.isNotNull() & ~text.isin(list(allowed)))
    return _any(broken)


def _is_delete(cast: DataFrame, source: SourceSpec | None) -> Column:
    op = source.cdc.op_column if source and source.cdc else None
    if op not in cast.columns:
        return F.lit(False)
    return F.coalesce(ref(op) == F.lit("D"), F.lit(False))


def _any_null(columns: Sequence[str]) -> Column:
    return _any([ref(name).isNull() for name in columns])


def _any(conditions: Sequence[Column]) -> Column:
    return reduce(or_, conditions, F.lit(False))
