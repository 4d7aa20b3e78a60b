"""Reports on a table as a whole: column health and referential gaps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeloom.functions.casts import safe_casts
from changeloom.functions.columns import ref
from changeloom.functions.types import resolve_type
from changeloom.operators.changes import _held, _matches
from changeloom.plans.specs import TargetSpec


def column_profile(df: DataFrame, target: TargetSpec) -> DataFrame:
    """One row per declared column: rows, NULLs, values lost by the cast, values off the list.

    One aggregation over one scan; only the finished counts are turned into rows.
    """
    present = [name for name in target.schema if name in df.columns]
    casts = safe_casts(df, {name: resolve_type(target.schema[name].type) for name in present})
    counts = [F.count(F.lit(1)).alias("n_rows")]
    for i, name in enumerate(present):
        lost = ref(name).isNotNull() & casts[name].isNull()
        allowed = target.enum_columns.get(name)
        off_list = ~casts[name].cast("string").isin(list(allowed)) if allowed else F.lit(False)
        counts += [
            F.count_if(ref(name).isNull()).alias(f"nulls_{i}"),
            F.count_if(lost).alias(f"lost_{i}"),
            F.count_if(off_list).alias(f"off_{i}"),
        ]
    totals = df.agg(*counts)
    rows = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.lit(not target.schema[name].nullable).alias("required"),
            ref("n_rows"),
            ref(f"nulls_{i}").alias("n_null"),
            ref(f"lost_{i}").alias("n_bad_cast"),
            ref(f"off_{i}").alias("n_off_list"),
        )
        for i, name in enumerate(present)
    ]
    return totals.select(F.inline(F.array(*rows)))


def fk_orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Foreign key values without a parent, with the number of rows that hold each.

    Rows are counted per value before the join: the join sees each value once, so a value that a
    third of the rows share costs no more than any other. NULL refers to nothing and is no orphan.
    """
    counted = child.where(ref(column).isNotNull()).groupBy(ref(column)).agg(
        F.count(F.lit(1)).alias("n_rows")
    )
    known = parent.select(ref(parent_column).alias(column))
    return counted.join(_held(known, [column]), _matches([column]), "left_anti")
