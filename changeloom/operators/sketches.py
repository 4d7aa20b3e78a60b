"""Column sketches that are stored per run and merged over runs: distinct counts, ranges and quantiles of
everything that was ever loaded, without a second look at the rows.

A run leaves one row per declared column. Counts and ranges are exact and add up; distinct counts come from
HyperLogLog sketches and quantiles from KLL sketches, which merge without any further loss. A sketch has a
bounded size whatever the rows, so merging reads kilobytes a run and column. Sketches describe the
changes that were loaded, not the rows a target holds now: a value that an update replaced still counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeloom.functions.columns import ref
from changeloom.plans.specs import TargetSpec

# Columns of the sketch table, in order.
COLUMN_SKETCHES = T.StructType(
    [
        T.StructField("table", T.StringType()),
        T.StructField("column_name", T.StringType()),
        T.StructField("n_rows", T.LongType()),
        T.StructField("n_null", T.LongType()),
        T.StructField("low", T.DoubleType()),
        T.StructField("high", T.DoubleType()),
        T.StructField("low_text", T.StringType()),
        T.StructField("high_text", T.StringType()),
        T.StructField("distinct_sketch", T.BinaryType()),
        T.StructField("quantile_sketch", T.BinaryType()),
    ]
)
DISTINCT_LG_K = 12
QUANTILE_K = 200
# What may be relied on: three standard errors of 1.04 / sqrt(2^12), and the published rank error of k = 200.
DISTINCT_ERROR = 3 * 1.04 / 2 ** (DISTINCT_LG_K / 2)
RANK_ERROR = 0.0165


def column_sketches(df: DataFrame, target: TargetSpec) -> DataFrame:
    """One row per declared column the input has, in one aggregation over one scan.

    Numbers, booleans and times have a numeric range (times in seconds since 1970) and quantiles; text has a
    range in byte order instead. NaN counts as a value, but quantiles leave it out. Whole numbers beyond 2^53
    are rounded in ranges and quantiles, not in distinct counts. An input without rows gives rows of zeros.
    """
    kinds = {f.name: f.dataType for f in df.schema.fields}
    present = [name for name in target.schema if name in kinds]
    if not present:
        return df.sparkSession.createDataFrame([], COLUMN_SKETCHES)
    aggregates = [F.count(F.lit(1)).alias("n_rows")]
    for i, name in enumerate(present):
        number, text = _number(name, kinds[name]), _text(name, kinds[name])
        none, no_text = F.lit(None).cast("double"), F.lit(None).cast("string")
        numeric = number if number is not None else none
        range_text = no_text if number is not None else text
        # the sketch passes over an empty text, hence the sign before it
        aggregates += [
            F.count_if(ref(name).isNull()).alias(f"null_{i}"),
            F.min(numeric).alias(f"low_{i}"),
            F.max(numeric).alias(f"high_{i}"),
            F.min(range_text).alias(f"low_text_{i}"),
            F.max(range_text).alias(f"high_text_{i}"),
            F.hll_sketch_agg(F.concat(F.lit("="), text), DISTINCT_LG_K).alias(f"distinct_{i}"),
            F.kll_sketch_agg_double(numeric, QUANTILE_K).alias(f"quantile_{i}"),
        ]
    totals = df.agg(*aggregates)
    parts = ("null", "low", "high", "low_text", "high_text", "distinct", "quantile")
    rows = [
        F.struct(
            *(
                value.cast(field.dataType).alias(field.name)
                for field, value in zip(
                    COLUMN_SKETCHES.fields,
                    [F.lit(target.table), F.lit(name), ref("n_rows"), *(ref(f"{part}_{i}") for part in parts)],
                )
            )
        )
        for i, name in enumerate(present)
    ]
    return totals.select(F.inline(F.array(*rows)))


def merged_profile(sketches: DataFrame, quantiles: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Sketch rows of any number of runs as one profile per table and column.

    ``n_distinct`` is within ``DISTINCT_ERROR`` of the exact number, the rank of a quantile within
    ``RANK_ERROR`` of the wanted one. A column without numbers has no quantiles (NULL).
    """
    merged = sketches.groupBy("table", "column_name").agg(
        F.sum("n_rows").alias("n_rows"),
        F.sum("n_null").alias("n_null"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.min("low_text").alias("low_text"),
        F.max("high_text").alias("high_text"),
        F.hll_union_agg("distinct_sketch").alias("_distinct"),
        F.kll_merge_agg_double("quantile_sketch").alias("_quantile"),
    )
    wanted = F.array(*[F.lit(float(q)) for q in quantiles])
    filled = F.kll_sketch_get_n_double("_quantile") > 0  # an empty sketch cannot be asked
    return merged.withColumns(
        {
            "n_distinct": F.hll_sketch_estimate("_distinct"),
            "quantiles": F.when(filled, F.kll_sketch_get_quantile_double("_quantile", wanted)),
        }
    ).drop("_distinct", "_quantile")


def _number(name: str, kind: T.DataType) -> Column | None:
    if isinstance(kind, T.TimestampNTZType):  # as if it were UTC
        micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), ref(name))
        return micros / F.lit(1e6)
    if isinstance(kind, T.TimestampType):
        return ref(name).cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(ref(name)).cast("double") * 86400
    if isinstance(kind, (T.NumericType, T.BooleanType)):
        return ref(name).cast("double")
    return None


def _text(name: str, kind: T.DataType) -> Column:
    """A value as text: equal for equal values and for no others, in any session."""
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return (ref(name) + F.lit(0).cast(kind)).cast("string")  # -0.0 equals 0.0
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(ref(name)).cast("string")
    if isinstance(kind, T.BinaryType):
        return F.hex(ref(name))
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        return F.to_json(F.struct(ref(name)))
    return ref(name).cast("string")
