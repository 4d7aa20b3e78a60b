"""Run-log and quality-metric rows, and the figures read from them."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeloom.plans.specs import TargetSpec

# Columns of the two audit tables, in order.
RUN_LOG = T.StructType(
    [
        T.StructField("execution_id", T.StringType()),
        T.StructField("job_name", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("execution_start", T.TimestampType()),
        T.StructField("execution_end", T.TimestampType()),
        T.StructField("status", T.StringType()),
        T.StructField("records_read", T.LongType()),
        T.StructField("records_written", T.LongType()),
        T.StructField("records_rejected", T.LongType()),
        T.StructField("target_partition", T.StringType()),
        T.StructField("error_message", T.StringType()),
        T.StructField("reference_date", T.DateType()),
    ]
)
QUALITY_METRICS = T.StructType(
    [
        T.StructField("database", T.StringType()),
        T.StructField("table", T.StringType()),
        T.StructField("processing_timestamp", T.TimestampType()),
        T.StructField("metric", T.StringType()),
        T.StructField("rule", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("failure_reason", T.StringType()),
        T.StructField("partition", T.StringType()),
        T.StructField("technology", T.StringType()),
        T.StructField("reference_date", T.DateType()),
    ]
)
JOB_NAME = "changeloom"
TECHNOLOGY = "spark"


@dataclass(frozen=True)
class RunResult:
    """What one run of one table did. Counts are rows: read, valid (offered), rejected.

    ``effects`` holds keys per effect (insert, update, delete and so on) if they were counted.
    """

    execution_id: str
    source: str
    status: str
    started: datetime
    ended: datetime
    records_read: int = 0
    records_written: int = 0
    records_rejected: int = 0
    error_message: str = ""
    effects: Mapping[str, int] = field(default_factory=dict)


def run_log_row(
    spark: SparkSession, result: RunResult, target: TargetSpec, job_name: str = JOB_NAME
) -> DataFrame:
    """One run-log row."""
    values = {
        "execution_id": result.execution_id,
        "job_name": job_name,
        "source": result.source,
        "execution_start": result.started,
        "execution_end": result.ended,
        "status": result.status,
        "records_read": result.records_read,
        "records_written": result.records_written,
        "records_rejected": result.records_rejected,
        "target_partition": target.partition_text,
        "error_message": result.error_message,
        "reference_date": result.ended.date(),
    }
    return _numbered(spark, 1).select(*_typed(values, RUN_LOG))


def quality_metric_rows(spark: SparkSession, result: RunResult, target: TargetSpec) -> DataFrame:
    """Four metric rows, and one per effect if they were counted; the value is text in ``failure_reason``."""
    outcome = "success" if result.status == "success" else "failed"
    metrics = [
        ("rows_read", str(result.records_read), outcome),
        ("rows_written", str(result.records_written), outcome),
        ("rows_rejected", str(result.records_rejected), "success"),
        ("pipeline_status", result.status, "success"),
        *((f"keys_{effect}", str(count), outcome) for effect, count in sorted(result.effects.items())),
    ]
    names, shown, states = (F.array(*map(F.lit, column)) for column in zip(*metrics))
    values = {
        "database": target.database,
        "table": target.table,
        "processing_timestamp": result.ended,
        "metric": names[F.col("n")],
        "rule": names[F.col("n")],
        "status": states[F.col("n")],
        "failure_reason": shown[F.col("n")],
        "partition": target.partition_text,
        "technology": TECHNOLOGY,
        "reference_date": result.ended.date(),
    }
    return _numbered(spark, len(metrics)).select(*_typed(values, QUALITY_METRICS))


def validity_rate(run_log: DataFrame) -> DataFrame:
    """Valid share of all rows read, per source."""
    totals = run_log.groupBy("source").agg(
        F.sum("records_read").alias("records_read"), F.sum("records_written").alias("records_written")
    )
    rate = F.try_divide(F.col("records_written").cast("double"), F.col("records_read"))
    return totals.withColumn("validity_rate", rate).withColumn("meets_target", rate >= F.lit(0.99))


def run_throughput(run_log: DataFrame) -> DataFrame:
    """Runs, rows, longest run and rows per minute, per source."""
    seconds = F.col("execution_end").cast("double") - F.col("execution_start").cast("double")
    totals = run_log.withColumn("seconds", seconds).groupBy("source").agg(
        F.count(F.lit(1)).alias("runs"),
        F.sum("records_read").alias("records_read"),
        F.max("seconds").alias("longest_run_seconds"),
        F.sum("seconds").alias("total_seconds"),
    )
    per_minute = F.try_divide(F.col("records_read") * F.lit(60.0), F.col("total_seconds"))
    return totals.withColumn("records_per_minute", per_minute).drop("total_seconds")


def _numbered(spark: SparkSession, count: int) -> DataFrame:
    """Rows 0 to count - 1 as constants, so Spark evaluates the select on top while planning."""
    return spark.sql(f"SELECT n FROM VALUES {', '.join(f'({i})' for i in range(count))} AS t(n)")


def _typed(values: dict, schema: T.StructType) -> list[Column]:
    return [F.lit(values[f.name]).cast(f.dataType).alias(f.name) for f in schema.fields]
