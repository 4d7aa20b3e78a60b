"""Reject store: one folder per batch, so a batch that runs twice replaces its own rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from changeloom.operators.quality import REJECT_METADATA
from changeloom.sinks.layout import even_files
from changeloom.storage import Storage


def write_rejects(
    rejects: DataFrame, location: str, batch_key: str, *, compression: str = "snappy"
) -> None:
    """Write the rejects of one batch. Callers skip it when the batch has none."""
    writer = even_files(rejects).write.mode("overwrite").option("compression", compression)
    writer.parquet(f"{location.rstrip('/')}/batch_id={batch_key}")


def clear_rejects(spark: SparkSession, location: str, batch_key: str) -> None:
    """A batch that has no rejects any more, after a change of rules say, keeps none of its old ones."""
    storage, folder = Storage(spark), f"{location.rstrip('/')}/batch_id={batch_key}"
    if storage.exists(folder):
        storage.remove(folder)


def read_rejects(
    spark: SparkSession, location: str, schema: T.StructType | None = None
) -> DataFrame:
    """All rejects with their batch; without any yet, an empty frame of the metadata columns."""
    if not Storage(spark).names(location):
        return spark.createDataFrame([], schema or REJECT_METADATA)
    reader = spark.read.option("mergeSchema", "true")
    if schema is not None:
        reader = reader.schema(T.StructType([*schema.fields, T.StructField("batch_id", T.StringType())]))
    return reader.parquet(location)
