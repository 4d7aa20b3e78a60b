"""File layout on write: even file sizes, partition folders, compaction."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from changeloom.functions.columns import ref


def even_files(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Regroup rows before a write so files come out near the advisory partition size.

    Spark's rebalance hint collects small pieces and splits a partition value that is too big for
    one task, so a value holding a third of the rows is still written by many tasks.
    """
    return df.hint("rebalance", *by)


def write_partitioned(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    *,
    sort_by: Sequence[str] = (),
    mode: str = "errorifexists",
    compression: str = "snappy",
) -> None:
    """Parquet folders per partition value. Sorting inside files lets scans skip row groups."""
    laid_out = even_files(df, partition_by)
    if sort_by:
        laid_out = laid_out.sortWithinPartitions(*map(ref, [*partition_by, *sort_by]))
    writer = laid_out.write.mode(mode).option("compression", compression)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def compact_files(
    spark: SparkSession, source: str, destination: str, partition_by: Sequence[str] = ()
) -> None:
    """Rewrite many small files as few even ones in a new folder; the old one is left alone."""
    if source.rstrip("/") == destination.rstrip("/"):
        raise ValueError("compaction needs a new folder: a scan cannot overwrite its own input")
    write_partitioned(spark.read.parquet(source), destination, partition_by)
