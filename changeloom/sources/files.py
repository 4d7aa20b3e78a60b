"""Batch and streaming file scans."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from changeloom.plans.specs import SourceSpec


class SourceError(RuntimeError):
    """A source could not be opened."""


def read_source(spark: SparkSession, source: SourceSpec, mode: str = "streaming") -> DataFrame:
    """``batch`` scans the full-load path; every other mode streams the change path."""
    return scan_batch(spark, source) if mode == "batch" else scan_stream(spark, source)


def scan_batch(
    spark: SparkSession,
    source: SourceSpec,
    *,
    recursive: bool = False,
    schema: T.StructType | None = None,
    modified_after: str | None = None,
) -> DataFrame:
    """All files at the full-load path, which may hold wildcards.

    recursive: also read date folders below the path. modified_after: skip older files.
    """
    reader = spark.read.format(source.format)
    if schema is not None:
        reader = reader.schema(schema)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    if modified_after:
        reader = reader.option("modifiedAfter", modified_after)
    try:
        return reader.load(source.source_location)
    except (PySparkException, Py4JJavaError) as error:
        raise SourceError(f"cannot read {source.source}: {error}") from error


def archive_folder(change_path: str) -> str:
    """Where processed change files go: a sibling of the change folder."""
    return change_path.rstrip("/") + "_archive/"


def scan_stream(
    spark: SparkSession,
    source: SourceSpec,
    *,
    schema: T.StructType | None = None,
    recursive: bool = True,
    archive: bool = True,
    max_files: int | None = 1,
    max_bytes: int | None = None,
) -> DataFrame:
    """Parquet change files as they land; the full-load path serves if no change path is set.

    One file per micro-batch unless told otherwise; at high arrival rates set ``max_bytes``
    (and ``max_files=None``), which bounds a micro-batch by size. A first start reads what is
    there already. Without a schema the one of the files present is used.
    """
    path = source.cdc_source_location or source.source_location
    options: dict[str, object] = {"recursiveFileLookup": str(recursive).lower()}
    if max_bytes is not None:
        options["maxBytesPerTrigger"] = max_bytes
    elif max_files is not None:
        options["maxFilesPerTrigger"] = max_files
    if archive:
        options |= {"cleanSource": "archive", "sourceArchiveDir": archive_folder(path)}
    try:
        if schema is None:
            lookup = spark.read.option("recursiveFileLookup", str(recursive).lower())
            schema = lookup.parquet(path).schema
        return spark.readStream.format("parquet").schema(schema).options(**options).load(path)
    except (PySparkException, Py4JJavaError) as error:
        raise SourceError(f"cannot stream {source.source}: {error}") from error
