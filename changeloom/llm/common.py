"""What the document operators share: inputs, staged tables, bounded Arrow batches, splits."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changeloom.storage import Storage, scratch_folder

#: A-Z and nothing else is lower-cased wherever a contract speaks of letters of ASCII
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def narrow(docs: DataFrame, *extra: Column) -> DataFrame:
    """Only the columns an operator needs, so that no other column can clash with its own."""
    columns = [F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")]
    return docs.select(*columns, *extra)


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write to the cluster's shared folder and read again: cuts lineage, survives lost executors."""
    return staged_at(df, label)[0]


def staged_at(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """As ``staged``, and the folder, for ``drop_staged`` once nothing reads it any more."""
    spark = df.sparkSession
    path = scratch_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def drop_staged(spark: SparkSession, path: str) -> None:
    if path:
        Storage(spark).remove(path)


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo; -1 for a missing id, which so is in no held-out part."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus, F.lit(-1))


def total_text_bytes(docs: DataFrame) -> int:
    return docs.select(F.sum(F.octet_length("text"))).first()[0] or 0


def raw(column: pa.Array) -> list[bytes]:
    """Texts of a batch as UTF-8 bytes, null as empty."""
    return [b"" if v is None else v for v in column.cast(pa.binary()).to_pylist()]


def release() -> None:
    """Hand memory of finished tasks back; Python workers serve many tasks of different stages."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def bounded(batches: Iterator[pa.RecordBatch], most_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in pieces of about ``most_bytes`` of text; a longer text comes alone."""
    release()
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + most_bytes, side="right")))
            yield batch.slice(start, stop - start)
            start = stop
