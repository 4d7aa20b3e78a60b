"""Compaction by bin packing: small files of a folder become few of the wanted size; good files stay.

Sizes come from file metadata and no large file is opened. In each folder the small files are dealt into
bins by first-fit-decreasing; Spark writes one new file per bin beside the folder, and only when all are there
are they moved in and the old ones removed. A run that died before that left nothing; one that died after it is
finished by the next run. A reader that lists a folder in that moment may see rows twice, so run this on
folders that no one reads or writes meanwhile, such as days that are closed.
"""

from __future__ import annotations

import uuid
from bisect import bisect_left, insort

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeloom.storage import Storage

_WORK, _READY = "_compaction", "_ready"
_TOGETHER = 10_000  # files of one folder that are packed by one task
_SIZE_ON_DISK = "folder string, path string, bytes long, bin string"


def first_fit_decreasing(sizes: list[int], capacity: int) -> list[int]:
    """Bin of each size; the largest goes first, each into the fullest bin that was opened and holds it."""
    bins: list[tuple[int, int]] = []  # free space and number, by free space
    out = [0] * len(sizes)
    opened = 0
    for at in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        k = bisect_left(bins, (sizes[at], -1))
        if k < len(bins):
            free, number = bins.pop(k)
        else:
            free, number, opened = capacity, opened, opened + 1
        out[at] = number
        insort(bins, (max(0, free - sizes[at]), number))
    return out


def small_files(spark: SparkSession, path: str, small_bytes: int) -> DataFrame:
    """folder, path and bytes of all files below a size; other files are skipped by their metadata."""
    rows = spark.read.option("recursiveFileLookup", "true").parquet(path)
    meta = F.col("_metadata")
    found = rows.where(meta.file_size < small_bytes).select(meta.file_path.alias("path"), meta.file_size.alias("bytes"))
    return found.distinct().select(F.regexp_replace("path", "/[^/]*$", "").alias("folder"), "path", "bytes")


def packed(files: DataFrame, target_bytes: int) -> DataFrame:
    """The files that share a bin with others, and their bin."""

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("path").drop(columns="share")
        numbers = first_fit_decreasing(group["bytes"].tolist(), target_bytes)
        return group.assign(bin=[f"{name}#{n}" for name, n in zip(group["path"].iloc[:1].repeat(len(group)), numbers)])

    shares = files.groupBy("folder").agg(F.ceil(F.count("path") / _TOGETHER).alias("shares"))
    dealt = files.join(shares, "folder").withColumn("share", F.pmod(F.xxhash64("path"), "shares")).drop("shares")
    bins = dealt.groupBy("folder", "share").applyInPandas(pack, _SIZE_ON_DISK)
    bins = bins.withColumn("bin", F.md5("bin"))
    return bins.join(bins.groupBy("bin").agg(F.count("path").alias("n")).where("n > 1"), "bin", "left_semi")


def compact_small(spark: SparkSession, path: str, *, target_bytes: int = 128 * 2**20, small_share: float = 0.5) -> int:
    """Merge files smaller than a share of the wanted size; returns how many files went.

    Partition folders may be nested; no row changes its folder.
    """
    path, storage = path.rstrip("/"), Storage(spark)
    gone = finish(spark, path)
    small_bytes = int(target_bytes * small_share)
    work = f"{path}/{_WORK}/{uuid.uuid4().hex}"
    if not storage.names(path):
        return gone
    packed(small_files(spark, path, small_bytes), target_bytes).write.parquet(f"{work}/plan")
    plan = spark.read.schema(_SIZE_ON_DISK).parquet(f"{work}/plan")
    bins = plan.select("bin").distinct().count()
    if not bins:
        storage.remove(f"{path}/{_WORK}")
        return gone
    rows = spark.read.option("recursiveFileLookup", "true").parquet(path)
    meta = F.col("_metadata")
    chosen = rows.where(meta.file_size < small_bytes).withColumn("_path", meta.file_path)
    merged = chosen.join(plan.select(F.col("path").alias("_path"), F.col("bin").alias("_bin")), "_path").drop("_path")
    merged.repartition(bins, "_bin").write.partitionBy("_bin").parquet(f"{work}/files")
    storage.put_text(f"{work}/{_READY}", "")
    return gone + finish(spark, path)


def finish(spark: SparkSession, path: str) -> int:
    """Move in the files of runs that wrote all of theirs and remove what they replace."""
    storage, gone = Storage(spark), 0
    for run in storage.names(f"{path}/{_WORK}"):
        work = f"{path}/{_WORK}/{run}"
        if storage.exists(f"{work}/{_READY}"):
            plan = spark.read.schema(_SIZE_ON_DISK).parquet(f"{work}/plan")
            moved = plan.groupBy("bin", "folder").agg(F.collect_list("path").alias("paths"))  # a bin's files only
            for row in moved.toLocalIterator():
                for name in storage.names(f"{work}/files/_bin={row.bin}"):
                    if name.endswith(".parquet"):
                        storage.move(f"{work}/files/_bin={row.bin}/{name}", f"{storage.decoded(row.folder)}/{row.bin}-{name}")
                for old in map(storage.decoded, row.paths):
                    gone += storage.exists(old)
                    storage.remove(old)
        storage.remove(work)
    return gone
