"""Audit tables. Each run writes its own folder, so a run that repeats replaces its rows."""

from __future__ import annotations

import json
import uuid
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeloom.functions.columns import ref
from changeloom.sinks.layout import even_files
from changeloom.sources.catalog import drop_partitions, enter_partition
from changeloom.storage import Storage

RUN_KEY = "run_key"
_MERGING, _REPLACED, _MERGED = "_merging", "_replaced.json", "merged-"


def write_audit(rows: DataFrame, path: str, run_key: str, name: str | None = None) -> None:
    """The rows of one run: a single small file, and a partition of the catalog table ``name``."""
    path = path.rstrip("/")
    rows.coalesce(1).write.mode("overwrite").parquet(f"{path}/{RUN_KEY}={run_key}")
    if name:
        enter_partition(rows.sparkSession, name, path, rows.schema, RUN_KEY, run_key)


def read_audit(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All rows of an audit table; empty before the first run."""
    if not Storage(spark).names(path):
        return spark.createDataFrame([], schema)
    return _keyed(spark, path, schema).drop(RUN_KEY)


def merge_closed_runs(
    spark: SparkSession, path: str, schema: T.StructType, before: date, name: str | None = None, day: str = "reference_date"
) -> int:
    """Put the runs that ended before a day into one folder; returns how many there were.

    A run of a closed day must not repeat any more: leave open the days that a stream may take up again. Only
    names of runs pass through the driver. The merged rows are whole before anything is
    removed, and a call that died is finished by the next. It is for hours when nobody reads the table.
    """
    path, storage = path.rstrip("/"), Storage(spark)
    _finish_merges(spark, path, schema, name)
    if not [n for n in storage.names(path) if n.startswith(f"{RUN_KEY}=")]:
        return 0
    rows = _keyed(spark, path, schema).where(~ref(RUN_KEY).startswith(_MERGED))
    ended = rows.groupBy(RUN_KEY).agg(F.max(day).alias("_day")).where(F.col("_day") < F.lit(before))
    closed = [row[RUN_KEY] for row in ended.collect()]
    if len(closed) > 1:
        draft = f"{path}/{_MERGING}/{uuid.uuid4().hex}"
        taken = rows.join(ended.select(ref(RUN_KEY).alias("_closed")), ref(RUN_KEY) == ref("_closed"), "left_semi")
        even_files(taken.drop(RUN_KEY)).write.parquet(f"{draft}/rows")
        storage.put_text(f"{draft}/{_REPLACED}", json.dumps(closed))
        _finish_merges(spark, path, schema, name)
    return len(closed)


def _finish_merges(spark: SparkSession, path: str, schema: T.StructType, name: str | None) -> None:
    """Let merges whose rows are whole take the place of their runs; drop the others."""
    storage = Storage(spark)
    for draft in storage.names(f"{path}/{_MERGING}"):
        folder = f"{path}/{_MERGING}/{draft}"
        if storage.exists(f"{folder}/{_REPLACED}"):
            closed = json.loads(storage.read_text(f"{folder}/{_REPLACED}"))
            for run_key in closed:
                storage.remove(f"{path}/{RUN_KEY}={run_key}")
            if storage.exists(f"{folder}/rows"):  # else the call died after this step
                storage.move(f"{folder}/rows", f"{path}/{RUN_KEY}={_MERGED}{draft}")
            if name:
                enter_partition(spark, name, path, schema, RUN_KEY, f"{_MERGED}{draft}")
                drop_partitions(spark, name, RUN_KEY, closed)
        storage.remove(folder)


def _keyed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    keyed = T.StructType([*schema.fields, T.StructField(RUN_KEY, T.StringType())])
    return spark.read.schema(keyed).parquet(path)
