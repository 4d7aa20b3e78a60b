"""Inputs of the registered queries, derived by Spark from the whole test tables.

The tables are clean, so some values are damaged on the way: that is what the operators are for.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeloom.functions.keys import rename_cdc_columns
from changeloom.plans.lake import Lake, LoadOptions
from changeloom.plans.specs import LoadPlan, SourceSpec
from changeloom.sinks.layout import write_partitioned
from changeloom.storage import Storage, scratch_folder
from changeloom.streaming.loads import StreamOptions

ORDERS_RAW = LoadPlan.from_dicts(
    {
        "source": "orders",
        "order": 1,
        "cdc_config": {"op_column": "Op", "timestamp_column": "dms_timestamp"},
        "target": {
            "catalog": {"database": "db_raw", "table": "tbl_orders"},
            "schema": {
                "order_id": {"type": "bigint", "nullable": False},
                "cust_id": {"type": "bigint", "nullable": False},
                "score": "int",
                "status": "string",
            },
            "primary_key": ["order_id"],
            "enum_columns": {"status": ["O", "F"]},
            "partition_keys": [{"name": "event_date", "type": "date"}],
        },
    }
).sources[0]

USER_CHANGES = LoadPlan.from_dicts(
    {
        "source": "users",
        "order": 2,
        "cdc_config": {"op_column": "Op", "timestamp_column": "dms_timestamp"},
        "target": {
            "catalog": {"database": "db_raw", "table": "tbl_users"},
            "schema": {
                "user_id": {"type": "bigint", "nullable": False},
                "event_type": "string",
                "event_id": "bigint",
            },
            "primary_key": ["user_id"],
            "partition_keys": [{"name": "event_date", "type": "date"}],
        },
    }
).sources[0]

USER_KEY = ["user_id"]
USER_ORDER = ["dms_timestamp", "event_id"]
USER_LOAD = LoadOptions(sequence_column="event_id")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` as text, with bad ids, missing customers and bad scores."""
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    return table(spark, sf_dir, "orders").select(
        F.when(key % 50 == 0, "bad").otherwise(key.cast("string")).alias("order_id"),
        F.when(cust % 40 != 0, cust.cast("string")).alias("cust_id"),
        F.when(key % 7 == 0, "x1").otherwise((key % 100).cast("string")).alias("score"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderdate").alias("dms_timestamp"),
    )


def user_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as a change feed on users: signup inserts, error deletes, the rest updates."""
    op = F.when(F.col("event_type") == "signup", "I").when(F.col("event_type") == "error", "D").otherwise("U")
    return table(spark, sf_dir, "events").select(
        "user_id", "event_type", "event_id", op.alias("Op"), F.col("ts").alias("dms_timestamp")
    )


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``customer`` as the user table before the changes; every second key, so some users are new."""
    return table(spark, sf_dir, "customer").select(
        (F.col("c_custkey") * 2).alias("user_id"),
        F.col("c_mktsegment").alias("event_type"),
        F.lit(None).cast("bigint").alias("event_id"),
    )


def users_with_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The user table with the change time it stores, not set yet."""
    return users(spark, sf_dir).withColumn("cdc_timestamp", F.lit(None).cast("timestamp_ntz"))


def renamed_user_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rename_cdc_columns(user_changes(spark, sf_dir), USER_CHANGES)


def scratch_lake(spark: SparkSession, label: str) -> Lake:
    return Lake(scratch_folder(spark, label))


def land_changes(changes: DataFrame, landing: str, time_column: str = "dms_timestamp") -> None:
    """Change files in nested date folders, as an upstream feed leaves them."""
    day = F.to_date(F.col(time_column))
    dated = changes.withColumns({"y": F.year(day), "m": F.month(day), "d": F.day(day)})
    write_partitioned(dated, landing, ["y", "m", "d"], mode="append")


def catch_up(spark: SparkSession, landing: str) -> StreamOptions:
    """Take all files there in about four micro-batches, none above 256 GB."""
    quarter = Storage(spark).bytes_under(landing) // 4
    return StreamOptions(available_now=True, max_files=None, max_bytes=max(1, min(quarter, 256 * 2**30)))


def located(source: SourceSpec, lake: Lake, landing: str) -> SourceSpec:
    """The spec with its change path and checkpoint filled in."""
    return replace(
        source,
        cdc_source_location=landing,
        checkpoint_location=f"{lake.root}/checkpoints/{source.source}",
    )
