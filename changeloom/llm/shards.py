"""Sharding by fixed virtual slots and a versioned slot-to-shard map.

A record's slot is a hash of its id and never changes. The map from slots to shards is a small table,
one row per slot and version; rebalancing writes a new version that moves as few slots as it can.
Everything is DataFrame code. The map has ``SLOTS`` rows whatever the data, so it is joined by
broadcast; records are numbered inside sub-buckets whose count follows the data, so no task sorts
a whole shard.

Defined results: a null text has size 1 and no checksum (null); a null id has the slot of the empty
text; repeated rows each get a place of their own; an empty table gives an empty table.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from changeloom.llm.common import documents, narrow, staged

SLOTS = 4096  # three hexadecimal digits of the hash
ROWS_PER_BUCKET = 50_000


def slot_of(doc_id: Column) -> Column:
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text), 1, 3), 16, 10).cast("int")


def slot_loads(records: DataFrame) -> DataFrame:
    """Bytes and rows of every slot, empty ones too; at most ``SLOTS`` rows."""
    found = records.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    slots = records.sparkSession.range(SLOTS).select(F.col("id").cast("int").alias("virtual_slot"))
    return slots.join(found, "virtual_slot", "left").na.fill(0, ["bytes", "rows"])


def first_map(spark: SparkSession, shards: int) -> DataFrame:
    """Version 0: slots dealt round."""
    slot = F.col("id").cast("int")
    return spark.range(SLOTS).select(
        F.lit(0).alias("version"), slot.alias("virtual_slot"), (slot % shards).alias("shard")
    )


def rebalance(slot_map: DataFrame, loads: DataFrame, shards: int) -> DataFrame:
    """The next version: every shard keeps its largest slots up to the mean load, the rest moves.

    Slots to be moved go, largest first, to the shard with the least bytes at that time. Slots of
    shards that no longer exist move too, and a new shard starts empty. The assignment is a fold
    over one array of at most ``SLOTS`` entries.
    """
    held = W.partitionBy("shard").orderBy(F.desc("bytes"), "virtual_slot")
    mean = F.sum("bytes").over(W.partitionBy(F.lit(0))) / shards
    judged = (
        slot_map.join(loads, "virtual_slot")
        .withColumn("filled", F.sum("bytes").over(held.rowsBetween(W.unboundedPreceding, 0)))
        .withColumn("stays", (F.col("filled") <= mean) & (F.col("shard") < shards))
    )
    kept = judged.where("stays")
    start = kept.groupBy().agg(F.collect_list(F.struct("shard", "bytes")).alias("kept"))
    moved = judged.where("NOT stays").groupBy().agg(
        F.array_sort(F.collect_list(F.struct((-F.col("bytes")).alias("less"), "virtual_slot"))).alias("moved")
    )
    begin = F.transform(
        F.sequence(F.lit(0), F.lit(shards - 1)),
        lambda s: F.aggregate(
            F.filter("kept", lambda k: k["shard"] == s), F.lit(0).cast("long"), lambda a, k: a + k["bytes"]
        ),
    )
    state = F.struct(begin.alias("filled"), F.expr("cast(array() as array<int>)").alias("to"))

    def place(acc: Column, slot: Column) -> Column:
        least = (F.array_position(acc["filled"], F.array_min(acc["filled"])) - 1).cast("int")
        filled = F.transform(acc["filled"], lambda v, i: F.when(i == least, v - slot["less"]).otherwise(v))
        return F.struct(filled.alias("filled"), F.concat(acc["to"], F.array(least)).alias("to"))

    dealt = start.crossJoin(moved).select(  # two tables of one row each
        F.explode(F.arrays_zip(F.col("moved.virtual_slot").alias("virtual_slot"), F.aggregate("moved", state, place)["to"].alias("shard"))).alias("m")
    )
    placed = dealt.select("m.virtual_slot", "m.shard").unionByName(kept.select("virtual_slot", "shard"))
    version = slot_map.agg(F.max("version") + 1).first()[0]
    return placed.select(F.lit(version).alias("version"), "virtual_slot", "shard")


def number(records: DataFrame, slot_map: DataFrame, rows: int) -> DataFrame:
    """Shard of each record and its place there, counted from 0 in slot order."""
    parts = max(1, math.ceil(rows / (SLOTS * ROWS_PER_BUCKET)))
    sub = F.pmod(F.xxhash64("doc_id"), F.lit(parts)).cast("int") if parts > 1 else F.lit(0)
    records = records.withColumn("sub", sub)
    mapped = slot_map.select("virtual_slot", "shard")
    ahead = W.partitionBy("shard").orderBy("virtual_slot", "sub").rowsBetween(W.unboundedPreceding, -1)
    starts = (
        records.groupBy("virtual_slot", "sub").agg(F.count("*").alias("n"))
        .join(F.broadcast(mapped), "virtual_slot")
        .withColumn("start", F.coalesce(F.sum("n").over(ahead), F.lit(0)))
        .drop("n")
    )
    inside = W.partitionBy("virtual_slot", "sub").orderBy("doc_id", "size", "text_crc32")
    return (
        records.withColumn("place", F.row_number().over(inside) - 1)
        .join(starts, ["virtual_slot", "sub"])
        .withColumn("slot", (F.col("start") + F.col("place")).cast("long"))
    )


def shard(docs: DataFrame, shards: int = 16) -> tuple[DataFrame, DataFrame]:
    """Numbered records, and both versions of the map they were placed by."""
    text = F.col("text")
    records = staged(
        narrow(docs).select(
            "doc_id",
            (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            slot_of(F.col("doc_id")).alias("virtual_slot"),
        ),
        "shard-records",
    )
    loads = staged(slot_loads(records), "slot-loads")
    old = first_map(docs.sparkSession, shards)
    new = rebalance(old, loads, shards)
    versions = staged(old.unionByName(new), "slot-map")
    rows = loads.agg(F.sum("rows")).first()[0]
    return number(records, versions.where("version = 1"), rows), versions


def op10_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed, _ = shard(documents(spark, sf_dir))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot",
    )
