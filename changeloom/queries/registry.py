"""The registered queries. Each takes a session and a data folder and returns a DataFrame."""

from __future__ import annotations

import zlib
from collections.abc import Callable
from dataclasses import replace
from datetime import date, datetime, timedelta, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from changeloom.functions.keys import (
    prepare_for_target,
    project_to_target,
    with_merge_key,
    with_partition_columns,
)
from changeloom.operators.audit import QUALITY_METRICS, RUN_LOG
from changeloom.operators.audit import run_throughput as throughput_of
from changeloom.operators.audit import validity_rate as validity_of
from changeloom.operators.changes import (
    EFFECT,
    IS_DELETED,
    apply_changes,
    classify_changes,
)
from changeloom.operators.changes import duplicate_keys as keys_that_repeat
from changeloom.operators.changes import latest_change as latest_per_key
from changeloom.operators.orphans import ORPHAN_OP, orphan_changes
from changeloom.operators.profile import column_profile as profile_columns
from changeloom.operators.profile import fk_orphans as orphans_of
from changeloom.operators.quality import (
    RULE,
    QualityOptions,
    cast_to_schema,
    combine_rejects,
    rule_counts,
    tag_rules,
    valid_rows,
    validate,
)
from changeloom.operators.sketches import COLUMN_SKETCHES, DISTINCT_ERROR, RANK_ERROR, merged_profile
from changeloom.plans.lake import LoadOptions
from changeloom.plans.loads import load_table, load_tables
from changeloom.plans.specs import LoadPlan, SourceSpec, TargetSpec
from changeloom.queries.inputs import (
    ORDERS_RAW,
    USER_CHANGES,
    USER_KEY,
    USER_LOAD,
    USER_ORDER,
    catch_up,
    land_changes,
    located,
    raw_orders,
    renamed_user_changes,
    scratch_lake,
    table,
    user_changes,
    users,
    users_with_time,
)
from changeloom.sinks.audit import merge_closed_runs, read_audit
from changeloom.sinks.compaction import compact_small as merge_small_files
from changeloom.sinks.keyed_table import KeyedTable
from changeloom.sinks.layout import compact_files, write_partitioned
from changeloom.sinks.partitioned_table import PartitionedTable
from changeloom.sinks.rejects import read_rejects, write_rejects
from changeloom.sources import catalog, files
from changeloom.storage import Storage, scratch_folder
from changeloom.streaming.loads import StreamFailed, StreamOptions, run_streams
from changeloom.streaming.progress import STREAM_PROGRESS, stream_latency

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

REJECTED_AT = datetime(2026, 6, 30, 10, 0, 0, tzinfo=timezone.utc)
USER_COLUMNS = ["user_id", "event_type", "event_id"]
RAW_NUMBERS = ["order_id", "cust_id", "score"]


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def shown(df: DataFrame, *columns: str) -> DataFrame:
    """Numbers that may be NULL as text, so a NULL reads the same in every client that checks."""
    return df.withColumns({name: F.col(name).cast("string") for name in columns})


# Scans and sources


@query
def scan_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.scan_batch(spark, SourceSpec(source="orders", source_location=f"{sf_dir}/orders.parquet"))


@query
def scan_glob(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_folder(spark, "scan_glob")
    orders = table(spark, sf_dir, "orders").withColumn("loaded", F.year("o_orderdate"))
    write_partitioned(orders, folder, ["loaded"])
    return files.scan_batch(spark, SourceSpec(source="orders", source_location=f"{folder}/loaded=*/"))


@query
def scan_recursive(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_folder(spark, "scan_recursive")
    orders = table(spark, sf_dir, "orders")
    dated = orders.withColumns({"y": F.year("o_orderdate"), "m": F.month("o_orderdate")})
    write_partitioned(dated, folder, ["y", "m"])
    spec = SourceSpec(source="orders", source_location=folder)
    return files.scan_batch(spark, spec, recursive=True)


@query
def catalog_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = f"changeloom_orders_{zlib.crc32(sf_dir.encode())}"
    if not catalog.table_exists(spark, name):
        catalog.register_files(spark, name, f"{sf_dir}/orders.parquet")
    orders = catalog.read_table(spark, name)
    return orders.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n_orders"))


@query
def sql_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.run_sql(
        spark,
        "SELECT o_orderstatus, count(*) AS n_orders, min(o_orderkey) AS first_order "
        "FROM {orders} GROUP BY o_orderstatus",
        tables={"orders": table(spark, sf_dir, "orders")},
    )


# Data quality


@query
def dq_type_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One column per declared type name, read from text."""
    key = F.col("o_orderkey")
    number, status = key.cast("string"), F.col("o_orderstatus")
    truth = F.when(status == "F", "false").when(status == "O", "true").otherwise("maybe")
    price = F.col("o_totalprice").cast("string")
    texts = {
        "c_string": number, "c_varchar": status, "c_char": status, "c_bigint": number,
        "c_integer": number, "c_int": number, "c_smallint": number, "c_double": price,
        "c_float": price, "c_decimal": price, "c_boolean": truth, "c_bool": truth,
        "c_timestamp": F.col("o_orderdate").cast("string"),
        "c_timestamptz": F.col("o_orderdate").cast("string"),
        "c_date": F.col("o_orderdate").cast("string"), "c_geometry": price,
    }
    declared = {name: name.removeprefix("c_") for name in texts} | {"c_decimal": "decimal(10,2)", "c_char": "CHAR(1)"}
    target = LoadPlan.from_dicts({"target": {"schema": {"o_orderkey": "bigint", **declared}}}).sources[0].target
    raw = table(spark, sf_dir, "orders").select("o_orderkey", *[e.alias(n) for n, e in texts.items()])
    shown = {n: F.col(n).cast("string") for n in ("c_decimal", "c_boolean", "c_bool", "c_date")}
    return cast_to_schema(raw, target).withColumns(shown)


@query
def dq_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cast rows, with the types the casts gave."""
    cast = cast_to_schema(raw_orders(spark, sf_dir), ORDERS_RAW.target)
    types = F.concat_ws(" ", *[F.typeof(name) for name in ORDERS_RAW.target.schema])
    return shown(cast.withColumn("types", types), *RAW_NUMBERS)


def _tagged(spark: SparkSession, sf_dir: str, options: QualityOptions = QualityOptions()) -> DataFrame:
    return tag_rules(raw_orders(spark, sf_dir), ORDERS_RAW.target, ORDERS_RAW, options)


def _broken(spark: SparkSession, sf_dir: str, rule: str) -> DataFrame:
    return shown(_tagged(spark, sf_dir).where(F.col(RULE) == rule).drop(RULE), *RAW_NUMBERS)


@query
def dq_cast_reject(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _broken(spark, sf_dir, "type_cast")


@query
def dq_null_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _broken(spark, sf_dir, "null_check")


@query
def dq_enum_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _broken(spark, sf_dir, "enum_check")


@query
def dq_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    tagged = shown(_tagged(spark, sf_dir), *RAW_NUMBERS)
    return tagged.withColumnRenamed(RULE, "rule").withColumn("rule", F.coalesce("rule", F.lit("valid")))


@query
def dq_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = rule_counts(_tagged(spark, sf_dir))
    return counts.select(F.coalesce(RULE, F.lit("valid")).alias("rule"), "n_rows")


@query
def dq_strict_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Strict rules: bad scores are type errors, bad order times are time errors."""
    ordered = F.col("dms_timestamp").cast("string")
    raw = raw_orders(spark, sf_dir).withColumn(
        "ordered_at", F.when(F.col("status") == "O", F.concat(ordered, F.lit(" o'clock"))).otherwise(ordered)
    )
    schema = {**ORDERS_RAW.to_dict()["target"]["schema"], "ordered_at": "timestamp"}
    target = TargetSpec.parse({**ORDERS_RAW.target.to_dict(), "schema": schema})
    tagged = tag_rules(raw, target, ORDERS_RAW, QualityOptions(casts="strict"))
    return shown(tagged, *RAW_NUMBERS).select(
        *RAW_NUMBERS, "status", F.coalesce(RULE, F.lit("valid")).alias("rule")
    )


@query
def dq_key_only_deletes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deletes that carry nothing but their key, with and without rules on deletes."""
    bare = user_changes(spark, sf_dir).withColumn("event_type", F.when(F.col("Op") != "D", F.col("event_type")))
    spec = USER_CHANGES.to_dict()
    spec["target"]["schema"]["event_type"] = {"type": "string", "nullable": False}
    source = SourceSpec.parse(spec)
    checked = tag_rules(bare, source.target, source)
    spared = tag_rules(bare, source.target, source, QualityOptions(validate_deletes=False))
    counted = [
        rule_counts(frame).select(
            F.lit(label).alias("mode"), F.coalesce(RULE, F.lit("valid")).alias("rule"), "n_rows"
        )
        for label, frame in (("checked", checked), ("spared", spared))
    ]
    return counted[0].unionByName(counted[1])


def _order_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_orders(spark, sf_dir)
    return validate(raw, ORDERS_RAW.target, ORDERS_RAW, rejected_at=REJECTED_AT)[1]


@query
def dq_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(_order_rejects(spark, sf_dir), *RAW_NUMBERS)


def _event_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = USER_CHANGES.to_dict()
    spec["target"]["enum_columns"] = {"event_type": ["signup", "click", "view", "error"]}
    source = SourceSpec.parse(spec)
    changes = user_changes(spark, sf_dir)
    return validate(changes, source.target, source, rejected_at=REJECTED_AT)[1]


@query
def reject_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = combine_rejects([_order_rejects(spark, sf_dir), _event_rejects(spark, sf_dir)])
    return shown(both, *RAW_NUMBERS, "user_id", "event_id").select(
        "_reject_table", "_reject_rule", "order_id", "cust_id", "score", "status", "user_id", "event_id"
    )


@query
def reject_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejects of two batches on disk, the first written twice as after a replay."""
    folder = scratch_folder(spark, "reject_sink")
    write_rejects(_order_rejects(spark, sf_dir), folder, "first")
    write_rejects(_order_rejects(spark, sf_dir), folder, "first")
    write_rejects(_event_rejects(spark, sf_dir), folder, "second")
    stored = read_rejects(spark, folder)
    return stored.groupBy("batch_id", "_reject_table", "_reject_rule").agg(F.count(F.lit(1)).alias("n_rows"))


# Keys, partitions, CDC names


@query
def merge_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = TargetSpec(primary_key=("l_orderkey", "l_linenumber"))
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    return with_merge_key(lines, target)


@query
def partition_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = LoadPlan.from_dicts(
        {"target": {"partition_keys": [{"name": "event_date", "source_column": "o_orderdate"}]}}
    ).sources[0].target
    dated = with_partition_columns(table(spark, sf_dir, "orders"), target)
    counted = dated.groupBy("event_date").agg(F.count(F.lit(1)).alias("n_rows"))
    return shown(counted, "event_date")


@query
def partition_date_cdc(spark: SparkSession, sf_dir: str) -> DataFrame:
    dated = with_partition_columns(user_changes(spark, sf_dir), USER_CHANGES.target, USER_CHANGES)
    counted = dated.groupBy("event_date").agg(F.count(F.lit(1)).alias("n_rows"))
    return shown(counted, "event_date")


@query
def partition_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partition folders on disk, read back: rows and lowest key per folder."""
    folder = scratch_folder(spark, "partition_layout")
    prepared = prepare_for_target(user_changes(spark, sf_dir), USER_CHANGES.target, USER_CHANGES)
    write_partitioned(prepared, folder, ["event_date"], sort_by=["user_id"])
    counted = spark.read.parquet(folder).groupBy("event_date").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("event_id").alias("first_event")
    )
    return shown(counted, "event_date")


@query
def cdc_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    return renamed_user_changes(spark, sf_dir)


@query
def cdc_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project_to_target(renamed_user_changes(spark, sf_dir), ["user_id", "event_type"])


# Applying changes


@query
def latest_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_per_key(user_changes(spark, sf_dir), USER_KEY, USER_ORDER)


@query
def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return keys_that_repeat(lines, ["l_orderkey", "l_linenumber"])


@query
def merge_bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First load: the changes applied to an empty table."""
    empty = users(spark, sf_dir).where(F.lit(False))
    return apply_changes(empty, user_changes(spark, sf_dir), USER_KEY, "Op", USER_ORDER)


def _applied(spark: SparkSession, sf_dir: str, was_there: bool, deleted: bool) -> DataFrame:
    """What an apply made of the user table: rows by whether the key was there and is deleted now."""
    before = users(spark, sf_dir)
    after = apply_changes(before, user_changes(spark, sf_dir), USER_KEY, "Op", USER_ORDER, "soft")
    # the table as it was has no event in any row
    changed = after.where(F.col("event_id").isNotNull() & (F.col(IS_DELETED) == F.lit(deleted)))
    held = before.select(*USER_KEY)
    return changed.join(held, USER_KEY, "left_semi" if was_there else "left_anti").select(*USER_COLUMNS)


@query
def merge_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _applied(spark, sf_dir, was_there=False, deleted=False)


@query
def merge_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _applied(spark, sf_dir, was_there=True, deleted=False)


@query
def merge_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _applied(spark, sf_dir, was_there=True, deleted=True)


@query
def merge_effects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many changes insert, update, delete or do nothing."""
    effects = classify_changes(
        users(spark, sf_dir), user_changes(spark, sf_dir), USER_KEY, "Op", USER_ORDER
    )
    return effects.groupBy(F.col(EFFECT).alias("effect")).agg(F.count(F.lit(1)).alias("n_changes"))


def _merged(spark: SparkSession, sf_dir: str, **choices: str) -> DataFrame:
    merged = apply_changes(
        users(spark, sf_dir), user_changes(spark, sf_dir), USER_KEY, "Op", USER_ORDER, **choices
    )
    return shown(merged, "event_id")


@query
def merge_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merged(spark, sf_dir)


@query
def merge_apply_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same result from the plan for small change sets."""
    return _merged(spark, sf_dir, strategy="join")


@query
def merge_apply_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same result from the plan for change sets too big to broadcast."""
    return _merged(spark, sf_dir, strategy="shuffle")


@query
def merge_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes timed by the day and without a sequence: one result for every plan, split and order."""
    changes = renamed_user_changes(spark, sf_dir).withColumn("cdc_timestamp", F.to_date("cdc_timestamp"))
    base = users(spark, sf_dir).withColumn("cdc_timestamp", F.lit(None).cast("date"))
    part = F.col("event_id") % 3
    thirds = [changes.where(part == i) for i in range(3)]
    shown_by = []
    for way, strategy, parts in (
        ("join", "join", [changes]),
        ("shuffle", "shuffle", [changes]),
        ("three batches", "shuffle", thirds),
        ("reversed", "join", thirds[::-1]),
    ):
        rows = base
        for batch in parts:
            rows = apply_changes(rows, batch, USER_KEY, "cdc_operation", ["cdc_timestamp"], "soft", strategy=strategy)
        kept = shown(rows.where(~F.col(IS_DELETED)), "event_id").select(*USER_COLUMNS)
        shown_by.append(kept.withColumn("way", F.lit(way)))
    return reduce(DataFrame.unionByName, shown_by)


@query
def load_soft_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The spec asks for soft deletes: the table, read by name, shows deleted keys as such."""
    lake = scratch_lake(spark, "load_soft_delete")
    source = replace(USER_CHANGES, cdc=replace(USER_CHANGES.cdc, delete_strategy="soft_delete"))
    load_table(spark, source, lake, dataframe=user_changes(spark, sf_dir), options=USER_LOAD)
    lake.table(spark, source.target).register("loaded_users")
    loaded = shown(spark.table("loaded_users"), "event_id")
    return loaded.select(*USER_COLUMNS, F.col(IS_DELETED).cast("int").alias(IS_DELETED))


@query
def merge_upsert_no_op(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = user_changes(spark, sf_dir).drop("Op")
    return shown(apply_changes(users(spark, sf_dir), changes, USER_KEY, None, USER_ORDER), "event_id")


@query
def merge_soft_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = _merged(spark, sf_dir, deletes="soft")
    return merged.withColumn(IS_DELETED, F.col(IS_DELETED).cast("int"))


def _user_table(spark: SparkSession, sf_dir: str, label: str) -> tuple[KeyedTable, Callable]:
    """The stored user table, and a function that applies one batch of changes to it."""
    stored = KeyedTable(spark, scratch_folder(spark, label))

    def apply(changes: DataFrame, batch_key: str) -> None:
        stored.apply(
            changes, batch_key, keys=USER_KEY, op="cdc_operation",
            order_by=["cdc_timestamp", "event_id"],
        )

    apply(users_with_time(spark, sf_dir), "start")
    return stored, apply


@query
def merge_sink_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored, apply = _user_table(spark, sf_dir, "merge_sink_roundtrip")
    apply(renamed_user_changes(spark, sf_dir), "changes")
    stored.compact()
    return shown(stored.read().select(*USER_COLUMNS), "event_id")


@query
def rebucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders stored in two buckets, changed, and dealt anew into sixteen: the rows stay the same."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    stored = KeyedTable(spark, scratch_folder(spark, "rebucket"))
    stored.apply(orders, "all", keys=["o_orderkey"], buckets=2)
    stored.apply(orders.withColumn("o_orderstatus", F.lower("o_orderstatus")), "lower", keys=["o_orderkey"])
    stored.rebucket(16)
    return stored.read()


@query
def dq_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validation of what is left of orders without orders, beside that of all orders."""
    every = raw_orders(spark, sf_dir)
    again = raw_orders(spark, sf_dir).select(F.col("dms_timestamp").alias("t"), F.col("status").alias("s"))
    nothing = every.join(again, (F.col("dms_timestamp") == F.col("t")) & (F.col("status") == F.col("s")), "left_anti")
    counted = []
    for label, rows in (("all", every), ("none", nothing)):
        halves = zip(("valid", "rejects"), validate(rows, ORDERS_RAW.target, ORDERS_RAW, rejected_at=REJECTED_AT))
        counted += [
            part.agg(F.count(F.lit(1)).alias("n_rows")).select(
                F.lit(label).alias("input"), F.lit(half).alias("half"), "n_rows", F.lit(len(part.columns)).alias("n_columns")
            )
            for half, part in halves
        ]
    return reduce(DataFrame.unionByName, counted)


@query
def table_probe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether a keyed table is there: before its first load, after it, and how many rows it then has."""
    stored = KeyedTable(spark, scratch_folder(spark, "table_probe"))
    before = stored.exists()
    stored.apply(users_with_time(spark, sf_dir), "start", keys=USER_KEY)
    return stored.read().agg(
        F.lit(int(before)).alias("before"), F.lit(int(stored.exists())).alias("after"), F.count(F.lit(1)).alias("n_rows")
    )


@query
def late_change_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest changes first, older ones later, one batch twice: the state stays the same."""
    stored, apply = _user_table(spark, sf_dir, "late_change_guard")
    changes = renamed_user_changes(spark, sf_dir)
    day = F.day("cdc_timestamp")
    apply(changes.where(day > 20), "late")
    apply(changes.where((day > 10) & (day <= 20)), "middle")
    stored.compact()
    apply(changes.where(day <= 10), "early")
    apply(changes.where((day > 10) & (day <= 20)), "middle")
    return shown(stored.read().select(*USER_COLUMNS), "event_id")


# Streaming


def _streamed_users(spark: SparkSession, sf_dir: str, label: str):
    """The user table with all changes streamed in from date folders."""
    lake = scratch_lake(spark, label)
    landing = f"{lake.root}/landing/users_cdc"
    land_changes(user_changes(spark, sf_dir), landing)
    source = located(USER_CHANGES, lake, landing)
    load_table(spark, source, lake, dataframe=_users_before(spark, sf_dir), options=USER_LOAD)
    run_streams(spark, [source], lake, options=USER_LOAD, stream=catch_up(spark, landing))
    return lake, source


def _users_before(spark: SparkSession, sf_dir: str) -> DataFrame:
    return users(spark, sf_dir).withColumn("dms_timestamp", F.lit(None).cast("timestamp_ntz"))


@query
def stream_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = scratch_lake(spark, "stream_scan")
    landing = f"{lake.root}/landing/events"
    events = table(spark, sf_dir, "events")
    land_changes(events, landing, "ts")
    source = located(USER_CHANGES, lake, landing)
    size = catch_up(spark, landing).max_bytes
    stream = files.scan_stream(spark, source, schema=events.schema, max_bytes=size)
    out = f"{lake.root}/out"
    started = (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", source.checkpoint_location)
        .trigger(availableNow=True)
        .start(out)
    )
    started.awaitTermination()
    return spark.read.schema(events.schema).parquet(out)


@query
def stream_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake, source = _streamed_users(spark, sf_dir, "stream_apply")
    return shown(lake.table(spark, source.target).read().select(*USER_COLUMNS), "event_id")


@query
def stream_batch_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run-log totals of all micro-batches."""
    lake, _ = _streamed_users(spark, sf_dir, "stream_batch_counts")
    log = read_audit(spark, lake.run_log_path, RUN_LOG)
    batches = log.where(F.col("execution_id").startswith("users-"))
    return batches.groupBy("source", "status").agg(
        F.sum("records_read").alias("records_read"),
        F.sum("records_written").alias("records_written"),
        F.sum("records_rejected").alias("records_rejected"),
    )


@query
def stream_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the changes, a stop, the other half from the same checkpoint; rows read once each."""
    lake = scratch_lake(spark, "stream_restart")
    landing = f"{lake.root}/landing/users_cdc"
    source = located(USER_CHANGES, lake, landing)
    changes = user_changes(spark, sf_dir)
    load_table(spark, source, lake, dataframe=_users_before(spark, sf_dir), options=USER_LOAD)
    later = F.day("dms_timestamp") > 15
    for half in (changes.where(~later), changes.where(later)):
        land_changes(half, landing)
        run_streams(spark, [source], lake, options=USER_LOAD, stream=catch_up(spark, landing))
    log = read_audit(spark, lake.run_log_path, RUN_LOG)
    streamed = log.where(F.col("execution_id").startswith("users-"))
    rows_read = streamed.agg(F.sum("records_read").alias("records_read"))
    state = lake.table(spark, source.target).read().agg(
        F.count(F.lit(1)).alias("n_users"), F.sum("event_id").alias("event_id_sum")
    )
    return _side_by_side(state, rows_read)


def _side_by_side(left: DataFrame, right: DataFrame) -> DataFrame:
    """Columns of two one-row frames in one row."""
    one = F.lit(1).alias("_one")
    return left.select("*", one).join(right.select("*", one), "_one").drop("_one")


@query
def stream_multi_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tables streamed side by side: rows each ends up with."""
    lake = scratch_lake(spark, "stream_multi_table")
    feeds = [(ORDERS_RAW, raw_orders(spark, sf_dir)), (USER_CHANGES, user_changes(spark, sf_dir))]
    sources = []
    for spec, changes in feeds:
        landing = f"{lake.root}/landing/{spec.source}_cdc"
        if spec is ORDERS_RAW:
            dated = changes.withColumn("y", F.year("dms_timestamp"))
            write_partitioned(dated, landing, ["y"])
        else:
            land_changes(changes, landing)
        sources.append(located(spec, lake, landing))
    run_streams(spark, sources, lake, options=USER_LOAD, stream=catch_up(spark, f"{lake.root}/landing"))
    return _rows_per_table(spark, lake, sources)


def _rows_per_table(spark: SparkSession, lake, sources) -> DataFrame:
    counted = [
        lake.table(spark, source.target).read().agg(
            F.lit(source.target.table).alias("table_name"), F.count(F.lit(1)).alias("n_rows")
        )
        for source in sources
    ]
    return combine_rejects(counted)


# Loads and audit


@query
def batch_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One table end to end from a frame that was read already."""
    lake = scratch_lake(spark, "batch_load")
    load_table(spark, ORDERS_RAW, lake, dataframe=raw_orders(spark, sf_dir))
    loaded = lake.table(spark, ORDERS_RAW.target).read()
    return shown(loaded, "score", "event_date")


@query
def load_by_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A full load into a table kept by the format its spec names, read by its name."""
    lake, named = scratch_lake(spark, "load_by_format"), {"database": "db_raw", "table": "tbl_orders_by_format"}
    source = SourceSpec.parse(ORDERS_RAW.to_dict() | {"target": ORDERS_RAW.target.to_dict() | {"format": "orc", "catalog": named}})
    spark.sql("DROP TABLE IF EXISTS db_raw.tbl_orders_by_format")  # of an earlier run, in another lake
    load_table(spark, source, lake, dataframe=raw_orders(spark, sf_dir), options=LoadOptions(layout="format"))
    return shown(catalog.read_table(spark, "db_raw.tbl_orders_by_format"), "score", "event_date")


@query
def multi_table_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All tables of a plan in order, from their full-load paths."""
    lake = scratch_lake(spark, "multi_table_load")
    sources = []
    for spec, rows in ((ORDERS_RAW, raw_orders(spark, sf_dir)), (USER_CHANGES, user_changes(spark, sf_dir))):
        path = f"{lake.root}/landing/{spec.source}"
        write_partitioned(rows, path)
        sources.append(SourceSpec.parse({**spec.to_dict(), "source_location": path}))
    load_tables(spark, sources, lake)
    return _rows_per_table(spark, lake, sources)


def _logged_orders(spark: SparkSession, sf_dir: str, label: str):
    lake = scratch_lake(spark, label)
    load_table(spark, ORDERS_RAW, lake, dataframe=raw_orders(spark, sf_dir))
    return lake


@query
def load_then_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load leaves its target and both audit tables in the catalog, under the names of the spec."""
    lake = scratch_lake(spark, "load_then_catalog")
    load_table(spark, ORDERS_RAW, lake, dataframe=raw_orders(spark, sf_dir))
    sums = {
        "db_raw.tbl_orders": F.sum("order_id"),
        lake.run_log_name: F.sum("records_read"),
        lake.metrics_name: F.sum(F.when(F.col("metric") == "rows_written", F.col("failure_reason").cast("long"))),
    }
    found = [
        catalog.read_table(spark, name).agg(
            F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n_rows"), total.alias("total")
        )
        for name, total in sums.items()
    ]
    return reduce(DataFrame.unionByName, found)


@query
def target_partition_move(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in folders by month; every tenth moves two months on, every thirtieth is deleted."""
    month = F.trunc("o_orderdate", "MM")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", month.alias("event_month"), F.lit(1).alias("version"))
    stored = PartitionedTable(spark, scratch_folder(spark, "target_partition_move"), ["event_month"])
    stored.apply(orders, "all", keys=["o_orderkey"], order_by=["version"])
    key = F.col("o_orderkey")
    changes = orders.where(key % 10 == 0).withColumns(
        {"event_month": F.add_months("event_month", 2), "version": F.lit(2), "op": F.when(key % 30 == 0, "D").otherwise("U")}
    )
    stored.apply(changes, "moved", keys=["o_orderkey"], op="op", order_by=["version"])
    return shown(stored.read(), "event_month")


@query
def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = read_audit(spark, _logged_orders(spark, sf_dir, "run_log").run_log_path, RUN_LOG)
    return log.select(
        "job_name", "source", "status", "records_read", "records_written", "records_rejected",
        "target_partition", "error_message",
    )


@query
def quality_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = _logged_orders(spark, sf_dir, "quality_metrics")
    metrics = read_audit(spark, lake.metrics_path, QUALITY_METRICS)
    return metrics.drop("processing_timestamp", "reference_date")


@query
def validity_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = read_audit(spark, _logged_orders(spark, sf_dir, "validity_rate").run_log_path, RUN_LOG)
    rates = validity_of(log)
    return rates.withColumn("meets_target", F.col("meets_target").cast("int"))


@query
def run_throughput(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = read_audit(spark, _logged_orders(spark, sf_dir, "run_throughput").run_log_path, RUN_LOG)
    rates = throughput_of(log)
    return rates.select(
        "source", "runs", "records_read",
        (F.col("longest_run_seconds") >= 0).cast("int").alias("has_longest_run"),
        (F.col("records_per_minute") > 0).cast("int").alias("has_rate"),
    )


@query
def fk_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers named by orders that the customer table lacks, after the keys were spread out."""
    orders = table(spark, sf_dir, "orders").select((F.col("o_custkey") * 2).alias("cust_id"))
    return orphans_of(orders, "cust_id", table(spark, sf_dir, "customer"), "c_custkey")


@query
def fk_orphans_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table of orphans after a first load and three batches that change orders, customers or both."""
    key, cust, parent = F.col("o_orderkey"), F.col("o_custkey"), F.col("c_custkey")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customers = table(spark, sf_dir, "customer").select("c_custkey")
    even, all_orders = orders.where(key % 2 == 0), orders
    last = orders.where(key % 10 != 5).withColumn("o_custkey", F.when(key % 10 == 0, cust + 1).otherwise(cust))
    first_parents = customers.where(parent % 3 != 0)
    later = (parent % 3 == 2) | (parent % 6 == 0)
    second_parents, last_parents = customers.where(later), customers.where(later | (parent % 9 == 1))
    nobody = customers.where(F.lit(False))
    steps = [  # children and parents after the batch, children it changed, parents that went and came
        (even, first_parents, even, nobody, first_parents),
        (all_orders, first_parents, orders.where(key % 2 == 1), nobody, nobody),
        (all_orders, second_parents, orders.where(F.lit(False)),
         customers.where(parent % 3 == 1), customers.where(parent % 6 == 0)),
        (last, last_parents, orders.where(key % 5 == 0), nobody, customers.where(parent % 9 == 1)),
    ]
    stored = KeyedTable(spark, scratch_folder(spark, "fk_orphans_incremental"))
    for n, (children, parents, changed, gone, come) in enumerate(steps):
        held = stored.read() if stored.exists() else orders.where(F.lit(False))
        found = orphan_changes(
            held, children, changed, parents, gone, come,
            child_keys=["o_orderkey"], reference="o_custkey", parent_key="c_custkey",
        )
        stored.apply(found, f"batch-{n}", keys=["o_orderkey"], op=ORPHAN_OP)
    return stored.read().select("o_orderkey", "o_custkey")


@query
def column_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    profile = profile_columns(raw_orders(spark, sf_dir), ORDERS_RAW.target)
    return profile.withColumn("required", F.col("required").cast("int"))


@query
def compact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many small files rewritten as few; the rows stay the same."""
    small, even = scratch_folder(spark, "compact-small"), scratch_folder(spark, "compact-even")
    pieces = 2 * spark.sparkContext.defaultParallelism
    table(spark, sf_dir, "orders").repartition(pieces).write.parquet(small)
    compact_files(spark, small, even)
    return spark.read.parquet(even)


@query
def compact_small(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by year, half of them in one file a year and half in eight: only the eight are merged."""
    folder = scratch_folder(spark, "compact_small")
    orders = table(spark, sf_dir, "orders").withColumn("year", F.year("o_orderdate"))
    half = F.col("o_orderkey") % 2 == 0
    orders.where(half).repartition(8, "year").write.partitionBy("year").parquet(folder)
    spread = orders.where(~half).withColumn("part", F.pmod("o_orderkey", F.lit(8)))
    spread.repartition(64, "year", "part").drop("part").write.mode("append").partitionBy("year").parquet(folder)
    files_before = spark.read.parquet(folder).select("_metadata.file_path", "_metadata.file_size").distinct()
    largest = files_before.agg(F.max("file_size")).first()[0]
    merge_small_files(spark, folder, target_bytes=2 * largest, small_share=0.4)
    return spark.read.parquet(folder).drop("year")


# Reports that grow with the runs


@query
def profile_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders loaded in three parts, profiled from the sketches of the three, held against exact figures."""
    lake = scratch_lake(spark, "profile_merged")
    raw = raw_orders(spark, sf_dir)
    third = F.pmod(F.day("dms_timestamp"), F.lit(3))
    for part in range(3):
        load_table(spark, ORDERS_RAW, lake, dataframe=raw.where(third == part), options=LoadOptions(sketch_columns=True))
    profile = merged_profile(read_audit(spark, lake.sketches_path, COLUMN_SKETCHES), quantiles=[0.5])

    valid = valid_rows(tag_rules(raw, ORDERS_RAW.target, ORDERS_RAW))
    # try_cast: a status has no number, and so no median
    values = [
        valid.select(
            F.lit(name).alias("column_name"), F.col(name).try_cast("double").alias("v"), F.col(name).cast("string").alias("t")
        )
        for name in ORDERS_RAW.target.schema
    ]
    median = F.col("quantiles")[0]
    exact = reduce(DataFrame.unionByName, values).join(profile.select("column_name", "quantiles"), "column_name")
    exact = exact.groupBy("column_name").agg(
        F.countDistinct("t").alias("exact"),
        F.avg((F.col("v") < median).cast("int")).alias("below"),
        F.avg((F.col("v") <= median).cast("int")).alias("upto"),
    )
    close = F.abs(F.col("n_distinct") - F.col("exact")) <= DISTINCT_ERROR * F.col("exact")
    ranked = (F.col("below") <= 0.5 + RANK_ERROR) & (F.col("upto") >= 0.5 - RANK_ERROR)
    return profile.join(exact, "column_name").select(
        "column_name", "n_rows", "n_null",
        F.col("low").cast("bigint").cast("string").alias("low"),
        F.col("high").cast("bigint").cast("string").alias("high"),
        "low_text", "high_text",
        close.cast("int").alias("distinct_ok"),
        F.when(median.isNull(), 1).otherwise(ranked.cast("int")).alias("median_ok"),
    )


@query
def effect_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys that the changes inserted, updated and deleted, as the audit keeps them."""
    lake = scratch_lake(spark, "effect_metrics")
    load_table(spark, USER_CHANGES, lake, dataframe=_users_before(spark, sf_dir), options=USER_LOAD)
    counted = replace(USER_LOAD, count_effects=True)
    load_table(spark, USER_CHANGES, lake, dataframe=user_changes(spark, sf_dir), options=counted)
    metrics = read_audit(spark, lake.metrics_path, QUALITY_METRICS).where(F.col("metric").startswith("keys_"))
    return metrics.select("metric", F.col("failure_reason").cast("bigint").alias("n_keys"))


@query
def audit_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The run log of three loads, merged into one folder: the same rows, by path and by name."""
    lake = scratch_lake(spark, "audit_merge")
    raw = raw_orders(spark, sf_dir)
    third = F.pmod(F.day("dms_timestamp"), F.lit(3))
    for part in range(3):
        load_table(spark, ORDERS_RAW, lake, dataframe=raw.where(third == part))
    merged = merge_closed_runs(spark, lake.run_log_path, RUN_LOG, date.today() + timedelta(days=2), lake.run_log_name)
    folders = [n for n in Storage(spark).names(lake.run_log_path) if "=" in n]
    found = [("path", read_audit(spark, lake.run_log_path, RUN_LOG)), ("name", catalog.read_table(spark, lake.run_log_name))]
    counted = [
        log.agg(
            F.lit(way).alias("way"), F.lit(merged).alias("merged"), F.lit(len(folders)).alias("folders"),
            F.count(F.lit(1)).alias("n_runs"), F.sum("records_read").alias("records_read"),
        )
        for way, log in found
    ]
    return reduce(DataFrame.unionByName, counted)


@query
def tombstone_purge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deleted keys after two folds, the second with a retention of ten days, and changes above the mark again."""
    stored, apply = _user_table(spark, sf_dir, "tombstone_purge")
    changes = renamed_user_changes(spark, sf_dir)
    early = F.day("cdc_timestamp") <= 15
    apply(changes.where(early), "early")
    stored.compact()
    apply(changes.where(~early), "late")
    mark = stored.low_water_mark("10 days")
    stored.compact("10 days")
    apply(changes.where(F.col("cdc_timestamp") >= F.lit(mark).cast("timestamp_ntz")), "again")
    state = stored.read("soft").withColumn(IS_DELETED, F.col(IS_DELETED).cast("int"))
    return shown(state.select(*USER_COLUMNS, IS_DELETED), "event_id")


@query
def stream_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Progress rows of a stream that takes one file a micro-batch."""
    lake = scratch_lake(spark, "stream_progress")
    landing = f"{lake.root}/landing/orders_cdc"
    write_partitioned(raw_orders(spark, sf_dir).withColumn("y", F.year("dms_timestamp")), landing, ["y"])
    landed = spark.read.parquet(landing).select("_metadata.file_path").distinct().count()
    options = StreamOptions(available_now=True, max_files=1, progress=True)
    run_streams(spark, [located(ORDERS_RAW, lake, landing)], lake, stream=options)
    latency = stream_latency(read_audit(spark, lake.progress_path, STREAM_PROGRESS))
    return latency.select(
        "stream", "input_rows", (F.col("batches") == landed).cast("int").alias("one_file_each"),
        F.col("meets_target").cast("int").alias("meets_target"),
    )


@query
def stream_fair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A backlog of user changes and a small feed of new orders side by side: who begins its last batch first."""
    lake = scratch_lake(spark, "stream_fair")
    sources, options = [], {}
    feeds = [(USER_CHANGES, user_changes(spark, sf_dir)), (ORDERS_RAW, raw_orders(spark, sf_dir).where(F.col("status") == "P"))]
    for spec, changes in feeds:
        landing = f"{lake.root}/landing/{spec.source}_cdc"
        land_changes(changes, landing)
        sources.append(located(spec, lake, landing))
        options[spec.source] = catch_up(spark, landing)
    options["orders"] = replace(options["orders"], max_bytes=256 * 2**30)
    run_streams(
        spark, sources, lake, options=USER_LOAD, stream=StreamOptions(available_now=True, progress=True), per_source=options
    )
    seen = read_audit(spark, lake.progress_path, STREAM_PROGRESS).groupBy("stream")
    ends = seen.agg(F.sum("input_rows").alias("input_rows"), F.max("batch_start").alias("last_start"))
    place = F.rank().over(Window.orderBy("last_start"))  # one row a stream
    return ends.select("stream", "input_rows", place.cast("bigint").alias("place"))


@query
def stream_redelivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every change file landed twice, under another name: the same table, every row counted once."""
    lake = scratch_lake(spark, "stream_redelivery")
    landing = f"{lake.root}/landing/users_cdc"
    for folder in (f"{landing}/first", f"{landing}/second"):
        land_changes(user_changes(spark, sf_dir), folder)
    source = located(USER_CHANGES, lake, landing)
    load_table(spark, source, lake, dataframe=_users_before(spark, sf_dir), options=USER_LOAD)
    once = replace(catch_up(spark, landing), redelivery="1 day")
    run_streams(spark, [source], lake, options=USER_LOAD, stream=once)
    log = read_audit(spark, lake.run_log_path, RUN_LOG)
    rows_read = log.where(F.col("execution_id").startswith("users-")).agg(F.sum("records_read").alias("records_read"))
    state = lake.table(spark, source.target).read().agg(
        F.count(F.lit(1)).alias("n_users"), F.sum("event_id").alias("event_id_sum")
    )
    return _side_by_side(state, rows_read)


@query
def stream_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events streamed with processed files moved to the archive: landing and archive still hold each row once."""
    lake = scratch_lake(spark, "stream_archive")
    landing = f"{lake.root}/landing/events"
    events = table(spark, sf_dir, "events")
    land_changes(events, landing, "ts")
    source = located(USER_CHANGES, lake, landing)
    size = catch_up(spark, landing).max_bytes
    stream = files.scan_stream(spark, source, schema=events.schema, max_bytes=size)
    writer = stream.writeStream.format("noop").option("checkpointLocation", source.checkpoint_location)
    writer.trigger(availableNow=True).start().awaitTermination()
    everywhere = spark.read.schema(events.schema).option("recursiveFileLookup", "true")
    archived = F.col("_metadata.file_path").contains("/events_archive/")
    return everywhere.parquet(f"{lake.root}/landing").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("event_id").alias("event_id_sum"),
        F.max(archived.cast("int")).alias("some_archived"),
    )


@query
def scan_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One source read by its mode: the full load as a batch, the changes as a stream."""
    lake = scratch_lake(spark, "scan_mode")
    landing = f"{lake.root}/landing/events"
    write_partitioned(table(spark, sf_dir, "events"), landing)
    spec = replace(located(USER_CHANGES, lake, landing), source_location=f"{sf_dir}/orders.parquet")
    batch, stream = files.read_source(spark, spec, "batch"), files.read_source(spark, spec)
    out = f"{lake.root}/out"
    writer = stream.writeStream.format("parquet").option("checkpointLocation", spec.checkpoint_location)
    writer.trigger(availableNow=True).start(out).awaitTermination()
    read = [("batch", batch), ("streaming", spark.read.schema(stream.schema).parquet(out))]
    flags = {"batch": batch.isStreaming, "streaming": stream.isStreaming}
    counted = [
        rows.agg(F.lit(mode).alias("mode"), F.lit(int(flags[mode])).alias("is_stream"), F.count(F.lit(1)).alias("n_rows"))
        for mode, rows in read
    ]
    return reduce(DataFrame.unionByName, counted)


@query
def dq_no_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejects of orders that break no rule: none, in the shape of those of orders that do."""
    damaged = raw_orders(spark, sf_dir)
    key = F.col("o_orderkey").cast("string")
    clean = table(spark, sf_dir, "orders").select(
        key.alias("order_id"), key.alias("cust_id"), F.lit("1").alias("score"),
        F.lit("O").alias("status"), F.col("o_orderdate").alias("dms_timestamp"),
    )
    found = {
        name: validate(rows, ORDERS_RAW.target, ORDERS_RAW, rejected_at=REJECTED_AT)
        for name, rows in (("clean", clean), ("damaged", damaged))
    }
    shapes = {name: [(f.name, f.dataType) for f in rejects.schema.fields] for name, (_, rejects) in found.items()}
    same = F.lit(int(shapes["clean"] == shapes["damaged"])).alias("same_shape")
    counted = [
        rejects.agg(F.lit(name).alias("input"), same, F.count(F.lit(1)).alias("n_rejects"))
        for name, (_, rejects) in found.items()
    ]
    return reduce(DataFrame.unionByName, counted)


@query
def stream_fail_fast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feed without its key column ends all streams; the other table is whole once it has run again."""
    lake = scratch_lake(spark, "stream_fail_fast")
    sources = []
    for spec, changes in ((USER_CHANGES, user_changes(spark, sf_dir)), (ORDERS_RAW, raw_orders(spark, sf_dir).drop("order_id"))):
        landing = f"{lake.root}/landing/{spec.source}_cdc"
        write_partitioned(changes, landing)
        sources.append(located(spec, lake, landing))
    raised = 0
    try:
        run_streams(spark, sources, lake, options=USER_LOAD, stream=StreamOptions(interval="1 second"))
    except StreamFailed:
        raised = 1
    names = {f"stream-{source.source}" for source in sources}
    left = sum(active.name in names for active in spark.streams.active)
    # the backlog by its bytes: a micro-batch a file would be as many as there are files
    run_streams(spark, sources[:1], lake, options=USER_LOAD, stream=catch_up(spark, sources[0].cdc_source_location))
    failed = read_audit(spark, lake.run_log_path, RUN_LOG).where("source = 'orders' AND status = 'failed'")
    state = lake.table(spark, USER_CHANGES.target).read().agg(
        F.lit(raised).alias("raised"), F.lit(left).alias("still_running"), F.count(F.lit(1)).alias("n_users")
    )
    return _side_by_side(state, failed.agg(F.count(F.lit(1)).alias("failed_runs")))
