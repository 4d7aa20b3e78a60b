from dataclasses import replace
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from changeloom.operators.audit import RUN_LOG
from changeloom.plans.lake import Lake, LoadOptions
from changeloom.queries import registry
from changeloom.sinks.audit import read_audit
from changeloom.sinks.rejects import read_rejects
from changeloom.streaming import loads
from changeloom.streaming.loads import (
    StreamFailed,
    StreamOptions,
    apply_micro_batch,
    run_streams,
    start_stream,
)
from changeloom.streaming.progress import STREAM_PROGRESS, stream_latency
from tests.meters import TIME, meters, meters_spec

COLUMNS = "meter_id long, zone string, status string, dms_timestamp timestamp, Op string"
NOW = StreamOptions(available_now=True)
SMALL = LoadOptions(buckets=4)


def changes(spark, *rows):
    """(id, status, minute, op)"""
    return meters(spark, *[(i, "AA", s, TIME + timedelta(minutes=m), op) for i, s, m, op in rows], columns=COLUMNS)


def land(df, landing, name):
    df.coalesce(1).write.parquet(f"{landing}/{name}")


@pytest.fixture
def lake(tmp_path):
    return Lake(str(tmp_path / "lake"))


@pytest.fixture
def source(tmp_path):
    return meters_spec(
        cdc_source_location=str(tmp_path / "meters_cdc"), checkpoint_location=str(tmp_path / "checkpoint")
    )


def state(spark, lake, source):
    return {r.meter_id: r.status for r in lake.table(spark, source.target).read().collect()}


def test_four_files_one_per_batch_then_restart(spark, lake, source):
    landing = source.cdc_source_location
    land(changes(spark, (1, "active", 1, "I"), (2, "active", 1, "I"), (9, "odd", 1, "I")), landing, "2026/06/30")
    land(changes(spark, (1, "read", 2, "U"), (2, "active", 5, "D")), landing, "2026/07/01")
    land(changes(spark, (2, "read", 3, "U"), (3, "active", 1, "I")), landing, "2026/07/02")
    land(changes(spark, (4, "active", 1, None)), landing, "2026/07/03")
    options = LoadOptions(buckets=4, compact_every=2)
    run_streams(spark, [source], lake, options=options, stream=NOW)
    expected = {1: "read", 3: "active", 4: "active"}
    assert state(spark, lake, source) == expected
    log = read_audit(spark, lake.run_log_path, RUN_LOG)
    assert log.count() == 4 and log.agg(F.sum("records_read")).first()[0] == 8
    assert read_rejects(spark, lake.rejects_path(source.target)).count() == 1

    run_streams(spark, [source], lake, options=options, stream=NOW)
    assert log.count() == read_audit(spark, lake.run_log_path, RUN_LOG).count()
    land(changes(spark, (4, "read", 2, "U")), landing, "2026/07/04")
    run_streams(spark, [source], lake, options=options, stream=NOW)
    assert state(spark, lake, source) == expected | {4: "read"}
    assert read_audit(spark, lake.run_log_path, RUN_LOG).count() == 5


def test_one_file_is_spread_over_the_cores(spark, lake, source, monkeypatch):
    """A micro-batch of one partition is validated in as many tasks as there are cores; a wide one stays as it is."""
    seen, real = [], loads.load_rows

    def load(spark, df, *args, **options):
        seen.append(df.rdd.getNumPartitions())
        return real(spark, df, *args, **options)

    monkeypatch.setattr(loads, "load_rows", load)
    batch = changes(spark, *[(i, "active", 1, "I") for i in range(40)]).withColumn("extra", F.create_map(F.lit("a"), F.lit(1)))
    apply_micro_batch(batch.coalesce(1), 0, source, lake, SMALL, stream_id="q")
    assert loads.spread(batch.repartition(9)).rdd.getNumPartitions() == 9
    assert seen == [spark.sparkContext.defaultParallelism]
    assert state(spark, lake, source) == {i: "active" for i in range(40)}


def test_a_replayed_batch_changes_nothing(spark, lake, source):
    batch = changes(spark, (1, "active", 1, "I"), (2, "odd", 1, "I"), (3, "active", 1, "D"))
    later = changes(spark, (1, "read", 2, "U"))
    apply_micro_batch(batch, 0, source, lake, SMALL, stream_id="q")
    apply_micro_batch(later, 1, source, lake, SMALL, stream_id="q")
    before = state(spark, lake, source)
    for number, df in ((0, batch), (1, later), (0, batch)):
        apply_micro_batch(df, number, source, lake, SMALL, stream_id="q")
    assert state(spark, lake, source) == before == {1: "read"}
    assert read_rejects(spark, lake.rejects_path(source.target)).count() == 1
    assert read_audit(spark, lake.run_log_path, RUN_LOG).count() == 2


def test_a_new_checkpoint_does_not_overwrite_older_batches(spark, lake, source, tmp_path):
    land(changes(spark, (1, "active", 1, "I")), source.cdc_source_location, "a")
    run_streams(spark, [source], lake, options=SMALL, stream=replace(NOW, archive=False))
    land(changes(spark, (2, "active", 1, "I")), source.cdc_source_location, "b")
    run_streams(spark, [source], lake, options=SMALL, stream=replace(NOW, archive=False))
    moved = replace(source, cdc_source_location=str(tmp_path / "other"), checkpoint_location=str(tmp_path / "new"))
    land(changes(spark, (3, "active", 1, "I")), moved.cdc_source_location, "c")
    land(changes(spark, (4, "active", 1, "I")), moved.cdc_source_location, "d")
    run_streams(spark, [moved], lake, options=SMALL, stream=NOW)
    assert set(state(spark, lake, source)) == {1, 2, 3, 4}


def test_a_failing_table_stops_the_others(spark, lake, source, tmp_path):
    land(changes(spark, (1, "active", 1, "I")), source.cdc_source_location, "a")
    bad = replace(
        meters_spec(cdc_source_location=str(tmp_path / "bad_cdc"), checkpoint_location=str(tmp_path / "bad_checkpoint")),
        source="bad",
    )
    spark.range(3).write.parquet(bad.cdc_source_location)  # lacks the key column
    forever = StreamOptions(interval="1 second")
    with pytest.raises(StreamFailed, match="stream-bad"):
        run_streams(spark, [source, bad], lake, options=SMALL, stream=forever)
    assert spark.streams.active == []
    failed = read_audit(spark, lake.run_log_path, RUN_LOG).where("status = 'failed' and source = 'bad'")
    assert "meter_id" in failed.first().error_message

    # a batch that the stop cut off runs again and replaces what it had recorded
    run_streams(spark, [source], lake, options=SMALL, stream=NOW)
    assert state(spark, lake, source) == {1: "active"}
    log = read_audit(spark, lake.run_log_path, RUN_LOG).where("source = 'meters'").collect()
    assert [r.status for r in log] == ["success"]


def test_query_name_and_trigger(spark, lake, source):
    land(changes(spark, (1, "active", 1, "I")), source.cdc_source_location, "a")
    query = start_stream(spark, source, lake, options=SMALL, stream=StreamOptions(interval="1 second"))
    try:
        assert query.name == "stream-meters"
        query.processAllAvailable()
        assert state(spark, lake, source) == {1: "active"}
    finally:
        query.stop()


def test_an_empty_batch_is_only_logged(spark, lake, source):
    counts = apply_micro_batch(changes(spark), 0, source, lake, SMALL, stream_id="q")
    assert (counts.read, counts.written) == (0, 0)
    assert not lake.table(spark, source.target).exists()


def test_redelivered_rows_count_once_and_none_is_dropped_as_late(spark, lake, source):
    landing, once = source.cdc_source_location, replace(NOW, redelivery="1 day", archive=False)
    first = changes(spark, (1, "active", 50000, "I"), (2, "active", 1, "I"), (2, "sealed", 1, "I"))
    land(first, landing, "a")
    run_streams(spark, [source], lake, options=SMALL, stream=once)
    land(first, landing, "again")
    land(changes(spark, (3, "active", -50000, "I")), landing, "old")  # long before the newest change time
    run_streams(spark, [source], lake, options=SMALL, stream=once)
    log = read_audit(spark, lake.run_log_path, RUN_LOG)
    assert log.agg(F.sum("records_read")).first()[0] == 4  # rows that differ in one column both count
    assert set(state(spark, lake, source)) == {1, 2, 3}


def test_what_is_remembered_is_gone_through_once_a_micro_batch_with_rows(spark, lake, source):
    names = ["spark.sql.streaming.noDataMicroBatches.enabled", "spark.sql.streaming.maxBatchesToRetainInMemory"]
    before = [spark.conf.get(name) for name in names]
    first = changes(spark, (1, "active", 50000, "I"), (2, "active", 1, "I"))
    for name in ("a", "b", "c"):
        land(first, source.cdc_source_location, name)
    run_streams(spark, [source], lake, options=SMALL, stream=replace(NOW, redelivery="1 day", archive=False))
    log = read_audit(spark, lake.run_log_path, RUN_LOG)
    assert sorted(r.records_read for r in log.collect()) == [0, 0, 2]  # one a file, none without one
    assert [spark.conf.get(name) for name in names] == before


def test_progress_and_pool_of_a_stream(spark, lake, source, monkeypatch):
    pools = []
    monkeypatch.setattr(
        "changeloom.streaming.loads.apply_micro_batch",
        lambda df, *rest: pools.append((df.sparkSession.sparkContext.getLocalProperty("spark.scheduler.pool"), df.count())),
    )
    for minute, rows in enumerate(([1, 2, 3], [4], [5, 6])):
        land(changes(spark, *[(i, "active", minute, "I") for i in rows]), source.cdc_source_location, str(minute))
    before = spark.sparkContext.getLocalProperty("spark.scheduler.pool")
    run_streams(spark, [source], lake, options=SMALL, stream=replace(NOW, progress=True, archive=False))
    assert sorted(pools) == [("stream-meters", n) for n in (1, 2, 3)]
    assert spark.sparkContext.getLocalProperty("spark.scheduler.pool") == before
    progress = read_audit(spark, lake.progress_path, STREAM_PROGRESS)
    assert sorted(r.input_rows for r in progress.collect()) == [1, 2, 3]
    assert spark.table(lake.progress_name).count() == 3
    tried_again = progress.unionByName(progress.withColumn("run_id", F.lit("x")))
    latency = stream_latency(tried_again).collect()
    assert [(r.stream, r.batches, r.input_rows, r.largest_batch, r.meets_target) for r in latency] == [("stream-meters", 3, 6, 3, True)]
    assert not stream_latency(progress, target_seconds=0).first().meets_target


def test_a_backlog_after_a_failure_takes_few_micro_batches(spark, monkeypatch):
    lakes, made = [], registry.scratch_lake
    monkeypatch.setattr(registry, "scratch_lake", lambda *args: lakes.append(made(*args)) or lakes[-1])
    files = {"spark.sql.shuffle.partitions": "24", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {name: spark.conf.get(name) for name in files}
    try:
        for name, value in files.items():
            spark.conf.set(name, value)
        row = registry.QUERIES["stream_fail_fast"](spark, "/root/testdata/sf0.001").first()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    batches = read_audit(spark, lakes[0].run_log_path, RUN_LOG).where("source = 'users'").count()
    landed = spark.read.option("recursiveFileLookup", "true").parquet(f"{lakes[0].root}/landing/users_cdc*")
    assert landed.select("_metadata.file_path").distinct().count() > 20 and landed.count() == 1000
    assert row.raised == 1 and row.failed_runs == 1 and batches < 12
