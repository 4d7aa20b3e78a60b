from datetime import datetime, timedelta, timezone

import pytest

from changeloom import SourceSpec
from changeloom.operators.audit import (
    QUALITY_METRICS,
    RUN_LOG,
    RunResult,
    quality_metric_rows,
    run_log_row,
    run_throughput,
    validity_rate,
)
from changeloom.operators.profile import column_profile, fk_orphans
from changeloom.operators.quality import QualityOptions
from changeloom.plans import loads
from changeloom.plans.lake import Lake, LoadOptions
from changeloom.plans.loads import LoadFailed, load_table, load_tables
from changeloom.sinks.audit import read_audit
from changeloom.sinks.rejects import read_rejects
from tests.meters import TIME, meters, meters_spec

SMALL = LoadOptions(buckets=4)
NOW = datetime(2026, 7, 1, 12, tzinfo=timezone.utc)


@pytest.fixture
def lake(tmp_path):
    return Lake(str(tmp_path / "lake"))


def ten_readings(spark):
    states = ["active", "read", "sealed", "spare"]
    rows = [(n, f"zone {n % 3}", n * 1.5, states[n % 4], TIME, "I") for n in range(1, 11)]
    return meters(
        spark, *rows, columns="meter_id long, zone string, litres double, status string, dms_timestamp timestamp, Op string"
    )


def log_of(spark, lake):
    return read_audit(spark, lake.run_log_path, RUN_LOG)


def test_ten_readings_end_to_end(spark, lake):
    source = meters_spec()
    result = load_table(spark, source, lake, dataframe=ten_readings(spark), options=SMALL)
    assert (result.status, result.records_read, result.records_written, result.records_rejected) == ("success", 10, 10, 0)
    loaded = lake.table(spark, source.target).read()
    assert {r.cod_unique for r in loaded.collect()} == {str(i) for i in range(1, 11)}
    assert {str(r.event_date) for r in loaded.collect()} == {"2026-06-30"}
    assert {"cdc_operation", "cdc_timestamp"} <= set(loaded.columns)
    assert read_rejects(spark, lake.rejects_path(source.target)).isEmpty()


@pytest.mark.parametrize("cache", [True, False, None])
def test_bad_status_never_lands(spark, lake, cache):
    source = meters_spec()
    df = meters(spark, (1, "AA", "invalid_status", TIME), (2, "AA", "active", TIME))
    load_table(spark, source, lake, dataframe=df, options=LoadOptions(buckets=4, cache=cache))
    assert [r.status for r in lake.table(spark, source.target).read().collect()] == ["active"]
    rejects = read_rejects(spark, lake.rejects_path(source.target)).collect()
    assert [(r.meter_id, r._reject_rule) for r in rejects] == [(1, "enum_check")]
    row = log_of(spark, lake).first()
    assert (row.records_read, row.records_written, row.records_rejected) == (2, 1, 1)
    assert (row.source, row.status, row.target_partition, row.error_message) == ("meters", "success", "event_date=", "")


def test_second_full_load_merges(spark, lake, tmp_path):
    source = meters_spec(source_location=str(tmp_path / "full"))
    meters(spark, (1, "AA", "active", TIME), (2, "AA", "active", TIME)).write.parquet(str(tmp_path / "full"))
    load_table(spark, source, lake, options=SMALL)
    later = TIME + timedelta(hours=1)
    df = meters(spark, (1, "AA", "read", later), (3, "BB", "active", later))
    load_table(spark, source, lake, dataframe=df, options=SMALL)
    table = lake.table(spark, source.target)
    assert {r.meter_id: r.status for r in table.read().collect()} == {1: "read", 2: "active", 3: "active"}
    assert table.pending_batches() == 1  # a small load rewrites no bucket
    table.compact()
    assert table.pending_batches() == 0 and table.read().count() == 3
    assert log_of(spark, lake).count() == 2


def test_effects_are_counted_if_asked(spark, lake):
    source, options = meters_spec(), LoadOptions(buckets=4, count_effects=True)
    first = meters(spark, (1, "AA", "active", TIME), (2, "AA", "active", TIME), (3, "AA", "active", TIME))
    assert load_table(spark, source, lake, dataframe=first, options=options).effects == {}
    columns = "meter_id long, status string, dms_timestamp timestamp, Op string"
    later, before = TIME + timedelta(hours=1), TIME - timedelta(hours=1)
    df = meters(
        spark, (1, "read", later, "U"), (2, "read", later, "D"), (3, "read", before, "U"),
        (4, "active", later, "I"), (5, "active", later, "D"), columns=columns,
    )
    result = load_table(spark, source, lake, dataframe=df, options=options)
    assert result.effects == {"update": 1, "delete": 1, "stale": 1, "insert": 1, "unknown_delete": 1}
    again = load_table(spark, source, lake, dataframe=df.where("meter_id = 2"), options=options)
    assert again.effects == {"unknown_delete": 1}


def test_positions_from_monthly_folders(spark, lake, tmp_path):
    """A two-part key with a time in it, a plain partition column, decimals, a wildcard path."""
    source = meters_spec(
        source_location=str(tmp_path / "positions_*"),
        schema={
            "position_id": {"type": "bigint", "nullable": False},
            "aircraft": {"type": "string", "nullable": False},
            "latitude": "decimal(10,7)",
            "recorded_at": {"type": "timestamp", "nullable": False},
        },
        primary_key=["position_id", "recorded_at"], enum_columns={}, partition_keys=[{"name": "aircraft"}],
        cod_unique_expr={"columns": ["position_id", "recorded_at"], "separator": "_"},
    )
    columns = "position_id long, aircraft string, latitude string, recorded_at timestamp"
    meters(spark, (1, "abc", "52.1234567", TIME), (1, "abc", "x", TIME + timedelta(days=1)), columns=columns).write.parquet(
        str(tmp_path / "positions_202606")
    )
    meters(spark, (2, None, "1", TIME), (1, "abc", "9", None), columns=columns).write.parquet(
        str(tmp_path / "positions_202607")
    )
    result = load_table(spark, source, lake, options=SMALL)
    assert (result.records_read, result.records_written, result.records_rejected) == (4, 2, 2)
    loaded = lake.table(spark, source.target).read()
    assert dict(loaded.dtypes)["latitude"] == "decimal(38,18)"
    assert {r.cod_unique: r.latitude and float(r.latitude) for r in loaded.collect()} == {
        "1_2026-06-30 10:00:00": 52.1234567, "1_2026-07-01 10:00:00": None
    }


def test_empty_input_writes_nothing_but_the_log(spark, lake):
    source = meters_spec()
    result = load_table(spark, source, lake, dataframe=meters(spark), options=SMALL)
    assert (result.status, result.records_read) == ("success", 0)
    assert not lake.table(spark, source.target).exists()
    assert log_of(spark, lake).count() == 1


def test_only_rejects(spark, lake):
    source = meters_spec()
    result = load_table(spark, source, lake, dataframe=meters(spark, (None, "A", "x", TIME)), options=SMALL)
    assert (result.records_written, result.records_rejected) == (0, 1)
    assert not lake.table(spark, source.target).exists()


def test_keys_that_look_alike_stay_two_rows(spark, lake):
    source = meters_spec(
        schema={"a": {"type": "string", "nullable": False}, "b": "string"}, primary_key=["a", "b"],
        cod_unique_expr={"columns": ["a", "b"], "separator": "_"}, enum_columns={}, partition_keys=[],
    )
    df = spark.createDataFrame([("a_b", "c"), ("a", "b_c"), ("a", None)], "a string, b string")
    load_table(spark, source, lake, dataframe=df, options=SMALL)
    loaded = lake.table(spark, source.target).read().collect()
    assert sorted(r.cod_unique for r in loaded) == ["a", "a_b_c", "a_b_c"]


def test_a_failure_is_logged_and_raised(spark, lake):
    source = meters_spec(source_location="/nowhere")
    with pytest.raises(LoadFailed, match="meters"):
        load_table(spark, source, lake)
    row = log_of(spark, lake).first()
    assert row.status == "failed" and "nowhere" in row.error_message
    metrics = {r.metric: (r.status, r.failure_reason) for r in read_audit(spark, lake.metrics_path, QUALITY_METRICS).collect()}
    assert metrics == {
        "rows_read": ("failed", "0"), "rows_written": ("failed", "0"),
        "rows_rejected": ("success", "0"), "pipeline_status": ("success", "failed"),
    }


def test_audit_failures(spark, lake, monkeypatch):
    def broken(*_):
        raise OSError("disk full")

    monkeypatch.setattr(loads, "write_audit", broken)
    df = meters(spark, (1, "AA", "active", TIME))
    assert load_table(spark, meters_spec(), lake, dataframe=df, options=SMALL).status == "success"
    with pytest.raises(OSError):
        load_table(spark, meters_spec(), lake, dataframe=df, options=LoadOptions(strict_audit=True))


def plan_of_three(spark, tmp_path):
    good = tmp_path / "full"
    meters(spark, (1, "AA", "active", TIME)).write.parquet(str(good))
    paths = {"first": str(good), "second": "/nowhere", "third": str(good)}
    return [
        SourceSpec.parse({
            **meters_spec().to_dict(), "source": name, "order": order, "source_location": paths[name],
            "target": {**meters_spec(enum_columns={}).target.to_dict(), "catalog": {"database": "db_raw", "table": f"tbl_{name}"}},
        })
        for name, order in (("third", 3), ("first", 1), ("second", 2))
    ]


def test_all_tables_stop_at_the_first_failure(spark, lake, tmp_path):
    sources = plan_of_three(spark, tmp_path)
    with pytest.raises(LoadFailed):
        load_tables(spark, sources, lake, options=SMALL)
    assert {r.source: r.status for r in log_of(spark, lake).collect()} == {"first": "success", "second": "failed"}


def test_all_tables_go_on_if_asked(spark, lake, tmp_path):
    sources = plan_of_three(spark, tmp_path)
    with pytest.raises(LoadFailed, match="second"):
        load_tables(spark, sources, lake, options=LoadOptions(buckets=4, on_error="continue"))
    assert {r.source: r.status for r in log_of(spark, lake).collect()} == {
        "first": "success", "second": "failed", "third": "success"
    }
    results = load_tables(spark, [s for s in sources if s.source != "second"], lake, options=SMALL)
    assert [r.source for r in results] == ["first", "third"]


def test_audit_rows(spark):
    target = meters_spec(partition_keys=[{"name": "event_date"}, {"name": "region"}]).target
    result = RunResult("id-1", "meters", "success", NOW - timedelta(seconds=30), NOW, 10, 9, 1)
    log = run_log_row(spark, result, target)
    assert log.schema.names == RUN_LOG.names and [f.dataType for f in log.schema] == [f.dataType for f in RUN_LOG]
    row = log.first()
    assert row.target_partition == "event_date=/region=" and str(row.reference_date) == "2026-07-01"
    assert (row.execution_end - row.execution_start).total_seconds() == 30
    metrics = quality_metric_rows(spark, result, target)
    assert metrics.schema.names == QUALITY_METRICS.names
    assert {r.metric: r.failure_reason for r in metrics.collect()} == {
        "rows_read": "10", "rows_written": "9", "rows_rejected": "1", "pipeline_status": "success"
    }
    assert validity_rate(log).first().validity_rate == 0.9
    speed = run_throughput(log).first()
    assert (speed.records_per_minute, speed.longest_run_seconds) == (20.0, 30.0)


def test_reports_without_runs(spark, tmp_path):
    empty = read_audit(spark, str(tmp_path / "none"), RUN_LOG)
    assert validity_rate(empty).isEmpty() and run_throughput(empty).isEmpty()


def test_column_profile(spark):
    source = meters_spec(schema={"meter_id": {"type": "bigint", "nullable": False}, "status": "string", "gone": "int"})
    df = spark.createDataFrame([("1", "active"), ("x", "odd"), (None, None)], "meter_id string, status string")
    profile = {r.column_name: tuple(r)[1:] for r in column_profile(df, source.target).collect()}
    assert profile == {"meter_id": (True, 3, 1, 1, 0), "status": (False, 3, 1, 0, 1)}


def test_fk_orphans(spark):
    child = spark.createDataFrame([(1,), (1,), (2,), (None,)], "flight long")
    parent = spark.createDataFrame([(2,), (None,)], "id long")
    assert [tuple(r) for r in fk_orphans(child, "flight", parent, "id").collect()] == [(1, 2)]


def test_strict_load_keeps_the_raw_input(spark, lake):
    source = meters_spec(schema={"meter_id": {"type": "bigint", "nullable": False}, "gate": "int"}, enum_columns={})
    df = spark.createDataFrame([("1", "5", TIME), ("2", "five", TIME)], "meter_id string, gate string, dms_timestamp timestamp")
    options = LoadOptions(buckets=4, quality=QualityOptions(casts="strict", keep_raw=True))
    result = load_table(spark, source, lake, dataframe=df, options=options)
    assert (result.records_written, result.records_rejected) == (1, 1)
    assert "five" in read_rejects(spark, lake.rejects_path(source.target)).first()._reject_raw


def test_a_replay_without_rejects_clears_the_old_ones(spark, lake):
    from changeloom.plans.loads import load_rows

    source = meters_spec()
    bad, good = meters(spark, (1, "AA", "no_such", TIME)), meters(spark, (1, "AA", "active", TIME))
    location = lake.rejects_path(source.target)
    load_rows(spark, bad, source, lake, "same", started=NOW, options=SMALL)
    assert read_rejects(spark, location).count() == 1
    load_rows(spark, good, source, lake, "same", started=NOW, options=SMALL)
    assert read_rejects(spark, location).isEmpty()
