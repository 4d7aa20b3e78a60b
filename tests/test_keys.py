from datetime import datetime

import pytest
from pyspark.sql import functions as F

from changeloom import TargetSpec
from changeloom.functions.keys import (
    KeyColumnMissing,
    match_columns,
    prepare_for_target,
    project_to_target,
    rename_cdc_columns,
    with_merge_key,
    with_partition_columns,
)
from tests.meters import TIME, meters, meters_spec


def test_key_from_primary_key(spark):
    out = with_merge_key(meters(spark, (1, "AA", "x", TIME)), meters_spec().target)
    assert out.first().cod_unique == "1"


def test_ready_made_key_is_kept(spark):
    df = meters(spark, (1, "AA", "x", TIME)).withColumn("cod_unique", F.lit("mine"))
    assert with_merge_key(df, meters_spec().target) is df
    assert match_columns(meters_spec().target, df.columns) == ["cod_unique"]


def test_key_text_skips_nulls_and_uses_the_separator(spark):
    target = TargetSpec.parse({"primary_key": ["a"], "cod_unique_expr": {"columns": ["a", "b", "c"], "separator": "-"}})
    df = spark.createDataFrame([("x", None, 3)], "a string, b string, c int")
    assert with_merge_key(df, target).first().cod_unique == "x-3"
    assert match_columns(target, df.columns) == ["a", "b", "c"]


def test_separator_and_columns_have_defaults(spark):
    df = spark.createDataFrame([("x", TIME)], "a string, b timestamp")
    assert with_merge_key(df, TargetSpec(primary_key=("a", "b"))).first().cod_unique == "x_2026-06-30 10:00:00"
    target = TargetSpec(primary_key=("a",), cod_unique_expr={"separator": "#"})
    assert with_merge_key(df, target).first().cod_unique == "x"


@pytest.mark.parametrize("target", [TargetSpec(primary_key=("a", "missing")), TargetSpec()])
def test_missing_key_columns(spark, target):
    with pytest.raises(KeyColumnMissing):
        with_merge_key(spark.createDataFrame([("x",)], "a string"), target)


def test_date_from_the_change_time(spark):
    source = meters_spec()
    out = with_partition_columns(meters(spark, (1, "AA", "x", TIME)), source.target, source)
    assert str(out.first().event_date) == "2026-06-30"


def test_date_from_a_source_column(spark):
    source = meters_spec(partition_keys=[{"name": "event_date", "source_column": "planned_at"}])
    df = spark.createDataFrame(
        [(1, "2026-06-30 08:30:00", TIME), (2, "soon", TIME), (3, "2026-07-01", TIME)],
        "meter_id long, planned_at string, dms_timestamp timestamp",
    ).coalesce(1)
    out = with_partition_columns(df, source.target, source).collect()
    assert [str(r.event_date) for r in out] == ["2026-06-30", "None", "2026-07-01"]


def test_missing_source_column_falls_back_to_the_change_time(spark):
    source = meters_spec(partition_keys=[{"name": "event_date", "source_column": "absent"}])
    out = with_partition_columns(meters(spark, (1, "AA", "x", TIME)), source.target, source)
    assert str(out.first().event_date) == "2026-06-30"


def test_partition_columns_that_cannot_be_derived(spark):
    source = meters_spec(partition_keys=[{"name": "region"}, {"name": "status"}, {"name": "event_date"}])
    df = meters(spark, (1, "AA", "x", TIME)).drop("dms_timestamp")
    assert with_partition_columns(df, source.target, source) is df
    assert "event_date" not in with_partition_columns(df, source.target).columns


def test_rename(spark):
    df = spark.createDataFrame([(1, "I", None)], "meter_id long, Op string, dms_timestamp timestamp")
    assert rename_cdc_columns(df, meters_spec()).columns == ["meter_id", "cdc_operation", "cdc_timestamp"]
    assert rename_cdc_columns(df, None) is df
    assert rename_cdc_columns(df.select("meter_id"), meters_spec()).columns == ["meter_id"]


def test_project_keeps_the_operation(spark):
    df = spark.createDataFrame([(1, "I", 2)], "meter_id long, cdc_operation string, extra int")
    assert project_to_target(df, ["meter_id", "other"]).columns == ["meter_id", "cdc_operation"]
    assert project_to_target(df, ["meter_id"], None).columns == ["meter_id"]


def test_prepared_shape(spark):
    source = meters_spec()
    out = prepare_for_target(meters(spark, (1, "AA", "x", datetime(2026, 1, 2))), source.target, source)
    assert out.columns == ["meter_id", "zone", "status", "cdc_timestamp", "cod_unique", "event_date"]
