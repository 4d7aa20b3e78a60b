"""Targets kept by the format their spec names; plain Spark has none that merges rows."""

from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from changeloom.plans.lake import Lake, LoadOptions
from changeloom.plans.loads import LoadFailed, load_table
from changeloom.sinks.catalog_merge import as_new
from changeloom.sinks.format_table import FormatTable
from tests.meters import TIME, meters, meters_spec

BY_FORMAT = LoadOptions(layout="format")


@pytest.fixture
def source(spark):
    named = {"database": "db_formats", "table": "tbl_meters"}
    yield lambda format, **more: meters_spec(format=format, catalog=named, **more)
    spark.sql("DROP DATABASE IF EXISTS db_formats CASCADE")


@pytest.mark.parametrize("format", ["orc", "parquet"])
def test_the_first_load_makes_a_table_of_the_stated_format(spark, tmp_path, source, format):
    lake, spec = Lake(str(tmp_path / "lake")), source(format)
    later = TIME + timedelta(days=1)
    df = meters(spark, (1, "AA", "active", TIME), (1, "AA", "read", later), (2, "BB", "sealed", TIME))
    load_table(spark, spec, lake, dataframe=df, options=BY_FORMAT)
    table = spark.table("db_formats.tbl_meters")
    assert sorted((r.meter_id, r.status, str(r.event_date)) for r in table.collect()) == [
        (1, "read", "2026-07-01"), (2, "sealed", "2026-06-30"),
    ]
    files = table.inputFiles()
    assert files and all(f.endswith(format) and "/event_date=" in f and str(tmp_path) in f for f in files)


def test_a_format_without_merge_refuses_the_second_batch(spark, tmp_path, source):
    lake, spec = Lake(str(tmp_path / "lake")), source("parquet")
    df = meters(spark, (1, "AA", "active", TIME))
    load_table(spark, spec, lake, dataframe=df, options=BY_FORMAT)
    with pytest.raises(LoadFailed, match="MERGE"):
        load_table(spark, spec, lake, dataframe=df, options=BY_FORMAT)
    assert lake.table(spark, spec.target, "format").read().count() == 1


def test_deletes_in_the_first_batch(spark, tmp_path, source):
    rows = spark.createDataFrame([(1, "a", 1, "I"), (1, "a", 2, "D"), (2, "b", 1, "I")], "id long, v string, n int, op string")
    for deletes, wanted in (("hard", {2}), ("soft", {1, 2})):
        table = FormatTable(spark, str(tmp_path / deletes), "orc", name=f"db_formats.{deletes}")
        assert not table.exists()
        table.apply(rows, "first", keys=["id"], op="op", order_by=["n"], deletes=deletes)
        assert table.exists() and {r.id for r in table.read().collect()} == wanted
        assert {r.id for r in table.read("hard").collect()} == {2}


def test_files_of_a_writer_that_died_before_the_table_was_entered(spark, tmp_path, source):
    table = FormatTable(spark, str(tmp_path / "t"), "parquet", name="db_formats.died")
    spark.range(3).write.parquet(f"{table.path}/rows")
    table.apply(spark.range(5, 7), "first", keys=["id"])
    assert sorted(r.id for r in table.read().collect()) == [5, 6]


def test_effects_are_counted_in_every_layout(spark, tmp_path, source):
    spec, later = source("parquet"), TIME + timedelta(hours=1)
    first = meters(spark, (1, "AA", "active", TIME), (2, "AA", "active", TIME))
    changes = meters(spark, (1, "AA", "read", later, "U"), (3, "AA", "active", later, "I"), columns="meter_id long, zone string, status string, dms_timestamp timestamp, Op string")
    for layout in ("keyed", "partitioned"):
        lake, options = Lake(str(tmp_path / layout)), LoadOptions(layout=layout, count_effects=True)
        load_table(spark, spec, lake, dataframe=first, options=options)
        assert load_table(spark, spec, lake, dataframe=changes, options=options).effects == {"update": 1, "insert": 1}
        spark.sql("DROP DATABASE IF EXISTS db_formats CASCADE")
    table = FormatTable(spark, str(tmp_path / "t"), "orc", name="db_formats.counted")
    table.apply(spark.createDataFrame([(1, 1), (2, 5)], "id long, n int"), "first", keys=["id"], order_by=["n"])
    found = table.effects(spark.createDataFrame([(1, 2), (2, 4), (3, 1)], "id long, n int"), keys=["id"], order_by=["n"])
    assert {tuple(r) for r in found.collect()} == {("update", 1), ("stale", 1), ("insert", 1)}


def test_which_changes_are_as_new_as_the_stored_row(spark):
    pairs = [(1, 1, 2, 1), (2, 1, 1, 9), (3, 2, 3, 1), (3, 1, 3, 2), (3, 2, 3, 2), (None, 1, 1, 1), (1, 1, None, 1), (None, 1, None, 2)]
    df = spark.createDataFrame([((a, b), (c, d)) for a, b, c, d in pairs], "c struct<t:int,s:int>, h struct<t:int,s:int>")
    found = [r[0] for r in df.coalesce(1).select(as_new(["t", "s"], "c", "h")).collect()]
    assert found == [False, True, True, False, True, False, True, False]
    assert df.select(as_new([], "c", "h")).distinct().collect() == [(True,)]
    assert df.where(F.col("c.t").isNull()).count() == 2
