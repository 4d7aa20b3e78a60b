from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from changeloom import LoadPlan
from changeloom.operators.audit import QUALITY_METRICS
from changeloom.operators.sketches import COLUMN_SKETCHES, DISTINCT_ERROR, RANK_ERROR, column_sketches, merged_profile
from changeloom.plans.lake import Lake, LoadOptions
from changeloom.plans.loads import load_table
from changeloom.sinks.audit import read_audit
from tests.meters import TIME, meters, meters_spec

TARGET = LoadPlan.from_dicts(
    {"target": {"catalog": {"table": "t"}, "schema": {"n": "bigint", "x": "double", "s": "string", "d": "date", "at": "timestamp", "absent": "int"}}}
).sources[0].target


def profile(sketches, quantiles=(0.5,)):
    return {r.column_name: r for r in merged_profile(sketches, quantiles).collect()}


def test_parts_merge_to_the_whole(spark):
    rows = spark.range(20000).select(
        F.when(F.col("id") % 10 != 0, F.col("id")).alias("n"), (F.col("id") % 100 / 2.0).alias("x"),
        F.concat(F.lit("k"), F.col("id") % 5000).alias("s"), F.date_add(F.lit(date(2026, 1, 1)), (F.col("id") % 30).cast("int")).alias("d"),
        F.timestamp_seconds("id").alias("at"),
    )
    parts = [column_sketches(rows.where(F.col("x") % 3 == k), TARGET) for k in (0, 0.5, 1, 1.5, 2, 2.5)]
    merged = profile(parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3]).unionByName(parts[4]).unionByName(parts[5]))
    assert set(merged) == {"n", "x", "s", "d", "at"}
    assert {r.n_rows for r in merged.values()} == {20000}
    assert merged["n"].n_null == 2000 and (merged["n"].low, merged["n"].high) == (1, 19999)
    assert (merged["s"].low_text, merged["s"].high_text, merged["s"].low, merged["s"].quantiles) == ("k0", "k999", None, None)
    assert merged["d"].low == datetime(2026, 1, 1).timestamp() - datetime(1970, 1, 1).timestamp()
    assert (merged["at"].low, merged["at"].high) == (0, 19999)
    for name, exact in {"n": 18000, "x": 100, "s": 5000, "d": 30, "at": 20000}.items():
        assert abs(merged[name].n_distinct - exact) <= DISTINCT_ERROR * exact, name
    assert abs(merged["at"].quantiles[0] - 10000) <= RANK_ERROR * 20000
    whole = profile(column_sketches(rows, TARGET))
    assert {k: r.n_rows for k, r in whole.items()} == {k: r.n_rows for k, r in merged.items()}


@pytest.mark.parametrize("schema", ["n long, s string", "other int"])
def test_no_rows_and_no_declared_columns(spark, schema):
    empty = column_sketches(spark.createDataFrame([], schema), TARGET)
    assert empty.schema.names == COLUMN_SKETCHES.names
    for row in profile(empty).values():
        assert (row.n_rows, row.n_null, row.n_distinct, row.quantiles) == (0, 0, 0, None)
    assert set(profile(empty)) == ({"n", "s"} if "n" in schema.split() else set())


def test_null_columns_and_values_that_look_alike(spark):
    rows = spark.createDataFrame([(None, -0.0, None), (None, 0.0, ""), (None, float("nan"), "")], "n long, x double, s string")
    found = profile(column_sketches(rows, TARGET))
    assert (found["n"].n_null, found["n"].n_distinct, found["n"].quantiles) == (3, 0, None)
    assert (found["x"].n_distinct, found["x"].quantiles) == (2, [0.0])
    assert (found["s"].n_distinct, found["s"].low_text) == (1, "")


def test_a_load_leaves_sketches_and_effects(spark, tmp_path):
    lake, source = Lake(str(tmp_path / "lake")), meters_spec()
    options = LoadOptions(buckets=2, sketch_columns=True, count_effects=True)
    columns = "meter_id long, zone string, status string, dms_timestamp timestamp, Op string"
    load_table(spark, source, lake, dataframe=meters(spark, (1, "A", "active", TIME, "I"), (2, "B", "odd", TIME, "I"), columns=columns), options=options)
    load_table(spark, source, lake, dataframe=meters(spark, (1, "A", "read", TIME.replace(hour=11), "U"), (3, "C", "read", TIME, "I"), columns=columns), options=options)
    merged = profile(read_audit(spark, lake.sketches_path, COLUMN_SKETCHES))
    assert (merged["meter_id"].n_rows, merged["meter_id"].n_distinct, merged["meter_id"].high) == (3, 2, 3)  # the reject does not count
    assert spark.table("db_raw.column_sketches").count() > 0
    metrics = read_audit(spark, lake.metrics_path, QUALITY_METRICS).where("metric like 'keys%'")
    assert {(r.metric, r.failure_reason) for r in metrics.collect()} == {("keys_insert", "1"), ("keys_update", "1")}
