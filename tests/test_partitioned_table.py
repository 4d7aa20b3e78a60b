import pytest
from pyspark.sql import functions as F

from changeloom.plans.lake import Lake, LoadOptions
from changeloom.plans.loads import load_table
from changeloom.sinks.partitioned_table import PartitionedTable
from tests.meters import TIME, meters, meters_spec

SCHEMA = "id long, v string, zone string, n long, op string"


def rows(spark, *items):
    return spark.createDataFrame(list(items), SCHEMA)


@pytest.fixture
def table(spark, tmp_path):
    return PartitionedTable(spark, str(tmp_path / "table"), ["zone"], name="db_parts.tbl")


def put(table, df):
    table.apply(df, "any", keys=["id"], op="op", order_by=["n"])


def state(table):
    return {r.id: (r.v, r.zone) for r in table.read().collect()}


def files(table):
    found = table.read("soft").select("zone", "_metadata.file_name").distinct()
    return {(r[0], r[1]) for r in found.collect()}


def test_rows_move_and_untouched_folders_keep_their_files(spark, table):
    put(table, rows(spark, *[(i, "a", f"z{i % 4}", 1, "I") for i in range(20)], (90, "a", "alone", 1, "I"), (91, "a", None, 1, "I")))
    before, was = files(table), state(table)
    # 1 moves from z1 to z2, 90 leaves the folder it had for itself, 91 gets a folder, 2 is deleted
    put(table, rows(spark, (1, "b", "z2", 2, "U"), (90, "b", "z2", 2, "U"), (91, "b", "z2", 2, "U"), (2, "b", "z2", 2, "D")))
    after = files(table)
    assert state(table) == {**{k: v for k, v in was.items() if k != 2}, 1: ("b", "z2"), 90: ("b", "z2"), 91: ("b", "z2")}
    kept = {z for z, _ in before & after}
    assert kept == {"z0", "z3"} and {z for z, _ in after} == {"z0", "z1", "z2", "z3"}
    assert spark.table("db_parts.tbl").count() == len(state(table))


def test_a_late_change_does_not_move_a_row_back(spark, table):
    put(table, rows(spark, (1, "a", "x", 5, "I"), (2, "a", "x", 5, "D")))
    put(table, rows(spark, (1, "late", "y", 4, "U"), (2, "late", "y", 4, "U"), (3, "new", "y", 4, "U")))
    assert state(table) == {1: ("a", "x"), 3: ("new", "y")}


def test_a_batch_that_was_cut_off_while_it_committed_is_put_right(spark, table):
    put(table, rows(spark, (1, "a", "x", 1, "I"), (2, "a", "x", 1, "I")))
    # the new folder is there, the old one was not rewritten
    half = rows(spark, (1, "b", "y", 2, "U")).select("id", "v", "n", "op", F.lit(False).alias("is_deleted"), "zone")
    half.write.insertInto(table._rows)
    put(table, rows(spark, (1, "b", "y", 2, "U")))
    assert sorted((r.id, r.v) for r in table.read().collect()) == [(1, "b"), (2, "a")]


def test_a_date_filter_skips_folders(spark, tmp_path):
    table = PartitionedTable(spark, str(tmp_path / "t"), ["day"])
    df = spark.range(100).select("id", F.expr("date'2026-06-01' + cast(id % 10 AS int)").alias("day"))
    table.apply(df, "all", keys=["id"])
    plan = table.read().where("day = date'2026-06-03'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and table.read().where("day = date'2026-06-03'").count() == 10


def test_a_session_that_does_not_know_the_table(spark, table):
    put(table, rows(spark, (1, "a", "x", 1, "I")))
    spark.sql("DROP DATABASE db_parts CASCADE")
    again = PartitionedTable(spark, table.path, ["zone"], name="db_parts.tbl")
    put(again, rows(spark, (1, "b", "y", 2, "U")))
    assert state(again) == {1: ("b", "y")} and spark.table("db_parts.tbl").count() == 1


def test_a_load_can_keep_its_target_in_folders(spark, tmp_path):
    lake, source, options = Lake(str(tmp_path / "lake")), meters_spec(), LoadOptions(layout="partitioned")
    for status in ("active", "read"):
        load_table(spark, source, lake, dataframe=meters(spark, (1, "AA", status, TIME)), options=options)
    loaded = lake.table(spark, source.target, "partitioned")
    assert [(r.meter_id, r.status) for r in loaded.read().collect()] == [(1, "read")]
    assert "event_date=2026-06-30" in "".join(f for f in loaded.read().inputFiles())
