from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeloom.functions.keys import key_text
from changeloom.sinks import keyed_table
from changeloom.sinks.keyed_table import KeyedTable, TableMissing, TypeDrift
from changeloom.storage import PathTaken

T0 = datetime(2026, 6, 30, 10)
SCHEMA = "id long, v string, cdc_timestamp timestamp, cdc_operation string"


def rows(spark, *items):
    return spark.createDataFrame([(i, v, T0 + timedelta(minutes=t), op) for i, v, t, op in items], SCHEMA)


@pytest.fixture
def table(spark, tmp_path):
    return KeyedTable(spark, str(tmp_path / "table"))


def put(table, df, key, **settings):
    table.apply(df, key, keys=["id"], op="cdc_operation", order_by=["cdc_timestamp"], buckets=4, **settings)


def state(table):
    return {r.id: r.v for r in table.read().collect()}


def test_missing_table(table):
    assert not table.exists()
    with pytest.raises(TableMissing):
        table.read()


def test_first_batch_is_reduced_and_deletes_do_not_show(spark, table):
    put(table, rows(spark, (1, "a", 1, "I"), (1, "b", 2, "U"), (2, "a", 1, "I"), (2, "a", 3, "D")), "b0")
    assert state(table) == {1: "b"}
    assert {(r.id, r.is_deleted) for r in table.read("soft").collect()} == {(1, False), (2, True)}
    assert table.read().columns == ["id", "v", "cdc_timestamp", "cdc_operation"]


@pytest.mark.parametrize("limit", ["10m", "-1"], ids=["broadcast", "buckets"])
def test_apply_then_compact(spark, table, limit, monkeypatch):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        apply_then_compact(spark, table)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def apply_then_compact(spark, table):
    put(table, rows(spark, *[(i, "a", 0, "I") for i in range(20)]), "b0")
    put(table, rows(spark, (1, "b", 1, "U"), (2, "b", 1, "D"), (30, "b", 1, "I")), "b1")
    put(table, rows(spark, (1, "c", 2, "U"), (2, "late", 0, "U")), "b2")
    expected = {i: "a" for i in range(20) if i != 2} | {1: "c", 30: "b"}
    assert table.pending_batches() == 2
    assert state(table) == expected
    assert table.compact() and table.version() == 2
    assert table.pending_batches() == 0
    assert state(table) == expected
    put(table, rows(spark, (2, "late", 0, "U")), "b3")
    assert state(table) == expected, "a late update must not bring a deleted key back"
    assert table.compact() and not table.compact()
    assert state(table) == expected


def test_replay_replaces_its_own_batch(spark, table):
    put(table, rows(spark, (1, "a", 0, "I")), "b0")
    batch = rows(spark, (1, "b", 1, "U"), (2, "b", 1, "I"))
    for _ in range(3):
        put(table, batch, "b1")
    assert table.pending_batches() == 1
    assert state(table) == {1: "b", 2: "b"}
    table.compact()
    put(table, batch, "b1")
    assert state(table) == {1: "b", 2: "b"}


def test_changes_without_some_columns(spark, table):
    put(table, rows(spark, (1, "a", 0, "I"), (2, "a", 0, "I")), "b0")
    put(table, rows(spark, (1, "x", 1, "U"), (3, "x", 1, "I")).drop("v"), "b1")
    assert state(table) == {1: "a", 2: "a", 3: None}


def test_first_load_without_change_columns(spark, table):
    put(table, rows(spark, (1, "a", 0, "I")).select("id", "v"), "full")
    put(table, rows(spark, (1, "b", 1, "U"), (2, "b", 1, "D"), (3, "b", 1, "I")), "b1")
    assert state(table) == {1: "b", 3: "b"}
    put(table, rows(spark, (1, "old", 0, "U")), "b2")
    assert state(table) == {1: "b", 3: "b"}


def test_without_times_the_batch_applied_last_counts(spark, table):
    def untimed(*items):
        return spark.createDataFrame(list(items), "id long, v string")

    put(table, untimed((1, "a"), (2, "a")), "b0")
    for n, value in enumerate(["z", "b", "m"]):
        put(table, untimed((1, value)), f"b{n + 1}")
        assert state(table) == {1: value, 2: "a"}
    table.merge_pending()
    put(table, untimed((1, "c")), "b9")
    assert state(table) == {1: "c", 2: "a"}
    table.compact()
    assert state(table) == {1: "c", 2: "a"}


def test_columns_are_stored_by_name(spark, table):
    put(table, rows(spark, (1, "a", 0, "I")), "b0")
    put(table, rows(spark, (1, "b", 1, "U")).select("cdc_operation", "v", "cdc_timestamp", "id"), "b1")
    assert state(table) == {1: "b"}


class Killed(Exception):
    """Stands for the death of the driver."""


@pytest.mark.parametrize("step", ["put_text", "_attached"])
@pytest.mark.parametrize("act", ["apply", "compact", "merge_pending", "rebucket"])
def test_a_driver_that_dies_anywhere_loses_nothing(spark, table, monkeypatch, act, step):
    """Whatever step of a write is the last, another driver reads the state before or after it and goes on."""
    put(table, rows(spark, *[(i, "a", 0, "I") for i in range(9)]), "b0")
    put(table, rows(spark, (1, "b", 1, "U"), (2, "b", 1, "D")), "b1")
    put(table, rows(spark, (1, "c", 2, "U")), "b2")
    before, batch = state(table), rows(spark, (3, "d", 3, "U"))
    after = {**before, 3: "d"}
    for calls in (1, 2):
        dying, n = KeyedTable(spark, table.path), [0]
        owner = dying if step == "_attached" else dying._storage
        real = getattr(owner, step)

        def fail(*args, real=real, n=n, calls=calls):
            n[0] += 1
            if n[0] == calls:
                raise Killed
            return real(*args)

        setattr(owner, step, fail)
        try:
            put(dying, batch, "b3") if act == "apply" else getattr(dying, act)()
        except Killed:
            pass
        assert state(KeyedTable(spark, table.path)) in (before, after)
    put(table, batch, "b3")
    assert state(table) == after
    table.compact()
    assert state(table) == after and table.expire() >= 0 and state(table) == after


def test_a_session_that_does_not_know_the_table_enters_it_again(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "table"), name="db_again.tbl")
    put(table, rows(spark, (1, "a", 0, "I"), (2, "a", 0, "I")), "b0")
    put(table, rows(spark, (1, "b", 1, "U")), "b1")
    spark.sql("DROP DATABASE db_again CASCADE")
    assert state(KeyedTable(spark, table.path, name="db_again.tbl")) == {1: "b", 2: "a"}
    put(table, rows(spark, (2, "b", 1, "U")), "b2")
    table.publish()
    assert {r.id: r.v for r in spark.table("db_again.tbl").collect()} == {1: "b", 2: "b"}


def test_the_name_follows_every_batch_and_version(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "table"), name="db_named.tbl")
    named = lambda: {r.id: r.v for r in spark.table("db_named.tbl").collect()}
    put(table, rows(spark, (1, "a", 0, "I"), (2, "a", 0, "I")), "b0")
    assert named() == {1: "a", 2: "a"}
    put(table, rows(spark, (1, "b", 1, "U"), (2, "b", 1, "D")), "b1")
    assert named() == {1: "b"}
    table.compact()
    assert named() == {1: "b"} and spark.table("db_named.tbl").columns == ["id", "v", "cdc_timestamp", "cdc_operation"]


def test_many_changes_meet_the_base_without_a_shuffle(spark, table):
    put(table, rows(spark, *[(i, "a", 0, "I") for i in range(50)]), "b0")
    put(table, rows(spark, *[(i, "b", 1, "U") for i in range(0, 50, 3)]), "b1")
    put(table, rows(spark, *[(i, "c", 2, "U") for i in range(0, 50, 5)]), "b2")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        current = table.read().where("v = 'a'")
        plan = current._jdf.queryExecution().executedPlan().toString()
        assert current.count() == sum(1 for i in range(50) if i % 3 and i % 5)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange" not in plan and "SortMergeJoin" in plan
    assert "EqualTo(v,a)" in plan


def test_key_text_tells_keys_apart(spark):
    rows = [("a", None), (None, "a"), ("a", "b"), ("ab", ""), ("a1:", "b"), ("", ""), (None, None), ("-", "-")]
    df = spark.createDataFrame(rows, "a string, b string")
    texts = [r[0] for r in df.select(key_text(df.schema.fields, ["a", "b"])).collect()]
    assert None not in texts and len(set(texts)) == len(rows)
    numbers = spark.createDataFrame([(0.0,), (-0.0,)], "x double")
    assert numbers.select(key_text(numbers.schema.fields, ["x"])).distinct().count() == 1


def test_keys_may_be_null(spark, table):
    df = spark.createDataFrame([(None, "a"), (1, "a")], "id long, v string")
    put(table, df, "b0")
    put(table, spark.createDataFrame([(None, "b")], "id long, v string"), "b1")
    assert state(table) == {None: "b", 1: "a"}


def test_a_commit_is_whole_or_absent(spark, table):
    storage = table._storage
    storage.put_text(f"{table.path}/x.json", "one")
    with pytest.raises(PathTaken):
        storage.put_text(f"{table.path}/x.json", "two")
    assert storage.read_text(f"{table.path}/x.json") == "one"
    assert [n for n in storage.names(table.path) if "x.json" in n] == ["x.json"]


def test_type_drift_is_an_error_and_widening_is_not(spark, table):
    put(table, spark.createDataFrame([(1, 5)], "id long, n long"), "b0")
    put(table, spark.createDataFrame([(2, 6)], "id int, n int"), "b1")
    with pytest.raises(TypeDrift, match="n: string"):
        put(table, spark.createDataFrame([(1, "many")], "id long, n string"), "b2")
    assert {r.id: r.n for r in table.read().collect()} == {1: 5, 2: 6}


def test_maintenance(spark, table):
    put(table, rows(spark, *[(i, "a", 0, "I") for i in range(50)]), "b0")
    put(table, rows(spark, (1, "b", 1, "U"), (2, "b", 1, "D")), "b1")
    put(table, rows(spark, (1, "c", 2, "U"), (60, "c", 1, "I")), "b2")
    expected = state(table)
    assert table.maintain(max_batches=3) == "none"
    version = table.version()
    assert table.maintain(max_batches=2, ratio=100) == "merged"
    assert table.pending_batches() == 1 and table.version() == version
    assert state(table) == expected
    put(table, rows(spark, (2, "b", 1, "D"), (1, "c", 2, "U")), "b2")
    assert state(table) == expected
    assert table.maintain(max_batches=2, ratio=0.01) == "compacted"
    assert table.pending_batches() == 0 and state(table) == expected
    table.merge_pending()
    assert table.pending_batches() == 0


def test_expire_keeps_what_is_in_use(spark, table):
    put(table, rows(spark, *[(i, "a", 0, "I") for i in range(9)]), "b0")
    for n in range(3):
        put(table, rows(spark, *[(i, f"v{n}", n + 1, "U") for i in range(9)]), f"b{n + 1}")
        table.compact()
    put(table, rows(spark, (1, "last", 9, "U")), "b9")
    expected = state(table)
    assert table.expire(keep=1) > 0
    assert state(table) == expected
    assert len(table._storage.names(f"{table.path}/base")) == 1
    batches = [n for n in table._storage.names(f"{table.path}/changes") if n.startswith("_seq=")]
    assert [len(table._storage.names(f"{table.path}/changes/{n}")) for n in batches] == [1]
    assert table.expire(keep=1) == 0


def test_buckets_can_change(spark, table):
    put(table, rows(spark, *[(i, "a", 0, "I") for i in range(200)]), "b0")
    put(table, rows(spark, (1, "b", 1, "U"), (2, "b", 1, "D"), (900, "b", 1, "I")), "b1")
    before = state(table)
    assert table.rebucket(64) == 64 and table.settings().buckets == 64 and table.pending_batches() == 0
    assert state(table) == before
    put(table, rows(spark, (2, "late", 0, "U"), (3, "c", 2, "U")), "b2")
    table.compact()
    assert state(table) == {**before, 3: "c"}
    assert table.rebucket() == 8 and state(table) == {**before, 3: "c"}


def test_buckets_too_few_are_no_tasks(spark, table, monkeypatch):
    """Big buckets are written by several tasks, and dealt anew without a task reading a whole one."""
    plans, real = [], KeyedTable._write_version

    def write(self, df, settings):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        real(self, df, settings)

    monkeypatch.setattr(KeyedTable, "_write_version", write)
    many = spark.range(20_000, numPartitions=4).select("id", F.md5(F.col("id").cast("string")).alias("v"))
    settings = {"adaptive.advisoryPartitionSizeInBytes": "32k", "adaptive.coalescePartitions.minPartitionSize": "16k"}
    settings |= {"autoBroadcastJoinThreshold": "-1"}
    for name, value in settings.items():
        spark.conf.set(f"spark.sql.{name}", value)
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        table.apply(many, "b0", keys=["id"], buckets=2)
        files = [n for n in table._storage.names(f"{table.path}/base/v{1:012d}") if n.endswith(".parquet")]
        assert len(files) > 2
        table.apply(many.where("id % 2 = 0").withColumn("v", F.lit("even")), "b1", keys=["id"])
        figures = [F.count("id"), F.count_if(F.col("v") == "even"), F.sum(F.crc32("v"))]
        before = table.read().agg(*figures).first()
        table.rebucket(16)
        assert "Bucketed: true" not in plans[-1]
        assert table.read().agg(*figures).first() == before
        assert before[:2] == (20_000, 10_000)
    finally:
        for name in settings:
            spark.conf.unset(f"spark.sql.{name}")
        spark.conf.set("spark.sql.shuffle.partitions", "2")


def test_register_gives_the_table_a_name(spark, table):
    put(table, rows(spark, (1, "a", 0, "I")), "b0")
    table.register("my_users")
    assert spark.table("my_users").count() == 1


def test_bucket_count_that_does_not_fit_the_shuffle(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "odd"))
    table.apply(rows(spark, *[(i, "a", 0, "I") for i in range(40)]), "b0", keys=["id"],
                op="cdc_operation", order_by=["cdc_timestamp"], buckets=3)
    assert len(state(table)) == 40
    assert len(files_of(table)) == 3


def test_aligned_buckets_need_one_shuffle_and_one_file_each(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "even"))
    table.apply(rows(spark, *[(i, "a", 0, "I") for i in range(400)]), "b0", keys=["id"],
                op="cdc_operation", order_by=["cdc_timestamp"], buckets=4)
    assert len(files_of(table)) == 4


def files_of(table):
    return [n for n in table._storage.names(f"{table.path}/base/v{table.version():012d}") if n.endswith(".parquet")]


@pytest.mark.parametrize(
    "size, buckets",
    [(0, 8), (2**30, 8), (3 * 2**30, 16), (10**12, 4096), (10**14, 2**19), (2**63 - 1, 16)],
)
def test_buckets_follow_the_size(size, buckets):
    assert keyed_table._bucket_count(size) == buckets


def test_first_load_shuffles_once(spark, tmp_path, monkeypatch):
    plans, write = [], KeyedTable._write_version

    def keep_plan(self, rows, settings):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        return write(self, rows, settings)

    monkeypatch.setattr(KeyedTable, "_write_version", keep_plan)
    put(KeyedTable(spark, str(tmp_path / "t")), rows(spark, (1, "a", 0, "I")), "b0")
    assert plans[0].count("Exchange") == 1 and "Join" not in plans[0]


def test_filters_reach_the_base_scan(spark, table):
    put(table, rows(spark, *[(i, "a", 0, "I") for i in range(9)]), "b0")
    put(table, rows(spark, (1, "b", 1, "U")), "b1")
    plan = table.read().where("v = 'a'").select("id")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(v,a)" in plan


def deleted(table):
    return {r.id for r in table.read("soft").collect() if r.is_deleted}


def test_old_deletes_go_and_late_changes_above_the_mark_revive_nothing(spark, table):
    put(table, rows(spark, (1, "a", 0, "I"), (2, "a", 0, "I"), (3, "a", 0, "I"), (4, "a", 0, "I")), "b0")
    put(table, rows(spark, (1, "a", 1, "D"), (2, "a", 8, "D"), (3, "a", 1, "D")), "b1")
    table.compact()
    put(table, rows(spark, (4, "b", 10, "U"), (3, "late", 0, "U")), "b2")
    assert table.low_water_mark("5 minutes") == "2026-06-30 10:05:00"
    table.compact("5 minutes")
    # 1 is older than the mark; 2 is not; a change waited for 3, so it stays until the next fold
    assert deleted(table) == {2, 3} and state(table) == {4: "b"}
    put(table, rows(spark, (2, "late", 6, "U")), "b3")
    assert deleted(table) == {2, 3} and state(table) == {4: "b"}
    table.compact("5 minutes")
    assert deleted(table) == {2} and state(table) == {4: "b"}


def test_a_driver_that_dies_after_a_purge_revives_nothing(spark, table, monkeypatch):
    put(table, rows(spark, (1, "a", 0, "I"), (9, "a", 30, "I")), "b0")
    put(table, rows(spark, (1, "a", 1, "D")), "b1")
    table.compact()
    put(table, rows(spark, (1, "late", 0, "U")), "b2")
    monkeypatch.setattr(KeyedTable, "_drop_batches", lambda *args: (_ for _ in ()).throw(RuntimeError("dead")))
    with pytest.raises(RuntimeError):
        table.compact("5 minutes")
    monkeypatch.undo()
    assert table.pending_batches() == 1 and state(table) == {9: "a"}


def test_a_change_far_in_the_future_does_not_move_the_mark(spark, table):
    put(table, rows(spark, (1, "a", 0, "I"), (2, "a", 60 * 24 * 365 * 50, "I")), "b0")
    assert table.low_water_mark("1 day") < "2060"
    untimed = KeyedTable(spark, table.path + "_untimed")
    untimed.apply(rows(spark, (1, "a", 0, "I")).select("id", "v"), "b0", keys=["id"], buckets=4)
    assert untimed.low_water_mark("1 day") is None
    untimed.apply(rows(spark, (1, "b", 0, "I")).select("id", "v"), "b1", keys=["id"])
    assert untimed.compact("1 day") and state(untimed) == {1: "b"}


def test_a_declared_column_that_the_first_batch_lacks(spark, table):
    put(table, rows(spark, (1, "a", 0, "I"), (2, "a", 0, "I")), "b0", declared={"id": T.LongType(), "w": T.IntegerType()})
    put(table, rows(spark, (1, "b", 1, "U")).withColumn("w", F.lit(7)), "b1")
    assert {(r.id, r.v, r.w) for r in table.read().collect()} == {(1, "b", 7), (2, "a", None)}


def test_a_fold_with_a_retention_shuffles_no_base_row(spark, table):
    put(table, rows(spark, *[(i, "a", 0, "I") for i in range(50)]), "b0")
    put(table, rows(spark, *[(i, "a", 9, "D") for i in range(9)]), "b1")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        settings = table._attached()
        kept = spark.sql(table._view(settings).kept(table._expired(settings, "5 minutes")))
        assert "Exchange" not in kept._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
