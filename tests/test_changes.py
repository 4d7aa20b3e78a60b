import itertools
import random
from datetime import datetime, timedelta

import pytest

from changeloom.operators.changes import (
    IS_DELETED,
    apply_changes,
    classify_changes,
    duplicate_keys,
    latest_change,
    pick_strategy,
)

T0 = datetime(2026, 6, 30, 10)
BASE = "k1 string, k2 string, v string, ts timestamp, seq long"
CHANGES = "k1 string, k2 string, v string, ts timestamp, seq long, op string"
KEYS = ["k1", "k2"]
ORDER = ["ts", "seq"]


def at(minute):
    return None if minute is None else T0 + timedelta(minutes=minute)


def base_frame(spark, rows):
    return spark.createDataFrame([(a, b, v, at(t), s) for a, b, v, t, s in rows], BASE)


def change_frame(spark, rows):
    return spark.createDataFrame([(a, b, v, at(t), s, o) for a, b, v, t, s, o in rows], CHANGES)


def state(df):
    rows = df.select("k1", "k2", "v").collect()
    assert len({(r.k1, r.k2) for r in rows}) == len(rows)
    return {(r.k1, r.k2): r.v for r in rows}


# name: (table, changes, table afterwards)
CASES = {
    "insert then delete": ([], [("a", "x", "1", 1, 1, "I"), ("a", "x", "1", 2, 2, "D")], {}),
    "delete then insert": (
        [("a", "x", "0", 0, 0)],
        [("a", "x", "1", 1, 1, "D"), ("a", "x", "2", 2, 2, "I")],
        {("a", "x"): "2"},
    ),
    "two updates": (
        [("a", "x", "0", 0, 0)],
        [("a", "x", "2", 2, 2, "U"), ("a", "x", "1", 1, 1, "U")],
        {("a", "x"): "2"},
    ),
    "unknown delete": ([], [("a", "x", "1", 1, 1, "D")], {}),
    "no operation": (
        [("a", "x", "0", 0, 0)],
        [("a", "x", "1", 1, 1, None), ("b", "x", "1", 1, 1, None)],
        {("a", "x"): "1", ("b", "x"): "1"},
    ),
    "late change": ([("a", "x", "0", 5, 0)], [("a", "x", "1", 1, 1, "U")], {("a", "x"): "0"}),
    "late delete": ([("a", "x", "0", 5, 0)], [("a", "x", "1", 1, 1, "D")], {("a", "x"): "0"}),
    "lower sequence": ([("a", "x", "0", 5, 3)], [("a", "x", "1", 5, 2, "U")], {("a", "x"): "0"}),
    "tie is applied": ([("a", "x", "0", 5, 3)], [("a", "x", "1", 5, 3, "U")], {("a", "x"): "1"}),
    "stored time missing": ([("a", "x", "0", None, None)], [("a", "x", "1", 1, 1, "U")], {("a", "x"): "1"}),
    "change time missing": ([("a", "x", "0", 1, 1)], [("a", "x", "1", None, 9, "U")], {("a", "x"): "0"}),
    "NULL key part and keys alike as text": (
        [("a", None, "0", 0, 0), ("a_b", "c", "0", 0, 0)],
        [("a", None, "1", 1, 1, "U"), ("a", "b_c", "1", 1, 1, "I")],
        {("a", None): "1", ("a_b", "c"): "0", ("a", "b_c"): "1"},
    ),
}


@pytest.mark.parametrize("strategy", ["join", "shuffle"])
def test_hand_cases(spark, strategy):
    """All cases in one table, kept apart by a prefix on the key."""
    base, changes, expected = [], [], {}
    for name, (before, incoming, after) in CASES.items():
        base += [(f"{name}/{row[0]}", *row[1:]) for row in before]
        changes += [(f"{name}/{row[0]}", *row[1:]) for row in incoming]
        expected |= {(f"{name}/{a}", b): v for (a, b), v in after.items()}
    out = apply_changes(
        base_frame(spark, base), change_frame(spark, changes), KEYS, "op", ORDER, strategy=strategy
    )
    assert out.columns == ["k1", "k2", "v", "ts", "seq"]
    assert state(out) == expected


@pytest.mark.parametrize("strategy", ["join", "shuffle"])
def test_without_operation_column_everything_is_an_upsert(spark, strategy):
    changes = change_frame(spark, [("a", "x", "1", 1, 1, "D"), ("b", "x", "2", 1, 1, "D")]).drop("op")
    out = apply_changes(base_frame(spark, [("a", "x", "0", 0, 0)]), changes, KEYS, "op", ORDER, strategy=strategy)
    assert state(out) == {("a", "x"): "1", ("b", "x"): "2"}


@pytest.mark.parametrize("strategy", ["join", "shuffle"])
def test_soft_delete_keeps_the_delete_record(spark, strategy):
    changes = change_frame(spark, [("a", "x", "gone", 1, 1, "D"), ("b", "x", "never", 1, 1, "D")])
    base = base_frame(spark, [("a", "x", "0", 0, 0), ("c", "x", "0", 0, 0)])
    out = apply_changes(base, changes, KEYS, "op", ORDER, "soft", strategy=strategy)
    rows = {(r.k1, r.v, r[IS_DELETED]) for r in out.collect()}
    assert rows == {("a", "gone", True), ("b", "never", True), ("c", "0", False)}


@pytest.mark.parametrize("strategy", ["join", "shuffle"])
def test_columns_that_changes_lack_keep_the_stored_value(spark, strategy):
    base = base_frame(spark, [("a", "x", "0", 0, 0)])
    changes = change_frame(spark, [("a", "x", "1", 1, 1, "U"), ("b", "x", "1", 1, 1, "I")]).drop("v")
    out = apply_changes(base, changes, KEYS, "op", ORDER, strategy=strategy)
    assert state(out) == {("a", "x"): "0", ("b", "x"): None}
    assert {r.k1: r.seq for r in out.collect()} == {"a": 1, "b": 1}


@pytest.mark.parametrize("strategy", ["join", "shuffle"])
def test_order_columns_the_table_does_not_store(spark, strategy):
    base = base_frame(spark, [("a", "x", "0", 9, 9)]).drop("ts", "seq")
    changes = change_frame(spark, [("a", "x", "2", 2, 2, "U"), ("a", "x", "1", 1, 1, "U")])
    out = apply_changes(base, changes, KEYS, "op", ORDER, strategy=strategy)
    assert out.columns == ["k1", "k2", "v"]
    assert state(out) == {("a", "x"): "2"}


def test_extra_columns_are_dropped_and_types_follow_the_table(spark):
    base = spark.createDataFrame([(1, 10)], "k long, n int")
    changes = spark.createDataFrame([(1, "11", "x", 1), (2, "bad", "y", 1)], "k int, n string, more string, seq int")
    out = apply_changes(base, changes, ["k"], None, ["seq"])
    assert out.schema.simpleString() == "struct<k:bigint,n:int>"
    assert {tuple(r) for r in out.collect()} == {(1, 11), (2, None)}


def test_classify(spark):
    base = base_frame(spark, [("a", "x", "0", 5, 5), ("b", "x", "0", 0, 0), ("c", "x", "0", 0, 0)])
    changes = change_frame(
        spark,
        [("a", "x", "1", 1, 1, "U"), ("b", "x", "1", 1, 1, "U"), ("c", "x", "1", 1, 1, "D"),
         ("d", "x", "1", 1, 1, "I"), ("e", "x", "1", 1, 1, "D")],
    )
    out = classify_changes(base, changes, KEYS, "op", ORDER)
    assert {r.k1: r._effect for r in out.collect()} == {
        "a": "stale", "b": "update", "c": "delete", "d": "insert", "e": "unknown_delete"
    }


def test_ties_are_settled_the_same_way_for_any_layout(spark):
    rows = [("a", "x", str(i), 1, 1, "U") for i in range(50)]
    seen = set()
    for parts in (1, 3, 7):
        random.Random(parts).shuffle(rows)
        seen.add(latest_change(change_frame(spark, rows).repartition(parts), KEYS, ORDER).first().v)
    assert len(seen) == 1


@pytest.mark.parametrize("seed", range(3))
def test_ties_have_one_result_for_any_plan_and_split(spark, seed):
    draw = random.Random(seed)
    rows = [(str(draw.randint(1, 9)), "x", draw.choice("abc"), draw.randint(0, 1), None, draw.choice("IUUD")) for _ in range(40)]
    changes = change_frame(spark, rows).drop("seq")
    base = base_frame(spark, [(str(i), "x", "b", draw.choice([0, 1]), None) for i in range(5)]).drop("seq")
    results = []
    for strategy in ("join", "shuffle"):
        for parts in ([rows], [rows[:13], rows[13:25], rows[25:]], [rows[25:], rows[:13], rows[13:25]]):
            table = base
            for part in parts:
                table = apply_changes(table, change_frame(spark, part).drop("seq"), KEYS, "op", ["ts"], "soft", strategy=strategy)
            results.append(sorted(map(tuple, table.select(*base.columns, IS_DELETED).collect())))
    assert changes.count() == 40 and all(r == results[0] for r in results)


def test_duplicate_keys(spark):
    df = change_frame(spark, [("a", "x", "1", 1, 1, "U"), ("a", "x", "2", 2, 2, "U"), ("b", "x", "1", 1, 1, "U")])
    assert [tuple(r) for r in duplicate_keys(df, KEYS).collect()] == [("a", "x", 2)]


def test_rejects_unknown_choices(spark):
    df = base_frame(spark, [])
    with pytest.raises(ValueError):
        apply_changes(df, df, KEYS, deletes="maybe")
    with pytest.raises(ValueError):
        apply_changes(df, df, KEYS, strategy="magic")


def fold(base, changes):
    """One change after the other in time order: what the table must end up as."""
    held = {(a, b): (v, False) for a, b, v, _, _ in base}
    for a, b, v, _, _, op in sorted(changes, key=lambda c: (c[3], c[4])):
        held[(a, b)] = (v, op == "D")
    return {key: v for key, (v, gone) in held.items() if not gone}


def test_any_split_order_and_replay_gives_the_fold(spark):
    rng = random.Random(42)
    keys = [(a, b) for a, b in itertools.product("abcdefghijklmnopqrst", ["x", None])]
    base = [(a, b, "base", -1, 0) for a, b in keys if rng.random() < 0.5]
    changes = [
        (*rng.choice(keys), f"v{i}", rng.randrange(6), i, rng.choice(["I", "U", "D", None])) for i in range(200)
    ]
    expected = fold(base, changes)
    whole = [changes]
    batches = [changes[0::3], changes[1::3], changes[2::3]]
    for plan in (whole, batches, batches[::-1], [*batches, batches[0], batches[1]]):
        for strategy in ("join", "shuffle"):
            table = base_frame(spark, base)
            for batch in plan:
                table = apply_changes(
                    table, change_frame(spark, batch), KEYS, "op", ORDER, "soft", strategy=strategy
                )
            assert state(table.where(f"not {IS_DELETED}")) == expected


def test_a_hot_key_is_cut_down_before_the_shuffle(spark):
    df = change_frame(spark, [("a", "x", "1", 1, 1, "U")])
    plan = latest_change(df, KEYS, ORDER)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan


def test_the_strategy_follows_the_size_of_the_changed_keys(spark, tmp_path):
    spark.range(2_000).selectExpr("id k", "uuid() v", "id seq").write.parquet(str(tmp_path / "c"))
    changes = spark.read.parquet(str(tmp_path / "c"))
    assert pick_strategy(changes, ["k"], ["seq"]) == "join"
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1000")
    try:
        assert pick_strategy(changes, ["k"], ["seq"]) == "shuffle"
        out = apply_changes(changes, changes, ["k"], None, ["seq"])
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "Join" not in plan and plan.count("Exchange") == 1
        assert out.count() == 2_000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_a_small_change_set_leaves_the_table_unshuffled(spark, tmp_path):
    wide = spark.range(50_000).selectExpr("string(id) k1", "'x' k2", "'v' v", "timestamp'2026-01-01' ts", "id seq")
    wide.write.parquet(str(tmp_path / "base"))
    change_frame(spark, [("1", "x", "1", 1, 1, "U")]).write.parquet(str(tmp_path / "changes"))
    out = apply_changes(
        spark.read.parquet(str(tmp_path / "base")), spark.read.parquet(str(tmp_path / "changes")),
        KEYS, "op", ORDER, reduced=True,
    )
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    assert out.count() == 50_000
