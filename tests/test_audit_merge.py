from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from changeloom.operators.audit import RUN_LOG
from changeloom.sinks.audit import merge_closed_runs, read_audit, write_audit
from changeloom.storage import Storage

NAME = "db_audit_merge.runs"


def put(spark, path, key, day):
    ended = F.lit(datetime(2026, 6, day, 10)).cast("timestamp")
    values = {"execution_id": F.lit(key), "execution_end": ended, "reference_date": ended.cast("date")}
    row = spark.range(1).select(*[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in RUN_LOG.fields])
    write_audit(row, path, key, NAME)


def runs(spark, path):
    by_path = sorted(r.execution_id for r in read_audit(spark, path, RUN_LOG).collect())
    assert by_path == sorted(r.execution_id for r in spark.table(NAME).collect())
    return by_path


def folders(spark, path):
    return [n for n in Storage(spark).names(path) if "=" in n]


@pytest.fixture
def path(spark, tmp_path):
    path = str(tmp_path / "runs")
    for key, day in (("a", 1), ("b", 1), ("c", 2), ("d", 9)):
        put(spark, path, key, day)
    return path


def test_closed_days_are_merged_and_open_ones_stay(spark, path):
    assert merge_closed_runs(spark, path, RUN_LOG, date(2026, 6, 5), NAME) == 3
    assert runs(spark, path) == ["a", "b", "c", "d"]
    assert len(folders(spark, path)) == 2 and "run_key=d" in folders(spark, path)
    assert merge_closed_runs(spark, path, RUN_LOG, date(2026, 6, 5), NAME) == 0
    put(spark, path, "e", 9)
    assert merge_closed_runs(spark, path, RUN_LOG, date(2026, 7, 1), NAME) == 2
    assert runs(spark, path) == ["a", "b", "c", "d", "e"] and len(folders(spark, path)) == 2


def test_an_empty_table_has_nothing_to_merge(spark, tmp_path):
    assert merge_closed_runs(spark, str(tmp_path / "none"), RUN_LOG, date(2026, 6, 5)) == 0


@pytest.mark.parametrize(("act", "step"), [("put_text", 1), ("remove", 1), ("remove", 2), ("move", 1), ("remove", 4)])
def test_a_call_that_dies_anywhere_is_finished_by_the_next(spark, path, monkeypatch, act, step):
    calls, real = [], getattr(Storage, act)

    def fail(*args):
        calls.append(args)
        if len(calls) == step:
            raise RuntimeError("dead")
        return real(*args)

    monkeypatch.setattr(Storage, act, fail)
    with pytest.raises(RuntimeError):
        merge_closed_runs(spark, path, RUN_LOG, date(2026, 6, 5), NAME)
    monkeypatch.undo()
    merge_closed_runs(spark, path, RUN_LOG, date(2026, 6, 5), NAME)
    assert runs(spark, path) == ["a", "b", "c", "d"]
    assert len(folders(spark, path)) == 2 and not Storage(spark).names(f"{path}/_merging")
