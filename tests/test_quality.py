import itertools
import json
from datetime import datetime, timezone

import pytest
from pyspark.sql import types as T

from changeloom import LoadPlan, TargetSpec
from changeloom.functions.types import resolve_type
from changeloom.operators.quality import (
    REJECT_METADATA,
    RULE,
    QualityOptions,
    cast_to_schema,
    combine_rejects,
    rule_counts,
    tag_rules,
    validate,
)
from tests.meters import TIME, meters, meters_spec

AT = datetime(2026, 7, 1, 12, 0, 0, 987654, tzinfo=timezone.utc)


def split(df, source, **options):
    return validate(df, source.target, source, rejected_at=AT, options=QualityOptions(**options))


def rules(df, source, **options):
    return [r[RULE] for r in tag_rules(df, source.target, source, QualityOptions(**options)).collect()]


@pytest.mark.parametrize(
    "rows, expected",
    [
        ([(1, "AA", "active", TIME), (2, "DL", "read", TIME)], [None, None]),
        ([(None, "AA", "active", TIME), (2, "DL", "read", TIME)], ["type_cast", None]),
        ([(None, None, "active", TIME)], ["type_cast"]),
        ([(1, "AA", "invalid_status", TIME), (2, "DL", "active", TIME)], ["enum_check", None]),
        ([(1, "AA", None, TIME)], [None]),
    ],
)
def test_rules_on_meters(spark, rows, expected):
    assert rules(meters(spark, *rows).coalesce(1), meters_spec()) == expected


def test_empty_input(spark):
    valid, rejects = split(meters(spark), meters_spec())
    assert valid.isEmpty() and rejects.isEmpty()


def test_reject_metadata(spark):
    _, rejects = split(meters(spark, (1, "AA", "bad_status", TIME)), meters_spec())
    row = rejects.first()
    assert (row._reject_table, row._reject_rule) == ("tbl_meters", "enum_check")
    assert rejects.selectExpr("string(_reject_timestamp)").first()[0] == "2026-07-01 12:00:00"
    assert rejects.columns == ["meter_id", "zone", "status", "dms_timestamp", *REJECT_METADATA.names]


def test_without_primary_key_nothing_is_rejected(spark):
    source = LoadPlan.from_dicts({"target": {"schema": {"col1": "string"}}}).sources[0]
    valid, rejects = split(spark.createDataFrame([("hello",)], "col1 string"), source)
    assert (valid.count(), rejects.count()) == (1, 0)


def test_primary_key_must_be_in_the_input(spark):
    with pytest.raises(ValueError, match="meter_id"):
        tag_rules(meters(spark).drop("meter_id"), meters_spec().target)


def test_only_the_first_key_column_is_a_type_error(spark):
    source = meters_spec(
        primary_key=["meter_id", "leg"],
        schema={"meter_id": "bigint", "leg": {"type": "int", "nullable": False}, "note": "string"},
    )
    df = spark.createDataFrame([("1", "x", "n"), ("x", "1", "n"), ("1", "1", None)], "meter_id string, leg string, note string")
    assert rules(df.coalesce(1), source) == ["null_check", "type_cast", None]


@pytest.mark.parametrize(
    "declared, expected",
    [
        ("bigint", T.LongType()), ("STRING", T.StringType()), ("timestamp", T.TimestampType()),
        ("unknown_type", T.StringType()), ("varchar(20)", T.StringType()), ("decimal(10,7)", T.DecimalType(38, 18)),
        ("smallint", T.IntegerType()), ("float", T.DoubleType()), ("timestamptz", T.TimestampType()),
        ("bool", T.BooleanType()), ("date", T.DateType()),
    ],
)
def test_type_names(declared, expected):
    assert resolve_type(declared) == expected


def test_declared_order_then_the_rest_and_drift(spark):
    source = meters_spec(schema={"status": "string", "gone": {"type": "int", "nullable": False}, "meter_id": "bigint"})
    df = spark.createDataFrame([("7", "x", "active")], "meter_id string, extra string, status string")
    out = cast_to_schema(df, source.target)
    assert out.schema.simpleString() == "struct<status:string,meter_id:bigint,extra:string>"
    assert rules(df, source) == [None]


def test_names_match_by_exact_case(spark):
    df = spark.createDataFrame([("7",)], "Flight_Id string")
    out = cast_to_schema(df, TargetSpec.parse({"schema": {"meter_id": "bigint"}}))
    assert out.schema.simpleString() == "struct<Flight_Id:string>"


def test_odd_column_names(spark):
    df = spark.createDataFrame([("7", "8")], "`a.b` string, `c``d` string")
    out = cast_to_schema(df, TargetSpec.parse({"schema": {"a.b": "int"}}))
    assert tuple(out.first()) == (7, "8")


def test_bad_values_become_null_and_never_fail(spark):
    target = TargetSpec.parse(
        {"schema": {"i": "int", "d": "decimal(5,2)", "t": "timestamp", "day": "date", "b": "boolean", "f": "double"}}
    )
    df = spark.createDataFrame(
        [("x", "9" * 30, "2026-13-01", "soon", "maybe", "1e3"), (" 12 ", "1.5", "2026-01-02 03:04:05", "2026-01-02", "t", "")],
        "i string, d string, t string, day string, b string, f string",
    )
    first, second = cast_to_schema(df.coalesce(1), target).collect()
    assert tuple(first) == (None, None, None, None, None, 1000.0)
    assert second.i == 12 and second.b is True and second.f is None and second.t == datetime(2026, 1, 2, 3, 4, 5)


def test_types_without_a_cast_become_null(spark):
    df = spark.sql("SELECT 1L AS id, date'2026-01-01' AS day")
    target = TargetSpec.parse({"schema": {"id": "int", "day": "int"}})
    out = cast_to_schema(df, target)
    assert out.schema.simpleString() == "struct<id:int,day:int>"
    assert tuple(out.first()) == (1, None)


def test_enum_on_the_operation_uses_its_source_name(spark):
    df = meters(spark, (1, "active", "X"), (2, "active", "D"), columns="meter_id long, status string, Op string")
    assert rules(df.coalesce(1), meters_spec()) == ["enum_check", None]


def test_empty_enum_list_and_missing_enum_column(spark):
    source = meters_spec(enum_columns={"status": [], "nowhere": ["a"]})
    assert rules(meters(spark, (1, "AA", "anything", TIME)), source) == [None]


def test_enum_on_a_number(spark):
    source = meters_spec(enum_columns={"meter_id": ["1", "2"]})
    assert rules(meters(spark, (1, "A", "x", TIME), (3, "A", "x", TIME)).coalesce(1), source) == [None, "enum_check"]


STRICT = {
    "meter_id": {"type": "bigint", "nullable": False},
    "gate": "int",
    "status": "string",
    "departed": "timestamp",
}


def strict_rows(spark):
    columns = "meter_id string, gate string, status string, departed string"
    rows = [
        ("1", "5", "active", "2026-01-01 00:00:00"),
        ("2", "five", "active", "2026-01-01 00:00:00"),
        ("3", "5", "active", "yesterday"),
        ("4", "5", "bad", "yesterday"),
        ("5", None, "active", None),
        ("x", "5", "active", "yesterday"),
    ]
    return spark.createDataFrame(rows, columns).coalesce(1)


def test_lenient_and_strict_casts(spark):
    source = meters_spec(schema=STRICT)
    assert rules(strict_rows(spark), source) == [None, None, None, "enum_check", None, "type_cast"]
    assert rules(strict_rows(spark), source, casts="strict") == [
        None, "type_cast", "timestamp_check", "enum_check", None, "type_cast"
    ]
    with pytest.raises(ValueError):
        QualityOptions(casts="other")


def test_strict_leaves_no_helper_columns(spark):
    valid, rejects = split(strict_rows(spark), meters_spec(schema=STRICT), casts="strict")
    assert valid.columns == ["meter_id", "gate", "status", "departed"]
    assert rejects.columns == [*valid.columns, *REJECT_METADATA.names]


def test_keep_raw(spark):
    valid, rejects = split(strict_rows(spark), meters_spec(schema=STRICT), casts="strict", keep_raw=True)
    assert "_reject_raw" not in valid.columns
    raw = {r.meter_id: json.loads(r._reject_raw) for r in rejects.collect()}
    assert raw[2]["gate"] == "five" and raw[None]["meter_id"] == "x"


def test_key_only_deletes(spark):
    schema = {"meter_id": {"type": "bigint", "nullable": False}, "status": {"type": "string", "nullable": False}}
    source = meters_spec(schema=schema)
    df = meters(
        spark, (1, None, "D"), (2, None, "U"), (None, None, "D"), (3, "odd", "D"), (4, None, None),
        columns="meter_id long, status string, Op string",
    ).coalesce(1)
    assert rules(df, source) == ["null_check", "null_check", "type_cast", "enum_check", "null_check"]
    assert rules(df, source, validate_deletes=False) == [None, "null_check", "type_cast", None, "null_check"]


def staged(row):
    """Rule by rule, the way a chain of filters would see the row."""
    flight, cust, status = row
    if flight is None or not flight.isdigit():
        return "type_cast"
    if cust is None or not cust.isdigit():
        return "null_check"
    if status is not None and status not in ("O", "F"):
        return "enum_check"
    return None


def test_single_pass_equals_the_stages(spark):
    source = meters_spec(
        schema={"meter_id": {"type": "bigint", "nullable": False}, "cust": {"type": "bigint", "nullable": False}, "status": "string"},
        enum_columns={"status": ["O", "F"]},
    )
    rows = list(itertools.product(["1", "x", "", None], ["1", "x", "", None], ["O", "P", "", None]))
    df = spark.createDataFrame(rows, "meter_id string, cust string, status string").coalesce(1)
    assert rules(df, source) == [staged(r) for r in rows]
    counts = {r[RULE]: r.n_rows for r in rule_counts(tag_rules(df, source.target, source)).collect()}
    assert sum(counts.values()) == len(rows)


def test_rejects_of_several_tables(spark):
    _, first = split(meters(spark, (None, "AA", "active", TIME)), meters_spec())
    _, second = split(spark.createDataFrame([(None, 5)], "meter_id long, other int"), meters_spec())
    both = combine_rejects([first, second])
    assert both.count() == 2 and {"zone", "other"} <= set(both.columns)


def test_counting_reads_only_rule_columns(spark, tmp_path):
    meters(spark, (1, "AA", "active", TIME)).write.parquet(str(tmp_path / "f"))
    tagged = tag_rules(spark.read.parquet(str(tmp_path / "f")), meters_spec().target)
    plan = rule_counts(tagged)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<meter_id:bigint,status:string>" in plan
