import json

import pytest

from changeloom import CdcSpec, ColumnSpec, LoadPlan, PartitionSpec, SourceSpec, TargetSpec

SOURCE = {
    "source": "parcels",
    "order": 3,
    "cdc_source_location": "/drop/parcels/changes",
    "checkpoint_location": "/state/parcels",
    "cdc_config": {"op_column": "kind", "delete_strategy": "soft_delete"},
    "target": {
        "catalog": {"database": "post", "table": "parcels"},
        "compression": "zstd",
        "schema": {"depot": "string", "parcel_no": {"type": "bigint", "nullable": False, "comment": "per depot"}, "grams": "int"},
        "primary_key": ["depot", "parcel_no"],
        "cod_unique_expr": {"columns": ["parcel_no", "depot"], "separator": "/"},
        "partition_keys": [{"name": "depot"}],
        "enum_columns": {"depot": ["north", "south"], "grams": None},
    },
}


def test_defaults():
    assert ColumnSpec("string") == ColumnSpec("string", True, "")
    assert PartitionSpec("event_date") == PartitionSpec("event_date", "string", None)
    assert CdcSpec() == CdcSpec("Op", "dms_timestamp", "")
    target = TargetSpec()
    assert (target.format, target.compression, target.database, target.table) == ("delta", "snappy", "", "")
    assert (target.key_columns, target.key_separator, target.partition_text) == ((), "_", "")
    source = SourceSpec()
    assert (source.source, source.order, source.format, source.cdc) == ("", 0, "parquet", None)


@pytest.mark.parametrize("data", [SOURCE, [SOURCE], {"sources": [SOURCE]}, {"sources": {"any": SOURCE}}])
def test_accepted_shapes(data):
    plan = LoadPlan.from_dicts(data)
    assert [s.source for s in plan.sources] == ["parcels"]
    assert plan["parcels"].target.table == "parcels"
    assert plan["parcels"].cdc == CdcSpec("kind", "dms_timestamp", "soft_delete")
    assert plan["parcels"].cdc.deletes == "soft" and CdcSpec().deletes == "hard"


def test_parsed_target():
    target = LoadPlan.from_dicts(SOURCE)["parcels"].target
    assert (target.database, target.compression, target.format) == ("post", "zstd", "delta")
    assert target.schema["depot"] == ColumnSpec("string")
    assert target.schema["parcel_no"] == ColumnSpec("bigint", False, "per depot")
    assert target.key_columns == ("parcel_no", "depot") and target.key_separator == "/"
    assert target.enum_columns == {"depot": ("north", "south"), "grams": ()}
    assert target.partition_text == "depot="


@pytest.mark.parametrize("data", [[], {"sources": []}, {"sources": None}, "text", None])
def test_nothing_declared(data):
    plan = LoadPlan.from_dicts(data)
    assert plan.sources == []
    with pytest.raises(KeyError):
        plan["parcels"]


def test_round_trip():
    plan = LoadPlan.from_dicts(SOURCE)
    written = [s.to_dict() for s in plan.sources]
    assert LoadPlan.from_dicts(json.loads(json.dumps(written))) == plan
    keyed = PartitionSpec("day", "date", "sent_at")
    assert PartitionSpec.parse(keyed.to_dict()) == keyed
    assert "source_column" not in PartitionSpec("day").to_dict()
    assert SourceSpec().to_dict()["cdc_config"] is None


def test_order_is_stable_and_lookup_by_name():
    plan = LoadPlan.from_dicts([{"source": n, "order": o} for n, o in [("b", 2), ("a", 1), ("c", 2)]])
    assert [s.source for s in plan.sources] == ["a", "b", "c"]
    assert plan["c"].order == 2


def test_file(tmp_path):
    path = tmp_path / "plan.json"
    path.write_text(json.dumps([SOURCE]))
    assert LoadPlan.from_file(str(path)) == LoadPlan.from_dicts(SOURCE)
    path.write_text("{invalid}")
    with pytest.raises(ValueError):
        LoadPlan.from_file(str(path))
