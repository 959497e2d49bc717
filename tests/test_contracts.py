"""The data contracts: names, types, nullability and order."""
import dataclasses

import pytest

from rankwise.contracts import DEFAULT_COLUMNS, DETECTIONS, LOCATIONS, OUTPUT, Columns


def _shape(schema):
    return [(f.name, f.dataType.simpleString(), f.nullable) for f in schema.fields]


def test_detections_contract():
    assert _shape(DETECTIONS) == [
        ("geographical_location_oid", "bigint", False),
        ("video_camera_oid", "bigint", False),
        ("detection_oid", "bigint", False),
        ("item_name", "string", False),
        ("timestamp_detected", "bigint", False),
    ]


def test_locations_contract():
    assert _shape(LOCATIONS) == [
        ("geographical_location_oid", "bigint", False),
        ("geographical_location", "string", False),
    ]


def test_output_contract():
    assert _shape(OUTPUT) == [
        ("geographical_location_oid", "bigint", False),
        ("geographical_location", "string", True),      # the lookup may miss
        ("item_rank", "int", False),
        ("item_name", "string", False),
    ]


def test_columns_default_to_contract_names_and_are_frozen():
    assert DEFAULT_COLUMNS.location == OUTPUT.fieldNames()[0]
    assert DEFAULT_COLUMNS.location_name == OUTPUT.fieldNames()[1]
    assert DEFAULT_COLUMNS.dedup_order == ["timestamp_detected", "geographical_location_oid",
                                           "video_camera_oid", "item_name"]
    with pytest.raises(dataclasses.FrozenInstanceError):
        DEFAULT_COLUMNS.location = "x"
    assert Columns(item="product").item == "product"
