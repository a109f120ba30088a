import datetime as dt
import json

import pytest
from pyspark.sql import types as T

from gaugeflow.plans.spec import (
    alter_spec, column_type, lenient_json, record_schema, table_spec, typed_literal,
)
from gaugeflow.plans.ranges import RangePartition, check_ranges
from gaugeflow.queries.streams import GREETING_RECORD
from gaugeflow.queries.tables import READINGS_CHANGE, READINGS_SPEC


def test_lenient_json():
    assert lenient_json('{"a": [1, 2,], "b": "x,]",\n}') == {"a": [1, 2], "b": "x,]"}
    with pytest.raises(ValueError):
        lenient_json('{"a": }')


def test_sample_spec():
    spec = table_spec(READINGS_SPEC).validate()
    assert spec.name == "readings"
    assert spec.keys == ["column1", "column2"]
    assert spec.schema.simpleString() == (
        "struct<column1:int,column2:string,column3:double,column4:timestamp>"
    )
    assert (spec.hash_keys, spec.buckets) == (("column1", "column2"), 8)
    assert [(r.lower, r.upper, r.lower_inclusive, r.upper_inclusive) for r in spec.ranges] == [
        ((30,), (39,), False, False), ((40,), (49,), False, False), ((50,), (59,), False, False),
    ]
    assert table_spec(spec.to_json()) == spec


@pytest.mark.parametrize("part", ["replicas", "waitKey", "tableName", "dimensions"])
def test_missing_part(part):
    with pytest.raises(ValueError, match="required part"):
        table_spec(READINGS_SPEC.replace(f'"{part}"', '"other"'))


def test_partition_spec_needed():
    document = lenient_json(READINGS_SPEC)
    del document["spec"]["tuningConfig"]
    with pytest.raises(ValueError, match="hash or range"):
        table_spec(document).validate()


@pytest.mark.parametrize(
    "old, new, message",
    [
        ('"INT32"', '"INT31"', "unknown column type"),
        ('"DOUBLE"', '"DECIMAL"', "needs 'precision'"),
        ('"DOUBLE"', '"VARCHAR"', "needs 'length'"),
    ],
)
def test_types_refused(old, new, message):
    with pytest.raises(ValueError, match=message):
        table_spec(READINGS_SPEC.replace(old, new))


@pytest.mark.parametrize(
    "old, new, message",
    [
        ('"lower": [40]', '"lower": [35]', "overlaps"),
        ('"lower": [40]', '"lower": [60]', "empty range"),
        ('"buckets": 8', '"buckets": 1', "two buckets"),
        ('["column1",]', '["column3",]', "not a key"),
        ('"name": "column4"', '"name": "bucket"', "reserved"),
        ('"name": "column4"', '"name": "column3"', "repeated"),
        ('"is_key": true', '"is_key": false', "key column"),
    ],
)
def test_validation(old, new, message):
    with pytest.raises(ValueError, match=message):
        table_spec(READINGS_SPEC.replace(old, new)).validate()


def test_sized_types():
    decimal = column_type({"type": "decimal", "precision": 9, "scale": 2})
    assert decimal == T.DecimalType(9, 2)
    assert column_type({"type": "VARCHAR", "length": 5}) == T.VarcharType(5)


@pytest.mark.parametrize(
    "value, data_type, expected",
    [
        (5, T.StringType(), "5"),
        ("5", T.LongType(), 5),
        (5, T.DoubleType(), 5.0),
        ("true", T.BooleanType(), True),
        ("2024-01-02", T.DateType(), dt.date(2024, 1, 2)),
        (1_500_000, T.TimestampType(), dt.datetime(1970, 1, 1, 0, 0, 1, 500_000, dt.UTC)),
        ("2024-01-02T03:04:05", T.TimestampType(), dt.datetime(2024, 1, 2, 3, 4, 5, 0, dt.UTC)),
    ],
)
def test_typed_literal(value, data_type, expected):
    assert typed_literal(value, data_type) == expected


def test_range_default_ends():
    document = lenient_json(READINGS_SPEC)
    part = document["spec"]["tuningConfig"]["partitionSpec"]["rangePartition"]
    part["partitions"] = [
        {"lower": [1], "upper": [2]},
        {"lower": [3], "upper": [4], "lower_bound": "inclusive", "upper_bound": "inclusive",
         "label": "north"},
    ]
    spec = table_spec(document)
    ends = [(r.lower_inclusive, r.upper_inclusive, r.label) for r in spec.ranges]
    assert ends == [(True, False, None), (True, True, "north")]
    assert table_spec(spec.to_json()) == spec


def test_alter_spec():
    change = alter_spec(READINGS_CHANGE)
    assert change.table == "readings" and change.rename_table == "xyz"
    assert [(c.name, c.nullable, c.default) for c in change.add_columns] == [("added", True, 54)]
    assert change.drop_columns == ("column4",)
    assert change.rename_columns == (("column3", "signal"),)
    assert len(change.drop_ranges) == 1 and change.add_ranges == ()
    with pytest.raises(ValueError, match="required part"):
        alter_spec("{}")


def test_record_schema():
    assert record_schema(GREETING_RECORD) == T.StructType([
        T.StructField("date", T.StringType(), False),
        T.StructField("message", T.StringType(), False),
    ])
    nested = {"type": "record", "name": "r", "fields": [
        {"name": "a", "type": ["null", "long"]},
        {"name": "b", "type": {"type": "array", "items": "double"}},
        {"name": "c", "type": {"type": "record", "name": "s", "fields": [
            {"name": "d", "type": "boolean"}]}},
    ]}
    schema = record_schema(json.dumps(nested))
    assert schema.simpleString() == "struct<a:bigint,b:array<double>,c:struct<d:boolean>>"
    assert schema["a"].nullable and not schema["b"].nullable
    with pytest.raises(ValueError):
        record_schema('{"type": "string"}')


def _partition(lower, upper, **kinds):
    return RangePartition(0, tuple(lower), tuple(upper), **kinds)


def test_open_and_prefix_bounds():
    check_ranges([_partition([], [30]), _partition([30], [30, 5]), _partition([30, 5], [])])
    check_ranges([_partition([30, 1], [30], upper_inclusive=True), _partition([31], [])])
    for left, right in (
        (_partition([], [30, 1]), _partition([30], [40])),
        (_partition([], []), _partition([1], [2])),
        (_partition([1], [30], upper_inclusive=True), _partition([30, 9], [])),
    ):
        with pytest.raises(ValueError, match="overlaps"):
            check_ranges([left, right])
    with pytest.raises(ValueError, match="empty"):
        check_ranges([_partition([30], [30])])


def test_no_ranges_are_one_without_bounds():
    document = lenient_json(READINGS_SPEC)
    document["spec"]["tuningConfig"]["partitionSpec"]["rangePartition"]["partitions"] = []
    spec = table_spec(document)
    assert [(p.range_id, p.lower, p.upper) for p in spec.ranges] == [(0, (), ())]
    assert table_spec(spec.to_json()).ranges == spec.ranges
