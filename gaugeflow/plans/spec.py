"""Table, change and record specs: small JSON documents read on the driver."""

from __future__ import annotations

import datetime as dt
import json
import re
from dataclasses import dataclass, field, replace
from decimal import Decimal

from pyspark.sql import types as T

from gaugeflow.plans.ranges import RangePartition, check_ranges

# Column type names a spec may use.
SPEC_TYPES = {
    "BOOL": T.BooleanType(),
    "INT8": T.ByteType(),
    "INT16": T.ShortType(),
    "INT32": T.IntegerType(),
    "INT64": T.LongType(),
    "FLOAT": T.FloatType(),
    "DOUBLE": T.DoubleType(),
    "STRING": T.StringType(),
    "BINARY": T.BinaryType(),
    "DATE": T.DateType(),
    "UNIXTIME_MICROS": T.TimestampType(),
}

# Primitive types of a record schema.
RECORD_TYPES = {
    "boolean": T.BooleanType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "bytes": T.BinaryType(),
    "string": T.StringType(),
}

_TRAILING_COMMA = re.compile(r'("(?:\\.|[^"\\])*")|,(?=\s*[\]}])')


def lenient_json(text: str):
    """JSON that may hold a comma before a closing bracket."""
    return json.loads(_TRAILING_COMMA.sub(lambda m: m.group(1) or "", text))


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    data_type: T.DataType
    is_key: bool = False


@dataclass(frozen=True)
class TableSpec:
    """A keyed table: columns, primary key, hash and range partitions."""

    name: str
    columns: tuple[ColumnSpec, ...]
    hash_keys: tuple[str, ...] = ()
    buckets: int = 0
    range_columns: tuple[str, ...] = ()
    ranges: tuple[RangePartition, ...] = ()
    # Store settings without a meaning in Parquet tables; kept as table properties.
    replicas: int = 1
    wait: bool = True
    # Columns beside the key that must not be NULL (added by a change spec).
    required: tuple[str, ...] = field(default=())

    @property
    def keys(self) -> list[str]:
        return [c.name for c in self.columns if c.is_key]

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, c.data_type) for c in self.columns])

    @property
    def partition_columns(self) -> list[str]:
        return (["range_id"] if self.range_columns else []) + (["bucket"] if self.hash_keys else [])

    def type_of(self, name: str) -> T.DataType:
        return self.schema[name].dataType

    def validate(self) -> TableSpec:
        names = [c.name for c in self.columns]
        if len(set(names)) != len(names):
            raise ValueError(f"repeated column name in {names}")
        if not self.keys:
            raise ValueError("a table needs at least one key column")
        if not self.hash_keys and not self.range_columns:
            raise ValueError("a table needs hash or range partitions")
        for name in (*self.hash_keys, *self.range_columns):
            if name not in self.keys:
                raise ValueError(f"partition column {name} is not a key column")
        if self.hash_keys and self.buckets < 2:
            raise ValueError("hash partitions need at least two buckets")
        reserved = set(self.partition_columns) & set(names)
        if reserved:
            raise ValueError(f"column names {sorted(reserved)} are reserved")
        check_ranges(self.ranges)
        return self

    def to_json(self) -> str:
        """The spec in the document form that :func:`table_spec` reads."""
        partition = {}
        if self.hash_keys:
            partition["hashPartition"] = {"keys": list(self.hash_keys), "buckets": self.buckets}
        if self.range_columns:
            partition["rangePartition"] = {
                "columns": list(self.range_columns),
                "partitions": [_range_document(p) for p in self.ranges],
            }
        dimensions = [
            {"name": c.name, "is_key": c.is_key, **_type_document(c.data_type)}
            for c in self.columns
        ]
        return json.dumps({
            "spec": {
                "tableSchema": {
                    "tableName": self.name,
                    "dimensionsSpec": {"dimensions": dimensions},
                },
                "ioConfig": {"replicas": self.replicas, "waitKey": self.wait},
                "tuningConfig": {"partitionSpec": partition},
            },
            "required": list(self.required),
        })


def _type_document(data_type: T.DataType) -> dict:
    if isinstance(data_type, T.DecimalType):
        return {"type": "DECIMAL", "precision": data_type.precision, "scale": data_type.scale}
    if isinstance(data_type, T.VarcharType):
        return {"type": "VARCHAR", "length": data_type.length}
    return {"type": next(name for name, t in SPEC_TYPES.items() if t == data_type)}


def _range_document(p: RangePartition) -> dict:
    def plain(value):
        if isinstance(value, (dt.datetime, dt.date)):
            return value.isoformat()
        return str(value) if isinstance(value, Decimal) else value

    return {
        "id": p.range_id,
        "lower": [plain(v) for v in p.lower],
        "upper": [plain(v) for v in p.upper],
        "lower_bound": "inclusive" if p.lower_inclusive else "exclusive",
        "upper_bound": "inclusive" if p.upper_inclusive else "exclusive",
        **({} if p.label is None else {"label": p.label}),
    }


def column_type(entry: dict) -> T.DataType:
    """Spark type of a column entry; sized types need their sizes."""
    name = str(entry["type"]).upper()
    try:
        if name == "DECIMAL":
            return T.DecimalType(int(entry["precision"]), int(entry["scale"]))
        if name == "VARCHAR":
            return T.VarcharType(int(entry["length"]))
    except KeyError as missing:
        raise ValueError(f"type {name} needs {missing}") from None
    if name not in SPEC_TYPES:
        raise ValueError(f"unknown column type {name}")
    return SPEC_TYPES[name]


def typed_literal(value, data_type: T.DataType):
    """A spec literal as the Python value of its column's type."""
    if isinstance(data_type, T.BooleanType):
        return value if isinstance(value, bool) else str(value).lower() == "true"
    if isinstance(data_type, T.IntegralType):
        if isinstance(value, float) and not value.is_integer():
            raise ValueError(f"{value} is no whole number")
        return int(value)
    if isinstance(data_type, T.FractionalType):
        return Decimal(str(value)) if isinstance(data_type, T.DecimalType) else float(value)
    if isinstance(data_type, T.TimestampType):
        if isinstance(value, (int, float)):
            return dt.datetime.fromtimestamp(0, dt.UTC) + dt.timedelta(microseconds=int(value))
        parsed = dt.datetime.fromisoformat(str(value))
        return parsed if parsed.tzinfo else parsed.replace(tzinfo=dt.UTC)
    if isinstance(data_type, T.DateType):
        return dt.date.fromisoformat(str(value))
    return str(value)


def range_partitions(
    entries: list[dict], types: list[T.DataType], first_id: int = 0
) -> tuple[RangePartition, ...]:
    """Ranges of a spec, numbered in the order given; ``lower``/``upper`` bind by name order.

    An end is exclusive only where the spec says ``exclusive``; an entry without
    bounds at all is the store's default, lower inclusive and upper exclusive.
    """
    result = []
    for position, entry in enumerate(entries):
        has_bounds = "lower_bound" in entry or "upper_bound" in entry
        upper_default = "inclusive" if has_bounds else "exclusive"
        if max(len(entry["lower"]), len(entry["upper"])) > len(types):
            raise ValueError(f"a bound has more values than the {len(types)} range columns")
        # A bound may name the first columns only, or none.
        lower = tuple(typed_literal(v, t) for v, t in zip(entry["lower"], types))
        upper = tuple(typed_literal(v, t) for v, t in zip(entry["upper"], types))
        result.append(RangePartition(
            range_id=int(entry.get("id", first_id + position)),
            lower=lower,
            upper=upper,
            lower_inclusive=entry.get("lower_bound", "inclusive") != "exclusive",
            upper_inclusive=entry.get("upper_bound", upper_default) != "exclusive",
            label=entry.get("label"),
        ))
    return tuple(result)


def table_spec(document: str | dict) -> TableSpec:
    """Parse a create spec. Name, columns and replicas are required parts."""
    data = lenient_json(document) if isinstance(document, str) else document
    try:
        spec = data["spec"]
        schema = spec["tableSchema"]
        columns = tuple(
            ColumnSpec(str(c["name"]), column_type(c), str(c.get("is_key")).lower() == "true")
            for c in schema["dimensionsSpec"]["dimensions"]
        )
        base = TableSpec(
            name=schema["tableName"],
            columns=columns,
            replicas=int(spec["ioConfig"]["replicas"]),
            wait=bool(spec["ioConfig"]["waitKey"]),
            required=tuple(data.get("required", ())),
        )
    except (KeyError, TypeError) as missing:
        raise ValueError(f"table spec lacks a required part: {missing}") from None

    partition = (spec.get("tuningConfig") or {}).get("partitionSpec") or {}
    hashed, ranged = partition.get("hashPartition"), partition.get("rangePartition")
    if hashed and "keys" in hashed and "buckets" in hashed:
        base = replace(base, hash_keys=tuple(hashed["keys"]), buckets=int(hashed["buckets"]))
    if ranged and "columns" in ranged and "partitions" in ranged:
        names = tuple(ranged["columns"])
        types = [base.type_of(name) for name in names]
        ranges = range_partitions(ranged["partitions"], types)
        # No ranges at all are one without bounds.
        base = replace(
            base, range_columns=names, ranges=ranges or (RangePartition(0, (), ()),)
        )
    return base


@dataclass(frozen=True)
class AddColumn:
    name: str
    data_type: T.DataType
    nullable: bool = True
    default: object = None


@dataclass(frozen=True)
class AlterSpec:
    """The changes of an alter document, in the order they are applied."""

    table: str
    add_columns: tuple[AddColumn, ...] = ()
    drop_columns: tuple[str, ...] = ()
    rename_columns: tuple[tuple[str, str], ...] = ()
    add_ranges: tuple[dict, ...] = ()
    drop_ranges: tuple[dict, ...] = ()
    rename_table: str | None = None


def alter_spec(document: str | dict) -> AlterSpec:
    data = lenient_json(document) if isinstance(document, str) else document
    try:
        table = data["spec"]["tableSchema"]["tableName"]
    except (KeyError, TypeError) as missing:
        raise ValueError(f"alter spec lacks a required part: {missing}") from None
    tuning = data["spec"].get("tuningConfig") or {}
    dimensions = tuning.get("dimensionsSpec") or {}
    partition = tuning.get("partitionSpec") or {}
    adds = []
    for entry in dimensions.get("addDimensions", ()):
        data_type = column_type(entry)
        default = entry.get("default_value")
        adds.append(AddColumn(
            name=entry["name"],
            data_type=data_type,
            nullable=bool(entry.get("is_nullable", True)),
            default=None if default is None else typed_literal(default, data_type),
        ))
    drops = tuple(
        d["name"] if isinstance(d, dict) else d for d in dimensions.get("dropDimensions", ()) if d
    )
    renames = tuple((r["from"], r["to"]) for r in dimensions.get("renameDimensions", ()) if r)
    return AlterSpec(
        table=table,
        add_columns=tuple(adds),
        drop_columns=drops,
        rename_columns=renames,
        add_ranges=tuple((partition.get("addRangePartition") or {}).get("partitions", ())),
        drop_ranges=tuple((partition.get("dropRangePartition") or {}).get("partitions", ())),
        rename_table=tuning.get("renameTable"),
    )


def record_schema(document: str | dict) -> T.StructType:
    """``StructType`` of a record schema file; a union with null is nullable."""
    data = lenient_json(document) if isinstance(document, str) else document

    def convert(kind) -> tuple[T.DataType, bool]:
        if isinstance(kind, list):
            inner = [k for k in kind if k != "null"]
            if len(inner) != 1:
                raise ValueError(f"only unions with null are supported: {kind}")
            return convert(inner[0])[0], "null" in kind
        if isinstance(kind, dict):
            if kind["type"] == "record":
                return record_schema(kind), False
            if kind["type"] == "array":
                element, nullable = convert(kind["items"])
                return T.ArrayType(element, nullable), False
            return convert(kind["type"])
        if kind not in RECORD_TYPES:
            raise ValueError(f"unknown record type {kind}")
        return RECORD_TYPES[kind], False

    if data.get("type") != "record":
        raise ValueError("a record schema must have type record")
    fields = []
    for entry in data["fields"]:
        data_type, nullable = convert(entry["type"])
        fields.append(T.StructField(entry["name"], data_type, nullable))
    return T.StructType(fields)
