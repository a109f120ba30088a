"""The concrete message and table schemas."""

from __future__ import annotations

from gaugeflow.plans.spec import SPEC_TYPES, ColumnSpec, TableSpec

# Message fields as from_json schemas. Fields that are coerced to
# text or parsed later are read as text, so that one bad value nulls only itself.
SENSOR_MESSAGE = "key int, date string, signal double"
GREETING_MESSAGE = "date variant, name string"
TRANSIT_MESSAGE = (
    "trip_id string, id string, route_id string, trip_direction string, "
    "actual_trip_start_time string, last_stop_arrival_time string, vehicle_label string, "
    "license_plate string, last_stop_id string, speed string, observationDateTime string, "
    "trip_delay string, location string"
)
TRANSIT_LOCATION = "type string, coordinates string"
SCHEDULE_ELEMENT = (
    "trip_id int, trip_details struct<arrival_time: string, stop_sequence: int, "
    "stop_id: int, departure_time: string>"
)


def _table(name: str, columns: list[tuple[str, str]], buckets: int = 8) -> TableSpec:
    """A table keyed and hash-partitioned by its first column."""
    specs = tuple(
        ColumnSpec(column, SPEC_TYPES[kind], is_key=position == 0)
        for position, (column, kind) in enumerate(columns)
    )
    return TableSpec(name, specs, hash_keys=(columns[0][0],), buckets=buckets)


# The tables the ingestion jobs fill.
SENSOR_TABLE = _table("sensor", [("key", "INT32"), ("date", "STRING"), ("signal", "DOUBLE")])

TRANSIT_TABLE = _table("transit_live", [
    ("primary_key", "STRING"),
    ("trip_id", "STRING"),
    ("id", "STRING"),
    ("route_id", "STRING"),
    ("trip_direction", "STRING"),
    ("actual_trip_start_time", "UNIXTIME_MICROS"),
    ("last_stop_arrival_time", "STRING"),
    ("vehicle_label", "STRING"),
    ("license_plate", "STRING"),
    ("last_stop_id", "STRING"),
    ("speed", "DOUBLE"),
    ("observationDateTime", "UNIXTIME_MICROS"),
    ("trip_delay", "STRING"),
    ("location_type", "STRING"),
    ("coordinate0", "DOUBLE"),
    ("coordinate1", "DOUBLE"),
])

SCHEDULE_TABLE = _table("schedule", [
    ("arrival_time", "STRING"),
    ("trip_id", "INT32"),
    ("stop_sequence", "INT32"),
    ("stop_id", "INT32"),
    ("departure_time", "STRING"),
])
