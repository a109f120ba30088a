"""Message text to typed rows. No Python code runs per row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeflow.functions.keys import name_uuid
from gaugeflow.functions.times import bucket_label, iso_timestamp, prefix_date
from gaugeflow.operators import rejects
from gaugeflow.plans import schemas

_CORRUPT = "_corrupt_record"
_BLANKS = " \t\r\n"


def decode_json(df: DataFrame, schema: str, value: str = "value") -> DataFrame:
    """Parse ``value`` once; add the schema's fields and a reject reason.

    Text that is no JSON object, that does not fit the schema, or that goes on after
    its object (as two messages on a line do) is tagged ``corrupt`` and keeps its text
    in ``value``.
    """
    parsed = F.from_json(
        F.col(value),
        f"{schema}, {_CORRUPT} string",
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT},
    )
    # A generator, since filters on the fields (such as on the reason) do not move
    # below it. They would move below a projection and parse the text once more each.
    rows = df.select("*", F.inline_outer(F.array(parsed)))
    text = F.col(value)
    corrupt = F.col(_CORRUPT).isNotNull() | text.isNull() | _no_single_object(text)
    return rejects.tag(rows, [(rejects.CORRUPT, corrupt)]).drop(_CORRUPT)


def _no_single_object(text: Column) -> Column:
    """Whether text is blank or anything follows its first object; the parser stops there in silence.

    As the only element of an array, text must be one object to its end. Nearly all texts are,
    and one more parse costs less than the signs by which the others are looked at. Those tell
    text that goes on from objects only this parse does not take, such as with single quotes.
    """
    elements = F.json_array_length(F.concat(F.lit("["), text, F.lit("]")))
    bare = F.btrim(text, F.lit(_BLANKS))
    open_, close = (F.length(F.replace(bare, F.lit(b), F.lit(""))) for b in "{}")
    # A brace between quotes may stand in a text, where it balances none.
    quoted = bare.rlike('"[^"]*[{}][^"]*"')
    suspicious = ~bare.endswith("}") | bare.rlike(r"\}\s*[^\s\]}]") | (open_ != close) | quoted
    return (F.coalesce(elements, F.lit(0)) != 1) & suspicious


def decode_sensor(df: DataFrame, value: str = "value") -> DataFrame:
    """``key, date, signal`` of a sensor message."""
    rows = decode_json(df, schemas.SENSOR_MESSAGE, value)
    return rejects.tag(rows, [(rejects.NULL_KEY, F.col("key").isNull())])


def decode_greeting(df: DataFrame, value: str = "value") -> DataFrame:
    """``date, message`` with the field ``name`` renamed, and the date's bucket label.

    A date that is no JSON string keeps its text but falls into the fallback bucket.
    """
    rows = decode_json(df, schemas.GREETING_MESSAGE, value)
    is_text = F.schema_of_variant(F.col("date")) == "STRING"
    text = F.col("date").cast("string")
    return (
        rows.withColumn("bucket", bucket_label(F.when(is_text, text)))
        .withColumn("date", text)
        .withColumnRenamed("name", "message")
    )


def decode_transit(df: DataFrame, value: str = "value", honour_offset: bool = False) -> DataFrame:
    """The 16 columns of a transit live message, keyed by trip and raw observation time.

    Each field is extracted on its own, so a missing or unreadable field is NULL
    without touching the others. Only a missing key part rejects the row.
    """
    names = df.columns
    rows = decode_json(df, schemas.TRANSIT_MESSAGE, value)
    # Checked on the parts: cheaper than on the key, which a filter would compute again.
    no_key = F.col("trip_id").isNull() | F.col("observationDateTime").isNull()
    rows = rejects.tag(rows, [(rejects.NULL_KEY, no_key)])
    # A location of another shape must not make the rest unreadable.
    location = F.from_json("location", schemas.TRANSIT_LOCATION)
    coordinates = F.from_json(location["coordinates"], "array<string>")
    columns = {
        "primary_key": name_uuid(F.col("trip_id"), F.col("observationDateTime")),
        "trip_id": F.col("trip_id"),
        "id": F.col("id"),
        "route_id": F.col("route_id"),
        "trip_direction": F.col("trip_direction"),
        "actual_trip_start_time": iso_timestamp(F.col("actual_trip_start_time"), honour_offset),
        "last_stop_arrival_time": F.col("last_stop_arrival_time"),
        "vehicle_label": F.col("vehicle_label"),
        "license_plate": F.col("license_plate"),
        "last_stop_id": F.col("last_stop_id"),
        "speed": F.col("speed").try_cast("double"),
        "observationDateTime": iso_timestamp(F.col("observationDateTime"), honour_offset),
        "trip_delay": F.col("trip_delay"),
        "location_type": location["type"],
        "coordinate0": F.get(coordinates, 0).try_cast("double"),
        "coordinate1": F.get(coordinates, 1).try_cast("double"),
    }
    return rows.select(
        *names, rejects.REASON, *[column.alias(name) for name, column in columns.items()]
    )


def split_line(
    df: DataFrame,
    fields: Sequence[tuple[str, str]],
    value: str = "value",
    delimiter: str = ",",
    fail_fast: bool = False,
) -> DataFrame:
    """Delimited text to typed columns ``(name, type)``.

    A short line or a field that does not fit its type tags the row ``bad_field``;
    with ``fail_fast`` such a field fails the job instead.
    """
    escaped = "".join("\\" + c if not c.isalnum() else c for c in delimiter)
    # A generator for the same reason as in decode_json: the text is split once.
    parts = F.array(F.split(F.col(value), escaped, -1))
    rows = df.select("*", F.explode_outer(parts).alias("_parts"))
    bad = F.col("_parts").isNull() | (F.size("_parts") < len(fields))
    for position, (name, kind) in enumerate(fields):
        raw = F.get(F.col("_parts"), position)
        rows = rows.withColumn(name, raw.cast(kind) if fail_fast else raw.try_cast(kind))
        if kind != "string":
            bad = bad | F.col(name).isNull()
    return rejects.tag(rows, [(rejects.BAD_FIELD, bad)]).drop("_parts")


def unnest_array(df: DataFrame, element_schema: str, value: str = "value") -> DataFrame:
    """One row per element of the JSON array in ``value``, with its ``position``.

    ``value`` then holds the element's own text. Text that is no array, and elements
    that do not fit the schema, are kept as rows tagged ``corrupt``.
    """
    keep = [c for c in df.columns if c != value]
    is_array = F.ltrim(F.col(value), F.lit(_BLANKS)).startswith("[")
    elements = F.when(is_array, F.from_json(F.col(value), "array<string>"))
    # Unreadable text becomes an array of itself, so that it stays as one row.
    whole = F.array(F.coalesce(F.col(value), F.lit("")))
    rows = df.select(
        *keep, F.posexplode(F.coalesce(elements, whole)).alias("position", value)
    )
    return decode_json(rows, element_schema, value)


def flatten_schedule(df: DataFrame, service_date: str) -> DataFrame:
    """Schedule elements (``trip_id, trip_details``) to the five flat columns.

    Both times get the service date in front. Other columns are kept.
    """
    keep = [c for c in df.columns if c not in ("trip_id", "trip_details")]
    return df.select(
        *keep,
        prefix_date(service_date, F.col("trip_details.arrival_time")).alias("arrival_time"),
        F.col("trip_id"),
        F.col("trip_details.stop_sequence").alias("stop_sequence"),
        F.col("trip_details.stop_id").alias("stop_id"),
        prefix_date(service_date, F.col("trip_details.departure_time")).alias("departure_time"),
    )


def rename_project(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Keep the named columns in this order under their new names."""
    return df.select(*[F.col(old).alias(new) for old, new in names.items()])
