"""Queries over decoding, scalar functions, rejects and sampling."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow.functions import keys, times
from gaugeflow.operators import decode, rejects, sample
from gaugeflow.plans import catalog
from gaugeflow.plans.ranges import RangePartition
from gaugeflow.queries import registry as r
from gaugeflow.queries.registry import query
from gaugeflow.session import scratch_dir
from gaugeflow.sources import delimited, geo, messages, snapshots

# SQL text of a version-3 UUID of {text}.
_UUID_SQL = (
    "substr(md5({text}),1,8) || '-' || substr(md5({text}),9,4) || '-3' || "
    "substr(md5({text}),14,3) || '-' || "
    "translate(substr(md5({text}),17,1),'0123456789abcdef','89ab89ab89ab89ab') || "
    "substr(md5({text}),18,3) || '-' || substr(md5({text}),21,12)"
)
_ISO_SQL = "strftime(ts, '%Y-%m-%dT%H:%M:%S')"
_CLOCK_SQL = "strftime(ts, '%H:%M:%S')"
_MICROS_SQL = "epoch_us(date_trunc('second', ts))"


def uuid_sql(text: str) -> str:
    return _UUID_SQL.format(text=text)


@query("SELECT event_id, cast(json_extract_string(props, '$.k') AS INT) AS k FROM events")
def json_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = decode.decode_json(r.spread_events(spark, sf_dir), "k int", "props")
    return rejects.accepted(rows).select("event_id", "k")


@query("""
SELECT event_id, user_id::INT AS key, ts::VARCHAR AS date, value AS signal FROM events
""")
def sensor_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = r.spread_events(spark, sf_dir).select("event_id", r.sensor_message().alias("value"))
    return rejects.accepted(decode.decode_sensor(rows)).select("event_id", "key", "date", "signal")


@query(f"""
SELECT event_id,
       'Point' AS location_type,
       cast(user_id AS DOUBLE) AS coordinate0,
       value AS coordinate1,
       cast(event_id AS VARCHAR) AS trip_delay,
       {_CLOCK_SQL} AS last_stop_arrival_time
FROM events
""")
def nested_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = r.spread_events(spark, sf_dir).select("event_id", r.transit_message().alias("value"))
    return rejects.accepted(decode.decode_transit(rows)).select(
        "event_id", "location_type", "coordinate0", "coordinate1", "trip_delay",
        "last_stop_arrival_time",
    )


TRANSIT_SQL = f"""
SELECT {uuid_sql("('T' || user_id || " + _ISO_SQL + " || '+05:30')")} AS primary_key,
       'T' || user_id AS trip_id,
       'x/' || event_id AS id,
       event_type AS route_id,
       CASE WHEN value > 100 THEN 'UP' ELSE 'DN' END AS trip_direction,
       {_MICROS_SQL} AS actual_trip_start_micros,
       {_CLOCK_SQL} AS last_stop_arrival_time,
       'V' || user_id AS vehicle_label,
       'AA00' AS license_plate,
       props AS last_stop_id,
       value AS speed,
       {_MICROS_SQL} AS observation_micros,
       cast(event_id AS VARCHAR) AS trip_delay,
       'Point' AS location_type,
       cast(user_id AS DOUBLE) AS coordinate0,
       value AS coordinate1
FROM events
"""


def transit_report(df: DataFrame) -> DataFrame:
    """The 16 columns with times as epoch microseconds."""
    renamed = {
        "actual_trip_start_time": "actual_trip_start_micros",
        "observationDateTime": "observation_micros",
    }
    return df.select(*[
        F.unix_micros(f.name).alias(renamed[f.name]) if f.name in renamed else F.col(f.name)
        for f in df.schema
    ])


@query(TRANSIT_SQL)
def transit_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = r.spread_events(spark, sf_dir).select(r.transit_message().alias("value"))
    return transit_report(rejects.accepted(decode.decode_transit(rows)).drop("value"))


@query(f"""
SELECT event_id, {_MICROS_SQL} AS micros, {_MICROS_SQL} - 19800000000 AS zoned_micros FROM events
""")
def ts_micros(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(r.iso_text(), F.lit("+05:30"))
    return r.events(spark, sf_dir).select(
        "event_id",
        times.iso_micros(text).alias("micros"),
        times.iso_micros(text, honour_offset=True).alias("zoned_micros"),
    )


@query(f"""
SELECT event_id, {uuid_sql("(cast(user_id AS VARCHAR) || " + _ISO_SQL + ")")} AS name_uuid FROM events
""")
def name_uuid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return r.events(spark, sf_dir).select(
        "event_id", keys.name_uuid(F.col("user_id"), r.iso_text()).alias("name_uuid")
    )


@query("""
SELECT 'Hello' || event_id AS message,
       CASE WHEN event_type <> 'error' THEN strftime(ts, '%Y-%m-%d') END AS date
FROM events
""")
def rename_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = r.spread_events(spark, sf_dir).select(r.greeting_message().alias("value"))
    rows = decode.decode_json(rows, "date string, name string")
    return decode.rename_project(rejects.accepted(rows), {"name": "message", "date": "date"})


@query("""
SELECT CASE WHEN event_type <> 'error' THEN strftime(ts, '%Y-%m-%d') END AS a,
       'Hello' || event_id AS b
FROM events
""")
def select_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = r.spread_events(spark, sf_dir).select(r.greeting_message().alias("value"))
    rows = rejects.accepted(decode.decode_greeting(rows))
    view = "greetings_" + scratch_dir(spark, "view")[-32:]
    catalog.temp_view(decode.rename_project(rows, {"date": "a", "message": "b"}), view)
    return spark.sql(f"SELECT * FROM {view}")


@query(f"SELECT event_id, '{r.SERVICE_DATE} ' || {_CLOCK_SQL} AS arrival_time FROM events")
def date_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return r.events(spark, sf_dir).select(
        "event_id", times.prefix_date(r.SERVICE_DATE, r.clock_text()).alias("arrival_time")
    )


@query("""
SELECT event_id,
       CASE WHEN event_type = 'error' THEN 'corrupt'
            WHEN value > 100 THEN 'null_key' ELSE 'accepted' END AS outcome,
       CASE WHEN event_type <> 'error' AND value <= 100 THEN cast(user_id AS INT) END AS key,
       CASE WHEN event_type <> 'error' THEN value END AS signal
FROM events
""")
def dead_letter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of errors are cut off, those with a high value lack their key."""
    whole = F.to_json(F.struct(
        F.when(F.col("value") <= 100, F.col("user_id")).alias("key"),
        F.col("ts").cast("string").alias("date"),
        F.col("value").alias("signal"),
    ))
    cut = F.substr(whole, F.lit(1), F.length(whole) - 1)
    text = F.when(F.col("event_type") == "error", cut).otherwise(whole)
    rows = r.spread_events(spark, sf_dir).select("event_id", text.alias("value"))
    return decode.decode_sensor(rows).select(
        "event_id", F.coalesce(rejects.REASON, F.lit("accepted")).alias("outcome"), "key", "signal"
    )


@query("""
SELECT event_id, cast(user_id AS INT) AS user_id, event_type, value,
       CAST(NULL AS VARCHAR) AS reject_reason
FROM events
""")
def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Export with a header and scan back."""
    path = scratch_dir(spark, "csv")
    rows = r.events(spark, sf_dir).select("event_id", F.col("user_id").cast("int"), "event_type", "value")
    delimited.write_csv(rows, path)
    return delimited.read_csv(spark, path, rows.schema).select(
        *rows.columns, rejects.REASON
    )


@query("""
SELECT event_id,
       CASE WHEN event_type <> 'error' THEN cast(user_id AS INT) END AS trip_id,
       event_type AS label,
       CASE WHEN event_type = 'error' THEN 'bad_field' END AS reject_reason
FROM events
""")
def delimited_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines split by hand; errors have a letter where a number belongs."""
    line = F.concat_ws(
        ",",
        F.when(F.col("event_type") == "error", F.lit("q")).otherwise(F.col("user_id").cast("string")),
        F.col("event_type"),
    )
    lines = r.events(spark, sf_dir).select("event_id", line.alias("value"))
    rows = decode.split_line(lines, [("trip_id", "int"), ("label", "string")])
    return rows.select("event_id", "trip_id", "label", rejects.REASON)


def schedule_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A JSON array per line item with two schedule elements: a stop and the one after."""
    clock = F.substr(F.col("l_shipdate").cast("string"), F.lit(6), F.lit(5))

    def element(step: int):
        return F.struct(
            F.col("l_partkey").cast("int").alias("trip_id"),
            F.struct(
                F.concat(clock, F.lit(f":{step}")).alias("arrival_time"),
                (F.col("l_linenumber") + step).alias("stop_sequence"),
                (F.col("l_suppkey") + step).cast("int").alias("stop_id"),
                F.concat(clock, F.lit("+")).alias("departure_time"),
            ).alias("trip_details"),
        )

    document = F.to_json(F.array(element(0), element(1)))
    lines = messages.spread(r.table(spark, sf_dir, "lineitem"), r.decode_tasks(spark))
    return lines.select(document.alias("value"))


SCHEDULE_SQL = f"""
SELECT '{r.SERVICE_DATE} ' || strftime(l_shipdate, '%m-%d') || ':' || step AS arrival_time,
       cast(l_partkey AS INT) AS trip_id,
       cast(l_linenumber + step AS INT) AS stop_sequence,
       cast(l_suppkey + step AS INT) AS stop_id,
       '{r.SERVICE_DATE} ' || strftime(l_shipdate, '%m-%d') || '+' AS departure_time
FROM lineitem CROSS JOIN (VALUES (0), (1)) AS steps(step)
"""


@query(SCHEDULE_SQL)
def schedule_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshots landed as text, one JSON array per line, then unnested."""
    path = scratch_dir(spark, "snapshots")
    messages.write_messages(schedule_documents(spark, sf_dir), path)
    elements = rejects.accepted(snapshots.read_snapshot_lines(spark, path))
    return decode.flatten_schedule(elements.drop("value", "position"), r.SERVICE_DATE)


def with_ends(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``group`` and ``order`` of a file's rows, and whether a row ``is_first`` or ``is_last``.

    One row each of a group is. Rows that tie are told apart by their place in the files.
    """
    place = [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row")]
    rows = rows.select(group, *order, *place)
    row = F.struct(*order, "_file", "_row")
    # Whole rows are aggregated sorted, so only those that have an extreme first column are.
    lead = order[0]
    least = rows.groupBy(group).agg(F.min(lead).alias("_low"), F.max(lead).alias("_high"))
    outer = _beside(rows, least, group).filter(
        F.col(lead).isNull() | (F.col(lead) == F.col("_low")) | (F.col(lead) == F.col("_high"))
    )
    ends = outer.groupBy(group).agg(F.min(row).alias("_first"), F.max(row).alias("_last"))
    return _beside(rows, ends, group).select(
        group, *order, (row == F.col("_first")).alias("is_first"),
        (row == F.col("_last")).alias("is_last"),
    )


def _beside(rows: DataFrame, groups: DataFrame, group: str) -> DataFrame:
    """Rows with what is known of their group, which may be NULL; groups are few."""
    known = F.broadcast(groups.withColumnRenamed(group, "_group"))
    return rows.join(known, F.col(group).eqNullSafe(F.col("_group"))).drop("_group")


@query("""
WITH placed AS (
  SELECT *, row_number() OVER (PARTITION BY l_linenumber ORDER BY l_orderkey, l_partkey, l_suppkey)
            AS place
  FROM lineitem
)
SELECT cast(place - 1 AS INT) AS position, cast(l_partkey AS INT) AS trip_id,
       'a}, "' || l_linenumber || '" [' AS note, CAST(NULL AS VARCHAR) AS reject_reason
FROM placed
""")
def snapshot_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One array over many lines per line number, each file read in blocks."""
    path = scratch_dir(spark, "snapshot-blocks")
    order = ["l_orderkey", "l_partkey", "l_suppkey"]
    lines = r.table(spark, sf_dir, "lineitem")
    # Only what the lines are made of is shuffled and sorted; a window would keep whole arrays.
    rows = with_ends(lines, "l_linenumber", order).repartition("l_linenumber").sortWithinPartitions(
        "l_linenumber", *order, F.desc("is_first"), "is_last"
    )
    element = F.to_json(F.struct(
        F.col("l_partkey").cast("int").alias("trip_id"),
        F.concat(F.lit('a}, "'), F.col("l_linenumber").cast("string"), F.lit('" [')).alias("note"),
    ))
    line = F.concat(
        F.when(F.col("is_first"), F.lit("[")).otherwise(F.lit(",")), element,
        F.when(F.col("is_last"), F.lit("]")).otherwise(F.lit("")),
    )
    rows.select("l_linenumber", line.alias("value")).write.partitionBy("l_linenumber").text(path)
    found = snapshots.read_snapshot_blocks(spark, path, "trip_id int, note string")
    return found.select("position", "trip_id", "note", rejects.REASON)


@query("""
SELECT doc_id, text, lang, CAST(NULL AS VARCHAR) AS reject_reason FROM documents
""")
def csv_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of many lines exported, and scanned back in blocks."""
    path = scratch_dir(spark, "csv-blocks")
    rows = r.table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    delimited.write_csv(rows, path)
    found = delimited.read_csv_blocks(spark, path, rows.schema)
    return found.select(*rows.columns, rejects.REASON)


@query("""
SELECT event_id,
       cast(cast('0x' || substr(md5(cast(user_id AS VARCHAR)), 1, 8) AS BIGINT) % 8 AS INT) AS bucket
FROM events
""")
def hash_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    return r.events(spark, sf_dir).select(
        "event_id", keys.portable_bucket([F.col("user_id")], 8).alias("bucket")
    )


# The ranges of the sample table spec, all ends exclusive.
SAMPLE_RANGES = (
    RangePartition(0, (30,), (39,), False, False),
    RangePartition(1, (40,), (49,), False, False),
    RangePartition(2, (50,), (59,), False, False),
)


@query("""
SELECT event_id,
       CASE WHEN user_id > 30 AND user_id < 39 THEN 0
            WHEN user_id > 40 AND user_id < 49 THEN 1
            WHEN user_id > 50 AND user_id < 59 THEN 2 END AS range_id,
       CASE WHEN (user_id > 30 AND user_id < 39) OR (user_id > 40 AND user_id < 49)
              OR (user_id > 50 AND user_id < 59) THEN NULL ELSE 'no_range' END AS reject_reason
FROM events
""")
def range_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = r.events(spark, sf_dir).withColumn(
        "range_id", keys.range_id([F.col("user_id")], ["bigint"], SAMPLE_RANGES)
    )
    rows = rejects.tag(rows, [(rejects.NO_RANGE, F.col("range_id").isNull())])
    return rows.select("event_id", "range_id", rejects.REASON)


@query("""
WITH p AS (
  SELECT cast(cast('0x' || substr(d, 1, 8) AS BIGINT) AS DOUBLE) / 2147483648.0 - 1 AS x,
         cast(cast('0x' || substr(d, 9, 8) AS BIGINT) AS DOUBLE) / 2147483648.0 - 1 AS y
  FROM (SELECT md5(l_orderkey || ':' || l_linenumber || ':' || l_partkey) AS d FROM lineitem)
)
SELECT count(*) AS points, count(*) FILTER (x * x + y * y <= 1) AS hits,
       4.0::DOUBLE * count(*) FILTER (x * x + y * y <= 1) / count(*) AS pi
FROM p
""")
def monte_carlo_pi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One repeatable point per line item."""
    lines = r.table(spark, sf_dir, "lineitem")
    return sample.monte_carlo_pi_of(lines, ["l_orderkey", "l_linenumber", "l_partkey"])


@query("""
SELECT '{"id":' || event_id || '}' AS properties,
       CASE WHEN event_type = 'error' THEN 'MultiPolygon' ELSE 'Point' END AS geometry_type,
       CASE WHEN event_type <> 'error' THEN cast(user_id AS DOUBLE) END AS lon,
       CASE WHEN event_type <> 'error' THEN value END AS lat
FROM events
""")
def geo_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One feature per event, in collections of one; errors are areas."""
    point = F.to_json(F.struct(
        F.lit("Point").alias("type"),
        F.array(F.col("user_id").cast("double"), F.col("value")).alias("coordinates"),
    ))
    area = F.lit('{"type":"MultiPolygon","coordinates":[[[[0,0],[1,0],[1,1],[0,0]]]]}')
    text = F.concat(
        F.lit('{"type":"FeatureCollection","features":[{"type":"Feature","properties":{"id":'),
        F.col("event_id").cast("string"),
        F.lit('},"geometry":'),
        F.when(F.col("event_type") == "error", area).otherwise(point),
        F.lit("}]}"),
    )
    features = geo.collections_to_features(r.spread_events(spark, sf_dir).select(text.alias("value")))
    return rejects.accepted(features).drop("geometry", "id", "raw")



@query("""
SELECT event_id,
       CASE WHEN event_type = 'click' THEN NULL ELSE cast(user_id AS INT) END AS key,
       CASE WHEN event_type = 'click' THEN 'corrupt' END AS reject_reason
FROM events
""")
def concatenated_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks come as two messages on one line, which is no message."""
    one = r.sensor_message()
    text = F.when(F.col("event_type") == "click", F.concat(one, one)).otherwise(one)
    rows = decode.decode_sensor(
        r.spread_events(spark, sf_dir).select("event_id", text.alias("value"))
    )
    key = F.when(F.col(rejects.REASON).isNull(), F.col("key")).alias("key")
    return rows.select("event_id", key, rejects.REASON)


@query("""
SELECT event_id, CASE WHEN event_type = 'click' THEN NULL ELSE 'Point' END AS location_type,
       CASE WHEN event_type <> 'click' THEN value END AS coordinate1, value AS speed,
       CAST(NULL AS VARCHAR) AS reject_reason
FROM events
""")
def transit_bad_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A location that is text leaves the rest of its message as it is."""
    good = r.transit_message()
    bad = F.regexp_replace(good, r'"location":\{[^}]*\}', '"location":"depot"')
    text = F.when(F.col("event_type") == "click", bad).otherwise(good)
    rows = decode.decode_transit(
        r.spread_events(spark, sf_dir).select("event_id", text.alias("value"))
    )
    return rows.select("event_id", "location_type", "coordinate1", "speed", rejects.REASON)


@query("""
SELECT event_id,
       CASE event_type WHEN 'click' THEN ' lead ' WHEN 'view' THEN '' WHEN 'purchase' THEN 'a"b,c'
         WHEN 'error' THEN 'two' || chr(10) || 'lines' END AS note,
       CAST(NULL AS VARCHAR) AS reject_reason
FROM events
""")
def csv_fidelity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spaces, an empty value, quotes and a line end come back as they were, NULL as NULL."""
    path = scratch_dir(spark, "csv-odd")
    kind = F.col("event_type")
    note = (
        F.when(kind == "click", " lead ").when(kind == "view", "")
        .when(kind == "purchase", 'a"b,c').when(kind == "error", "two\nlines")
    )
    rows = r.events(spark, sf_dir).select("event_id", note.alias("note"))
    delimited.write_csv(rows, path)
    found = delimited.read_csv(spark, path, rows.schema, multi_line=True)
    return found.select("event_id", "note", rejects.REASON)


@query("""
SELECT cast(event_id AS VARCHAR) AS id, cast(user_id AS DOUBLE) AS lon, value AS lat,
       CAST(NULL AS VARCHAR) AS reject_reason
FROM events
""")
def geo_single_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One feature a line."""
    point = F.struct(
        F.lit("Point").alias("type"),
        F.array(F.col("user_id").cast("double"), F.col("value")).alias("coordinates"),
    )
    feature = F.to_json(F.struct(
        F.lit("Feature").alias("type"), F.col("event_id").cast("string").alias("id"),
        point.alias("geometry"),
    ))
    features = geo.collections_to_features(
        r.spread_events(spark, sf_dir).select(feature.alias("value"))
    )
    return features.select("id", "lon", "lat", rejects.REASON)
