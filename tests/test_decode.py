import datetime as dt
import json

import pytest
from pyspark.sql import types as T

from gaugeflow.operators import decode, rejects
from gaugeflow.plans import schemas
from gaugeflow.sources import delimited, geo, snapshots


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


@pytest.mark.parametrize(
    "text, reason",
    [
        ('{"key": 5976, "date": "d", "signal": 0.5}', None),
        ('{"key": 5976, "date": "d", "signal": null}', None),
        ('{"key": null, "date": "d", "signal": 0.5}', "null_key"),
        ('{"date": "d", "signal": 0.5}', "null_key"),
        ('{"key": "five", "date": "d", "signal": 0.5}', "corrupt"),
        ("not json", "corrupt"),
        ('{"key": 5', "corrupt"),
        ("[1, 2]", "corrupt"),
        ('{"key":1,"date":"{","signal":1.0}}', "corrupt"),
        ('{"key":1,"date":"{","signal":1.0}', None),
        ('{"key":1,"date":"}{","signal":1.0}', None),
        (" \t\n", "corrupt"),
        (None, "corrupt"),
    ],
)
def test_sensor(messages, text, reason):
    row = one(decode.decode_sensor(messages(text)))
    assert row[rejects.REASON] == reason
    assert row["value"] == text


TRANSIT = (
    '{"trip_id":"T1","id":"x/1","route_id":"R1","trip_direction":"UP",'
    '"actual_trip_start_time":"2021-06-01T09:00:00+05:30","last_stop_arrival_time":"09:10:00",'
    '"vehicle_label":"V1","license_plate":"AA00","last_stop_id":"S1","speed":12.5,'
    '"observationDateTime":"2021-06-01T10:00:00+05:30","trip_delay":30,'
    '"location":{"type":"Point","coordinates":[72.83,21.17]}}'
)


def test_transit_whole_message(spark, messages):
    rows = decode.decode_transit(messages(TRANSIT))
    assert rows.columns == ["value", rejects.REASON, *schemas.TRANSIT_TABLE.schema.names]
    row = one(rejects.accepted(rows).drop("value"))
    assert tuple(row) == (
        "a37e5c36-12ee-3e81-84fa-fbf21a313a22", "T1", "x/1", "R1", "UP",
        dt.datetime(2021, 6, 1, 9), "09:10:00", "V1", "AA00", "S1", 12.5,
        dt.datetime(2021, 6, 1, 10), "30", "Point", 72.83, 21.17,
    )


@pytest.mark.parametrize(
    "old, new, column, value",
    [
        ('"speed":12.5,', "", "speed", None),
        ('"speed":12.5,', '"speed":"12.5",', "speed", 12.5),
        ('"speed":12.5,', '"speed":"fast",', "speed", None),
        ('"speed":12.5,', '"speed":3,', "speed", 3.0),
        ('"trip_delay":30', '"trip_delay":null', "trip_delay", None),
        ('"trip_delay":30', '"trip_delay":{"min":3}', "trip_delay", '{"min":3}'),
        ("[72.83,21.17]", "[72.83]", "coordinate1", None),
        ("[72.83,21.17]", "[72.83]", "coordinate0", 72.83),
        ("[72.83,21.17]", "[]", "coordinate0", None),
        ("[72.83,21.17]", "[72,21]", "coordinate0", 72.0),
        ("[72.83,21.17]", '["east",21.17]', "coordinate0", None),
        ("[72.83,21.17]", '["east",21.17]', "coordinate1", 21.17),
        (',"location":{"type":"Point","coordinates":[72.83,21.17]}', "", "location_type", None),
        ("2021-06-01T09:00:00+05:30", "2021-13-01T09:00:00", "actual_trip_start_time", None),
        ("2021-06-01T09:00:00+05:30", "soon", "actual_trip_start_time", None),
    ],
)
def test_transit_bad_field_nulls_only_itself(messages, old, new, column, value):
    assert old in TRANSIT
    row = one(rejects.accepted(decode.decode_transit(messages(TRANSIT.replace(old, new)))))
    assert row[column] == value
    assert row["license_plate"] == "AA00"


@pytest.mark.parametrize(
    "text, reason",
    [
        (TRANSIT.replace('"T1"', "null"), "null_key"),
        (TRANSIT.replace('"observationDateTime"', '"other"'), "null_key"),
        (TRANSIT[:-1], "corrupt"),
    ],
)
def test_transit_rejects(messages, text, reason):
    assert one(decode.decode_transit(messages(text)))[rejects.REASON] == reason


@pytest.mark.parametrize(
    "date, text, bucket",
    [
        ('"2021-06-01"', "2021-06-01", "2021-06-01"),
        ('"2021/06/01"', "2021/06/01", "2021/06/01"),
        ('""', "", "00000000"),
        ("null", None, "00000000"),
        ("5", "5", "00000000"),
    ],
)
def test_greeting(messages, date, text, bucket):
    row = one(decode.decode_greeting(messages(f'{{"date": {date}, "name": "Hello0"}}')))
    assert (row["date"], row["message"], row["bucket"]) == (text, "Hello0", bucket)


def test_split_line(messages):
    fields = [("t", "string"), ("a", "int"), ("b", "int")]
    rows = decode.split_line(messages("x,1,2", "x,q,2", "x,1", "", "x,1,2,3"), fields).collect()
    assert [r[rejects.REASON] for r in rows] == [None, "bad_field", "bad_field", "bad_field", None]
    assert (rows[1]["a"], rows[1]["b"]) == (None, 2)


def test_split_line_fail_fast(messages):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        decode.split_line(messages("q"), [("a", "int")], fail_fast=True).collect()


SNAPSHOT = """[
 {"trip_id":7,"trip_details":{"arrival_time":"06:20:00","stop_sequence":1,"stop_id":3,"departure_time":"06:21:00"}},
 {"trip_id":8,"trip_details":{"arrival_time":"06:20:00","stop_sequence":2,"stop_id":4,"departure_time":"06:26:00"}}
]"""
FLAT = [
    ("2021-03-24 06:20:00", 7, 1, 3, "2021-03-24 06:21:00"),
    ("2021-03-24 06:20:00", 8, 2, 4, "2021-03-24 06:26:00"),
]


def test_snapshot_files(spark, tmp_path):
    (tmp_path / "one.json").write_text("\n\t" + SNAPSHOT)
    rows = rejects.accepted(snapshots.read_snapshot_files(spark, str(tmp_path)))
    rows = rows.drop("value", "position")
    assert sorted(map(tuple, decode.flatten_schedule(rows, "2021-03-24").collect())) == FLAT


def test_snapshot_files_with_bad_parts(spark, tmp_path):
    (tmp_path / "a.json").write_text(SNAPSHOT.replace('"trip_id":7', '"trip_id":"q"'))
    (tmp_path / "b.json").write_text("[{")
    rows = snapshots.read_snapshot_files(spark, str(tmp_path))
    assert rejects.rejected(rows).count() == 2
    assert [r["trip_id"] for r in rejects.accepted(rows).select("trip_id").collect()] == [8]


def test_snapshot_lines(spark, tmp_path):
    (tmp_path / "lines.txt").write_text(SNAPSHOT.replace("\n", " ") + "\n[]\n")
    rows = snapshots.read_snapshot_lines(spark, str(tmp_path))
    flat = decode.flatten_schedule(rejects.accepted(rows).drop("value", "position"), "2021-03-24")
    assert sorted(map(tuple, flat.collect())) == FLAT


def test_unnest_keeps_bad_elements(messages):
    texts = ('[{"trip_id":1},{"trip_id":"q"},null]', '{"trip_id":9}', "[1", None, "[]")
    rows = decode.unnest_array(messages(*texts), "trip_id int").collect()
    got = [(r["value"], r["trip_id"], r[rejects.REASON]) for r in rows]
    assert got == [
        ('{"trip_id":1}', 1, None),
        ('{"trip_id":"q"}', None, "corrupt"),
        (None, None, "corrupt"),
        ('{"trip_id":9}', 9, None),
        ("[1", None, "corrupt"),
        ("", None, "corrupt"),
    ]


CSV = T.StructType([
    T.StructField("arrival_time", T.StringType()),
    T.StructField("trip_id", T.IntegerType()),
    T.StructField("stop_id", T.IntegerType()),
])


@pytest.mark.parametrize("header", [True, False])
def test_csv_round_trip(spark, folder, header):
    df = spark.createDataFrame([("06:20:00", 7, 3), ("a,b", 8, None)], CSV)
    delimited.write_csv(df, folder + "/csv", header)
    rows = delimited.read_csv(spark, folder + "/csv", CSV, header)
    assert sorted(map(tuple, rejects.accepted(rows).drop("raw").collect())) == sorted(
        map(tuple, df.collect())
    )


def test_csv_bad_lines(spark, tmp_path):
    (tmp_path / "x.csv").write_text("arrival_time,trip_id,stop_id\na,1,2\na,q,2\na,1\n")
    rows = delimited.read_csv(spark, str(tmp_path), CSV).collect()
    assert [(r[rejects.REASON], r["raw"]) for r in rows] == [
        (None, None), ("bad_field", "a,q,2"), ("bad_field", "a,1"),
    ]
    with pytest.raises(Exception):
        delimited.read_csv(spark, str(tmp_path), CSV, fail_fast=True).collect()


def test_csv_reason_does_not_depend_on_the_columns_used(spark, tmp_path):
    (tmp_path / "x.csv").write_text("arrival_time,trip_id,stop_id\na,1,2\na,q,2\na,1\n")
    rows = delimited.read_csv(spark, str(tmp_path), CSV)
    assert rejects.accepted(rows).select("arrival_time").count() == 1
    assert rejects.rejected(rows).count() == 2
    assert [r[0] for r in rows.select(rejects.REASON).collect()] == [None, "bad_field", "bad_field"]


GEO = """{"type": "FeatureCollection", "features": [
 {"type": "Feature", "properties": {"name": "A"}, "geometry": {"type": "MultiPolygon",
  "coordinates": [[[[0, 0], [1, 0], [1, 1], [0, 0]]]]}},
 {"type": "Feature", "properties": {"id": 1}, "geometry": {"type": "Point",
  "coordinates": [20.522875, 51.070292]}}
]}"""


def test_geojson(spark, tmp_path):
    (tmp_path / "sample.geojson").write_text(GEO)
    rows = geo.read_geojson(spark, str(tmp_path)).collect()
    assert [(r["geometry_type"], r["lon"], r["lat"]) for r in rows] == [
        ("MultiPolygon", None, None), ("Point", 20.522875, 51.070292),
    ]
    assert json.loads(rows[0]["geometry"])["coordinates"] == [[[[0, 0], [1, 0], [1, 1], [0, 0]]]]
    assert json.loads(rows[1]["properties"]) == {"id": 1}


def test_geojson_bad_and_empty(messages):
    texts = ('{"type":"FeatureCollection","features":[]}', "junk", '{"type":"Feature"}')
    rows = geo.collections_to_features(messages(*texts)).collect()
    assert [r[rejects.REASON] for r in rows] == ["corrupt", "corrupt"]


def test_text_is_parsed_once(spark, messages):
    """A filter on the reject reason must not bring a second parse into the plan."""
    rows = rejects.accepted(decode.decode_sensor(messages(TRANSIT)))
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_texts_are_looked_at_only_after_one_more_parse(messages):
    """Most texts are one object, and the parse that tells so costs less than the other signs."""
    rows = rejects.accepted(decode.decode_json(messages("{}"), "key int"))
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert 0 < plan.index("lengthOfJsonArray") < plan.index("RLIKE")
    assert plan.count("lengthOfJsonArray") == 1


def test_odd_objects_and_what_follows_them(messages):
    texts = [
        '{"key":{"a":{}}}', " {'key':1}\n", '{"key":1}}', '{"key":"}"}{', '{"key":{"a":1}} {}',
        "{}", " ", '{"key":1},', '{"key":"a\\"}{"}',
    ]
    rows = decode.decode_json(messages(*texts), "key string")
    good = {r["value"] for r in rejects.accepted(rows).collect()}
    assert good == {'{"key":{"a":{}}}', " {'key':1}\n", "{}", '{"key":"a\\"}{"}'}
