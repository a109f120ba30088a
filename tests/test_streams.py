import datetime as dt
import json
import os
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeflow import session
from gaugeflow.operators import decode, keyed, rejects
from gaugeflow.plans import catalog, schemas
from gaugeflow.queries.streams import GREETING_RECORD
from gaugeflow.sources import messages
from gaugeflow.streaming import ingest
from gaugeflow.streaming.keyed_log import INSERT, UPSERT, KeyedLog
from gaugeflow.streaming.ingest import start_stateful
from gaugeflow.streaming.keyed_state import PreviousFeed

SENSOR = [
    {"key": i % 7, "date": f"2021-06-01 10:{i // 60:02d}:{i % 60:02d}", "signal": float(i)}
    for i in range(120)
]


def land(path, batches):
    """One text file per batch; later files are younger, so they are read in order."""
    os.makedirs(path, exist_ok=True)
    for number, lines in enumerate(batches):
        target = f"{path}/{number:03d}.txt"
        with open(target, "w") as out:
            out.writelines(line + "\n" for line in lines)
        os.utime(target, (1_600_000_000 + number * 10,) * 2)


def chunks(rows, n):
    return [[json.dumps(r) for r in rows[i::n]] for i in range(n)]


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def sensor_stream(spark, path):
    return decode.decode_sensor(messages.file_messages(spark, path, files_per_trigger=1))


@pytest.mark.parametrize("mode", [UPSERT, INSERT])
def test_log_stream_equals_batch(spark, folder, mode):
    land(folder + "/in", chunks(SENSOR, 4) + [["junk", '{"key": null, "date": "x"}']])
    log = KeyedLog(spark, folder + "/log", schemas.SENSOR_TABLE, ["date"], mode)
    log.start(sensor_stream(spark, folder + "/in"), folder + "/cp").awaitTermination()
    assert log.batches() == [0, 1, 2, 3, 4]
    df = spark.createDataFrame([tuple(r.values()) for r in SENSOR], "key int, date string, signal double")
    pick = keyed.latest if mode == UPSERT else keyed.first
    assert rows_of(log.current()) == rows_of(pick(df, ["key"], ["date"]))
    assert {r["reject_reason"] for r in log.rejected().collect()} == {"corrupt", "null_key"}


def test_log_stream_restart_and_replay(spark, folder):
    log = KeyedLog(spark, folder + "/log", schemas.SENSOR_TABLE, ["date"])
    parts = chunks(SENSOR, 4)
    land(folder + "/in", parts[:2])
    log.start(sensor_stream(spark, folder + "/in"), folder + "/cp").awaitTermination()
    land(folder + "/in", parts)
    # The first run looks as if it had failed before committing its last batch.
    os.remove(folder + "/cp/commits/1")
    crc = folder + "/cp/commits/.1.crc"
    if os.path.exists(crc):
        os.remove(crc)
    log.start(sensor_stream(spark, folder + "/in"), folder + "/cp").awaitTermination()
    df = spark.createDataFrame([tuple(r.values()) for r in SENSOR], "key int, date string, signal double")
    assert log.batches() == [0, 1, 2, 3]
    assert rows_of(log.current()) == rows_of(keyed.latest(df, ["key"], ["date"]))
    # Compaction between runs.
    log.compact()
    log.vacuum()
    land(folder + "/in", [*parts, [json.dumps({"key": 3, "date": "2022", "signal": None})]])
    log.start(sensor_stream(spark, folder + "/in"), folder + "/cp").awaitTermination()
    assert (3, "2022", None) in rows_of(log.current())


def test_log_stream_compacts_on_the_way(spark, folder):
    land(folder + "/in", chunks(SENSOR, 5))
    log = KeyedLog(spark, folder + "/log", schemas.SENSOR_TABLE, ["date"])
    stream = sensor_stream(spark, folder + "/in")
    log.start(stream, folder + "/cp", compact_every=2).awaitTermination()
    assert os.listdir(folder + "/log/snapshot")
    log.vacuum()
    assert log.batches() == [3, 4]
    df = spark.createDataFrame([tuple(r.values()) for r in SENSOR], "key int, date string, signal double")
    assert rows_of(log.current()) == rows_of(keyed.latest(df, ["key"], ["date"]))


def test_interval_trigger(spark, folder):
    land(folder + "/in", chunks(SENSOR, 2))
    log = KeyedLog(spark, folder + "/log", schemas.SENSOR_TABLE, ["date"])
    running = log.start(sensor_stream(spark, folder + "/in"), folder + "/cp", "1 second")
    try:
        running.processAllAvailable()
    finally:
        running.stop()
    assert log.batches() == [0, 1]


def bucketed(spark, folder, lines):
    land(folder + "/in", lines)
    stream = messages.file_messages(spark, folder + "/in", files_per_trigger=1)
    rows = rejects.accepted(decode.decode_greeting(stream)).drop("value")
    # A file system URI works like a plain path.
    ingest.write_bucketed(rows, f"file:{folder}/out", folder + "/cp").awaitTermination()
    with open(folder + "/record.avsc", "w") as out:
        out.write(GREETING_RECORD)
    schema = ingest.read_record_schema(spark, folder + "/record.avsc")
    return ingest.read_bucketed(spark, folder + "/out", schema)


def test_date_buckets(spark, folder):
    lines = [
        ['{"date": "2021-06-01", "name": "a"}', '{"date": "2021/06/02", "name": "b"}'],
        ['{"date": "", "name": "c"}', '{"date": null, "name": "d"}', '{"date": 7, "name": "e"}'],
    ]
    rows = bucketed(spark, folder, lines)
    assert rows.schema["bucket"].dataType == T.StringType()
    assert rows_of(rows) == sorted([
        ("2021-06-01", "a", "2021-06-01"), ("2021/06/02", "b", "2021/06/02"),
        ("", "c", "00000000"), (None, "d", "00000000"), ("7", "e", "00000000"),
    ], key=str)
    assert os.path.isdir(folder + "/out/bucket=2021-06-01")
    # Resuming adds only what is new.
    rows = bucketed(spark, folder, [*lines, ['{"date": "2021-06-01", "name": "f"}']])
    assert rows.count() == 6


def test_all_fallback_bucket_is_text(spark, folder):
    rows = bucketed(spark, folder, [['{"date": null, "name": "a"}']])
    assert [r["bucket"] for r in rows.collect()] == ["00000000"]


def test_redelivery(spark, folder):
    sent = [{"id": f"m{i}", "at": f"2021-06-01 10:00:{i:02d}"} for i in range(20)]
    land(folder + "/in", [[json.dumps(r) for r in part] for part in (sent[:12], sent[8:], sent[::3])])
    stream = messages.file_messages(spark, folder + "/in", files_per_trigger=1)
    rows = decode.decode_json(stream, "id string, at timestamp").select("id", "at")
    once = ingest.drop_redelivered(rows, "id", "at", "10 minutes")
    running = start_stateful(once, folder + "/out", folder + "/cp", state_partitions=3)
    running.awaitTermination()
    assert len([n for n in os.listdir(folder + "/cp/state/0") if n.isdigit()]) == 3
    got = sorted(r["id"] for r in spark.read.parquet(folder + "/out").collect())
    assert got == sorted(r["id"] for r in sent)


def test_stream_to_external_table(spark, folder):
    land(folder + "/in", [['{"date": "test", "name": "Hello0"}'], ['{"date": "test", "name": "Hello1"}']])
    stream = messages.file_messages(spark, folder + "/in", files_per_trigger=1)
    rows = rejects.accepted(decode.decode_greeting(stream))
    rows = decode.rename_project(rows, {"date": "a", "message": "b"})
    name = "sink_" + os.path.basename(folder).replace("-", "_")
    catalog.external_table(spark, name, folder + "/table", rows.schema)
    catalog.temp_view(rows, "incoming")
    ingest.write_table(spark.sql("SELECT * FROM incoming"), name, folder + "/cp").awaitTermination()
    assert rows_of(spark.table(name)) == [("test", "Hello0"), ("test", "Hello1")]


READINGS = "k int, t int, v string"
PARTS = [
    [(1, 1, "a"), (1, 5, "b"), (2, 2, "c"), (1, 3, "d")],
    [(1, 4, "late"), (1, 9, "e"), (2, 1, "late"), (3, 1, "f")],
    [(1, 10, "g"), (2, 8, "h"), (3, 0, "late"), (1, 5, "equal")],
]
EXPECTED = {
    (1, 1, "a"): None, (1, 3, "d"): "a", (1, 5, "b"): "d", (2, 2, "c"): None,
    (1, 4, "late"): None, (1, 9, "e"): "b", (2, 1, "late"): None, (3, 1, "f"): None,
    (1, 10, "g"): "e", (2, 8, "h"): "c", (3, 0, "late"): None, (1, 5, "equal"): None,
}
LATE = {(1, 4, "late"), (2, 1, "late"), (3, 0, "late"), (1, 5, "equal")}


def reading_stream(spark, folder, parts=PARTS):
    land(folder + "/in", [[json.dumps(dict(zip("ktv", r))) for r in part] for part in parts])
    stream = messages.file_messages(spark, folder + "/in", files_per_trigger=1)
    return rejects.accepted(decode.decode_json(stream, READINGS)).drop("value")


def check_previous(df):
    rows = df.collect()
    got = {(r["k"], r["t"], r["v"]): (r["previous"]["v"] if r["previous"] else None) for r in rows}
    assert got == EXPECTED and len(rows) == len(EXPECTED)
    assert {(r["k"], r["t"], r["v"]) for r in rows if r["late"]} == LATE


@pytest.mark.parametrize("compact_every", [1, 2, 20])
def test_previous_state_outlives_its_feed(spark, folder, compact_every):
    for parts in (PARTS[:1], PARTS):
        stream = reading_stream(spark, folder, parts)
        feed = PreviousFeed(
            spark, folder + "/root", stream.schema, ["k"], ["t"], ["v"], compact_every=compact_every
        )
        feed.start(stream, folder + "/cp").awaitTermination()
    check_previous(feed.rows())


def test_previous_feed_splits_a_hot_key(spark, folder):
    """Half of the rows share a key; no task gets more than twice the limit, unlike by key."""
    limit = 1_000
    rows = spark.range(40_000).select(
        F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id")).alias("k"),
        F.timestamp_seconds("id").alias("t"), F.col("id").alias("v"),
    )
    feed = PreviousFeed(
        spark, folder + "/feed", rows.schema, ["k"], ["t"], ["v"], max_key_rows=limit
    )
    feed.write_batch(rows.filter("id < 4000"), 0)
    with session.settings(
        spark, spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__shuffle__partitions="64",
        spark__sql__adaptive__enabled="false",
    ):
        batch = rows.filter("id >= 4000")
        told = feed._with_previous(batch, 1, 36_000)
        sizes = told.groupBy(F.spark_partition_id().alias("task")).count().collect()
        wrong = told.filter("k = 0 AND previous.v <> v - 2 OR late").count()
    assert sum(row["count"] for row in sizes) == 36_000 and wrong == 0
    assert max(row["count"] for row in sizes) <= 2 * limit


def test_landings_are_batches(spark):
    from gaugeflow.queries import streams

    log = streams.sensor_log(spark, "upsert")
    rows = streams.sensor_stream(spark, "/root/testdata/sf0.001")
    log.start(rows, streams.checkpoint(spark)).awaitTermination()
    assert len(log.batches()) == streams.LANDINGS


@pytest.mark.parametrize("max_key_rows", [1, 1000])
def test_previous_by_feed(spark, folder, max_key_rows):
    stream = reading_stream(spark, folder)
    feed = PreviousFeed(
        spark, folder + "/feed", stream.schema,
        ["k"], ["t"], ["v"],
        max_key_rows=max_key_rows, compact_every=2,
    )
    feed.start(stream, folder + "/cp").awaitTermination()
    check_previous(feed.rows())
    # Writing the last batch again changes nothing.
    last = spark.createDataFrame(PARTS[2], READINGS)
    feed.write_batch(last, 2)
    check_previous(feed.rows())
    assert feed.rejected() is None


class _Session:
    """Just the settings that scratch_root reads."""

    def __init__(self, master, root=None):
        self.sparkContext = self
        self.master = master
        self.conf = {} if root is None else {"spark.checkpoint.dir": root}


def test_scratch_follows_the_session():
    assert session.scratch_root(_Session("spark://host", "hdfs://n/shared/")) == "hdfs://n/shared"
    path = session.scratch_dir(_Session("spark://host", "hdfs://n/shared"), "x")
    assert path.startswith("hdfs://n/shared/gaugeflow/x-")
    assert os.path.isdir(session.scratch_root(_Session("local[2]")))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.scratch_root(_Session("spark://host"))


def test_environment_options(monkeypatch):
    monkeypatch.setenv("GAUGEFLOW_KAFKA_BOOTSTRAP_SERVERS", "h:1")
    assert session.environment_options("GAUGEFLOW_KAFKA_") == {"bootstrap.servers": "h:1"}


def test_table_stream_reads_a_folder_and_a_file(spark, folder):
    df = spark.range(10).select(F.col("id"))
    df.repartition(3).write.parquet(folder + "/many")
    time.sleep(0.01)
    for number, path in enumerate([folder + "/many", sorted(
        f"{folder}/many/{n}" for n in os.listdir(folder + "/many") if n.endswith(".parquet")
    )[0]]):
        stream = messages.table_stream(spark, path, df.schema)
        writer = stream.writeStream.format("parquet").option("path", f"{folder}/o{number}")
        writer = writer.option("checkpointLocation", f"{folder}/c{number}")
        ingest.with_trigger(writer, None).start().awaitTermination()
    assert spark.read.parquet(folder + "/o0").count() == 10
    assert 0 < spark.read.parquet(folder + "/o1").count() < 10


def test_files_per_bucket(spark, folder):
    inbox = folder + "/in"
    spark.range(2_000, numPartitions=8).selectExpr(
        "id", "cast(id % 20 as string) AS day"
    ).write.parquet(inbox)
    stream = messages.table_stream(spark, inbox, spark.read.parquet(inbox).schema)
    ingest.write_bucketed(
        stream, folder + "/out", folder + "/cp", "day", files_per_bucket=2
    ).awaitTermination()
    found = ingest.read_bucketed(spark, folder + "/out", spark.range(1).schema, "day")
    assert found.count() == 2_000
    assert len(found.inputFiles()) <= 40


def test_columns_of_queue_messages(spark):
    """On a stand-in with the columns that the connector gives."""
    when = dt.datetime(2024, 1, 2, 3, 4, 5)
    headers = [("other", b"x"), ("correlation_id", b"c-1"), ("correlation_id", b"c-2")]
    rows = spark.createDataFrame(
        [(b"k", b'{"key": 1}', "topic", 3, 70, when, 0, headers), (None, None, "topic", 4, 71, when, 0, None),
         (None, b"x", "topic", 4, 72, None, 1, [("correlation_id", None)])],
        "key binary, value binary, topic string, partition int, offset long, timestamp timestamp, "
        "timestampType int, headers array<struct<key:string,value:binary>>",
    )
    found = messages.queue_columns(rows)
    assert found.columns == ["value", "correlation_id", "ts", "partition", "offset"]
    assert [tuple(r) for r in found.orderBy("offset").collect()] == [
        ('{"key": 1}', "c-1", when, 3, 70), (None, None, when, 4, 71), ("x", None, None, 4, 72),
    ]
