"""Queries that run a stream over a whole table to its end and read the result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow.operators import decode, rejects
from gaugeflow.plans import catalog, schemas
from gaugeflow.plans.spec import ColumnSpec, TableSpec, record_schema
from gaugeflow.queries import registry as r
from gaugeflow.queries.decoding import TRANSIT_SQL, transit_report
from gaugeflow.queries.keyed import FIRST_SQL, LATEST_SQL, sensor_log
from gaugeflow.queries.registry import query
from gaugeflow.session import scratch_dir
from gaugeflow.sources import messages
from gaugeflow.streaming import ingest
from gaugeflow.streaming.keyed_log import INSERT, UPSERT, KeyedLog
from gaugeflow.streaming.keyed_state import PreviousFeed

# Fixed value: record schema of the date-bucketed files.
GREETING_RECORD = """
{"type": "record", "name": "greeting", "fields": [
  {"name": "date", "type": "string"},
  {"name": "message", "type": "string"}
]}
"""


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{sf_dir}/events.parquet"
    return messages.table_stream(spark, path, spark.read.parquet(path).schema)


#: Landings of the events: row n of the broker's order comes with landing n modulo this.
LANDINGS = 4
_LANDING_FILES = 4


def landed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as a stream of four batches, none of them in the order of time."""
    events = r.events(spark, sf_dir)
    inbox = scratch_dir(spark, "landed")
    for landing in range(LANDINGS):
        rows = events.filter(F.col("event_id") % LANDINGS == landing)
        rows.repartition(_LANDING_FILES).write.mode("append").parquet(inbox)
    return messages.table_stream(spark, inbox, events.schema, _LANDING_FILES)


def checkpoint(spark: SparkSession) -> str:
    return scratch_dir(spark, "checkpoint")


def run_stateful(spark: SparkSession, stream: DataFrame, path: str) -> None:
    """Run to the end of the input with as many state partitions as there are cores."""
    cores = spark.sparkContext.defaultParallelism
    running = ingest.start_stateful(stream, path, checkpoint(spark), state_partitions=cores)
    running.awaitTermination()


@query("""
SELECT cast(user_id AS INT) AS key, cast(ts AS VARCHAR) AS date, value AS signal FROM events
""")
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text messages as a stream, decoded and appended to Parquet."""
    inbox, out = scratch_dir(spark, "inbox"), scratch_dir(spark, "sensor-files")
    sent = r.spread_events(spark, sf_dir).select(r.sensor_message().alias("value"))
    messages.write_messages(sent, inbox)
    rows = decode.decode_sensor(messages.file_messages(spark, inbox))
    rows = rejects.accepted(rows).select("key", "date", "signal")
    bucketed = rows.withColumn("bucket", F.substr("date", F.lit(1), F.lit(10)))
    ingest.write_bucketed(bucketed, out, checkpoint(spark)).awaitTermination()
    return ingest.read_bucketed(spark, out, rows.schema).drop("bucket")


@query("SELECT event_id, user_id, value FROM events")
def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks are delivered twice, purchases three times; the stream keeps one of each."""
    out = scratch_dir(spark, "once")
    kind = F.col("event_type")
    copies = F.when(kind == "click", 2).when(kind == "purchase", 3).otherwise(1)
    delivered = event_stream(spark, sf_dir).select(
        "event_id", "user_id", "value",
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("event_id").cast("string").alias("correlation_id"),
        F.explode(F.sequence(F.lit(1), copies)).alias("delivery"),
    )
    once = ingest.drop_redelivered(delivered, "correlation_id", "ts", "60 days")
    rows = once.select("event_id", "user_id", "value")
    run_stateful(spark, rows, out)
    return spark.read.schema(rows.schema).parquet(out)


@query("""
SELECT CASE WHEN event_type <> 'error' THEN strftime(ts, '%Y-%m-%d') END AS date,
       'Hello' || event_id AS message,
       CASE WHEN event_type <> 'error' THEN strftime(ts, '%Y-%m-%d') ELSE '00000000' END AS bucket
FROM events
""")
def date_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Greetings to Parquet files by date; the date stays in the files as well."""
    out = scratch_dir(spark, "by-date")
    rows = event_stream(spark, sf_dir).select(r.greeting_message().alias("value"))
    rows = rejects.accepted(decode.decode_greeting(rows)).drop("value")
    ingest.write_bucketed(rows, out, checkpoint(spark)).awaitTermination()
    return ingest.read_bucketed(spark, out, record_schema(GREETING_RECORD))


@query("""
SELECT CASE WHEN event_type <> 'error' THEN strftime(ts, '%Y-%m-%d') END AS a,
       'Hello' || event_id AS b
FROM events
""")
def stream_to_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A view on a stream, selected in full into an external table."""
    folder = scratch_dir(spark, "greetings")
    name = "sink_" + folder[-32:]
    rows = event_stream(spark, sf_dir).select(r.greeting_message().alias("value"))
    rows = rejects.accepted(decode.decode_greeting(rows))
    rows = decode.rename_project(rows, {"date": "a", "message": "b"})
    view = "stream_" + folder[-32:]
    catalog.temp_view(rows, view)
    catalog.external_table(spark, name, folder, rows.schema)
    selected = spark.sql(f"SELECT * FROM {view}")
    ingest.write_table(selected, name, checkpoint(spark)).awaitTermination()
    return spark.table(name)


def sensor_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = landed_events(spark, sf_dir).select(
        F.col("event_id").alias("sequence"), r.sensor_message().alias("value")
    )
    return decode.decode_sensor(rows)


@query(LATEST_SQL)
def upsert_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = sensor_log(spark, UPSERT)
    log.start(sensor_stream(spark, sf_dir), checkpoint(spark)).awaitTermination()
    return log.current()


@query(FIRST_SQL)
def insert_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = sensor_log(spark, INSERT)
    log.start(sensor_stream(spark, sf_dir), checkpoint(spark)).awaitTermination()
    return log.current()


@query(f"""
SELECT * FROM ({TRANSIT_SQL})
QUALIFY row_number() OVER (
  PARTITION BY primary_key ORDER BY observation_micros, cast(trip_delay AS BIGINT)
) = 1
""")
def transit_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transit messages into their table; a repeated trip and time is ignored."""
    rows = landed_events(spark, sf_dir).select("event_id", r.transit_message().alias("value"))
    rows = decode.decode_transit(rows).withColumnRenamed("event_id", "sequence")
    log = KeyedLog(
        spark, scratch_dir(spark, "transit"), schemas.TRANSIT_TABLE,
        ["observationDateTime", "sequence"], INSERT, rows.select("sequence").schema,
    )
    log.start(rows, checkpoint(spark)).awaitTermination()
    return transit_report(log.current())


PREVIOUS_SQL = f"""
WITH placed AS (
  SELECT *, event_id % {LANDINGS} AS landing,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS place
  FROM events
), seen AS (
  SELECT *, coalesce(place < max(place) OVER (
    PARTITION BY user_id ORDER BY landing RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING
  ), false) AS late
  FROM placed
), told AS (
  SELECT event_id, lag(value) OVER (PARTITION BY user_id ORDER BY place) AS previous_value
  FROM seen WHERE NOT late
)
SELECT event_id, previous_value, late FROM seen LEFT JOIN told USING (event_id)
"""


def _previous_report(df: DataFrame) -> DataFrame:
    return df.select("event_id", F.col("previous.value").alias("previous_value"), "late")


def previous_feed(spark: SparkSession, root: str, schema, **options) -> PreviousFeed:
    return PreviousFeed(
        spark, root, schema, ["user_id"], ["ts", "event_id"], ["value"], **options
    )


@query(PREVIOUS_SQL)
def keyed_previous_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Previous row per key by joins and windows, batch after batch."""
    rows = landed_events(spark, sf_dir).select("event_id", "ts", "user_id", "value")
    feed = previous_feed(spark, scratch_dir(spark, "previous"), rows.schema)
    feed.start(rows, checkpoint(spark)).awaitTermination()
    return _previous_report(feed.rows())


@query(PREVIOUS_SQL)
def keyed_previous_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state outlives its writer: a new feed for each batch, merges, a batch written twice."""
    rows = r.events(spark, sf_dir).select("event_id", "ts", "user_id", "value")
    root = scratch_dir(spark, "previous-state")
    for landing in range(LANDINGS):
        landed = rows.filter(F.col("event_id") % LANDINGS == landing)
        for _ in range(2 if landing == LANDINGS - 2 else 1):
            feed = previous_feed(spark, root, rows.schema, compact_every=2)
            feed.write_batch(landed, landing)
    return _previous_report(feed.rows())


@query("SELECT event_id, user_id, value FROM events")
def stream_dedup_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event twice, the landings out of time order: ids are looked up in the table.

    A watermark would drop first deliveries that come late; here none is lost.
    """
    rows = landed_events(spark, sf_dir).select(
        "event_id", "user_id", "value", F.explode(F.array(F.lit(1), F.lit(2))).alias("delivery")
    )
    columns = tuple(
        ColumnSpec(c, rows.schema[c].dataType, c == "event_id")
        for c in ("event_id", "user_id", "value")
    )
    spec = TableSpec("once", columns, hash_keys=("event_id",), buckets=8)
    log = KeyedLog(
        spark, scratch_dir(spark, "once"), spec, ["delivery"], INSERT,
        rows.select("delivery").schema,
    )
    log.start(rows, checkpoint(spark)).awaitTermination()
    return log.current()


@query("""
SELECT count(*) FILTER (event_type = 'error') AS n_rejected_before, count(*) AS n_rows,
       CAST(0 AS BIGINT) AS n_rejected
FROM events
""")
def replaced_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch with rejects, written again without them: neither rows nor rejects stay."""
    rows = r.events(spark, sf_dir).select(
        F.col("event_id").cast("int").alias("key"), F.col("ts").cast("string").alias("date"),
        F.col("value").alias("signal"), F.col("event_id").alias("sequence"), "event_type",
    )
    log = sensor_log(spark, UPSERT)
    broken = F.when(F.col("event_type") != "error", F.col("key"))
    log.write_batch(rows.withColumn("key", broken), 0)
    before = log.rejected().agg(F.count(F.lit(1)).alias("n_rejected_before"))
    before = spark.createDataFrame(before.collect(), before.schema)
    log.write_batch(rows, 0)
    left = log.rejected()
    n_left = F.lit(0 if left is None else left.count()).cast("long").alias("n_rejected")
    now = log.current().agg(F.count(F.lit(1)).alias("n_rows"))
    return before.join(now).select("n_rejected_before", "n_rows", n_left)


@query(LATEST_SQL)
def commit_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Commits on a timer: each makes its batch visible, and the query goes on."""
    log = sensor_log(spark, UPSERT)
    running = log.start(sensor_stream(spark, sf_dir), checkpoint(spark), interval="100 milliseconds")
    running.processAllAvailable()
    running.stop()
    return log.current()


@query(f"""
SELECT event_id % {LANDINGS} AS landing, strftime(ts, '%Y-%m') AS bucket, count(*) AS n
FROM events GROUP BY 1, 2
""")
def rolled_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each commit rolls new files in every bucket it meets, below a path with a scheme."""
    out = scratch_dir(spark, "rolled")
    if "://" not in out and not out.startswith("file:"):
        out = f"file:{out}"
    rows = landed_events(spark, sf_dir).select(
        (F.col("event_id") % LANDINGS).alias("landing"),
        F.substr(F.col("ts").cast("string"), F.lit(1), F.lit(7)).alias("bucket"),
    )
    ingest.write_bucketed(rows, out, checkpoint(spark)).awaitTermination()
    found = ingest.read_bucketed(spark, out, rows.select("landing").schema)
    return found.groupBy("landing", "bucket").agg(F.count(F.lit(1)).alias("n"))
