"""Queries over keyed operators and keyed tables, in batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeflow.operators import decode, keyed, rejects
from gaugeflow.plans import schemas
from gaugeflow.queries import registry as r
from gaugeflow.queries.registry import query
from gaugeflow.session import scratch_dir
from gaugeflow.streaming.keyed_log import INSERT, UPSERT, KeyedLog

SEQUENCE = T.StructType([T.StructField("sequence", T.LongType())])

LATEST_SQL = """
SELECT cast(user_id AS INT) AS key, cast(ts AS VARCHAR) AS date, value AS signal
FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
"""
FIRST_SQL = LATEST_SQL.replace(" DESC", "")


@query("""
SELECT user_id, ts::VARCHAR AS ts_text, event_id, event_type, value, props FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
""")
def upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = r.events(spark, sf_dir)
    return _with_text(keyed.latest(events, ["user_id"], ["ts", "event_id"], narrow_first=True))


@query("""
SELECT user_id, ts::VARCHAR AS ts_text, event_id, event_type, value, props FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1
""")
def insert_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = r.events(spark, sf_dir)
    return _with_text(keyed.first(events, ["user_id"], ["ts", "event_id"], narrow_first=True))


def _with_text(df: DataFrame) -> DataFrame:
    return df.withColumn("ts", F.col("ts").cast("string")).withColumnRenamed("ts", "ts_text")


@query("SELECT user_id, count(*) - 1 AS superseded FROM events GROUP BY user_id HAVING count(*) > 1")
def key_collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed.superseded(r.events(spark, sf_dir), ["user_id"])


@query("""
SELECT event_id,
       lag(value) OVER w AS previous_value,
       lag(event_type) OVER w AS previous_type
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
""")
def keyed_previous(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = keyed.previous(
        r.events(spark, sf_dir), ["user_id"], ["ts", "event_id"], ["value", "event_type"]
    )
    return rows.select(
        "event_id",
        F.col("previous.value").alias("previous_value"),
        F.col("previous.event_type").alias("previous_type"),
    )


def sensor_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decoded sensor messages with a broker sequence number."""
    rows = r.spread_events(spark, sf_dir).select(
        F.col("event_id").alias("sequence"), r.sensor_message().alias("value")
    )
    return decode.decode_sensor(rows)


def sensor_log(spark: SparkSession, mode: str) -> KeyedLog:
    return KeyedLog(
        spark, scratch_dir(spark, "sensor"), schemas.SENSOR_TABLE, ["date", "sequence"],
        mode, SEQUENCE,
    )


@query("""
WITH latest AS (
  SELECT user_id, ts, value FROM events
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
)
SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS sensors, max(value) AS highest
FROM latest GROUP BY 1
""")
def sensor_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages to a keyed table, then SQL: the sensors last heard of per day."""
    log = sensor_log(spark, UPSERT)
    log.write_batch(sensor_rows(spark, sf_dir), 0)
    name = "sensor_now_" + log.root[-32:]
    log.register(name)
    return spark.sql(f"""
        SELECT substr(date, 1, 10) AS day, count(*) AS sensors, max(signal) AS highest
        FROM {name} GROUP BY 1
    """)


@query(LATEST_SQL)
def compacted_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stream in two batches by event type, the older one merged."""
    log = sensor_log(spark, UPSERT)
    rows = r.spread_events(spark, sf_dir).select(
        F.col("event_id").alias("sequence"), "event_type", r.sensor_message().alias("value")
    )
    rows = decode.decode_sensor(rows)
    first_half = F.col("event_type").isin("click", "view")
    log.write_batch(rows.filter(first_half), 0)
    log.write_batch(rows.filter(~first_half), 1)
    log.compact()
    return log.current()


@query(LATEST_SQL)
def replayed_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch that is written twice counts once."""
    log = sensor_log(spark, UPSERT)
    rows = sensor_rows(spark, sf_dir)
    log.write_batch(rows, 0)
    log.write_batch(rows, 0)
    return log.current()


@query("""
SELECT CASE WHEN event_type = 'error' THEN 'null_key' ELSE 'null_order' END AS reject_reason,
       count(*) AS n
FROM events WHERE event_type IN ('error', 'signup') GROUP BY 1
""")
def rejected_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a keyed table refuses: errors lack their key, signups their order."""
    rows = r.events(spark, sf_dir).select(
        F.when(F.col("event_type") != "error", F.col("user_id").cast("int")).alias("key"),
        F.col("ts").cast("string").alias("date"),
        F.col("value").alias("signal"),
        F.when(F.col("event_type") != "signup", F.col("event_id")).alias("sequence"),
    )
    log = sensor_log(spark, INSERT)
    log.write_batch(rows, 0)
    return log.rejected().groupBy(rejects.REASON).agg(F.count(F.lit(1)).alias("n"))


@query(LATEST_SQL)
def live_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A view made before the first batch follows batches, a merge and the end of old files."""
    log = sensor_log(spark, UPSERT)
    name = "live_" + log.root[-32:]
    log.register(name)
    rows = sensor_rows(spark, sf_dir)
    for batch in range(3):
        log.write_batch(rows.filter(F.col("sequence") % 3 == batch), batch)
        if batch == 1:
            log.compact()
            log.vacuum()
    return spark.table(name)


@query(LATEST_SQL)
def tiered_merges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nine batches, merged into runs and partitions as a stream does it."""
    log = sensor_log(spark, UPSERT)
    rows = sensor_rows(spark, sf_dir)
    for batch in range(9):
        log.write_batch(rows.filter(F.pmod(F.xxhash64("sequence"), F.lit(9)) == batch), batch)
        if (batch + 1) % 2 == 0:
            log.merge(batch, every=2, share=0.75)
            log.vacuum()
    return log.current()
