"""Registration of queries, and the inputs they derive from the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow.sources.messages import spread

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# Fixed value: the service date of schedule queries (a parameter, so reruns agree).
SERVICE_DATE = "2024-03-01"


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its name, with the SQL that gives the same rows."""

    def register(function: Query) -> Query:
        name = function.__name__
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def spread_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events for decoding, which costs far more than reading their one file."""
    return spread(events(spark, sf_dir), decode_tasks(spark))


def decode_tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def iso_text(ts: str = "ts") -> Column:
    """``yyyy-MM-ddTHH:mm:ss`` of a zoneless timestamp, independent of the session zone."""
    text = F.col(ts).cast("string")
    return F.concat(
        F.substr(text, F.lit(1), F.lit(10)), F.lit("T"), F.substr(text, F.lit(12), F.lit(8))
    )


def clock_text(ts: str = "ts") -> Column:
    """``HH:mm:ss`` of a zoneless timestamp."""
    return F.substr(F.col(ts).cast("string"), F.lit(12), F.lit(8))


def day_text(ts: str = "ts") -> Column:
    return F.substr(F.col(ts).cast("string"), F.lit(1), F.lit(10))


def sensor_message() -> Column:
    """A sensor message of an event: the user is the key."""
    return F.to_json(F.struct(
        F.col("user_id").alias("key"),
        F.col("ts").cast("string").alias("date"),
        F.col("value").alias("signal"),
    ))


def greeting_message() -> Column:
    """A greeting message; the date is missing for events of type ``error``."""
    return F.to_json(F.struct(
        F.when(F.col("event_type") != "error", day_text()).alias("date"),
        F.concat(F.lit("Hello"), F.col("event_id").cast("string")).alias("name"),
    ))


def transit_message() -> Column:
    """A transit live message: the user is the trip, the event its observation."""
    observed = F.concat(iso_text(), F.lit("+05:30"))
    return F.to_json(F.struct(
        F.concat(F.lit("T"), F.col("user_id").cast("string")).alias("trip_id"),
        F.concat(F.lit("x/"), F.col("event_id").cast("string")).alias("id"),
        F.col("event_type").alias("route_id"),
        F.when(F.col("value") > 100, F.lit("UP")).otherwise(F.lit("DN")).alias("trip_direction"),
        observed.alias("actual_trip_start_time"),
        clock_text().alias("last_stop_arrival_time"),
        F.concat(F.lit("V"), F.col("user_id").cast("string")).alias("vehicle_label"),
        F.lit("AA00").alias("license_plate"),
        F.col("props").alias("last_stop_id"),
        F.col("value").alias("speed"),
        observed.alias("observationDateTime"),
        F.col("event_id").alias("trip_delay"),
        F.struct(
            F.lit("Point").alias("type"),
            F.array(F.col("user_id").cast("double"), F.col("value")).alias("coordinates"),
        ).alias("location"),
    ))


def schedule_element() -> Column:
    """A schedule element of an event."""
    return F.struct(
        F.col("user_id").cast("int").alias("trip_id"),
        F.struct(
            clock_text().alias("arrival_time"),
            F.col("event_id").cast("int").alias("stop_sequence"),
            F.length("event_type").alias("stop_id"),
            clock_text().alias("departure_time"),
        ).alias("trip_details"),
    )
