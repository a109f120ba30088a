"""Stream operators and append sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from gaugeflow import files
from gaugeflow.plans.spec import record_schema
from gaugeflow.session import ROCKSDB_PROVIDER, settings


def with_trigger(writer: DataStreamWriter, interval: str | None) -> DataStreamWriter:
    """Commit every ``interval`` (``"10 seconds"``); without one, drain the input and stop.

    Each trigger is one commit: files become visible, and the checkpoint moves on.
    """
    if interval is None:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=interval)


def drop_redelivered(
    stream: DataFrame, id_column: str, event_time: str, delay: str
) -> DataFrame:
    """Drop messages whose id was seen within ``delay``; state is bounded by it."""
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([id_column])


def start_stateful(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    interval: str | None = None,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Append a stateful stream to Parquet, with its state in the disk-backed store.

    ``state_partitions`` is the number of tasks that share the state. It stays with the
    checkpoint, so choose it once for the cluster; by default the session's shuffle
    partitions count.
    """
    writer = stream.writeStream.format("parquet").outputMode("append")
    writer = writer.option("path", path).option("checkpointLocation", checkpoint)
    conf = {"spark__sql__streaming__stateStore__providerClass": ROCKSDB_PROVIDER}
    if state_partitions is not None:
        conf["spark__sql__shuffle__partitions"] = str(state_partitions)
    with settings(stream.sparkSession, **conf):
        return with_trigger(writer, interval).start()


def write_bucketed(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    bucket: str = "bucket",
    interval: str | None = None,
    files_per_bucket: int | None = None,
) -> StreamingQuery:
    """Append to Parquet files below ``bucket=<label>/``, exactly once.

    By default tasks write the buckets they meet without a shuffle: a live stream touches
    a few dates per commit, and a date that holds most rows stays spread over all tasks.
    A backfill meets many dates in each task; ``files_per_bucket`` then deals each bucket's
    rows out to so many files at most. ``path`` may be on any Hadoop file system.
    """
    if files_per_bucket is not None:
        names = stream.columns
        part = F.pmod(F.xxhash64(*names), F.lit(files_per_bucket))
        stream = stream.withColumn("_part", part).repartition(bucket, "_part").select(*names)
    writer = stream.writeStream.format("parquet").partitionBy(bucket)
    writer = writer.option("path", path).option("checkpointLocation", checkpoint)
    return with_trigger(writer.outputMode("append"), interval).start()


def read_record_schema(spark: SparkSession, path: str) -> T.StructType:
    """Schema of a record schema file on any Hadoop file system."""
    return record_schema(files.read_text(spark, path))


def read_bucketed(
    spark: SparkSession, path: str, schema: T.StructType, bucket: str = "bucket"
) -> DataFrame:
    """Read :func:`write_bucketed` back with the bucket as text.

    The schema is explicit, else a folder of all-digit labels would read as numbers,
    and nullable, since files may hold NULL in a field the record schema requires.
    """
    fields = [T.StructField(f.name, f.dataType) for f in schema]
    fields.append(T.StructField(bucket, T.StringType()))
    return spark.read.schema(T.StructType(fields)).parquet(path)


def write_table(
    stream: DataFrame, table: str, checkpoint: str, interval: str | None = None
) -> StreamingQuery:
    """Continuously insert a stream into a catalog table."""
    writer = stream.writeStream.option("checkpointLocation", checkpoint).outputMode("append")
    return with_trigger(writer, interval).toTable(table)
