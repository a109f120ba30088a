"""Message sources, as a stream or as a batch, with the payload in ``value``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TEXT_SCHEMA = T.StructType([T.StructField("value", T.StringType())])


def file_messages(
    spark: SparkSession, path: str, files_per_trigger: int | None = None
) -> DataFrame:
    """Stream of text files with one message per line."""
    reader = spark.readStream.schema(TEXT_SCHEMA)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.text(path)


def queue_messages(
    spark: SparkSession, options: dict[str, str], offsets_per_trigger: int | None = None
) -> DataFrame:
    """Stream of a Kafka topic; needs the connector in the deployment.

    ``correlation_id`` is the header of that name and ``ts`` the broker's time.
    Pass logins through ``session.environment_options``, not in code.
    """
    reader = spark.readStream.format("kafka").option("includeHeaders", "true").options(**options)
    if offsets_per_trigger is not None:
        reader = reader.option("maxOffsetsPerTrigger", offsets_per_trigger)
    return queue_columns(reader.load())


def queue_columns(rows: DataFrame) -> DataFrame:
    """What :func:`queue_messages` takes from the connector's columns."""
    header = F.filter("headers", lambda h: h["key"] == "correlation_id")
    return rows.select(
        F.col("value").cast("string").alias("value"),
        F.get(header, 0)["value"].cast("string").alias("correlation_id"),
        F.col("timestamp").alias("ts"),
        F.col("partition"),
        F.col("offset"),
    )


def table_stream(
    spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int | None = None
) -> DataFrame:
    """Stream of Parquet rows below ``path``, which may be one file or a folder."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    # A stream over one file needs a pattern; the pattern matches a folder as well.
    return reader.parquet(f"{path[:-1]}[{path[-1]}]")


def write_messages(df: DataFrame, path: str, value: str = "value") -> None:
    """Write one message per line."""
    df.select(F.col(value).alias("value")).write.text(path)


def spread(df: DataFrame, partitions: int | None) -> DataFrame:
    """Deal an input out for costly decoding, where its files make too few splits.

    The caller knows the input and chooses; None leaves it as it is, without a shuffle.
    """
    return df if partitions is None else df.repartition(partitions)
