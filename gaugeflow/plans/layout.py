"""How a keyed table's rows are checked and laid out in partitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeflow.functions.keys import hash_bucket, range_id
from gaugeflow.operators import rejects
from gaugeflow.plans.spec import TableSpec


def key_rules(spec: TableSpec) -> list[tuple[str, Column]]:
    """Reasons to refuse a row: no key, no required value, no range for it."""
    rules = [(rejects.NULL_KEY, rejects.any_null(spec.keys))]
    if spec.required:
        rules.append((rejects.NULL_REQUIRED, rejects.any_null(spec.required)))
    if spec.range_columns:
        rules.append((rejects.NO_RANGE, range_of(spec).isNull()))
    return rules


def range_of(spec: TableSpec) -> Column:
    """Range partition id of a row, NULL where no range holds it."""
    types = [spec.type_of(c).simpleString() for c in spec.range_columns]
    return range_id([F.col(c) for c in spec.range_columns], types, spec.ranges)


def key_filter(spec: TableSpec, key_values: dict) -> Column:
    """Condition on key values, and on the partition columns that follow from them."""
    values = {c: F.lit(v).cast(spec.type_of(c)) for c, v in key_values.items()}
    condition = F.lit(True)
    for name, value in values.items():
        condition = condition & (F.col(name) == value)
    if spec.hash_keys and set(spec.hash_keys) <= set(values):
        keys = [values[c] for c in spec.hash_keys]
        condition = condition & (F.col("bucket") == hash_bucket(keys, spec.buckets))
    if spec.range_columns and set(spec.range_columns) <= set(values):
        bounds = [values[c] for c in spec.range_columns]
        types = [spec.type_of(c).simpleString() for c in spec.range_columns]
        condition = condition & (F.col("range_id") == range_id(bounds, types, spec.ranges))
    return condition


def with_partitions(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Add the partition columns of ``spec``: ``range_id`` and ``bucket``."""
    if spec.range_columns:
        df = df.withColumn("range_id", range_of(spec))
    if spec.hash_keys:
        keys = [F.col(c) for c in spec.hash_keys]
        df = df.withColumn("bucket", hash_bucket(keys, spec.buckets))
    return df


def for_write(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Rows reduced per key, arranged for a write with few files per partition.

    Buckets over the whole key, in its order, follow from the exchange of the reduction
    where the shuffle's partitions are a multiple of them. Others need a rebalance, which
    splits partitions that are too large and joins small ones. Files are in the order of keys.
    """
    shuffled = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if spec.hash_keys and tuple(spec.hash_keys) == tuple(spec.keys) and shuffled % spec.buckets == 0:
        return in_key_order(df, spec)
    return in_key_order(df.hint("rebalance", *spec.partition_columns), spec)


def in_key_order(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Rows sorted for files in which the statistics of row groups and pages tell keys apart.

    The writer sorts by partition anyway; this order includes its own.
    """
    return df.sortWithinPartitions(*spec.partition_columns, *spec.keys)
