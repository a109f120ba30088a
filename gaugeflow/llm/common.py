"""Helpers the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gaugeflow.session import scratch_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def doc_id() -> Column:
    return F.col("doc_id").cast("long").alias("doc_id")


def texts(docs: DataFrame) -> DataFrame:
    """The two columns most operators read; null text counts as empty."""
    return docs.select(doc_id(), text_or_empty().alias("text"))


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table in the shared folder.

    Cuts the lineage: what a lost executor had computed is read again, not computed
    again, and several readers see the same rows.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def map_batches(
    df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str | StructType
) -> DataFrame:
    """``mapInArrow`` with a function of one record batch (Spark bounds their bytes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield function(batch)

    return df.mapInArrow(run, schema)


def packed_once(df: DataFrame, by: list[str]) -> DataFrame:
    """``by``, and ``text`` compressed as (packed, size), once for each ``by`` in a batch.

    For shuffles that need each text once: a row that a third of all rows repeat is then
    shuffled a few times only.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        first: dict[tuple, int] = {}
        for i, key in enumerate(zip(*(batch.column(name).to_pylist() for name in by))):
            first.setdefault(key, i)
        batch = batch.take(pa.array(first.values(), pa.int64()))
        codec = pa.Codec("zstd", 1)
        plain = batch.column("text").cast(pa.binary()).to_pylist()
        packed = pa.array([codec.compress(t, asbytes=True) for t in plain], pa.binary())
        sizes = pa.array(map(len, plain), pa.int64())
        return pa.RecordBatch.from_arrays(
            [*(batch.column(name) for name in by), packed, sizes], [*by, "packed", "size"]
        )

    fields = df.select(*by, F.lit(b"").alias("packed"), F.lit(0).cast("long").alias("size")).schema
    return map_batches(df.select(*by, "text"), run, fields)


def unpacked(packed: pa.Array, sizes: pa.Array) -> pa.Array:
    codec = pa.Codec("zstd")
    return pa.array([
        codec.decompress(t, n, asbytes=True) if n else b""
        for t, n in zip(packed.to_pylist(), sizes.to_pylist())
    ], pa.binary())


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All UTF-8 bytes of a text column without nulls, and the offset of each row's first."""
    if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type):
        width = np.int64
    else:
        width = np.int32
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], width)[column.offset:column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    first, last = int(offsets[0]), int(offsets[-1])
    if last == first:
        return np.zeros(0, np.uint8), offsets - first
    return np.frombuffer(buffers[2], np.uint8)[first:last], offsets - first


def span_summary(kinds: tuple[str, ...], spans: str = "spans") -> list[Column]:
    """Counts of the base kinds, the digest of their spans, and all spans as text."""
    def joined(column):
        return F.array_join(F.transform(column, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    base = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    def number(kind):
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")

    counts = [number(kind).alias(f"n_{kind}") for kind in kinds]
    return [
        *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col(spans)).alias("spans"),
    ]
