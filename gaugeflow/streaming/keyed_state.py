"""The previous row of each key, carried across the batches of a stream.

The state is a keyed table of each key's last row. A batch is ordered by windows, joined to
the stored rows of its keys, and its own last rows become the next state: joins and windows
over Parquet, in which a key with most of the rows is split over tasks.

Rows are ordered within a batch, and against the key's last row across batches. A
row older than that last row is ``late``: it is kept, without a previous row, and
does not replace the stored one.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from gaugeflow import files
from gaugeflow.operators.keyed import MAX_KEY_ROWS, join_one_of_each, previous
from gaugeflow.plans.spec import ColumnSpec, TableSpec
from gaugeflow.streaming.ingest import with_trigger
from gaugeflow.streaming.keyed_log import MAX_BROADCAST_BYTES, MAX_BROADCAST_KEYS, KeyedLog


def output_schema(
    schema: T.StructType, fields: Sequence[str], out: str = "previous"
) -> T.StructType:
    """The input columns, the struct of previous values, and the late flag."""
    carried = T.StructType([T.StructField(c, schema[c].dataType) for c in fields])
    return T.StructType([
        *schema.fields, T.StructField(out, carried), T.StructField("late", T.BooleanType())
    ])


class PreviousFeed:
    """Previous rows by joins and windows; one folder of rows per batch below ``root``."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        schema: T.StructType,
        key: Sequence[str],
        order_by: Sequence[str],
        fields: Sequence[str],
        buckets: int = 8,
        max_key_rows: int = MAX_KEY_ROWS,
        compact_every: int = 20,
    ):
        self.spark = spark
        self.root = root.rstrip("/")
        self.schema = schema
        self.key = list(key)
        self.order_by = list(order_by)
        self.fields = list(fields)
        self.max_key_rows = max_key_rows
        self.compact_every = compact_every
        kept = dict.fromkeys([*key, *order_by, *fields])
        columns = tuple(ColumnSpec(c, schema[c].dataType, c in key) for c in kept)
        spec = TableSpec("last_rows", columns, hash_keys=tuple(key), buckets=buckets)
        self.last_rows = KeyedLog(spark, f"{self.root}/last", spec, order_by)

    def write_batch(self, df: DataFrame, batch_id: int) -> None:
        """Write the batch's rows, then its last rows; both replace an earlier try."""
        df = df.persist()
        try:
            sizes = [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in self.key]
            n, key_bytes = df.agg(
                F.count(F.lit(1)), F.sum(functools.reduce(Column.__add__, sizes))
            ).first()
            rows = self._with_previous(df, batch_id, n, key_bytes or 0)
            rows.write.mode("overwrite").parquet(f"{self.root}/rows/batch_id={batch_id}")
            self.last_rows.write_batch(df, batch_id)
            if (batch_id + 1) % self.compact_every == 0:
                # Only this feed reads the last rows, so merged batches can go at once.
                self.last_rows.merge(batch_id, self.compact_every)
                self.last_rows.vacuum()
        finally:
            df.unpersist()

    def _with_previous(
        self, df: DataFrame, batch_id: int, rows_in_batch: int, key_bytes: int = 0
    ) -> DataFrame:
        # A batch below the limit for one key has no key above it.
        max_key_rows = self.max_key_rows if rows_in_batch > self.max_key_rows else None
        # Only the batch's keys are of interest; many are left to the join below.
        few = rows_in_batch <= MAX_BROADCAST_KEYS and key_bytes <= MAX_BROADCAST_BYTES
        among = df.select(*self.key).distinct() if few else None
        # A replayed batch must not see its own rows.
        stored = self.last_rows.current(through=batch_id - 1, among=among)
        prior = stored.select(
            *self.key,
            F.struct(*self.order_by).alias("_order"),
            F.struct(*self.fields).alias("_prior"),
        )
        order = F.struct(*self.order_by)
        usable = F.lit(True)
        for name in (*self.key, *self.order_by):
            usable = usable & F.col(name).isNotNull()
        rows = df.filter(usable)
        if max_key_rows is None:
            joined = rows.join(prior, self.key, "left")
        else:
            joined = join_one_of_each(rows, prior, self.key, max_key_rows)
        joined = joined.withColumn(
            "late", F.coalesce(order < F.col("_order"), F.lit(False))
        )
        rows = previous(joined, [*self.key, "late"], self.order_by, self.fields, max_key_rows)
        shown = F.coalesce("previous", "_prior")
        return rows.select(
            *self.schema.names, F.when(~F.col("late"), shown).alias("previous"), "late"
        )

    def rejected(self) -> DataFrame | None:
        """Rows without a key or an order, which have no previous row."""
        return self.last_rows.rejected()

    def start(
        self, stream: DataFrame, checkpoint: str, interval: str | None = None
    ) -> StreamingQuery:
        writer = stream.writeStream.foreachBatch(self.write_batch)
        writer = writer.option("checkpointLocation", checkpoint)
        return with_trigger(writer, interval).start()

    def rows(self) -> DataFrame:
        """All rows written so far; batches that are not complete are left out."""
        base = f"{self.root}/rows"
        done = files.complete_folders(self.spark, base, "batch_id")
        paths = [f"{base}/batch_id={n}" for n in done]
        schema = output_schema(self.schema, self.fields)
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)
