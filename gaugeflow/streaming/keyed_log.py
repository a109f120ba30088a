"""Keyed tables fed batch by batch: upsert (last row wins) or insert (first row wins).

Parquet tables have no MERGE. Each batch is therefore written once, as a folder of
its own, reduced to one row per key, and the current table is the last (or first)
row per key over the batches::

    <root>/log/batch_id=<n>/[range_id=<r>/]bucket=<b>/   accepted rows of batch n
    <root>/rejects/batch_id=<n>/                         rejected rows with a reason
    <root>/runs/from=<m>/through=<n>/...                 batches m to n, merged
    <root>/snapshot/through=<n>/...                      all batches up to n, merged

A key never leaves its partition, so partitions merge one by one: a snapshot holds those
that it wrote, and the others stay in the snapshot that has them. The rows of a partition
are its newest snapshot and what came after. A stream merges batches into runs, runs into
longer runs, and a partition anew once what came for it amounts to a share of its size.
So what is written follows what has changed, whatever the size of the table.

A batch that is replayed after a failure overwrites its own folder, so it counts
once. Spark's ``_SUCCESS`` file marks a folder as complete; others are not read.
"""

from __future__ import annotations

import functools
from collections import defaultdict
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from gaugeflow import files
from gaugeflow.operators import keyed, rejects
from gaugeflow.plans.layout import for_write, key_filter, key_rules, with_partitions
from gaugeflow.plans.pruning import partition_filter
from gaugeflow.plans.spec import TableSpec
from gaugeflow.streaming.ingest import with_trigger

UPSERT = "upsert"
INSERT = "insert"

# Batches of a stream that are merged into a run, and runs into a longer one.
COMPACT_EVERY = 10
# A stream writes a partition anew once this share of its size has come for it.
MERGE_SHARE = 0.25
# Seconds that a stream leaves merged folders to queries which may read them.
KEEP_SECONDS = 3600
# Rows after a snapshot, and bytes of their files, up to which their keys are broadcast to it.
MAX_BROADCAST_KEYS = 1_000_000
MAX_BROADCAST_BYTES = 32 << 20


@dataclass(frozen=True)
class _Stored:
    """One partition's folder in a batch, run or snapshot: what it covers, and its size."""

    folder: str
    first: int
    last: int
    part: str
    path: str
    size: int


class KeyedLog:
    """A keyed table of ``spec`` below ``root``, ordered by ``order_by``.

    ``order_by`` names columns of the incoming rows (of the table or beside it, such
    as a broker offset) that decide which row of a key is last; the batch number
    decides between equals. ``order_schema`` gives the types of those beside it.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        spec: TableSpec,
        order_by: Sequence[str],
        mode: str = UPSERT,
        order_schema: T.StructType | None = None,
    ):
        if mode not in (UPSERT, INSERT):
            raise ValueError(f"unknown mode {mode}")
        self.spark = spark
        self.root = root.rstrip("/")
        self.spec = spec.validate()
        self.order_by = list(order_by)
        self.mode = mode
        beside = [] if order_schema is None else list(order_schema.fields)
        self.row_schema = T.StructType([*spec.schema.fields, *beside])
        missing = [c for c in self.order_by if c not in self.row_schema.names]
        if missing:
            raise ValueError(f"order columns {missing} need a type in order_schema")
        # Columns younger than their oldest rows: the default (SQL) of rows up to a batch.
        self.added: dict[str, tuple[str, int]] = {}
        self._views: set[str] = set()

    # -- writing ---------------------------------------------------------------

    def write_batch(self, df: DataFrame, batch_id: int) -> None:
        """Write one batch. Writing the same ``batch_id`` again replaces it and its rejects.

        A batch that a snapshot covers is merged already and can no longer be replaced.
        """
        if self._is_merged(batch_id):
            raise ValueError(f"batch {batch_id} is merged")
        tagged = self._tagged(df)
        seen = Observation()
        observed = tagged.observe(
            seen, F.count_if(F.col(rejects.REASON).isNotNull()).alias("rejected")
        )
        reduced = self._reduce(rejects.accepted(observed).select(*self.row_schema.names))
        self._write(reduced, f"{self.root}/log/batch_id={batch_id}")
        # Rejected rows are rare: they cost a second pass only where there are some.
        path = f"{self.root}/rejects/batch_id={batch_id}"
        if seen.get["rejected"]:
            rejects.rejected(tagged).write.mode("overwrite").parquet(path)
        else:
            files.delete(self.spark, path)
        self._renew_views()

    def start(
        self,
        stream: DataFrame,
        checkpoint: str,
        interval: str | None = None,
        compact_every: int | None = COMPACT_EVERY,
        keep_seconds: float = KEEP_SECONDS,
    ) -> StreamingQuery:
        """Feed a stream into the table, one batch per trigger.

        After each ``compact_every`` batches :meth:`merge` merges what it takes to keep
        reads short, and what that replaces goes after ``keep_seconds``; None leaves both to
        the caller.
        """

        def write(df: DataFrame, batch_id: int) -> None:
            # After a failure between merge and commit the batch comes again, and is there.
            if self._is_merged(batch_id):
                return
            self.write_batch(df, batch_id)
            if compact_every and (batch_id + 1) % compact_every == 0:
                self.merge(batch_id, compact_every)
                self.vacuum(keep_seconds)

        writer = stream.writeStream.foreachBatch(write)
        writer = writer.option("checkpointLocation", checkpoint)
        return with_trigger(writer, interval).start()

    def _tagged(self, df: DataFrame) -> DataFrame:
        rules = [*key_rules(self.spec), (rejects.NULL_ORDER, rejects.any_null(self.order_by))]
        return rejects.tag(df, rules)

    def _reduce(self, df: DataFrame) -> DataFrame:
        pick = keyed.latest if self.mode == UPSERT else keyed.first
        return pick(df, self.spec.keys, self.order_by)

    def _write(self, df: DataFrame, path: str) -> None:
        rows = for_write(with_partitions(df, self.spec), self.spec)
        rows.write.mode("overwrite").partitionBy(*self.spec.partition_columns).parquet(path)

    # -- reading ---------------------------------------------------------------

    def current(
        self,
        through: int | None = None,
        where: Column | None = None,
        among: DataFrame | None = None,
    ) -> DataFrame:
        """One row per key, of all batches or of those up to ``through``.

        A merged table with no batch after it is a plain scan. With few rows after it,
        only the keys among them are reduced again. Otherwise all rows are reduced per
        key, with a partial step before the shuffle. ``where`` may use key and partition
        columns; it reaches the scan. ``among`` holds distinct keys to keep, few enough
        to be broadcast: rows of others are dropped before any shuffle.
        """
        return self._current(through, where, among).select(*self.spec.schema.names)

    def lookup(self, **key_values) -> DataFrame:
        """Rows of one key, reading only the folders that can hold it."""
        return self.current(where=key_filter(self.spec, key_values))

    def filtered(self, condition: Column | str) -> DataFrame:
        """Current rows that meet a condition, reading only partitions that can hold one."""
        where = partition_filter(self.spark, self.spec, condition)
        return self.current(where=where).filter(condition)

    def register(self, name: str) -> DataFrame:
        """Make the current rows a temporary view for SQL.

        What this log writes, merges or deletes from now on renews the view, so a query
        started later sees it. Batches that another session writes do not.
        """
        self._views.add(name)
        df = self.current()
        df.createOrReplaceTempView(name)
        return df

    def _renew_views(self) -> None:
        for name in self._views:
            self.current().createOrReplaceTempView(name)

    def rejected(self) -> DataFrame | None:
        """All rejected rows with their batch, or None."""
        folders = self._complete("rejects", "batch_id")
        if not folders:
            return None
        paths = [f"{self.root}/rejects/batch_id={n}" for n in folders]
        reader = self.spark.read.option("basePath", f"{self.root}/rejects")
        return reader.option("mergeSchema", "true").parquet(*paths)

    def batches(self) -> list[int]:
        return self._complete("log", "batch_id")

    def _complete(self, folder: str, label: str) -> list[int]:
        return files.complete_folders(self.spark, f"{self.root}/{folder}", label)

    def _runs(self) -> list[tuple[int, int]]:
        """The first and last batch of each complete run."""
        marks = files.matching(self.spark, f"{self.root}/runs/from=*/through=*/_SUCCESS")
        return sorted(tuple(int(x.partition("=")[2]) for x in m.split("/")[-3:-1]) for m in marks)

    def _is_merged(self, batch_id: int) -> bool:
        ends = self._complete("snapshot", "through") + [last for _, last in self._runs()]
        return any(n >= batch_id for n in ends)

    def _stored(self, folder: str) -> list[_Stored]:
        """What is complete in ``log``, ``runs`` or ``snapshot``, by partition."""
        if folder == "runs":
            complete = set(self._runs())
        else:
            label = "batch_id" if folder == "log" else "through"
            complete = {(n,) for n in self._complete(folder, label)}
        if not complete:
            return []
        parts, labels = len(self.spec.partition_columns), 2 if folder == "runs" else 1
        pattern = f"{self.root}/{folder}" + "/*=*" * (labels + parts) + "/*.parquet"
        found = []
        for path, size in files.folder_sizes(self.spark, pattern).items():
            names = path.split("/")[-labels - parts:]
            numbers = tuple(int(n.partition("=")[2]) for n in names[:labels])
            if numbers in complete:
                first = numbers[0] if folder != "snapshot" else -1
                part = "/".join(names[labels:])
                found.append(_Stored(folder, first, numbers[-1], part, path, size))
        return found

    def _layout(
        self, through: int | None = None, min_age: float | None = None
    ) -> tuple[dict[str, _Stored], dict[str, list[_Stored]]]:
        """Of each partition: its newest snapshot, and the fewest folders that come after.

        ``min_age`` passes over snapshots and runs that are younger (in seconds).
        """
        def old(path: str) -> bool:
            return min_age is None or files.age(self.spark, f"{self.root}/{path}/_SUCCESS") >= min_age

        def known(folder: str) -> list[_Stored]:
            return [s for s in self._stored(folder) if through is None or s.last <= through]

        ends = {n for n in self._complete("snapshot", "through") if old(f"snapshot/through={n}")}
        bases: dict[str, _Stored] = {}
        for stored in sorted(known("snapshot"), key=lambda s: s.last):
            if stored.last in ends:
                bases[stored.part] = stored
        runs = [
            r for r in self._runs()
            if (through is None or r[1] <= through) and old(f"runs/from={r[0]}/through={r[1]}")
        ]
        later: dict[str, list[_Stored]] = defaultdict(list)
        for stored in [*known("runs"), *known("log")]:
            if stored.folder == "runs" and (stored.first, stored.last) not in runs:
                continue
            if stored.part not in bases or stored.last > bases[stored.part].last:
                if not any(self._covers(run, stored) for run in runs):
                    later[stored.part].append(stored)
        return bases, dict(later)

    @staticmethod
    def _covers(run: tuple[int, int], stored: _Stored) -> bool:
        """A longer run holds all that a batch or run does."""
        own = stored.first, stored.last
        if not run[0] <= own[0] <= own[1] <= run[1]:
            return False
        return stored.folder == "log" or run != own

    def _read(
        self, stored: Iterable[_Stored], where: Column | None = None, also: Sequence[str] = ()
    ) -> DataFrame:
        parts = [T.StructField(c, T.IntegerType()) for c in self.spec.partition_columns]
        fields = [*self.row_schema.fields, T.StructField("batch_id", T.LongType()), *parts]
        labels = {"log": (), "runs": ("from", "through"), "snapshot": ("through",)}
        paths = defaultdict(list)
        for one in stored:
            paths[one.folder].append(one.path)
        frames = []
        for folder, found in paths.items():
            beside = [T.StructField(label, T.LongType()) for label in labels[folder]]
            reader = self.spark.read.schema(T.StructType([*fields, *beside]))
            df = reader.option("basePath", f"{self.root}/{folder}").parquet(*sorted(found))
            if where is not None:
                df = df.filter(where)
            frames.append(df)
        if not frames:
            return self.spark.createDataFrame([], T.StructType(fields)).select(
                *self.row_schema.names, "batch_id", *also
            )
        for name, (default, last) in self.added.items():
            old = F.expr(default).cast(self.row_schema[name].dataType)
            now = F.when(F.col("batch_id") <= last, old).otherwise(F.col(name))
            frames = [df.withColumn(name, now) for df in frames]
        columns = [*self.row_schema.names, "batch_id", *also]
        return functools.reduce(DataFrame.unionByName, [df.select(*columns) for df in frames])

    def _current(
        self,
        through: int | None,
        where: Column | None = None,
        among: DataFrame | None = None,
    ) -> DataFrame:
        return self._merged(*self._layout(through), where, among)

    def _merged(
        self,
        bases: dict[str, _Stored],
        later: dict[str, list[_Stored]],
        where: Column | None = None,
        among: DataFrame | None = None,
    ) -> DataFrame:
        """One row per key of the given folders."""
        def read(stored: Iterable[_Stored]) -> DataFrame:
            rows = self._read(stored, where)
            if among is None:
                return rows
            return rows.join(F.broadcast(among), self.spec.keys, "left_semi")

        # Partitions that stand in one folder have one row for each key already.
        whole = [base for part, base in bases.items() if part not in later]
        whole += [s[0] for part, s in later.items() if part not in bases and len(s) == 1]
        known = {s.part for s in whole}
        merged = [base for part, base in bases.items() if part not in known]
        new = [s for part, found in later.items() if part not in known for s in found]
        if not new:
            return read(whole)
        rows = self._last_of(merged, new, read, among)
        return rows.unionByName(read(whole)) if whole else rows

    def _last_of(self, merged: list[_Stored], new: list[_Stored], read, among) -> DataFrame:
        added = read(new)
        if not merged:
            return self._last(added)
        stored = read(merged)
        if among is not None or sum(s.size for s in new) > MAX_BROADCAST_BYTES:
            return self._last(stored.unionByName(added))
        # Counting rows reads only the files' footers, and small files only.
        if self._read(new).count() > MAX_BROADCAST_KEYS:
            return self._last(stored.unionByName(added))
        # A large snapshot with few later rows: only keys that changed are shuffled.
        keys = self.spec.keys
        changed = F.broadcast(added.select(*keys).distinct())
        untouched = stored.join(changed, keys, "left_anti")
        touched = stored.join(changed, keys, "left_semi")
        return untouched.unionByName(self._last(touched.unionByName(added)))

    def _last(self, rows: DataFrame) -> DataFrame:
        pick = keyed.latest if self.mode == UPSERT else keyed.first
        return pick(rows, self.spec.keys, [*self.order_by, "batch_id"])

    # -- upkeep ----------------------------------------------------------------

    def compact(self, through: int | None = None, share: float = 0.0) -> int | None:
        """Merge batches into a snapshot; later reads start from it.

        Only partitions are written for which rows came since their last merge, and of these
        those whose new rows amount to ``share`` of their size. The newest batch stays out by
        default, since a restarted stream may replay it. Nothing is replaced: a reader sees
        the old state until the new folder is complete. Returns the last merged batch, None
        if there was nothing to merge.
        """
        if through is None:
            done = sorted({*self.batches(), *(last for _, last in self._runs())})
            through = done[-2] if len(done) > 1 else None
        if through is None or through in self._complete("snapshot", "through"):
            return None
        bases, later = self._layout(through)
        due = {
            part: found for part, found in later.items()
            if part not in bases or sum(s.size for s in found) >= share * bases[part].size
        }
        if share and not due:
            return None
        rows = self._merged({part: base for part, base in bases.items() if part in due}, due)
        if not due:  # batches without rows: only the mark that they are merged
            rows = rows.limit(0)
        self._write(rows, f"{self.root}/snapshot/through={through}")
        self._renew_views()
        return through

    def merge(self, batch_id: int, every: int = COMPACT_EVERY, share: float = MERGE_SHARE) -> None:
        """What a stream does after its batch ``batch_id``, all but that batch taking part.

        Partitions are written anew that have grown by ``share``; what came for the others
        becomes a run of ``every`` batches, or of as many shorter runs.
        """
        self.compact(batch_id - 1, share)
        turn, width = (batch_id + 1) // every, every
        while every > 1 and turn % every == 0:
            turn, width = turn // every, width * every
        run = batch_id - width, batch_id - 1
        _, later = self._layout(batch_id - 1)
        short = [s for found in later.values() for s in found if self._covers(run, s)]
        if len({(s.first, s.last) for s in short}) > 1:
            rows = self._last(self._read(short))
            self._write(rows, f"{self.root}/runs/from={run[0]}/through={run[1]}")
            self._renew_views()

    def vacuum(self, keep_seconds: float = 0) -> None:
        """Delete folders of partitions that a newer snapshot or a longer run covers.

        A query that runs may still read them: ``keep_seconds`` spares what is covered only
        by merges younger than that.
        """
        aged, now = self._layout(min_age=keep_seconds or None), self._layout()
        used = {
            s.path for bases, later in (aged, now)
            for found in (bases.values(), *later.values()) for s in found
        }
        held = set()
        for folder in ("log", "runs", "snapshot"):
            for stored in self._stored(folder):
                if stored.path in used:
                    held.add((folder, stored.first, stored.last))
                else:
                    files.delete(self.spark, stored.path)
        # Then folders in which nothing is left, but for the newest of either kind.
        old = [n for n in self._complete("snapshot", "through") if files.age(
            self.spark, f"{self.root}/snapshot/through={n}/_SUCCESS") >= keep_seconds]
        end = max(old, default=-1)
        runs = self._runs()
        for n in self.batches():
            covered = n <= end or any(("runs", *r) in held and r[0] <= n <= r[1] for r in runs)
            if covered and ("log", n, n) not in held:
                files.delete(self.spark, f"{self.root}/log/batch_id={n}")
        for n in old:
            if n < end and ("snapshot", -1, n) not in held:
                files.delete(self.spark, f"{self.root}/snapshot/through={n}")
        for run in runs:
            longer = any(r != run and r[0] <= run[0] and run[1] <= r[1] for r in runs)
            if (run[1] <= end or longer) and ("runs", *run) not in held:
                files.delete(self.spark, f"{self.root}/runs/from={run[0]}/through={run[1]}")

    def merged_parts(self) -> dict[str, tuple[int, str]]:
        """Of each partition (``range_id=1/bucket=2``): the last merged batch, and its folder."""
        return {part: (base.last, base.path) for part, base in self._layout()[0].items()}
