"""The feed of a catalog table: batches upserted into a table made from a spec.

A fed table is a :class:`KeyedLog` whose merges the catalog follows. After each merge the
partitions it wrote are pointed at the new snapshot, one by one. A key never leaves its
partition, so a query by table name, in any session, sees each key as of the last merge of
its partition or the one before: at most a quarter of the partition's size may be newer.
``current`` and ``register`` show batches that are not merged yet too.

The table's definition is read anew for each batch, so a stream goes on after DDL. Stop it
while DDL runs: nothing coordinates the two.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from gaugeflow.streaming.keyed_log import KeyedLog


class TableFeed(KeyedLog):
    """Made by ``Tables.feed``; rows that leave out columns get their defaults."""

    def __init__(self, tables, name: str):
        self.tables, self.name = tables, name
        self._reload()
        self._views = set()

    def _reload(self) -> None:
        views = getattr(self, "_views", set())
        root, settings = self.tables.feed_settings(self.name)
        beside = [T.StructField.fromJson(f) for f in settings["beside"]]
        super().__init__(
            self.tables.spark, root, self.tables.spec(self.name), settings["order_by"],
            settings["mode"], T.StructType(beside),
        )
        self.added = {c: (default, last) for c, (default, last) in settings["added"].items()}
        self._views = views

    def write_batch(self, df: DataFrame, batch_id: int) -> None:
        self._reload()
        super().write_batch(self.tables.completed(self.name, df), batch_id)

    def compact(self, through: int | None = None, share: float = 0.0) -> int | None:
        """Merge all batches (or those up to ``through``) and show the result by table name.

        A merged batch cannot be written again; a restarted stream passes over it.
        """
        self._reload()
        known = {*self.batches(), *(last for _, last in self._runs())}
        merged = [n for n in known if through is None or n <= through]
        done = super().compact(max(merged), share) if merged else None
        self.tables.show_merged(self.name, self.merged_parts())
        return done

    def merged_rows(self) -> DataFrame:
        """The merged rows with all that the feed keeps beside them."""
        return self._read(self._layout()[0].values(), None, self.spec.partition_columns)
