"""Keyed Parquet tables in the catalog: create from a spec, load, change, drop.

A table's spec is kept in its properties. Its data lies below one folder, in a
sub-folder per layout version, partitioned by ``range_id`` and ``bucket``. Tables are
loaded, where a key's first row stays, or fed (:meth:`Tables.feed`), where batches upsert.

Columns of loaded tables have Parquet field ids, which files keep and readers go by. So
renaming, dropping and adding columns are changes of the definition only. Sessions that read
such a table need ``spark.sql.parquet.fieldId.read.enabled``: ``build_session`` sets it, and
opening :class:`Tables` does for its session and those made from it later.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeflow import files
from gaugeflow.operators import keyed, rejects
from gaugeflow.plans import spec as specs
from gaugeflow.plans.catalog import quoted, quoted_column, text_literal
from gaugeflow.plans.layout import (
    for_write, in_key_order, key_filter, key_rules, with_partitions,
)
from gaugeflow.plans.pruning import partition_filter
from gaugeflow.plans.ranges import RangePartition, check_ranges
from gaugeflow.plans.spec import AddColumn, AlterSpec, ColumnSpec, TableSpec
from gaugeflow.session import scratch_dir
from gaugeflow.streaming import keyed_log
from gaugeflow.streaming.table_feed import TableFeed

_SPEC = "gaugeflow.spec"
_ROOT = "gaugeflow.root"
_VERSION = "gaugeflow.version"
_RETIRED = "gaugeflow.retired"
_FEED = "gaugeflow.feed"
_LAST_ID = "gaugeflow.last_id"
_FIELD_ID = "parquet.field.id"
_READ_BY_ID = "spark.sql.parquet.fieldId.read.enabled"


@dataclass(frozen=True)
class Loaded:
    """What a load did not take: rows with a reason, and keys that were there before."""

    rejected: DataFrame
    superseded: DataFrame


class Tables:
    """Administration of the keyed tables of one database, stored below ``root``."""

    def __init__(self, spark: SparkSession, database: str, root: str):
        self.spark = spark
        self.database = database
        self.root = root.rstrip("/")
        spark.conf.set(_READ_BY_ID, "true")
        spark.sparkContext._jsc.sc().conf().set(_READ_BY_ID, "true")  # for later sessions
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(database)}")
        self._recover()

    # -- creating and reading --------------------------------------------------

    def create(self, spec: TableSpec) -> bool:
        """Create the table; an existing one is left alone and gives False.

        Hash or range partitions are required.
        """
        spec.validate()
        if self.exists(spec.name):
            return False
        # A folder of its own: a renamed or dropped table may still hold the plain name's.
        fields = [
            T.StructField(f.name, f.dataType, True, {_FIELD_ID: number})
            for number, f in enumerate(spec.schema, 1)
        ]
        # Sized texts are known to SQL definitions only, which give no ids.
        sized = any(isinstance(f.dataType, T.VarcharType) for f in fields)
        self._define(
            spec, f"{self.root}/{spec.name}-{uuid.uuid4().hex}", 1, {},
            numbered=None if sized else (fields, len(fields)),
        )
        return True

    def create_from(self, path: str) -> bool:
        """Create the table of a spec file on any Hadoop file system."""
        return self.create(specs.table_spec(files.read_text(self.spark, path)))

    def alter_from(self, path: str) -> str:
        """Apply a change file; returns the table's name afterwards."""
        return self.alter(specs.alter_spec(files.read_text(self.spark, path)))

    def exists(self, name: str) -> bool:
        return self.spark.catalog.tableExists(self._name(name))

    def spec(self, name: str) -> TableSpec:
        return specs.table_spec(self._properties(name)[_SPEC])

    def read(self, name: str) -> DataFrame:
        """The table's columns without the partition numbers."""
        spec = self.spec(name)
        return self.spark.table(self._name(name)).select(*spec.schema.names)

    def lookup(self, name: str, **key_values) -> DataFrame:
        """Rows of one key, reading only the partitions that can hold it."""
        spec = self.spec(name)
        rows = self.spark.table(self._name(name)).filter(key_filter(spec, key_values))
        return rows.select(*spec.schema.names)

    def filtered(self, name: str, condition: Column | str) -> DataFrame:
        """Rows that meet a condition, reading only the partitions that can hold one.

        Comparisons, ``BETWEEN`` and ``IN`` on the first range column narrow the ranges;
        constants for all hash columns narrow the buckets.
        """
        spec = self.spec(name)
        rows = self.spark.table(self._name(name))
        rows = rows.filter(partition_filter(self.spark, spec, condition)).filter(condition)
        return rows.select(*spec.schema.names)

    # -- loading ---------------------------------------------------------------

    def load(self, name: str, df: DataFrame, order_by: Sequence[str]) -> Loaded:
        """Insert rows; the first row of a key stays, whether loaded now or before.

        Rows without a key, a required value or a range are returned, not loaded; so are
        the keys of which rows lost, to the load's own or to stored ones, with how many.
        Columns that ``df`` leaves out get their default, or NULL. For upserts and
        continuous loads use ``streaming.keyed_log``.
        """
        if self._feed(name):
            raise ValueError(f"table {name} is fed: write its batches through its feed")
        spec = self.spec(name)
        columns = spec.schema.names
        tagged = rejects.tag(self.completed(name, df), key_rules(spec))
        good = rejects.accepted(tagged)
        beside = [c for c in order_by if c not in columns]
        good = good.select(*columns, *beside)
        rejected = rejects.rejected(tagged)
        if self._is_empty(name, spec):
            rows = keyed.first(good, spec.keys, order_by)
            self._insert(name, for_write(with_partitions(rows, spec), spec), spec)
            return Loaded(rejected, keyed.superseded(good, spec.keys))
        # One row for each key, read three times below, but made once.
        counted = keyed.first(good, spec.keys, order_by, count="_n")
        arrived = self._written(with_partitions(counted, spec), "arrived")
        known = self._stored_keys(name, spec, arrived)
        lost = F.col("_n") - 1 + F.coalesce("_stored", F.lit(0))
        # Written, since the insert makes all keys stored ones.
        superseded = self._written(
            arrived.join(known, spec.keys, "left").select(*spec.keys, lost.alias("superseded"))
            .filter("superseded > 0"),
            "superseded",
        )
        new = arrived.join(known, spec.keys, "left_anti")
        new = new.hint("rebalance", *spec.partition_columns)
        self._insert(name, in_key_order(new, spec), spec)
        return Loaded(rejected, superseded)

    def completed(self, name: str, df: DataFrame) -> DataFrame:
        """``df`` with the columns it leaves out: their default, or NULL."""
        spec, defaults = self.spec(name), self._defaults(name)
        for c in spec.schema.names:
            if c not in df.columns:
                value = F.expr(defaults.get(c, "NULL")).cast(spec.type_of(c))
                df = df.withColumn(c, value)
        return df

    def _insert(self, name: str, rows: DataFrame, spec: TableSpec) -> None:
        columns = [*spec.schema.names, *spec.partition_columns]
        rows.select(*columns).write.insertInto(self._name(name))

    def _stored_keys(self, name: str, spec: TableSpec, arrived: DataFrame) -> DataFrame:
        """The keys of ``arrived`` that are stored, marked ``_stored``.

        Only partitions that rows arrived for are read; a table has a bounded number of
        them. Few arrived keys are broadcast by Spark's own size check, and then the stored
        ones are not shuffled either.
        """
        stored = self.spark.table(self._name(name))
        met = arrived.select(*spec.partition_columns).distinct().collect()
        for c in spec.partition_columns:
            stored = stored.filter(F.col(c).isin(sorted({row[c] for row in met})))
        keys = arrived.select(*spec.keys)
        return stored.select(*spec.keys).join(keys, spec.keys, "left_semi").withColumn(
            "_stored", F.lit(1)
        )

    def _written(self, df: DataFrame, label: str) -> DataFrame:
        path = scratch_dir(self.spark, label)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def insert(self, name: str, query: str, order_by: Sequence[str]) -> Loaded:
        """Load the rows of a SQL query, with the checks and layout of :meth:`load`."""
        return self.load(name, self.spark.sql(query), order_by)

    def _is_empty(self, name: str, spec: TableSpec) -> bool:
        return not self.spark.sql(f"SHOW PARTITIONS {self._sql(name)}").head(1)

    # -- feeding ---------------------------------------------------------------

    def feed(
        self,
        name: str,
        order_by: Sequence[str] = (),
        mode: str = keyed_log.UPSERT,
        order_schema: T.StructType | None = None,
    ) -> TableFeed:
        """The feed of a table: batches whose last (or first) row of each key stays.

        The first call settles ``order_by``, ``mode`` and the types of order columns beside
        the table's own; later calls need no more than the name. Rows loaded before take
        part, so their order columns must be the table's own.
        """
        known = self._feed(name)
        beside = [] if order_schema is None else [f.jsonValue() for f in order_schema.fields]
        wanted = {"order_by": list(order_by), "mode": mode, "beside": beside}
        if known:
            if order_by and any(known[k] != v for k, v in wanted.items()):
                raise ValueError(f"table {name} is fed in another way")
            return TableFeed(self, name)
        if not order_by:
            raise ValueError(f"table {name} is not fed yet: name its order columns")
        spec = self.spec(name)
        if beside and not self._is_empty(name, spec):
            raise ValueError(f"rows of {name} have no values of {order_schema.names}")
        # Checks the settings before anything is written.
        keyed_log.KeyedLog(self.spark, self.root, spec, order_by, mode, order_schema)
        rows = self.spark.table(self._name(name)).withColumn("batch_id", F.lit(-1).cast("long"))
        for field in order_schema or []:
            rows = rows.withColumn(field.name, F.lit(None).cast(field.dataType))
        self._move(name, spec, rows, wanted | {"added": {}, "through": -1})
        return TableFeed(self, name)

    def feed_settings(self, name: str) -> tuple[str, dict]:
        """The folder and the settings of a table's feed."""
        properties = self._properties(name)
        return f"{properties[_ROOT]}/v{properties[_VERSION]}", json.loads(properties[_FEED])

    def show_merged(self, name: str, parts: dict[str, tuple[int, str]]) -> None:
        """Let the catalog read merges of the feed: partitions merged since it last did so.

        ``parts`` has the last merged batch and the folder of each partition.
        """
        folder, settings = self.feed_settings(name)
        newest = max((last for last, _ in parts.values()), default=settings["through"])
        if settings["through"] == newest:
            return
        table = self._sql(name)
        shown = {row["partition"] for row in self.spark.sql(f"SHOW PARTITIONS {table}").collect()}
        added = []
        for part, (last, path) in sorted(parts.items()):
            clause = f"PARTITION ({part.replace('/', ', ')})"
            if part not in shown:
                added.append(f"{clause} LOCATION {text_literal(path)}")
            elif last > settings["through"]:
                self.spark.sql(f"ALTER TABLE {table} {clause} SET LOCATION {text_literal(path)}")
        if added:
            self.spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {' '.join(added)}")
        location = _snapshot(folder, newest)
        self.spark.sql(f"ALTER TABLE {table} SET LOCATION {text_literal(location)}")
        self._store_feed(name, settings | {"through": newest})

    def _feed(self, name: str) -> dict | None:
        text = self._properties(name).get(_FEED)
        return json.loads(text) if text else None

    def _store_feed(self, name: str, settings: dict) -> None:
        self._set_property(name, _FEED, json.dumps(settings))

    def _merged(self, name: str) -> dict | None:
        """Merge what was fed, so that a change finds all rows in the table."""
        if self._feed(name):
            TableFeed(self, name).compact()
        return self._feed(name)

    def _not_ordering(self, name: str, column: str) -> None:
        feed = self._feed(name)
        if feed and column in feed["order_by"]:
            raise ValueError(f"the feed of {name} orders by {column}")

    # -- changing --------------------------------------------------------------

    def rename(self, name: str, new_name: str) -> None:
        spec = replace(self.spec(name), name=new_name)
        self.spark.sql(f"ALTER TABLE {self._sql(name)} RENAME TO {self._sql(new_name)}")
        self._store_spec(new_name, spec)

    def add_column(self, name: str, column: AddColumn) -> None:
        """Add a column without touching files; older rows read its default.

        A column that must not be NULL needs a default once the table has rows.
        """
        spec = self.spec(name)
        if column.name in spec.schema.names or column.name in spec.partition_columns:
            raise ValueError(f"column {column.name} exists")
        if not column.nullable and column.default is None and not self._is_empty(name, spec):
            raise ValueError(f"column {column.name} must not be NULL but has no default")
        feed = self._merged(name)
        if feed and column.name in [f["name"] for f in feed["beside"]]:
            raise ValueError(f"the feed of {name} has a column {column.name}")
        required = spec.required if column.nullable else (*spec.required, column.name)
        larger = replace(
            spec, columns=(*spec.columns, ColumnSpec(column.name, column.data_type)), required=required
        )
        if self._ids(name):
            metadata = {}
            if column.default is not None:
                text = sql_literal(column.default)
                metadata = {"CURRENT_DEFAULT": text, "EXISTS_DEFAULT": text}
            if column.name in self._retired(name):
                self._rewrite(name, spec, lambda df: df)
            fields = self._fields(name) + [T.StructField(column.name, column.data_type, True, metadata)]
            self._over_files(name, larger, fields)
            return
        if column.name in self._retired(name):
            # Files still hold values under this name: write them without it first.
            self._rewrite(name, spec, lambda df: df)
        default = "" if column.default is None else f" DEFAULT {sql_literal(column.default)}"
        self.spark.sql(
            f"ALTER TABLE {self._sql(name)} ADD COLUMNS "
            f"({quoted_column(column.name)} {column.data_type.simpleString()}{default})"
        )
        self._store_spec(name, larger)
        if feed and column.default is not None:
            since = {column.name: (sql_literal(column.default), feed["through"])}
            self._store_feed(name, feed | {"added": feed["added"] | since})

    def drop_column(self, name: str, column: str) -> None:
        """Drop a column that is not part of the key.

        A new definition over the same files is enough. Only a fed table with column
        defaults is written anew.
        """
        spec = self.spec(name)
        if column in spec.keys:
            raise ValueError(f"key column {column} cannot be dropped")
        if column not in spec.schema.names:
            raise ValueError(f"no column {column}")
        self._not_ordering(name, column)
        self._merged(name)
        smaller = replace(
            spec,
            columns=tuple(c for c in spec.columns if c.name != column),
            required=tuple(c for c in spec.required if c != column),
        )
        if self._ids(name):
            self._over_files(name, smaller, [f for f in self._fields(name) if f.name != column])
            return
        if self._defaults(name):
            self._rewrite(name, smaller, lambda df: df.drop(column))
            return
        properties = self._properties(name)
        retired = {*self._retired(name), column}
        self._redefine(
            smaller, properties[_ROOT], int(properties[_VERSION]), {}, retired,
            self._comments(name), self._feed(name),
        )

    def rename_column(self, name: str, old: str, new: str) -> None:
        """Rename a column by a new definition over the same files.

        A fed table, whose files have no field ids, is written anew in one pass without a
        shuffle. So is a table with files in which another column had the new name: Spark
        finds values by id, but their types by name.
        """
        spec = self.spec(name)
        if old not in spec.schema.names:
            raise ValueError(f"no column {old}")
        if new in spec.schema.names or new in spec.partition_columns:
            raise ValueError(f"column {new} exists")
        self._not_ordering(name, old)
        self._merged(name)

        def changed(names):
            return tuple(new if c == old else c for c in names)

        renamed = replace(
            spec,
            columns=tuple(replace(c, name=new) if c.name == old else c for c in spec.columns),
            hash_keys=changed(spec.hash_keys),
            range_columns=changed(spec.range_columns),
            required=changed(spec.required),
        )
        if self._ids(name) and new not in self._retired(name):
            fields = [
                T.StructField(new if f.name == old else f.name, f.dataType, True, f.metadata)
                for f in self._fields(name)
            ]
            self._over_files(name, renamed, fields, {old})
            return
        self._rewrite(name, renamed, lambda df: df.withColumnRenamed(old, new), {old: new})

    def set_default(self, name: str, column: str, value) -> None:
        self.spark.sql(
            f"ALTER TABLE {self._sql(name)} ALTER COLUMN {quoted_column(column)} "
            f"SET DEFAULT {sql_literal(value)}"
        )

    def remove_default(self, name: str, column: str) -> None:
        self.spark.sql(
            f"ALTER TABLE {self._sql(name)} ALTER COLUMN {quoted_column(column)} DROP DEFAULT"
        )

    def comment_column(self, name: str, column: str, comment: str) -> None:
        self.spark.sql(
            f"ALTER TABLE {self._sql(name)} ALTER COLUMN {quoted_column(column)} "
            f"COMMENT {text_literal(comment)}"
        )

    def comment_table(self, name: str, comment: str) -> None:
        self.spark.sql(f"COMMENT ON TABLE {self._sql(name)} IS {text_literal(comment)}")

    def add_range(self, name: str, entry: dict) -> int:
        """Add a range partition (``lower``, ``upper`` and optional bound kinds)."""
        spec = self.spec(name)
        added = self._range(spec, entry, 1 + max((r.range_id for r in spec.ranges), default=-1))
        check_ranges([*spec.ranges, added])
        self._store_spec(name, replace(spec, ranges=(*spec.ranges, added)))
        return added.range_id

    def drop_range(self, name: str, entry: dict) -> None:
        """Drop the range partition with these bounds, and its rows."""
        spec = self.spec(name)
        wanted = self._range(spec, entry, -1)
        gone = [r for r in spec.ranges if r.same_bounds(wanted)]
        if not gone:
            raise ValueError(f"no range {wanted.lower} .. {wanted.upper}")
        self._merged(name)
        number = gone[0].range_id
        shown = f"SHOW PARTITIONS {self._sql(name)} PARTITION (range_id={number})"
        # One entry per bucket of the range.
        entries = [row["partition"] for row in self.spark.sql(shown).collect()]
        if entries:
            listed = ", ".join(f"PARTITION ({e.replace('/', ', ')})" for e in entries)
            self.spark.sql(f"ALTER TABLE {self._sql(name)} DROP {listed}")
        # The table is external, so dropping a partition leaves its files.
        base = f"{self._properties(name)[_ROOT]}/v{self._properties(name)[_VERSION]}"
        folders = ["", "/log/batch_id=*", "/runs/from=*/through=*", "/snapshot/through=*"]
        for folder in folders if self._feed(name) else [""]:
            for path in files.matching(self.spark, f"{base}{folder}/range_id={number}"):
                files.delete(self.spark, path)
        self._store_spec(
            name, replace(spec, ranges=tuple(r for r in spec.ranges if r.range_id != number))
        )

    def _range(self, spec: TableSpec, entry: dict, number: int) -> RangePartition:
        if not spec.range_columns:
            raise ValueError(f"table {spec.name} has no range partitions")
        types = [spec.type_of(c) for c in spec.range_columns]
        plain = {k: v for k, v in entry.items() if k != "id"}
        return specs.range_partitions([plain], types, number)[0]

    def alter(self, change: AlterSpec) -> str:
        """Apply a change document; returns the table's name afterwards.

        What can be told from the spec is checked before anything is changed.
        """
        name = change.table
        self._check(change)
        for column in change.add_columns:
            self.add_column(name, column)
        for column in change.drop_columns:
            self.drop_column(name, column)
        for old, new in change.rename_columns:
            self.rename_column(name, old, new)
        for entry in change.drop_ranges:
            self.drop_range(name, entry)
        for entry in change.add_ranges:
            self.add_range(name, entry)
        if change.rename_table:
            self.rename(name, change.rename_table)
            name = change.rename_table
        return name

    def _check(self, change: AlterSpec) -> None:
        """Refuse a change document of which some part would fail."""
        spec = self.spec(change.table)
        names = list(spec.schema.names)
        for column in change.add_columns:
            if column.name in names or column.name in spec.partition_columns:
                raise ValueError(f"column {column.name} exists")
            if not column.nullable and column.default is None:
                if not self._is_empty(change.table, spec):
                    raise ValueError(f"column {column.name} must not be NULL but has no default")
            names.append(column.name)
        for column in change.drop_columns:
            if column in spec.keys:
                raise ValueError(f"key column {column} cannot be dropped")
            if column not in names:
                raise ValueError(f"no column {column}")
            self._not_ordering(change.table, column)
            names.remove(column)
        for old, new in change.rename_columns:
            if old not in names:
                raise ValueError(f"no column {old}")
            if new in names or new in spec.partition_columns:
                raise ValueError(f"column {new} exists")
            self._not_ordering(change.table, old)
            names[names.index(old)] = new
        left = list(spec.ranges)
        for entry in change.drop_ranges:
            wanted = self._range(spec, entry, -1)
            if not any(r.same_bounds(wanted) for r in left):
                raise ValueError(f"no range {wanted.lower} .. {wanted.upper}")
            left = [r for r in left if not r.same_bounds(wanted)]
        check_ranges([*left, *(self._range(spec, e, -1) for e in change.add_ranges)])
        if change.rename_table and self.exists(change.rename_table):
            raise ValueError(f"table {change.rename_table} exists")

    def drop(self, *names: str, purge: bool = False) -> None:
        """Drop tables that exist; ``purge`` deletes their files too."""
        for name in names:
            if not self.exists(name):
                continue
            folder = self._properties(name)[_ROOT]
            self.spark.sql(f"DROP TABLE IF EXISTS {self._sql(name)}")
            if purge:
                files.delete(self.spark, folder)

    # -- definition ------------------------------------------------------------

    def _name(self, name: str) -> str:
        return f"{self.database}.{name}"

    def _sql(self, name: str) -> str:
        return quoted(self._name(name))

    def _properties(self, name: str) -> dict[str, str]:
        rows = self.spark.sql(f"SHOW TBLPROPERTIES {self._sql(name)}").collect()
        return {row["key"]: row["value"] for row in rows}

    def _fields(self, name: str) -> list[T.StructField]:
        """The table's columns with all that the catalog knows of them."""
        spec = self.spec(name)
        return [f for f in self.spark.table(self._name(name)).schema if f.name in spec.schema.names]

    def _ids(self, name: str) -> bool:
        return _LAST_ID in self._properties(name)

    def _over_files(
        self, name: str, spec: TableSpec, fields: list[T.StructField], retired: set[str] = frozenset()
    ) -> None:
        """Define the table anew with other columns over the files it has; new ones get ids.

        ``retired`` are names that files hold and that now are another column's former ones.
        """
        properties = self._properties(name)
        last = int(properties[_LAST_ID])
        numbered = []
        for f in fields:
            if _FIELD_ID not in f.metadata:
                last += 1
                f = T.StructField(f.name, f.dataType, True, f.metadata | {_FIELD_ID: last})
            numbered.append(f)
        self._redefine(
            spec, properties[_ROOT], int(properties[_VERSION]), {}, self._retired(name) | retired,
            self._comments(name), None, (numbered, last),
        )

    def _retired(self, name: str) -> set[str]:
        return set(filter(None, self._properties(name).get(_RETIRED, "").split("\n")))

    def _defaults(self, name: str) -> dict[str, str]:
        fields = self.spark.table(self._name(name)).schema.fields
        return {
            f.name: f.metadata["CURRENT_DEFAULT"] for f in fields if "CURRENT_DEFAULT" in f.metadata
        }

    def _comments(self, name: str) -> dict[str | None, str]:
        """Comments by column; that of the table under None."""
        fields = self.spark.table(self._name(name)).schema.fields
        comments = {f.name: f.metadata["comment"] for f in fields if "comment" in f.metadata}
        described = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self._sql(name)}").collect()
        own = [row["data_type"] for row in described if row["col_name"] == "Comment"]
        return comments | ({None: own[0]} if own else {})

    def _store_spec(self, name: str, spec: TableSpec) -> None:
        self._set_property(name, _SPEC, spec.to_json())

    def _set_property(self, name: str, key: str, value: str) -> None:
        self.spark.sql(
            f"ALTER TABLE {self._sql(name)} SET TBLPROPERTIES "
            f"({text_literal(key)} = {text_literal(value)})"
        )

    def _define(
        self,
        spec: TableSpec,
        root: str,
        version: int,
        defaults: dict[str, str],
        retired: set[str] = frozenset(),
        comments: dict[str | None, str] | None = None,
        feed: dict | None = None,
        numbered: tuple[list[T.StructField], int] | None = None,
        under: str | None = None,
    ) -> None:
        """Create the table of ``spec`` (``under`` another name) over the files there are.

        ``numbered`` has the columns with field ids, and the last id that was given.
        """

        def column(name: str, data_type: T.DataType) -> str:
            default = f" DEFAULT {defaults[name]}" if name in defaults else ""
            noted = f" COMMENT {text_literal(comments[name])}" if name in comments else ""
            return f"{quoted_column(name)} {data_type.simpleString()}{default}{noted}"

        comments = comments or {}
        columns = [column(f.name, f.dataType) for f in spec.schema]
        columns += [column(c, T.IntegerType()) for c in spec.partition_columns]
        properties = {
            _SPEC: spec.to_json(), _ROOT: root, _VERSION: str(version),
            _RETIRED: "\n".join(sorted(retired)),
        }
        location = f"{root}/v{version}"
        if feed:
            properties[_FEED] = json.dumps(feed)
            location = _snapshot(location, feed["through"])
        name = under or spec.name
        if numbered:
            properties[_LAST_ID] = str(numbered[1])
        listed = ", ".join(f"{text_literal(k)} = {text_literal(v)}" for k, v in properties.items())
        if numbered:
            self._create_numbered(name, spec, numbered[0], location, listed)
        else:
            self.spark.sql(
                f"CREATE TABLE {self._sql(name)} ({', '.join(columns)}) USING parquet "
                f"PARTITIONED BY ({', '.join(spec.partition_columns)}) "
                f"LOCATION {text_literal(location)} TBLPROPERTIES ({listed})"
            )
        if None in comments:
            self.comment_table(name, comments[None])
        if feed:
            beside = T.StructType([T.StructField.fromJson(f) for f in feed["beside"]])
            log = keyed_log.KeyedLog(
                self.spark, f"{root}/v{version}", spec, feed["order_by"], feed["mode"], beside
            )
            parts = [
                f"PARTITION ({part.replace('/', ', ')}) LOCATION {text_literal(path)}"
                for part, (_, path) in sorted(log.merged_parts().items())
            ]
            if parts:
                self.spark.sql(f"ALTER TABLE {self._sql(name)} ADD {' '.join(parts)}")
        elif files.exists(self.spark, location):
            self.spark.sql(f"ALTER TABLE {self._sql(name)} RECOVER PARTITIONS")

    def _create_numbered(
        self, name: str, spec: TableSpec, fields: list[T.StructField], location: str, properties: str
    ) -> None:
        """A table whose columns keep their metadata, which SQL has no words for.

        It is made of no rows in a folder of its own, and then pointed to ``location``.
        """
        parts = [T.StructField(c, T.IntegerType()) for c in spec.partition_columns]
        empty = self.spark.createDataFrame(
            self.spark.sparkContext.emptyRDD(), T.StructType([*fields, *parts])
        )
        made = f"{location}-made-{uuid.uuid4().hex}"
        empty.write.format("parquet").partitionBy(*spec.partition_columns).option(
            "path", made
        ).saveAsTable(self._name(name))
        self.spark.sql(f"ALTER TABLE {self._sql(name)} SET LOCATION {text_literal(location)}")
        self.spark.sql(f"ALTER TABLE {self._sql(name)} SET TBLPROPERTIES ({properties})")
        files.delete(self.spark, made)

    def _redefine(self, spec: TableSpec, *definition) -> None:
        """Replace the table by a new definition, which is complete before the old one goes.

        After a failure in between, the next one to open the database finishes it.
        """
        following = spec.name + "_next"
        self.spark.sql(f"DROP TABLE IF EXISTS {self._sql(following)}")
        self._define(spec, *definition, under=following)
        self.spark.sql(f"DROP TABLE {self._sql(spec.name)}")
        self.spark.sql(f"ALTER TABLE {self._sql(following)} RENAME TO {self._sql(spec.name)}")

    def _recover(self) -> None:
        """Finish changes that a failure cut off: see :meth:`_redefine`."""
        shown = self.spark.sql(f"SHOW TABLES IN {quoted(self.database)} LIKE '*_next'").collect()
        for row in shown:
            following = row["tableName"]
            text = self._properties(following).get(_SPEC)
            # A table may be called so by its own spec, too.
            if text is None or specs.table_spec(text).name + "_next" != following:
                continue
            name = specs.table_spec(text).name
            if self.exists(name):  # the old definition still holds
                self.spark.sql(f"DROP TABLE {self._sql(following)}")
            else:
                self.spark.sql(f"ALTER TABLE {self._sql(following)} RENAME TO {self._sql(name)}")

    def _rewrite(
        self, name: str, spec: TableSpec, change, renamed: dict[str, str] | None = None
    ) -> None:
        """Write the changed rows to the next version folder and point the table there."""
        feed = self._feed(name)
        rows = TableFeed(self, name).merged_rows() if feed else self.spark.table(self._name(name))
        self._move(name, spec, change(rows), feed and feed | {"added": {}}, renamed)

    def _move(
        self,
        name: str,
        spec: TableSpec,
        rows: DataFrame,
        feed: dict | None,
        renamed: dict[str, str] | None = None,
    ) -> None:
        """Write the table's rows anew, for a feed with what it needs beside them."""
        properties, renamed = self._properties(name), renamed or {}
        version = int(properties[_VERSION]) + 1
        defaults = {renamed.get(c, c): v for c, v in self._defaults(name).items()}
        defaults = {c: v for c, v in defaults.items() if c in spec.schema.names}
        comments = {renamed.get(c, c): v for c, v in self._comments(name).items()}
        parts = spec.partition_columns
        folder, target = properties[_ROOT], f"{properties[_ROOT]}/v{version}"
        columns = [*spec.schema.names, *parts]
        if feed:
            target = _snapshot(target, feed["through"])
            columns += ["batch_id", *(f["name"] for f in feed["beside"])]
        numbered = None
        if not feed and _LAST_ID in properties:
            fields = [
                T.StructField(renamed.get(f.name, f.name), f.dataType, True, f.metadata)
                for f in self._fields(name) if renamed.get(f.name, f.name) in spec.schema.names
            ]
            numbered = fields, int(properties[_LAST_ID])
            ids = {f.name: {_FIELD_ID: f.metadata[_FIELD_ID]} for f in fields}
            rows = rows.select(*(
                F.col(c).alias(c, metadata=ids[c]) if c in ids else F.col(c) for c in columns
            ))
        rows.select(*columns).write.mode("overwrite").partitionBy(*parts).parquet(target)
        self._redefine(spec, folder, version, defaults, frozenset(), comments, feed, numbered)
        # Older versions would keep rows of ranges that were dropped since.
        for old in range(1, version):
            files.delete(self.spark, f"{folder}/v{old}")


def _snapshot(folder: str, through: int) -> str:
    return f"{folder}/snapshot/through={through}"


def sql_literal(value) -> str:
    """A spec value as SQL text."""
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, dt.datetime):
        return f"TIMESTAMP {text_literal(value.isoformat())}"
    if isinstance(value, dt.date):
        return f"DATE {text_literal(value.isoformat())}"
    if isinstance(value, str):
        return text_literal(value)
    return str(value)
