"""Queries over tables made from specs, changed by DDL and read with SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeflow.functions.keys import hash_bucket
from gaugeflow.operators import decode, rejects
from gaugeflow.operators.decode import unnest_array
from gaugeflow.plans import catalog, schemas
from gaugeflow.plans.spec import AddColumn, alter_spec, lenient_json, table_spec
from gaugeflow.plans.tables import Tables
from gaugeflow.queries import registry as r
from gaugeflow.queries.decoding import SCHEDULE_SQL, schedule_documents
from gaugeflow.queries.registry import query
from gaugeflow.session import scratch_dir

# The sample create spec, with its trailing comma.
READINGS_SPEC = """
{
  "type": "keyed",
  "spec": {
    "tableSchema": {"tableName": "readings", "dimensionsSpec": {"dimensions": [
      {"type": "INT32", "name": "column1", "is_key": true},
      {"type": "STRING", "name": "column2", "is_key": true},
      {"type": "DOUBLE", "name": "column3", "is_key": false},
      {"type": "UNIXTIME_MICROS", "name": "column4", "is_key": false}
    ]}},
    "ioConfig": {"replicas": 1, "waitKey": true},
    "tuningConfig": {"partitionSpec": {
      "hashPartition": {"keys": ["column1", "column2"], "buckets": 8},
      "rangePartition": {"columns": ["column1",], "partitions": [
        {"lower": [30], "upper": [39], "lower_bound": "exclusive", "upper_bound": "exclusive"},
        {"lower": [40], "upper": [49], "lower_bound": "exclusive", "upper_bound": "exclusive"},
        {"lower": [50], "upper": [59], "lower_bound": "exclusive", "upper_bound": "exclusive"}
      ]}
    }}
  }
}
"""

_RANGED = (
    "((user_id > 30 AND user_id < 39) OR (user_id > 40 AND user_id < 49) "
    "OR (user_id > 50 AND user_id < 59))"
)
_READINGS = "cast(user_id AS INT) AS column1, cast(event_id AS VARCHAR) AS column2, value AS column3"


def tables(spark: SparkSession) -> Tables:
    """A database of its own for one query."""
    folder = scratch_dir(spark, "tables")
    return Tables(spark, "db_" + folder[-32:], folder)


def reading_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return r.events(spark, sf_dir).select(
        F.col("user_id").cast("int").alias("column1"),
        F.col("event_id").cast("string").alias("column2"),
        F.col("value").alias("column3"),
        F.col("ts").cast("timestamp").alias("column4"),
    )


def loaded_readings(spark: SparkSession, sf_dir: str) -> Tables:
    db = tables(spark)
    db.create(table_spec(READINGS_SPEC))
    db.load("readings", reading_rows(spark, sf_dir), ["column4"])
    return db


@query(f"SELECT {_READINGS} FROM events WHERE {_RANGED}")
def create_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table from a spec; rows outside its ranges are refused."""
    return loaded_readings(spark, sf_dir).read("readings").drop("column4")


@query(f"""
SELECT cast(event_id AS VARCHAR) AS column2, 'no_range' AS reject_reason
FROM events WHERE NOT {_RANGED}
""")
def refused_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    db = tables(spark)
    db.create(table_spec(READINGS_SPEC))
    loaded = db.load("readings", reading_rows(spark, sf_dir), ["column4"])
    return loaded.rejected.select("column2", rejects.REASON)


@query(f"SELECT {_READINGS}, 54 AS flag FROM events WHERE {_RANGED}")
def add_column_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    db = loaded_readings(spark, sf_dir)
    db.add_column("readings", AddColumn("flag", T.IntegerType(), nullable=False, default=54))
    return db.read("readings").drop("column4")


@query(f"""
SELECT cast(user_id AS INT) AS column1, cast(event_id AS VARCHAR) AS column2, 60 AS flag FROM events
UNION ALL
SELECT cast(o_custkey AS INT), cast(o_orderkey AS VARCHAR), CAST(NULL AS INT) FROM orders
""")
def column_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inserts that leave a column out get its default of that moment."""
    db = tables(spark)
    document = lenient_json(READINGS_SPEC)
    del document["spec"]["tuningConfig"]["partitionSpec"]["rangePartition"]
    db.create(table_spec(document))
    db.add_column("readings", AddColumn("flag", T.IntegerType(), default=54))
    db.set_default("readings", "flag", 60)
    insert = f"INSERT INTO {db.database}.readings (column1, column2, bucket) SELECT * FROM "
    bucket = hash_bucket([F.col("column1"), F.col("column2")], 8)
    keys = reading_rows(spark, sf_dir).select("column1", "column2")
    catalog.temp_view(keys.withColumn("bucket", bucket), f"{db.database}_events")
    spark.sql(f"{insert} {db.database}_events")
    db.remove_default("readings", "flag")
    orders = r.table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("int").alias("column1"),
        F.col("o_orderkey").cast("string").alias("column2"),
    )
    catalog.temp_view(orders.withColumn("bucket", bucket), f"{db.database}_orders")
    spark.sql(f"{insert} {db.database}_orders")
    return db.read("readings").select("column1", "column2", "flag")


@query(f"SELECT {_READINGS}, CAST(NULL AS VARCHAR) AS note FROM events WHERE {_RANGED}")
def add_column_nullable(spark: SparkSession, sf_dir: str) -> DataFrame:
    db = loaded_readings(spark, sf_dir)
    db.add_column("readings", AddColumn("note", T.StringType()))
    return db.read("readings").drop("column4")


@query(f"""
SELECT cast(user_id AS INT) AS column1, cast(event_id AS VARCHAR) AS column2
FROM events WHERE {_RANGED}
""")
def drop_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    db = loaded_readings(spark, sf_dir)
    db.drop_column("readings", "column3")
    return db.read("readings").drop("column4")


@query(f"""
SELECT cast(user_id AS INT) AS column1, cast(event_id AS VARCHAR) AS column2, value AS signal
FROM events WHERE {_RANGED}
""")
def rename_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    db = loaded_readings(spark, sf_dir)
    db.rename_column("readings", "column3", "signal")
    return db.read("readings").drop("column4")


@query(f"SELECT {_READINGS} FROM events WHERE {_RANGED}")
def rename_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    db = loaded_readings(spark, sf_dir)
    db.rename("readings", "measurements")
    return db.read("measurements").drop("column4")


@query(f"SELECT {_READINGS} FROM events WHERE {_RANGED} OR (user_id >= 60 AND user_id < 90)")
def add_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fourth range lets further rows in; those loaded before stay as they are."""
    db = loaded_readings(spark, sf_dir)
    db.add_range("readings", {"lower": [60], "upper": [90]})
    db.load("readings", reading_rows(spark, sf_dir), ["column4"])
    return db.read("readings").drop("column4")


@query(f"SELECT {_READINGS} FROM events WHERE {_RANGED} AND NOT (user_id > 40 AND user_id < 49)")
def drop_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    db = loaded_readings(spark, sf_dir)
    db.drop_range("readings", {
        "lower": [40], "upper": [49], "lower_bound": "exclusive", "upper_bound": "exclusive",
    })
    return db.read("readings").drop("column4")


# A change document with every kind of change.
READINGS_CHANGE = """
{
  "spec": {
    "tableSchema": {"tableName": "readings",},
    "tuningConfig": {
      "renameTable": "xyz",
      "dimensionsSpec": {
        "addDimensions": [
          {"type": "INT32", "name": "added", "is_nullable": true, "default_value": 54}
        ],
        "dropDimensions": ["column4"],
        "renameDimensions": [{"from": "column3", "to": "signal"}, {}]
      },
      "partitionSpec": {
        "dropRangePartition": {"columns": ["column1",], "partitions": [
          {"lower": [30], "upper": [39], "lower_bound": "exclusive", "upper_bound": "exclusive"}
        ]}
      }
    }
  }
}
"""


@query(f"""
SELECT cast(user_id AS INT) AS column1, cast(event_id AS VARCHAR) AS column2, value AS signal, 54 AS added
FROM events WHERE {_RANGED} AND NOT (user_id > 30 AND user_id < 39)
""")
def alter_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole change document applied to a loaded table."""
    db = loaded_readings(spark, sf_dir)
    return db.read(db.alter(alter_spec(READINGS_CHANGE)))


@query(f"""
SELECT * FROM ({SCHEDULE_SQL})
QUALIFY row_number() OVER (PARTITION BY arrival_time ORDER BY trip_id, stop_sequence, stop_id) = 1
""")
def schedule_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The schedule into its table, whose key is the arrival time alone: one row each stays."""
    db = tables(spark)
    db.create(schemas.SCHEDULE_TABLE)
    elements = rejects.accepted(unnest_array(schedule_documents(spark, sf_dir), schemas.SCHEDULE_ELEMENT))
    rows = decode.flatten_schedule(elements.drop("value", "position"), r.SERVICE_DATE)
    db.load("schedule", rows, ["trip_id", "stop_sequence", "stop_id"])
    return db.read("schedule")


def event_table(spark: SparkSession, sf_dir: str) -> str:
    """The given events mapped to an external table; its name."""
    name = "events_" + scratch_dir(spark, "name")[-32:]
    catalog.external_table(spark, name, f"{sf_dir}/events.parquet")
    return name


@query("SELECT event_id, user_id, event_type, value FROM events")
def external_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.table(event_table(spark, sf_dir)).select("event_id", "user_id", "event_type", "value")


@query("""
SELECT event_type, count(*) AS n, min(value) AS lowest, max(value) AS highest,
       count(DISTINCT user_id) AS users
FROM events GROUP BY event_type
""")
def adhoc_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = event_table(spark, sf_dir)
    return spark.sql(f"""
        SELECT event_type, count(*) AS n, min(value) AS lowest, max(value) AS highest,
               count(DISTINCT user_id) AS users
        FROM {name} GROUP BY event_type
    """)


@query("""
SELECT user_id, event_type, count(*) AS n, max(value) AS highest FROM events GROUP BY 1, 2
""")
def ctas(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = event_table(spark, sf_dir)
    folder = scratch_dir(spark, "ctas")
    return catalog.table_as_select(
        spark, "summary_" + folder[-32:],
        f"SELECT user_id, event_type, count(*) AS n, max(value) AS highest FROM {name} GROUP BY 1, 2",
        folder,
    )


GIVEN_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


@query(" UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in GIVEN_TABLES))
def list_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The given tables mapped into a database, listed with their row counts."""
    database = "given_" + scratch_dir(spark, "name")[-32:]
    catalog.create_database(spark, database, scratch_dir(spark, "database"))
    for name in GIVEN_TABLES:
        catalog.external_table(spark, f"{database}.{name}", f"{sf_dir}/{name}.parquet")
    return catalog.count_tables(spark, database)


def _unranged() -> dict:
    document = lenient_json(READINGS_SPEC)
    del document["spec"]["tuningConfig"]["partitionSpec"]["rangePartition"]
    return document


@query("""
SELECT CASE WHEN event_type = 'click' THEN 'stored' ELSE 'new' END AS kind,
       count(*) AS n_rows, count(*) FILTER (event_type = 'click') AS n_superseded
FROM events GROUP BY 1
""")
def load_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks are loaded, then all events: rows that lose to stored ones are accounted for."""
    db = tables(spark)
    db.create(table_spec(_unranged()))
    rows = reading_rows(spark, sf_dir)
    clicks = r.events(spark, sf_dir).filter("event_type = 'click'").select(
        F.col("event_id").cast("string").alias("column2")
    )
    db.load("readings", rows.join(clicks, "column2", "left_semi"), ["column4"])
    lost = db.load("readings", rows, ["column4"]).superseded.select("column2", "superseded")
    kinds = db.read("readings").select("column2").join(lost, "column2", "left")
    kind = F.when(F.col("superseded").isNull(), "new").otherwise("stored").alias("kind")
    return kinds.groupBy(kind).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.coalesce(F.sum("superseded"), F.lit(0)).alias("n_superseded"),
    )


@query("SELECT cast(event_id AS VARCHAR) AS column2, 54 AS flag FROM events")
def default_on_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load of rows that leave out a column gives them its default."""
    db = tables(spark)
    db.create(table_spec(_unranged()))
    db.add_column("readings", AddColumn("flag", T.IntegerType(), default=54))
    db.load("readings", reading_rows(spark, sf_dir), ["column4"])
    return db.read("readings").select("column2", "flag")


@query(f"""
SELECT cast(event_id AS VARCHAR) AS column2, value AS column3 FROM events WHERE {_RANGED}
""")
def sql_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of a SQL query, checked and laid out like any others."""
    db = tables(spark)
    db.create(table_spec(READINGS_SPEC))
    db.insert("readings", f"""
        SELECT cast(user_id AS INT) AS column1, cast(event_id AS STRING) AS column2,
               value AS column3 FROM {event_table(spark, sf_dir)}
    """, ["column3"])
    return db.read("readings").select("column2", "column3")


@query("""
SELECT cast(event_id AS VARCHAR) AS column2,
       CASE WHEN user_id < 30 THEN 0 WHEN user_id >= 60 THEN 1 ELSE 2 END AS range_id
FROM events WHERE user_id < 30 OR user_id >= 40
""")
def open_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranges open at an end, and bounds that name the first of two columns only."""
    document = lenient_json(READINGS_SPEC)
    document["spec"]["tuningConfig"]["partitionSpec"]["rangePartition"] = {
        "columns": ["column1", "column2"],
        "partitions": [
            {"lower": [], "upper": [30]}, {"lower": [60], "upper": []},
            {"lower": [40], "upper": [60]},
        ],
    }
    db = tables(spark)
    db.create(table_spec(document))
    db.load("readings", reading_rows(spark, sf_dir), ["column4"])
    return spark.table(f"{db.database}.readings").select("column2", "range_id")


@query("""
SELECT 'signal' AS name, 'volts' AS note, count(*) AS n_rows FROM events
UNION ALL SELECT 'readings', 'per sensor', count(*) FROM events
""")
def comments_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comments on a column and its table outlive renaming one and dropping another."""
    db = tables(spark)
    db.create(table_spec(_unranged()))
    db.load("readings", reading_rows(spark, sf_dir), ["column4"])
    db.comment_table("readings", "per sensor")
    db.comment_column("readings", "column3", "volts")
    db.rename_column("readings", "column3", "signal")
    db.drop_column("readings", "column4")
    fields = spark.table(f"{db.database}.readings").schema
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {db.database}.readings")
    own = described.filter("col_name = 'Comment'").first()["data_type"]
    notes = spark.createDataFrame(
        [("signal", fields["signal"].metadata["comment"]), ("readings", own)],
        "name string, note string",
    )
    return notes.join(db.read("readings").agg(F.count(F.lit(1)).alias("n_rows")))


@query("SELECT true AS created, false AS again, true AS refused, count(*) AS n_rows FROM events")
def create_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second create leaves the loaded table alone; a spec without partitions is refused."""
    db = tables(spark)
    created = db.create(table_spec(_unranged()))
    db.load("readings", reading_rows(spark, sf_dir), ["column4"])
    again = db.create(table_spec(_unranged()))
    bare = _unranged()
    del bare["spec"]["tuningConfig"]
    bare["spec"]["tableSchema"]["tableName"] = "bare"
    try:
        refused = not db.create(table_spec(bare))
    except ValueError:
        refused = not db.exists("bare")
    return db.read("readings").agg(
        F.lit(created).alias("created"), F.lit(again).alias("again"),
        F.lit(refused).alias("refused"), F.count(F.lit(1)).alias("n_rows"),
    )


@query("SELECT event_type AS table_name, count(*) AS n_rows FROM events WHERE event_type <> 'error' GROUP BY 1")
def drop_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table for each kind of event; that of the errors is dropped with its files."""
    events = r.events(spark, sf_dir)
    db = tables(spark)
    kinds = [row[0] for row in events.select("event_type").distinct().collect()]
    for kind in kinds:
        document = _unranged()
        document["spec"]["tableSchema"]["tableName"] = kind
        db.create(table_spec(document))
        own = events.filter(F.col("event_type") == kind).select("event_id")
        rows = reading_rows(spark, sf_dir).join(
            own.select(F.col("event_id").cast("string").alias("column2")), "column2", "left_semi"
        )
        db.load(kind, rows, ["column4"])
    db.drop("error", "never_there", purge=True)
    return catalog.count_tables(spark, db.database)


@query("""
SELECT cast(user_id AS INT) AS column1, event_type AS column2, value AS column3,
       CASE WHEN event_id % 4 = 3 THEN 7 ELSE 54 END AS flag
FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1
""")
def upsert_then_alter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table made from a spec, fed three batches, given a column, fed another; read by name."""
    db = tables(spark)
    db.create(table_spec(_unranged()))
    beside = T.StructType([T.StructField("sequence", T.LongType())])
    feed = db.feed("readings", ["column4", "sequence"], order_schema=beside)
    rows = r.events(spark, sf_dir).select(
        F.col("user_id").cast("int").alias("column1"),
        F.col("event_type").alias("column2"),
        F.col("value").alias("column3"),
        F.col("ts").cast("timestamp").alias("column4"),
        F.col("event_id").cast("long").alias("sequence"),
    )
    for batch in range(3):
        feed.write_batch(rows.filter(F.col("sequence") % 4 == batch), batch)
    db.add_column("readings", AddColumn("flag", T.IntegerType(), nullable=False, default=54))
    feed.write_batch(rows.filter("sequence % 4 = 3").withColumn("flag", F.lit(7)), 3)
    feed.compact()
    return spark.sql(f"SELECT column1, column2, column3, flag FROM {db.database}.readings")


@query(f"""
SELECT {_READINGS} FROM events
WHERE user_id BETWEEN 41 AND 45 OR user_id IN (33, 57) AND value > 50
""")
def pruned_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conditions on the key, of which only the ranges they can meet are read."""
    db = tables(spark)
    db.create(table_spec(READINGS_SPEC))
    db.load("readings", reading_rows(spark, sf_dir), ["column4"])
    found = db.filtered(
        "readings", "column1 BETWEEN 41 AND 45 OR column1 IN (33, 57) AND column3 > 50"
    )
    return found.select("column1", "column2", "column3")
