"""The plans behind the operators: shuffles, pruning, no Python per row."""

import glob
import re

import pytest
from oracle_check import contract
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeflow.operators import keyed
from gaugeflow.plans import schemas
from gaugeflow.plans.layout import for_write, with_partitions
from gaugeflow.plans.spec import ColumnSpec, TableSpec
from gaugeflow.session import settings
from gaugeflow.sources import messages
from gaugeflow.streaming.keyed_log import KeyedLog

SF_DIR = "/root/testdata/sf0.001"


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(plan):
    return len(re.findall(r"Exchange (hash|range|RoundRobin|Single|REBALANCE)", plan))


@pytest.fixture(scope="module")
def events(spark):
    return spark.read.parquet(f"{SF_DIR}/events.parquet")


@pytest.mark.parametrize("pick, partial", [(keyed.latest, "partial_max"), (keyed.first, "partial_min")])
def test_reduction_combines_before_its_only_shuffle(events, pick, partial):
    plan = physical(pick(events.select("user_id", "ts", "event_id", "value"), ["user_id"], ["ts", "event_id"]))
    assert exchanges(plan) == 1
    assert plan.index("Exchange") < plan.index(partial)
    assert "event_type" not in plan


def test_keyed_write_needs_no_second_shuffle(events):
    rows = events.select(F.col("user_id").cast("int").alias("key"), "event_id", "value")
    reduced = keyed.latest(rows, ["key"], ["event_id"])
    assert exchanges(physical(for_write(with_partitions(reduced, schemas.SENSOR_TABLE), schemas.SENSOR_TABLE))) == 1


def test_unaligned_buckets_are_rebalanced(events):
    columns = (
        ColumnSpec("user_id", T.LongType(), True), ColumnSpec("event_id", T.LongType(), True),
    )
    spec = TableSpec("t", columns, hash_keys=("user_id",), buckets=4)
    rows = with_partitions(events.select("user_id", "event_id"), spec)
    assert "REBALANCE_PARTITIONS_BY_COL" in physical(for_write(rows, spec))


def test_one_file_per_task_in_a_keyed_write(spark, folder):
    """16 tasks, 8 buckets: each task writes one bucket."""
    log = KeyedLog(spark, folder, schemas.SENSOR_TABLE, ["date"])
    rows = spark.range(5000).selectExpr("cast(id AS int) AS key", "'d' AS date", "1D AS signal")
    with settings(
        spark,
        spark__sql__shuffle__partitions="16",
        spark__sql__adaptive__coalescePartitions__enabled="false",
    ):
        log.write_batch(rows, 0)
    assert len(glob.glob(folder + "/log/batch_id=0/bucket=*/*.parquet")) == 16


def test_previous_without_hot_keys_is_one_shuffle(events):
    rows = keyed.previous(events, ["user_id"], ["ts", "event_id"], ["value"])
    plan = physical(rows.select("event_id", "previous"))
    assert exchanges(plan) == 1
    assert "props" not in plan


def test_hot_slices_are_spread(spark):
    """With a third of the rows in one key no task sorts more than a part of them."""
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("t"),
    )
    cut = keyed.previous(df, ["k"], ["t"], ["t"], max_key_rows=1000)
    with settings(spark, spark__sql__adaptive__enabled="false", spark__sql__shuffle__partitions="32"):
        tasks = cut.select(F.spark_partition_id().alias("task"), "previous")
        sizes = tasks.groupBy("task").agg(F.count("previous.t").alias("n")).collect()
    # 10,000 of the 30,000 rows share a key.
    assert sum(row["n"] for row in sizes) == 9_999
    assert max(row["n"] for row in sizes) < 1_500


def test_spread_only_small_inputs(spark):
    cores = spark.sparkContext.defaultParallelism
    assert messages.spread(spark.range(10, numPartitions=1), cores).rdd.getNumPartitions() == cores
    enough = spark.range(10, numPartitions=cores)
    assert messages.spread(enough, None) is enough


def test_no_python_and_no_cross_joins(spark):
    names = [
        "json_decode", "nested_extract", "transit_decode", "ts_micros", "name_uuid", "geo_features",
        "hash_bucket", "range_route", "monte_carlo_pi", "upsert_latest", "insert_first",
        "keyed_previous", "sensor_daily", "schedule_flatten", "create_table",
    ]
    for name in names:
        plan = physical(contract.queries()[name](spark, SF_DIR))
        assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan), name
