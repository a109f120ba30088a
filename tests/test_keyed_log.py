import glob
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from gaugeflow import files
from gaugeflow.plans import schemas
from gaugeflow.plans.spec import table_spec
from gaugeflow.queries.tables import READINGS_SPEC
from gaugeflow.streaming import keyed_log
from gaugeflow.streaming.keyed_log import INSERT, UPSERT, KeyedLog

SEQUENCE = T.StructType([T.StructField("n", T.LongType())])
COLUMNS = "key int, date string, signal double, n bigint"


def sensor(spark, folder, mode=UPSERT):
    return KeyedLog(spark, folder, schemas.SENSOR_TABLE, ["n"], mode, SEQUENCE)


def rows_of(df):
    return sorted(map(tuple, df.collect()))


def write(spark, log, rows, batch_id):
    log.write_batch(spark.createDataFrame(rows, COLUMNS), batch_id)


def test_upsert_null_overwrites(spark, folder):
    log = sensor(spark, folder)
    write(spark, log, [(1, "a", 1.0, 1), (1, "b", 2.0, 2), (2, "a", 5.0, 3)], 0)
    write(spark, log, [(1, "c", None, 4)], 1)
    assert rows_of(log.current()) == [(1, "c", None), (2, "a", 5.0)]
    assert rows_of(log.current(through=0)) == [(1, "b", 2.0), (2, "a", 5.0)]


def test_late_row_does_not_replace(spark, folder):
    log = sensor(spark, folder)
    write(spark, log, [(1, "new", 1.0, 9)], 0)
    write(spark, log, [(1, "old", 1.0, 2)], 1)
    assert rows_of(log.current()) == [(1, "new", 1.0)]


def test_insert_keeps_first(spark, folder):
    log = sensor(spark, folder, INSERT)
    write(spark, log, [(1, "a", 1.0, 1), (1, "b", 2.0, 2)], 0)
    write(spark, log, [(1, "c", 3.0, 3), (2, "d", 4.0, 4)], 1)
    assert rows_of(log.current()) == [(1, "a", 1.0), (2, "d", 4.0)]


def test_replay_counts_once(spark, folder):
    log = sensor(spark, folder)
    write(spark, log, [(1, "a", 1.0, 1), (None, "x", 1.0, 2)], 0)
    write(spark, log, [(1, "a", 1.0, 1), (None, "x", 1.0, 2)], 0)
    assert rows_of(log.current()) == [(1, "a", 1.0)]
    assert log.rejected().count() == 1


def test_rejects(spark, folder):
    log = sensor(spark, folder)
    write(spark, log, [(None, "a", 1.0, 1), (3, "b", 1.0, None), (4, "c", 1.0, 2)], 0)
    assert log.rejected().count() == 2
    reasons = {r["date"]: r["reject_reason"] for r in log.rejected().collect()}
    assert reasons == {"a": "null_key", "b": "null_order"}
    assert rows_of(log.current()) == [(4, "c", 1.0)]


def test_no_rejects(spark, folder):
    log = sensor(spark, folder)
    write(spark, log, [(4, "c", 1.0, 2)], 0)
    assert log.rejected() is None


def test_empty_table_and_empty_batch(spark, folder):
    log = sensor(spark, folder)
    assert rows_of(log.current()) == []
    write(spark, log, [], 0)
    write(spark, log, [(1, "a", 1.0, 1)], 1)
    assert rows_of(log.current()) == [(1, "a", 1.0)]


def test_incomplete_batch_is_not_read(spark, folder):
    log = sensor(spark, folder)
    write(spark, log, [(1, "a", 1.0, 1)], 0)
    write(spark, log, [(1, "b", 1.0, 2)], 1)
    (marker,) = glob.glob(f"{folder}/log/batch_id=1/_SUCCESS")
    import os

    os.remove(marker)
    assert rows_of(log.current()) == [(1, "a", 1.0)]
    write(spark, log, [(1, "b", 1.0, 2)], 1)
    assert rows_of(log.current()) == [(1, "b", 1.0)]


@pytest.mark.parametrize("limit", [0, 1_000_000])
@pytest.mark.parametrize("mode", [UPSERT, INSERT])
def test_compaction_changes_nothing(spark, folder, mode, limit, monkeypatch):
    monkeypatch.setattr(keyed_log, "MAX_BROADCAST_KEYS", limit)
    log = sensor(spark, folder, mode)
    random.seed(3)
    for batch in range(4):
        rows = [
            (random.randrange(12), f"{batch}.{i}", float(i), random.randrange(1000))
            for i in range(20)
        ]
        write(spark, log, rows, batch)
    before = rows_of(log.current())
    assert log.compact() == 2 and log.compact() is None
    assert rows_of(log.current()) == before
    log.vacuum()
    assert log.batches() == [3]
    assert rows_of(log.current()) == before
    write(spark, log, [(99, "z", 0.0, 5)], 4)
    assert rows_of(log.current()) == sorted([*before, (99, "z", 0.0)])
    assert log.compact(through=4) == 4
    log.vacuum()
    assert rows_of(log.current()) == sorted([*before, (99, "z", 0.0)])
    plan = log.current()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_small_delta_does_not_shuffle_the_snapshot(spark, folder):
    log = sensor(spark, folder)
    write(spark, log, [(k, "a", 1.0, k) for k in range(50)], 0)
    log.compact(through=0)
    write(spark, log, [(3, "b", 1.0, 99)], 1)
    plan = log.current()._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LeftAnti" in plan
    assert (3, "b", 1.0) in rows_of(log.current()) and log.current().count() == 50


@pytest.mark.parametrize("compacted", [False, True])
def test_among_keeps_the_given_keys(spark, folder, compacted):
    log = sensor(spark, folder)
    write(spark, log, [(k, "a", 1.0, k) for k in range(50)], 0)
    write(spark, log, [(k, "b", 1.0, 100 + k) for k in range(0, 50, 2)], 1)
    if compacted:
        log.compact(through=0)
    keys = spark.createDataFrame([(3,), (4,), (99,)], "key int")
    found = log.current(among=keys)
    assert rows_of(found) == [(3, "a", 1.0), (4, "b", 1.0)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.index("SortAggregate") < plan.index("BroadcastHashJoin")


def test_lookup_prunes_buckets(spark, folder):
    log = sensor(spark, folder)
    write(spark, log, [(k, "a", 1.0, k) for k in range(50)], 0)
    found = log.lookup(key=7)
    assert rows_of(found) == [(7, "a", 1.0)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan
    assert "EqualTo(key,7)" in plan


@pytest.fixture
def small_row_groups(spark):
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    # As in large row groups, whose keys outgrow a dictionary; else that would tell.
    options = {"parquet.block.size": str(1 << 14), "parquet.enable.dictionary": "false"}
    for name, value in options.items():
        conf.set(name, value)
    yield
    for name in options:
        conf.unset(name)


def rows_scanned(found):
    scans = found._jdf.queryExecution().executedPlan().collectLeaves()
    return scans.head().metrics().apply("numOutputRows").value()


@pytest.mark.parametrize("partitions", [7, 8])
@pytest.mark.parametrize("merged", [False, True])
def test_lookup_reads_few_rows_of_a_bucket(spark, folder, small_row_groups, merged, partitions):
    """Also where the rows come from a rebalance, since buckets do not divide the tasks."""
    # Small partitions stay apart, as large ones do, and come in several runs.
    conf = {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {name: spark.conf.get(name) for name in conf}
    for name, value in conf.items():
        spark.conf.set(name, value)
    try:
        _check_rows_scanned(spark, sensor(spark, folder), merged)
    finally:
        for name, value in old.items():
            spark.conf.set(name, value)


def _check_rows_scanned(spark, log, merged):
    n = 40_000
    shuffled = spark.range(n).selectExpr(
        f"cast(id * 7919 % {n} AS int) AS key", "'a' AS date", "1.0D AS signal", "id AS n"
    )
    if merged:
        log.write_batch(shuffled.filter("key % 2 = 0"), 0)
        log.write_batch(shuffled.filter("key % 2 = 1"), 1)
        log.compact(through=1)
    else:
        log.write_batch(shuffled, 0)
    found = log.lookup(key=777)
    assert rows_of(found) == [(777, "a", 1.0)]
    # A bucket has about 5,000 rows.
    assert 1 <= rows_scanned(found) <= 2_000


def test_layout(spark, folder):
    log = sensor(spark, folder)
    write(spark, log, [(k, "a", 1.0, k) for k in range(500)], 0)
    buckets = {p.split("=")[-1] for p in glob.glob(f"{folder}/log/batch_id=0/bucket=*")}
    assert buckets == set("01234567")


def test_ranges_and_required(spark, folder):
    spec = table_spec(READINGS_SPEC)
    log = KeyedLog(spark, folder, spec, ["column4"])
    df = spark.sql("""
        SELECT * FROM VALUES (30, 'a'), (31, 'a'), (38, 'a'), (39, 'a'), (45, 'a'), (60, 'a')
        AS t(column1, column2)
    """).selectExpr("*", "1.5D AS column3", "timestamp'2024-01-01' AS column4")
    log.write_batch(df, 0)
    assert [r[0] for r in rows_of(log.current())] == [31, 38, 45]
    assert sorted(r["column1"] for r in log.rejected().collect()) == [30, 39, 60]
    assert {r["reject_reason"] for r in log.rejected().collect()} == {"no_range"}
    found = log.lookup(column1=45, column2="a")
    assert found.count() == 1
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "range_id" in plan.split("PartitionFilters")[1]


def test_order_column_needs_a_type(spark, folder):
    with pytest.raises(ValueError):
        KeyedLog(spark, folder, schemas.SENSOR_TABLE, ["offset"])
    with pytest.raises(ValueError):
        KeyedLog(spark, folder, schemas.SENSOR_TABLE, ["date"], "merge")


@settings(max_examples=4, deadline=None)
@given(
    rows=st.lists(
        st.tuples(
            st.one_of(st.none(), st.integers(0, 5)), st.text("ab", max_size=2),
            st.one_of(st.none(), st.floats(0, 3, width=16)), st.integers(0, 9),
        ),
        min_size=1, max_size=25,
    ),
    cut=st.integers(0, 25),
)
def test_every_row_is_accounted_for(spark, tmp_path_factory, rows, cut):
    """Rows are in the table, rejected, or superseded by a row of their key; any split agrees."""
    whole = sensor(spark, str(tmp_path_factory.mktemp("whole")))
    write(spark, whole, rows, 0)
    split = sensor(spark, str(tmp_path_factory.mktemp("split")))
    write(spark, split, rows[cut:], 0)
    write(spark, split, rows[:cut], 1)
    keys = {r[0] for r in rows if r[0] is not None}
    table = rows_of(whole.current())
    assert {r[0] for r in table} == keys and len(table) == len(keys)
    nulls = sum(r[0] is None for r in rows)
    assert (whole.rejected().count() if nulls else 0) == nulls
    orders = {k: max(r[3] for r in rows if r[0] == k) for k in keys}
    unique = [k for k in keys if sum(r[0] == k and r[3] == orders[k] for r in rows) == 1]
    assert [r for r in rows_of(split.current()) if r[0] in unique] == [
        r for r in table if r[0] in unique
    ]


def test_replaced_batch_takes_its_rejects_along(spark, folder):
    log = sensor(spark, folder)
    write(spark, log, [(1, "a", 1.0, 1), (None, "x", 1.0, 2)], 0)
    write(spark, log, [(1, "a", 1.0, 1)], 0)
    assert log.rejected() is None
    write(spark, log, [(2, "a", 1.0, 2)], 1)
    log.compact()
    with pytest.raises(ValueError, match="merged"):
        write(spark, log, [(1, "b", 1.0, 1)], 0)


def written_parts(folder, of):
    return sorted(p.split("=")[-1] for p in glob.glob(f"{folder}/{of}/bucket=*"))


def test_merges_write_touched_partitions_only(spark, folder):
    log = sensor(spark, folder)
    write(spark, log, [(k, "a", 1.0, k) for k in range(400)], 0)
    log.compact(through=0)
    write(spark, log, [(7, "b", 1.0, 900)], 1)
    write(spark, log, [(7, "c", 1.0, 901)], 2)
    assert log.compact(through=2) == 2
    assert len(written_parts(folder, "snapshot/through=0")) == 8
    assert len(written_parts(folder, "snapshot/through=2")) == 1
    assert log.current().count() == 400 and (7, "c", 1.0) in rows_of(log.current())
    log.vacuum()
    assert len(written_parts(folder, "snapshot/through=0")) == 7
    assert log.batches() == [] and (7, "c", 1.0) in rows_of(log.current())
    assert log.current().count() == 400


@pytest.mark.parametrize("mode", [UPSERT, INSERT])
def test_tiers_change_nothing_and_write_what_changed(spark, folder, mode):
    log, plain = sensor(spark, folder + "/tiers", mode), sensor(spark, folder + "/plain", mode)
    rng = random.Random(4)
    first = [(k, "a" * 20, float(k), k) for k in range(3000)]
    for one in (log, plain):
        write(spark, one, first, 0)
    log.compact(through=0)
    base = sum(files.folder_sizes(spark, f"{folder}/tiers/snapshot/*/*/*.parquet").values())
    for batch in range(1, 18):
        rows = [(rng.randrange(4000), f"{batch}", 1.0, rng.randrange(9000)) for _ in range(3)]
        for one in (log, plain):
            write(spark, one, rows, batch)
        if (batch + 1) % 3 == 0:
            log.merge(batch, every=3, share=99.0)
            log.vacuum()
    assert rows_of(log.current()) == rows_of(plain.current())
    # No partition was written anew, and few folders are left: two runs of nine batches,
    # and the batches since.
    assert log._complete("snapshot", "through") == [0]
    assert log._runs() == [(-1, 7), (8, 16)]
    assert len(log.batches()) <= 3
    merged = files.folder_sizes(spark, f"{folder}/tiers/runs/*/*/*/*.parquet")
    assert sum(merged.values()) < base
    with pytest.raises(ValueError, match="merged"):
        write(spark, log, [(1, "b", 1.0, 1)], 3)
    # A partition that has grown enough is written anew.
    log.merge(17, every=3, share=0.0)
    assert len(log._complete("snapshot", "through")) == 2
    assert rows_of(log.current()) == rows_of(plain.current())


def test_vacuum_goes_by_age(spark, folder):
    log = sensor(spark, folder)
    for batch in range(6):
        write(spark, log, [(k, f"{batch}", 1.0, 10 * batch + k) for k in range(5)], batch)
    log.compact(through=2)
    log.merge(5, every=2, share=9.0)
    before = rows_of(log.current())
    log.vacuum(keep_seconds=3600)
    assert log.batches() == list(range(6)) and rows_of(log.current()) == before
    log.vacuum()
    assert log.batches() == [5] and rows_of(log.current()) == before


def test_wide_keys_are_not_broadcast(spark, folder, monkeypatch):
    monkeypatch.setattr(keyed_log, "MAX_BROADCAST_BYTES", 10)
    log = sensor(spark, folder)
    write(spark, log, [(k, "a", 1.0, k) for k in range(50)], 0)
    log.compact(through=0)
    write(spark, log, [(3, "b", 1.0, 99)], 1)
    plan = log.current()._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan and (3, "b", 1.0) in rows_of(log.current())
