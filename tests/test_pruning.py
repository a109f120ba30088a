"""Conditions on keys prune the partitions that follow from them, and lose no row."""

import random
import re
import uuid
from dataclasses import replace

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeflow.plans import schemas
from gaugeflow.plans.pruning import partitions_of
from gaugeflow.plans.ranges import RangePartition
from gaugeflow.plans.spec import table_spec, typed_literal
from gaugeflow.plans.tables import Tables
from gaugeflow.queries.tables import READINGS_SPEC
from gaugeflow.streaming.keyed_log import KeyedLog


@pytest.fixture(scope="module")
def db(spark, tmp_path_factory):
    db = Tables(spark, "prune_" + uuid.uuid4().hex[:8], str(tmp_path_factory.mktemp("prune")))
    db.create(table_spec(READINGS_SPEC))
    rows = spark.range(31, 60).selectExpr(
        "cast(id AS int) AS column1", "cast(id % 7 AS string) AS column2",
        "cast(id AS double) AS column3", "timestamp_seconds(id) AS column4",
    )
    db.load("readings", rows, ["column4"])
    return db


def numbers(condition, spark, db):
    """The (ranges, buckets) that a condition leaves, None for all."""
    found = partitions_of(spark, db.spec("readings"), condition)
    return found.get("range_id"), found.get("bucket")


@pytest.mark.parametrize("condition, ranges", [
    ("column1 > 49", [2]), ("column1 > 47", [1, 2]), ("column1 >= 51", [2]), ("50 < column1", [2]),
    ("column1 < 30", []), ("column1 = NULL", None), ("column1 BETWEEN 33 AND 42", [0, 1]), ("column1 IN (31, 58)", [0, 2]),
    ("column1 IN (1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 45)", [1]), ("column1 = 45 AND column3 > 1", [1]),
    ("column1 < 35 OR column1 > 55", [0, 2]), ("column1 < 35 OR column3 > 5", None),
    ("NOT (column1 < 51)", [2]), ("column1 + 1 > 48", None), ("column3 > 40", None),
    ("column1 > 40.5 AND column1 < 49.5", [1]), ("column1 IS NOT NULL", None), ("COLUMN1 = 45", [1]),
])
def test_ranges_of_conditions(spark, db, condition, ranges):
    assert numbers(condition, spark, db)[0] == ranges
    found = sorted(r["column1"] for r in db.filtered("readings", condition).collect())
    assert found == sorted(r["column1"] for r in db.read("readings").filter(condition).collect())


def test_one_folder_is_read(spark, db):
    found = db.filtered("readings", F.col("column1") > 50)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[.*range_id#\d+ (IN \(2\)|= 2)", plan)
    folders = {r[0].split("range_id=")[1][0] for r in found.select(F.input_file_name()).collect()}
    assert folders == {"2"}


def test_buckets_of_whole_keys(spark, db):
    spec = db.spec("readings")
    one = numbers("column1 = 45 AND column2 = '3'", spark, db)[1]
    assert set(spec.hash_keys) <= {"column1", "column2"} and len(one) == 1
    assert numbers("column2 > '3'", spark, db)[1] is None
    many = numbers("column1 IN (45, 46) AND column2 IN ('3', '4', NULL)", spark, db)[1]
    assert len(many) <= 4 and set(one) <= set(many)
    rows = db.filtered("readings", "column1 IN (45, 46) AND column2 IN ('3', '4')")
    assert sorted(r["column1"] for r in rows.collect()) == [45, 46]


def test_random_conditions_lose_no_row(spark, db):
    rng = random.Random(3)

    def condition(depth):
        if depth and rng.random() < 0.7:
            left, right = condition(depth - 1), condition(depth - 1)
            return f"({left} {rng.choice(['AND', 'OR'])} {right})"
        column = rng.choice(["column1", "column1", "column3", "column2"])
        value = rng.randrange(28, 63)
        text = f"{column} {rng.choice(['<', '<=', '=', '>=', '>', '<=>', '<>'])} {value}"
        return rng.choice([text, f"NOT {text}", f"{value} < {column}", f"{column} IN ({value}, {value + 9})"])

    whole = [r.asDict() for r in db.read("readings").collect()]
    assert whole
    for _ in range(12):
        text = condition(2)
        expected = sorted(r["column1"] for r in db.read("readings").filter(text).collect())
        assert sorted(r["column1"] for r in db.filtered("readings", text).collect()) == expected, text


def test_log_prunes_by_key_and_filters_after_reducing(spark, folder):
    log = KeyedLog(spark, folder, schemas.SENSOR_TABLE, ["date"])
    schema = "key int, date string, signal double"
    log.write_batch(spark.createDataFrame([(k, "1", 5.0) for k in range(40)], schema), 0)
    log.write_batch(spark.createDataFrame([(7, "2", 1.0)], schema), 1)
    found = log.filtered("key IN (7, 8) AND signal > 2")
    assert [r["key"] for r in found.collect()] == [8]
    assert "bucket" in found._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1]


def test_open_and_compound_ranges(spark):
    spec = replace(
        table_spec(READINGS_SPEC), range_columns=("column1", "column2"),
        ranges=(RangePartition(0, (), (3,)), RangePartition(1, (3, "b"), (5,), True, True),
                RangePartition(2, (5,), (), False, False)),
    )
    for condition, expected in (
        ("column1 < 3", [0]), ("column1 = 3", [1]), ("column1 <= 3", [0, 1]), ("column1 = 5", [1]),
        ("column1 > 5", [2]), ("column1 > 100 OR column1 < -100", [0, 2]),
    ):
        assert partitions_of(spark, spec, condition).get("range_id") == expected, condition


def test_change_that_failed_half_way_is_finished(spark, tmp_path):
    name = "half_" + uuid.uuid4().hex[:8]
    db = Tables(spark, name, str(tmp_path))
    db.create(table_spec(READINGS_SPEC))
    rows = spark.sql("SELECT 45 AS column1, 'a' AS column2, 1.0D AS column3, timestamp'2024-01-01' AS column4")
    db.load("readings", rows, ["column4"])
    # The old definition is gone, the new one is not yet there under its name.
    spark.sql(f"ALTER TABLE {name}.readings RENAME TO {name}.readings_next")
    again = Tables(spark, name, str(tmp_path))
    assert again.exists("readings") and not again.exists("readings_next")
    assert again.read("readings").count() == 1
    # The new one is complete, the old one not yet gone.
    properties = again._properties("readings")
    again._define(again.spec("readings"), properties["gaugeflow.root"], 1, {}, under="readings_next")
    assert Tables(spark, name, str(tmp_path)).read("readings").count() == 1
    assert not again.exists("readings_next")


def test_bounds_that_do_not_fit_their_column_are_refused():
    with pytest.raises(ValueError, match="no whole number"):
        typed_literal(30.9, T.IntegerType())
    assert typed_literal(30.0, T.IntegerType()) == 30
