import uuid

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gaugeflow.functions import keys, times
from gaugeflow.plans.ranges import RangePartition, check_ranges


def expected_uuid(text):
    import hashlib

    return str(uuid.UUID(bytes=hashlib.md5(text.encode()).digest(), version=3))


def test_known_uuids(spark):
    df = spark.createDataFrame(
        [("T1", "2021-06-01T10:00:00"), ("T1", "2021-06-01T10:00:00+05:30"), ("T1", None)],
        "trip string, at string",
    )
    got = [row[0] for row in df.select(keys.name_uuid(F.col("trip"), F.col("at"))).collect()]
    assert got == [
        "b6baf816-fae6-38c3-abc1-b1cb2184c6b1",
        "a37e5c36-12ee-3e81-84fa-fbf21a313a22",
        None,
    ]


@settings(max_examples=5, deadline=None)
@given(texts=st.lists(st.text(st.characters(codec="utf-8")), min_size=1, max_size=50))
def test_uuid_equals_python(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [row[0] for row in df.select(keys.name_uuid(F.col("t"))).collect()]
    assert got == [expected_uuid(t) for t in texts]


@pytest.mark.parametrize(
    "text, plain, zoned",
    [
        ("2021-06-01T10:00:00+05:30", 1622541600, 1622521800),
        ("2021-06-01T10:00:00", 1622541600, 1622541600),
        ("2021-06-01T10:00:00.123+00:00", 1622541600, 1622541600.123),
        ("2021-13-01T10:00:00", None, None),
        ("yesterday", None, None),
        (None, None, None),
    ],
)
def test_iso_micros(spark, text, plain, zoned):
    df = spark.createDataFrame([(text,)], "t string")
    row = df.select(
        times.iso_micros(F.col("t")), times.iso_micros(F.col("t"), honour_offset=True)
    ).first()
    micros = [None if s is None else round(s * 1_000_000) for s in (plain, zoned)]
    assert list(row) == micros


def test_bucket_label(spark):
    df = spark.createDataFrame([("2021/06/01",), ("",), (None,)], "d string")
    got = [row[0] for row in df.select(times.bucket_label(F.col("d"))).collect()]
    assert got == ["2021/06/01", "00000000", "00000000"]


def test_prefix_date(spark):
    df = spark.createDataFrame([("06:20:00",), (None,)], "t string")
    got = [row[0] for row in df.select(times.prefix_date("2021-03-24", F.col("t"))).collect()]
    assert got == ["2021-03-24 06:20:00", None]


def test_bucket_follows_the_exchange(spark):
    """One bucket per task after an exchange on the key: no second shuffle is needed."""
    df = spark.range(10_000).repartition(16, "id")
    rows = df.select(
        F.spark_partition_id().alias("task"), keys.hash_bucket([F.col("id")], 8).alias("b")
    )
    counts = rows.groupBy("task").agg(F.countDistinct("b").alias("n")).collect()
    assert len(counts) == 16 and all(row["n"] == 1 for row in counts)


SAMPLE = [
    RangePartition(0, (30,), (39,), False, False),
    RangePartition(1, (40,), (49,), False, False),
    RangePartition(2, (50,), (59,), False, False),
]


def ids(spark, partitions, values, kind="int"):
    df = spark.createDataFrame([(v,) for v in values], f"v {kind}")
    return [row[0] for row in df.select(keys.range_id([F.col("v")], [kind], partitions)).collect()]


def test_sample_ranges(spark):
    values = [29, 30, 31, 38, 39, 40, 41, 49, 50, 51, 59, 60, None]
    assert ids(spark, SAMPLE, values) == [
        None, None, 0, 0, None, None, 1, None, None, 2, None, None, None,
    ]


def test_touching_ends(spark):
    partitions = [
        RangePartition(7, (10,), (20,), True, True),
        RangePartition(3, (20,), (30,), False, False),
        RangePartition(5, (30,), (40,), True, False),
    ]
    assert ids(spark, partitions, [9, 10, 20, 21, 29, 30, 40]) == [None, 7, 7, 3, 3, 5, None]


def test_text_ranges_are_typed(spark):
    partitions = [RangePartition(0, ("a",), ("m",)), RangePartition(1, ("m",), ("z",))]
    assert ids(spark, partitions, ["a", "lzz", "m", "z"], "string") == [0, 0, 1, None]


def test_two_column_ranges(spark):
    partitions = [RangePartition(0, (1, "b"), (2, "b")), RangePartition(1, (2, "b"), (3, "a"))]
    df = spark.createDataFrame(
        [(1, "a"), (1, "b"), (1, "z"), (2, "a"), (2, "b"), (3, "a"), (2, "z")], "x int, y string"
    )
    column = keys.range_id([F.col("x"), F.col("y")], ["int", "string"], partitions)
    assert [row[0] for row in df.select(column).collect()] == [None, 0, 0, 0, 1, None, 1]


@settings(max_examples=10, deadline=None)
@given(cuts=st.lists(st.integers(-50, 50), min_size=2, max_size=20, unique=True), closed=st.booleans())
def test_range_tree_equals_linear_search(spark, cuts, closed):
    cuts = sorted(cuts)
    partitions = [
        RangePartition(i, (a,), (b,), not closed, closed) for i, (a, b) in enumerate(zip(cuts, cuts[1:]))
    ]
    values = list(range(-55, 56))

    def search(v):
        for p in partitions:
            above = v >= p.lower[0] if p.lower_inclusive else v > p.lower[0]
            below = v <= p.upper[0] if p.upper_inclusive else v < p.upper[0]
            if above and below:
                return p.range_id
        return None

    assert ids(spark, partitions, values) == [search(v) for v in values]


@pytest.mark.parametrize(
    "partitions",
    [
        [RangePartition(0, (1,), (5,)), RangePartition(1, (4,), (9,))],
        [RangePartition(0, (1,), (5,), True, True), RangePartition(1, (5,), (9,))],
        [RangePartition(0, (5,), (1,))],
        [RangePartition(0, (5,), (5,))],
    ],
)
def test_overlap_and_empty_refused(partitions):
    with pytest.raises(ValueError):
        check_ranges(partitions)


def test_touching_ranges_accepted():
    check_ranges([RangePartition(0, (1,), (5,)), RangePartition(1, (5,), (9,))])
    check_ranges(SAMPLE)
