import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gaugeflow.operators import keyed, sample

ROWS = st.lists(
    st.tuples(
        st.integers(0, 4), st.integers(0, 20), st.one_of(st.none(), st.floats(-9, 9, width=16))
    ),
    min_size=1, max_size=60,
)


def frame(spark, rows):
    numbered = [(k, t, i, v) for i, (k, t, v) in enumerate(rows)]
    random.shuffle(numbered)
    return spark.createDataFrame(numbered, "k int, t bigint, i int, v double")


@settings(max_examples=6, deadline=None)
@given(rows=ROWS)
def test_latest_and_first(spark, rows):
    df = frame(spark, rows)
    last, head = {}, {}
    for i, (k, t, v) in sorted(enumerate(rows), key=lambda e: (e[1][1], e[0])):
        last[k] = (k, t, i, v)
        head.setdefault(k, (k, t, i, v))
    got_last = keyed.latest(df, ["k"], ["t", "i"])
    got_first = keyed.first(df, ["k"], ["t", "i"])
    assert got_last.columns == got_first.columns == df.columns
    assert sorted(map(tuple, got_last.collect())) == [last[k] for k in sorted(last)]
    assert sorted(map(tuple, got_first.collect())) == [head[k] for k in sorted(head)]


def test_ties_do_not_depend_on_row_order(spark):
    rows = [(1, 5, "a", None), (1, 5, "b", 2.0), (1, 5, "b", 1.0)]
    for order in ([0, 1, 2], [2, 1, 0], [1, 0, 2]):
        df = spark.createDataFrame([rows[i] for i in order], "k int, t int, s string, v double")
        assert tuple(keyed.latest(df, ["k"], ["t"]).first()) == (1, 5, "b", 2.0)
        assert tuple(keyed.first(df, ["k"], ["t"]).first()) == (1, 5, "a", None)


def test_null_order_is_last_for_first(spark):
    df = spark.createDataFrame([(1, None, "x"), (1, 3, "y")], "k int, t int, s string")
    assert keyed.first(df, ["k"], ["t"]).first()["s"] == "y"


NULLABLE = st.lists(
    st.tuples(
        st.one_of(st.none(), st.integers(0, 3)), st.one_of(st.none(), st.integers(0, 5)),
        st.integers(0, 3),
    ),
    max_size=40,
)


@settings(max_examples=6, deadline=None)
@given(rows=NULLABLE)
def test_narrow_first_changes_no_row(spark, rows):
    df = spark.createDataFrame([(*row, str(i)) for i, row in enumerate(rows)], "k int, t int, i int, s string")
    for pick in (keyed.latest, keyed.first):
        whole, narrow = (pick(df, ["k"], ["t", "i"], narrow_first=n) for n in (False, True))
        assert sorted(map(repr, whole.collect())) == sorted(map(repr, narrow.collect()))


def test_narrow_first_aggregates_by_hash(spark):
    df = spark.createDataFrame([(1, 2, "a")], "k int, t int, s string")
    plan = keyed.latest(df, ["k"], ["t"], narrow_first=True)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate(keys=[k" in plan
    with pytest.raises(ValueError, match="no rows to count"):
        keyed.first(df, ["k"], ["t"], count="n", narrow_first=True)


def test_superseded(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (1, 3), (2, 1)], "k int, v int")
    assert [tuple(r) for r in keyed.superseded(df, ["k"]).collect()] == [(1, 2)]


def brute_previous(rows):
    before, result = {}, {}
    for i, (k, t, v) in sorted(enumerate(rows), key=lambda e: (e[1][1], e[0])):
        result[i] = before.get(k)
        before[k] = (v, i)
    return result


@settings(max_examples=6, deadline=None)
@given(rows=ROWS, limit=st.sampled_from([1, 2, 5, 1000]))
def test_previous(spark, rows, limit):
    df = frame(spark, rows)
    out = keyed.previous(df, ["k"], ["t", "i"], ["v", "i"], max_key_rows=limit)
    got = {r["i"]: (tuple(r["previous"]) if r["previous"] else None) for r in out.collect()}
    assert got == brute_previous(rows)


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date", "double"])
def test_previous_cuts_a_hot_key(spark, kind):
    """One key holds most rows; slices of each order type give what the window gives."""
    seconds = F.col("id") * 7919 % 864_000
    moment = F.timestamp_seconds(seconds)
    lead = {
        "timestamp": moment, "date": moment.cast("date"), "double": seconds.cast("double"),
        "timestamp_ntz": moment.cast("timestamp_ntz"),
    }[kind]
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 > 0, F.lit(0)).otherwise(F.col("id") % 50).alias("k"),
        lead.alias("t"), F.col("id").alias("i"),
    )
    plain = keyed.previous(df, ["k"], ["t", "i"], ["i"], max_key_rows=None)
    cut = keyed.previous(df, ["k"], ["t", "i"], ["i"], max_key_rows=500)
    assert "_slice" in cut._jdf.queryExecution().optimizedPlan().toString()
    assert cut.exceptAll(plain).count() == 0 and cut.count() == 3000


@pytest.mark.parametrize("case", ["text", "bunched", "one moment", "null key", "null order"])
def test_previous_cuts_hot_keys_of_any_order(spark, case):
    key = F.when(F.col("id") % 3 > 0, F.lit(0)).otherwise(F.col("id") % 50)
    lead = F.col("id") * 7919 % 2999
    if case == "text":
        lead = F.concat(F.lit("2024-"), lead.cast("string"))
    if case == "bunched":
        lead = F.when(F.col("id") == 1, 10**12).otherwise(lead)
    if case == "one moment":
        lead = F.lit(5)
    if case == "null key":
        key = F.when(F.col("id") % 3 == 0, F.col("id") % 50)
    if case == "null order":
        lead = F.when(F.col("id") % 7 > 0, lead)
    df = spark.range(3000).select(key.alias("k"), lead.alias("t"), F.col("id").alias("i"))
    plain = keyed.previous(df, ["k"], ["t", "i"], ["i"], max_key_rows=None)
    cut = keyed.previous(df, ["k"], ["t", "i"], ["i"], max_key_rows=500)
    assert "_slice" in cut._jdf.queryExecution().optimizedPlan().toString()
    assert cut.columns == plain.columns
    assert cut.exceptAll(plain).count() == 0 and cut.count() == 3000


def test_monte_carlo(spark):
    row = sample.monte_carlo_pi(spark, partitions=2, seed=7).first()
    assert row["points"] == 200_000
    assert abs(row["pi"] - 3.14159) < 0.02
    again = sample.monte_carlo_pi(spark, partitions=2, seed=7).first()
    assert again == row
    rows = sample.monte_carlo_pi_of(spark.range(50_000), ["id"]).first()
    assert rows["points"] == 50_000 and abs(rows["pi"] - 3.14159) < 0.04
