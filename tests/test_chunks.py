import json
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeflow.operators import rejects
from gaugeflow.queries import decoding
from gaugeflow.sources import chunks, delimited, snapshots

ELEMENT = "trip_id int, note string, more string"
NOTES = ["", "}", "{[", 'a "quoted" one, with commas', "back\\slash\\", "two\nlines", "][", ",", '\\"']


@pytest.fixture
def blocks(spark):
    """Files are cut into blocks of so many bytes."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = [spark.conf.get(name) for name in names]

    def set_to(size):
        for name, value in zip(names, (size, 1)):
            spark.conf.set(name, str(value))

    yield set_to
    for name, value in zip(names, old):
        spark.conf.set(name, value)


def elements(n, seed):
    chance = random.Random(seed)
    return [
        {
            "trip_id": i, "note": chance.choice(NOTES),
            "more": {"list": [chance.choice(NOTES), [1, {"x": chance.choice(NOTES)}]]},
        }
        for i in range(n)
    ]


@pytest.mark.parametrize("size", [13, 64, 500, 1 << 20])
def test_blocks_of_one_array_equal_the_whole_file(spark, tmp_path, blocks, size):
    (tmp_path / "a.json").write_text(" \n" + json.dumps(elements(40, 1), indent=1) + "\n")
    (tmp_path / "b.json").write_text(json.dumps(elements(25, 2), separators=(",", ":")))
    whole = snapshots.read_snapshot_files(spark, str(tmp_path), ELEMENT)
    blocks(size)
    split = snapshots.read_snapshot_blocks(spark, str(tmp_path), ELEMENT)
    columns = ["position", "value", "trip_id", "note", "more", rejects.REASON]
    got = sorted(map(tuple, split.select(columns).collect()), key=str)
    assert got == sorted(map(tuple, whole.select(columns).collect()), key=str)
    assert len(got) == 65 and all(row[-1] is None for row in got)
    if size == 64:
        pieces = chunks.pieces(spark, str(tmp_path), ",")
        assert pieces.select("file", "block").distinct().count() > 20


def test_odd_arrays(spark, tmp_path, blocks):
    texts = {
        "empty": "[]", "blank": " [ \n ] ", "nothing": "", "scalars": '[1, "x,]", null, [2, 3]]',
        "object": '{"trip_id": 1, "note": "n"}', "cut": '[{"trip_id": 1}, {"trip_id": 2',
        "bad": '[{"trip_id": "q"}, {"trip_id": 5}]',
    }
    for name, text in texts.items():
        (tmp_path / f"{name}.json").write_text(text)
    blocks(7)

    def rows(name):
        found = snapshots.read_snapshot_blocks(spark, str(tmp_path / f"{name}.json"), ELEMENT)
        return [
            (r["value"], r["trip_id"], r[rejects.REASON])
            for r in found.orderBy("position").collect()
        ]

    assert rows("empty") == rows("blank") == rows("nothing") == []
    assert rows("scalars") == [
        ("1", None, "corrupt"), ("x,]", None, "corrupt"), (None, None, "corrupt"),
        ("[2,3]", None, "corrupt"),
    ]
    assert [r[2] for r in rows("object")] == ["corrupt", "corrupt"]
    assert [r[2] for r in rows("cut")] == ["corrupt", "corrupt"]
    assert rows("bad") == [('{"trip_id":"q"}', None, "corrupt"), ('{"trip_id":5}', 5, None)]


CSV = T.StructType([
    T.StructField("id", T.IntegerType()),
    T.StructField("note", T.StringType()),
    T.StructField("more", T.StringType()),
])


@pytest.mark.parametrize("size", [11, 64, 1 << 20])
@pytest.mark.parametrize("header", [True, False])
def test_csv_blocks_equal_the_whole_file(spark, tmp_path, blocks, size, header):
    chance = random.Random(3)
    values = ["", None, " a ", "two\nlines", "\r\n", 'a"b,c', '"', "\n\n\"", "x" * 90, "\u00e9,\n"]
    data = [(i, chance.choice(values), chance.choice(values)) for i in range(120)]
    path = str(tmp_path / "csv")
    delimited.write_csv(spark.createDataFrame(data, CSV).repartition(2), path, header)
    whole = delimited.read_csv(spark, path, CSV, header, multi_line=True)
    blocks(size)
    split = delimited.read_csv_blocks(spark, path, CSV, header)
    assert split.columns == whole.columns
    got = sorted(map(tuple, split.collect()), key=str)
    assert got == sorted(map(tuple, whole.collect()), key=str)
    assert sorted((r[:3] for r in got), key=str) == sorted(data, key=str)


def test_bad_csv_records(spark, tmp_path, blocks):
    (tmp_path / "x.csv").write_text('id,note,more\r\n1,"a\nb",c\r\n\r\nq,"d\ne",f\r\n3,g')
    blocks(9)
    rows = delimited.read_csv_blocks(spark, str(tmp_path), CSV).collect()
    got = {r["raw"]: (r["note"], r[rejects.REASON]) for r in rows}
    assert got == {
        None: ("a\nb", None), 'q,"d\ne",f': ("d\ne", "bad_field"), "3,g": ("g", "bad_field"),
    }
    accepted = rejects.accepted(delimited.read_csv_blocks(spark, str(tmp_path), CSV))
    assert accepted.select("note").count() == 1
    with pytest.raises(Exception):
        delimited.read_csv_blocks(spark, str(tmp_path), CSV, fail_fast=True).collect()


def test_text_is_shuffled_by_block(spark, tmp_path, blocks):
    """No exchange brings the pieces of a file into one task."""
    (tmp_path / "a.json").write_text(json.dumps(elements(5, 4)))
    rows = chunks.json_elements(spark, str(tmp_path))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    by_file = [
        line for line in plan.splitlines()
        if "Exchange hashpartitioning(file" in line and "block" not in line and "number" not in line
    ]
    # The one table dealt by file has a row a block.
    assert len(by_file) == 1
    assert len([line for line in plan.splitlines() if "hashpartitioning(file" in line]) > 1


def test_pieces_are_walked_where_they_are_read(spark, tmp_path, blocks):
    """Windows and sorts hold a row a block, never the pieces of one."""
    (tmp_path / "a.json").write_text(json.dumps(elements(5, 4)))
    plan = chunks.json_elements(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 2
    for line in plan.splitlines():
        if "Window [" in line or "Sort [" in line:
            assert "at#" not in line and "value#" not in line, line


@pytest.mark.parametrize("rows", [1, 2, 7])
@pytest.mark.parametrize("size", [64, 1 << 20])
def test_records_over_many_batches(spark, tmp_path, blocks, rows, size):
    """Files whose pieces, and records, come in more than one record batch, two files a task."""
    want = [elements(30, 5), [[1, ["a,", {}], "\\"], 2, "\\\\\",", {"x": []}] * 4, elements(9, 6)]
    for i, data in enumerate(want):
        (tmp_path / f"{i}.json").write_text(json.dumps(data, indent=i or None))
    (tmp_path / "open.json").write_text('[{"a": 1}, {"b": [')
    blocks(size)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    try:
        found = chunks.json_elements(spark, str(tmp_path)).orderBy("file", "number").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    for i, data in enumerate(want):
        texts = [(r["number"], r["text"]) for r in found if r["file"].endswith(f"/{i}.json")]
        assert [n for n, _ in texts] == list(range(len(data)))
        assert [json.loads(text) for _, text in texts] == data
    cut = [(r["text"], r["is_array"]) for r in found if r["file"].endswith("/open.json")]
    assert cut == [('[{"a": 1}', False), ('{"b": [', False)]


def test_runs_are_cut_by_bytes():
    walk = chunks._Walk(",", True)
    data = [f'"{i}' + "x" * 1000 + '"' for i in range(3000)]
    walk.take(pa.array(data))
    row = {
        "file": "f", "block": 0, "odd_before": 0, "depth_before": 1, "number_before": 7,
        "opening": 91, "last": 9, "balanced": True,
    }
    runs = chunks._runs(walk, row, 1).to_pylist()
    assert [t for run in runs for t in run["texts"]] == data
    assert max(sum(map(len, run["texts"])) for run in runs) <= chunks._RUN_BYTES + 2000
    places = [run["number"] - 7 for run in runs]
    assert places == [sum(len(r["texts"]) for r in runs[:i]) for i in range(len(runs))]


def test_snapshot_blocks_of_equal_and_missing_values(spark, tmp_path):
    """Rows that tie for the first or last place, rows without a number, and a group of one."""
    data = [(1, 5, 5, 5)] * 3 + [(2, 1, 1, 1), (2, 1, 2, 1), (2, 1, 2, 1), (3, 9, 9, 9)]
    data += [(None, None, 4, None), (None, 2, None, 1), (4, None, 1, 1), (4, None, 2, 2)]
    columns = "l_linenumber int, l_orderkey long, l_partkey long, l_suppkey long"
    rows = spark.createDataFrame(data, columns).repartition(3)
    rows.write.parquet(str(tmp_path / "lineitem.parquet"))
    ends = decoding.with_ends(
        spark.read.parquet(str(tmp_path / "lineitem.parquet")), "l_linenumber",
        ["l_orderkey", "l_partkey", "l_suppkey"],
    )
    for n, first, last in ends.groupBy("l_linenumber").agg(
        F.count_if("is_first"), F.count_if("is_last")
    ).collect():
        assert (first, last) == (1, 1), n
    assert ends.count() == len(data)
    found = decoding.snapshot_blocks(spark, str(tmp_path)).collect()
    assert all(r[rejects.REASON] is None for r in found)
    got = sorted((str(r["note"]), r["position"], r["trip_id"] or 0) for r in found)
    notes = {n: f'a}}, "{n}" [' for n in (1, 2, 3, 4)}
    want = [(notes[1], i, 5) for i in range(3)] + [(notes[2], i, p) for i, p in enumerate((1, 2, 2))]
    want += [(notes[3], 0, 9), (notes[4], 0, 1), (notes[4], 1, 2), ("None", 0, 4), ("None", 1, 0)]
    assert got == sorted(want)
