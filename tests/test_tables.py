import glob
import uuid
from dataclasses import replace

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeflow import files
from gaugeflow.plans import catalog, schemas
from gaugeflow.plans.spec import AddColumn, alter_spec, lenient_json, table_spec
from gaugeflow.plans.tables import Tables
from gaugeflow.queries.tables import READINGS_CHANGE, READINGS_SPEC

INT = T.IntegerType()


@pytest.fixture
def db(spark, folder):
    return Tables(spark, f"t_{uuid.uuid4().hex}", folder)


def readings(spark, *rows):
    df = spark.createDataFrame(rows, "column1 int, column2 string, column3 double")
    return df.withColumn("column4", F.lit("2024-01-01").cast("timestamp"))


@pytest.fixture
def loaded(spark, db):
    db.create(table_spec(READINGS_SPEC))
    rows = [(k, "a", float(k)) for k in range(25, 65)]
    db.load("readings", readings(spark, *rows), ["column4"])
    return db


KEPT = [*range(31, 39), *range(41, 49), *range(51, 59)]


def first_column(df):
    return sorted(r[0] for r in df.collect())


def test_create_twice(db):
    assert db.create(table_spec(READINGS_SPEC)) is True
    assert db.create(table_spec(READINGS_SPEC)) is False
    assert db.spec("readings") == table_spec(READINGS_SPEC)
    assert db.read("readings").count() == 0


def test_create_from_code(db):
    for spec in (schemas.SENSOR_TABLE, schemas.TRANSIT_TABLE, schemas.SCHEDULE_TABLE):
        assert db.create(spec)
        assert db.read(spec.name).schema.names == spec.schema.names


def test_spec_files(db, tmp_path):
    (tmp_path / "create.json").write_text(READINGS_SPEC)
    (tmp_path / "alter.json").write_text(READINGS_CHANGE)
    assert db.create_from(f"file:{tmp_path}/create.json")
    assert db.alter_from(str(tmp_path / "alter.json")) == "xyz"
    assert db.read("xyz").columns == ["column1", "column2", "signal", "added"]


def test_load_refuses_and_keeps_first(spark, loaded):
    assert first_column(loaded.read("readings")) == KEPT
    result = loaded.load(
        "readings",
        readings(spark, (31, "a", -1.0), (31, "b", 7.0), (31, "b", 8.0), (None, "x", 0.0), (39, "x", 0.0)),
        ["column3"],
    )
    assert {r["reject_reason"] for r in result.rejected.collect()} == {"null_key", "no_range"}
    # One row lost to a stored one, another to one of the same load.
    lost = sorted(tuple(r) for r in result.superseded.collect())
    assert lost == [(31, "a", 1), (31, "b", 1)]
    rows = loaded.read("readings").filter("column1 = 31").orderBy("column2").collect()
    assert [(r["column2"], r["column3"]) for r in rows] == [("a", 31.0), ("b", 7.0)]


def test_schedule_key_collision(spark, db):
    db.create(schemas.SCHEDULE_TABLE)
    df = spark.createDataFrame(
        [("d 06:20:00", 7, 1, 3, "x"), ("d 06:20:00", 8, 2, 4, "y")], schemas.SCHEDULE_TABLE.schema
    )
    result = db.load("schedule", df, ["trip_id"])
    assert first_column(db.read("schedule")) == ["d 06:20:00"]
    assert result.superseded.first()["superseded"] == 1


def test_lookup_prunes(loaded):
    found = loaded.lookup("readings", column1=45, column2="a")
    assert first_column(found) == [45]
    scan = found._jdf.queryExecution().executedPlan().toString()
    assert "range_id" in scan and "bucket" in scan
    files = found.inputFiles()
    assert files and all("range_id=1" in f for f in files)


def test_rename_table(loaded):
    loaded.rename("readings", "other")
    assert not loaded.exists("readings")
    assert loaded.spec("other").name == "other"
    assert first_column(loaded.read("other")) == KEPT


def test_names_can_be_used_again(spark, loaded):
    loaded.rename("readings", "other")
    loaded.create(table_spec(READINGS_SPEC))
    loaded.load("readings", readings(spark, (31, "fresh", 0.0)), ["column4"])
    assert first_column(loaded.read("other")) == KEPT
    assert first_column(loaded.read("readings")) == [31]
    loaded.drop("readings")
    loaded.create(table_spec(READINGS_SPEC))
    assert loaded.read("readings").count() == 0


def test_add_column_cases(spark, loaded):
    loaded.add_column("readings", AddColumn("a", INT))
    loaded.add_column("readings", AddColumn("b", INT, default=54))
    loaded.add_column("readings", AddColumn("c", INT, nullable=False, default=5))
    with pytest.raises(ValueError, match="no default"):
        loaded.add_column("readings", AddColumn("d", INT, nullable=False))
    with pytest.raises(ValueError, match="exists"):
        loaded.add_column("readings", AddColumn("a", INT))
    rows = loaded.read("readings").select("a", "b", "c").distinct().collect()
    assert [tuple(r) for r in rows] == [(None, 54, 5)]
    more = readings(spark, (31, "new", 0.0), (32, "new", 0.0)).selectExpr(
        "*", "1 AS a", "2 AS b", "CASE WHEN column1 = 31 THEN 3 END AS c"
    )
    result = loaded.load("readings", more, ["column4"])
    assert [r["reject_reason"] for r in result.rejected.collect()] == ["null_required"]
    row = loaded.read("readings").filter("column2 = 'new'").first()
    assert (row["a"], row["b"], row["c"]) == (1, 2, 3)


def test_add_required_column_to_empty_table(db):
    db.create(table_spec(READINGS_SPEC))
    db.add_column("readings", AddColumn("d", INT, nullable=False))
    assert db.spec("readings").required == ("d",)


def test_drop_column_without_rewrite(loaded, folder):
    files = sorted(loaded.read("readings").inputFiles())
    loaded.drop_column("readings", "column3")
    assert loaded.read("readings").columns == ["column1", "column2", "column4"]
    assert sorted(loaded.read("readings").inputFiles()) == files
    assert first_column(loaded.read("readings")) == KEPT
    # The old values must not come back under the same name.
    loaded.add_column("readings", AddColumn("column3", T.DoubleType()))
    assert loaded.read("readings").filter("column3 IS NOT NULL").count() == 0
    assert first_column(loaded.read("readings")) == KEPT


def test_drop_column_of_table_with_defaults(loaded):
    loaded.add_column("readings", AddColumn("b", INT, default=54))
    loaded.set_default("readings", "b", 55)
    loaded.drop_column("readings", "column3")
    rows = loaded.read("readings")
    assert rows.columns == ["column1", "column2", "column4", "b"]
    assert [r["b"] for r in rows.select("b").distinct().collect()] == [54]
    assert first_column(rows) == KEPT


def test_drop_key_column_refused(loaded):
    with pytest.raises(ValueError, match="key column"):
        loaded.drop_column("readings", "column1")
    with pytest.raises(ValueError, match="no column"):
        loaded.drop_column("readings", "nothing")


def test_rename_column(loaded):
    loaded.rename_column("readings", "column3", "signal")
    loaded.rename_column("readings", "column1", "sensor")
    assert loaded.read("readings").columns == ["sensor", "column2", "signal", "column4"]
    assert loaded.spec("readings").keys == ["sensor", "column2"]
    assert loaded.spec("readings").range_columns == ("sensor",)
    assert first_column(loaded.read("readings")) == KEPT
    assert first_column(loaded.lookup("readings", sensor=45, column2="a")) == [45]
    with pytest.raises(ValueError):
        loaded.rename_column("readings", "signal", "column2")


def test_ranges(spark, loaded, folder):
    entry = {"lower": [40], "upper": [49], "lower_bound": "exclusive", "upper_bound": "exclusive"}
    assert glob.glob(f"{folder}/readings-*/v1/range_id=1")
    loaded.drop_range("readings", entry)
    assert first_column(loaded.read("readings")) == [*range(31, 39), *range(51, 59)]
    assert not glob.glob(f"{folder}/readings-*/v1/range_id=1")
    with pytest.raises(ValueError, match="no range"):
        loaded.drop_range("readings", entry)
    with pytest.raises(ValueError, match="overlaps"):
        loaded.add_range("readings", {"lower": [35], "upper": [45]})
    number = loaded.add_range("readings", {"lower": [40], "upper": [42]})
    assert number == 3
    loaded.load("readings", readings(spark, (40, "n", 0.0), (42, "n", 0.0)), ["column4"])
    assert first_column(loaded.read("readings")) == [*range(31, 39), 40, *range(51, 59)]


def test_defaults(spark, loaded):
    loaded.add_column("readings", AddColumn("b", INT, default=54))
    loaded.set_default("readings", "b", 60)
    name = f"`{loaded.database}`.`readings`"
    insert = f"INSERT INTO {name} (column1, column2, range_id, bucket) VALUES ({{}}, 'sql', 0, 0)"
    spark.sql(insert.format(33))
    loaded.remove_default("readings", "b")
    spark.sql(insert.format(34))
    rows = loaded.read("readings").filter("column2 = 'sql'").orderBy("column1").collect()
    assert [r["b"] for r in rows] == [60, None]


def test_comments(spark, loaded):
    loaded.comment_column("readings", "column3", "the signal's value")
    loaded.comment_table("readings", "sample table")
    name = f"{loaded.database}.readings"
    comments = {r["col_name"]: r["comment"] for r in spark.sql(f"DESCRIBE TABLE {name}").collect()}
    assert comments["column3"] == "the signal's value"
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()
    assert any(r["col_name"] == "Comment" and r["data_type"] == "sample table" for r in described)


def test_alter_document(loaded):
    assert loaded.alter(alter_spec(READINGS_CHANGE)) == "xyz"
    rows = loaded.read("xyz")
    assert rows.columns == ["column1", "column2", "signal", "added"]
    assert first_column(rows) == [*range(41, 49), *range(51, 59)]


def test_drop_tables(loaded, folder):
    loaded.create(schemas.SENSOR_TABLE)
    loaded.drop("readings", "sensor", "absent", purge=True)
    assert not loaded.exists("readings") and not loaded.exists("sensor")
    assert not glob.glob(f"{folder}/readings-*")


def test_catalog(spark, folder):
    name = f"c_{uuid.uuid4().hex}"
    catalog.use_catalog(spark)
    catalog.register_catalog(spark, "other", "example.Catalog", {"url": "x"})
    assert spark.conf.get("spark.sql.catalog.other.url") == "x"
    spark.conf.unset("spark.sql.catalog.other")
    spark.conf.unset("spark.sql.catalog.other.url")
    catalog.use_database(spark, name, folder + "/db")
    try:
        assert spark.catalog.currentDatabase() == name
        spark.range(3).write.parquet(folder + "/ids")
        assert catalog.external_table(spark, f"{name}.ids", folder + "/ids") is True
        assert catalog.external_table(spark, f"{name}.ids", folder + "/ids") is False
        listed = [tuple(r) for r in catalog.list_tables(spark, name).collect()]
        assert ("ids", "EXTERNAL", False) in listed
        copy = catalog.table_as_select(spark, f"{name}.copy", f"SELECT id + 1 AS id FROM {name}.ids")
        assert first_column(copy) == [1, 2, 3]
        counted = {r["table_name"]: r["n_rows"] for r in catalog.count_tables(spark, name).collect()}
        assert counted == {"ids": 3, "copy": 3}
    finally:
        spark.catalog.setCurrentDatabase("default")


def test_alter_refuses_a_bad_document_whole(spark, folder):
    db = Tables(spark, "db_" + uuid.uuid4().hex, folder)
    db.create(table_spec(READINGS_SPEC))
    change = alter_spec({"spec": {"tableSchema": {"tableName": "readings"}, "tuningConfig": {
        "dimensionsSpec": {
            "addDimensions": [{"type": "INT32", "name": "fresh"}], "dropDimensions": ["missing"],
        },
    }}})
    with pytest.raises(ValueError, match="no column missing"):
        db.alter(change)
    assert "fresh" not in db.spec("readings").schema.names


def unranged():
    document = lenient_json(READINGS_SPEC)
    del document["spec"]["tuningConfig"]["partitionSpec"]["rangePartition"]
    return table_spec(document)


KEPT_RANGES = [k for k in range(31, 58) if k not in (39, 40, 49, 50)]


def by_key(df, *columns):
    return {r[0]: tuple(r)[1:] for r in df.select("column1", *columns).collect()}


def test_feed_of_loaded_table_through_ddl(spark, loaded):
    """Stored rows take part, and every verb finds what was fed before it."""
    feed = loaded.feed("readings", ["column3"])
    feed.write_batch(readings(spark, (31, "a", 99.0), (32, "a", 1.0), (5, "a", 1.0)), 0)
    assert by_key(feed.current(), "column3")[31] == (99.0,)
    assert by_key(loaded.read("readings"), "column3")[31] == (31.0,)  # not merged yet
    feed.compact()
    assert by_key(loaded.read("readings"), "column3")[31] == (99.0,)
    assert by_key(loaded.read("readings"), "column3")[32] == (32.0,)  # stored row is later
    assert [r["column1"] for r in feed.rejected().collect()] == [5]

    feed.write_batch(readings(spark, (33, "a", 98.0)), 1)
    loaded.add_column("readings", AddColumn("flag", INT, default=54))
    feed.write_batch(readings(spark, (34, "a", 97.0)).withColumn("flag", F.lit(7)), 2)
    feed.write_batch(readings(spark, (35, "a", 96.0)), 3)
    assert by_key(feed.current(), "flag")[33] == (54,)
    loaded.rename_column("readings", "flag", "mark")
    rows = by_key(loaded.read("readings"), "column3", "mark")
    assert [rows[k] for k in range(33, 37)] == [(98.0, 54), (97.0, 7), (96.0, 54), (36.0, 54)]
    loaded.drop_column("readings", "column4")
    loaded.drop_range("readings", {
        "lower": [40], "upper": [49], "lower_bound": "exclusive", "upper_bound": "exclusive",
    })
    feed.write_batch(readings(spark, (36, "a", 95.0)).drop("column4"), 4)
    feed.compact()
    rows = by_key(spark.table(f"{loaded.database}.readings"), "column3", "mark")
    assert rows[36] == (95.0, 54)
    assert sorted(rows) == [k for k in KEPT if not 40 < k < 49]
    assert first_column(feed.current()) == sorted(rows)


def test_feed_guards(spark, loaded):
    with pytest.raises(ValueError, match="not fed yet"):
        loaded.feed("readings")
    beside = T.StructType([T.StructField("sequence", INT)])
    with pytest.raises(ValueError, match="no values of"):
        loaded.feed("readings", ["sequence"], order_schema=beside)
    feed = loaded.feed("readings", ["column3"])
    with pytest.raises(ValueError, match="another way"):
        loaded.feed("readings", ["column4"])
    with pytest.raises(ValueError, match="is fed"):
        loaded.load("readings", readings(spark, (31, "b", 1.0)), ["column4"])
    for change in (lambda: loaded.drop_column("readings", "column3"),
                   lambda: loaded.rename_column("readings", "column3", "x")):
        with pytest.raises(ValueError, match="orders by"):
            change()
    feed.write_batch(readings(spark, (31, "b", 1.0)), 0)
    feed.compact()
    with pytest.raises(ValueError, match="merged"):
        feed.write_batch(readings(spark, (31, "b", 1.0)), 0)


def test_feed_view_and_old_snapshots(spark, db):
    db.create(unranged())
    feed = db.feed("readings", ["column3"])
    view = "feed_view_" + uuid.uuid4().hex
    feed.register(view)
    for batch in range(3):
        feed.write_batch(readings(spark, (1, "a", float(batch)), (batch, "b", 0.0)), batch)
        assert spark.table(view).filter("column2 = 'a'").first()["column3"] == batch
        feed.compact()
    feed.vacuum(keep_seconds=3600)
    assert len(feed.batches()) == 3
    feed.vacuum()
    assert feed.batches() == []
    assert spark.table(view).count() == db.read("readings").count() == 4
    db.rename("readings", "renamed")
    db.feed("renamed").write_batch(readings(spark, (9, "z", 1.0)), 3)
    db.feed("renamed").compact()
    assert db.read("renamed").count() == 5


def data_files(spark, db):
    return sorted(files.sizes(spark, f"{db.root}/readings-*/*/*=*/*=*/*.parquet"))


def test_columns_change_without_writing_a_file(spark, loaded):
    name = f"{loaded.database}.readings"
    before, rows = data_files(spark, loaded), by_key(loaded.read("readings"), "column2", "column3")
    assert before
    loaded.rename_column("readings", "column3", "signal")
    loaded.rename_column("readings", "column2", "sensor")
    assert data_files(spark, loaded) == before
    loaded.load("readings", spark.sql(
        "SELECT 51 AS column1, 'new' AS sensor, 8.0D AS signal, timestamp'2024-01-01' AS column4"
    ), ["column4"])
    for session in (spark, spark.newSession()):
        found = by_key(session.table(name), "sensor", "signal")
        assert {k: found[k] for k in rows if k != 51} == {k: v for k, v in rows.items() if k != 51}
        assert ("new", 8.0) in [tuple(r) for r in session.table(name).select("sensor", "signal").collect()]
    # Names may change places, and a name that is free again has no old values.
    loaded.rename_column("readings", "signal", "spare")
    loaded.rename_column("readings", "sensor", "signal")
    loaded.rename_column("readings", "spare", "sensor")
    swapped = by_key(spark.table(name), "signal", "sensor")
    assert all(swapped[k] == rows[k] for k in rows if k != 51)
    loaded.rename_column("readings", "signal", "kept")
    loaded.add_column("readings", AddColumn("signal", INT, default=1))
    assert {k: v for k, v in by_key(spark.table(name), "kept").items() if k != 51} == {
        k: v[:1] for k, v in rows.items() if k != 51
    }
    before = data_files(spark, loaded)
    loaded.drop_column("readings", "sensor")
    loaded.add_column("readings", AddColumn("sensor", T.DoubleType(), default=2.5))
    assert set(by_key(spark.table(name), "sensor").values()) == {(2.5,)}
    loaded.set_default("readings", "sensor", 3.5)
    loaded.drop_column("readings", "column4")
    loaded.comment_column("readings", "sensor", "volts")
    loaded.rename_column("readings", "sensor", "level")
    assert data_files(spark, loaded) == before
    assert set(by_key(spark.table(name), "level").values()) == {(2.5,)}
    assert spark.table(name).schema["level"].metadata["comment"] == "volts"
    assert loaded._defaults("readings") == {"level": "3.5"} or "3.5" in loaded._defaults("readings")["level"]


def test_sized_texts_go_by_name(spark, db):
    spec = replace(table_spec(READINGS_SPEC), columns=tuple(
        replace(c, data_type=T.VarcharType(9)) if c.name == "column2" else c
        for c in table_spec(READINGS_SPEC).columns
    ))
    db.create(spec)
    db.load("readings", readings(spark, (31, "a", 1.0)), ["column3"])
    db.rename_column("readings", "column3", "signal")
    assert by_key(db.read("readings"), "column2", "signal") == {31: ("a", 1.0)}


def test_feed_shows_partitions_as_they_merge(spark, db):
    """Partitions stand in folders of different merges; DDL and other sessions find them all."""
    db.create(table_spec(READINGS_SPEC))
    feed = db.feed("readings", ["column3"])
    name = f"{db.database}.readings"
    feed.write_batch(readings(spark, *((k, "a", 0.0) for k in range(31, 58))), 0)
    feed.compact()
    feed.write_batch(readings(spark, (32, "a", 5.0)), 1)
    feed.compact()
    assert by_key(spark.newSession().table(name), "column3")[32] == (5.0,)
    assert spark.newSession().table(name).count() == len(KEPT_RANGES)
    db.drop_column("readings", "column4")
    assert spark.table(name).count() == len(KEPT_RANGES)
    feed.write_batch(readings(spark, (33, "a", 6.0)).drop("column4"), 2)
    feed.compact(share=1000.0)  # too little for that share
    assert by_key(spark.table(name), "column3")[33] == (0.0,)
    assert by_key(feed.current(), "column3")[33] == (6.0,)
    low = {"lower": [30], "upper": [39], "lower_bound": "exclusive", "upper_bound": "exclusive"}
    db.drop_range("readings", low)
    assert min(first_column(feed.current())) == 41
    db.add_range("readings", low)
    assert min(first_column(feed.current())) == 41 == min(first_column(spark.table(name)))
    feed.write_batch(readings(spark, (31, "z", 1.0)).drop("column4"), 3)
    feed.compact()
    assert min(first_column(spark.table(name))) == 31


def test_small_load_reads_only_partitions_it_meets(spark, loaded):
    arrived = spark.createDataFrame([(31, "a", 0, 3)], "column1 int, column2 string, range_id int, bucket int")
    known = loaded._stored_keys("readings", loaded.spec("readings"), arrived)
    plan = known._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line and "bucket" in line)
    assert "PartitionFilters" in scan and "(range_id" in scan and "(bucket" in scan


def test_two_loads_account_for_every_row(spark, db):
    db.create(table_spec(READINGS_SPEC))
    given, lost, refused = 0, 0, 0
    for rows in ([(31, "a", 1.0), (31, "a", 2.0), (45, "b", 1.0), (99, "c", 1.0)],
                 [(31, "a", 3.0), (46, "b", 1.0), (46, "b", 2.0), (None, "c", 1.0)]):
        done = db.load("readings", readings(spark, *rows), ["column3"])
        given += len(rows)
        refused += done.rejected.count()
        lost += sum(r["superseded"] for r in done.superseded.collect())
    assert db.read("readings").count() + lost + refused == given
    assert (lost, refused) == (3, 2)
