"""Tables that are replaced: failures at every step, readers in between, writers that meet."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from cadenza.sources import versions
from cadenza.sources.tables import Warehouse, between_days

DAY, OTHER = "20240130", "20240129"


class Lost(Exception):
    pass


def count(store, name):
    return store.read(name).count()


@pytest.fixture
def folders(spark, tmp_path):
    return Warehouse(spark, root=str(tmp_path / "w"))


@pytest.fixture
def catalog(spark, tmp_path):
    name = f"safe_{tmp_path.name.replace('-', '_')}"
    spark.sql(f"CREATE DATABASE {name}")
    yield Warehouse(spark, database=name)
    spark.sql(f"DROP DATABASE {name} CASCADE")


def dated(spark, n, day=DAY):
    return spark.range(n).withColumn("data_dt", F.lit(day))


def broken(df):
    return df.withColumn("id", F.raise_error(F.lit("broken")).cast("bigint"))


def write(store, kind, df):
    if kind == "table":
        store.replace(df.drop("data_dt"), "t")
    elif kind == "day":
        store.replace_day(df, "t", DAY)
    else:
        store.replace_days(df, "t", {DAY})


@pytest.mark.parametrize("kind", ["table", "day", "days"])
@pytest.mark.parametrize("place", ["folders", "catalog"])
def test_a_write_that_fails_leaves_the_old_rows(spark, request, place, kind):
    store = request.getfixturevalue(place)
    write(store, kind, dated(spark, 5))
    with pytest.raises(Exception, match="broken"):
        write(store, kind, broken(dated(spark, 9)))
    assert count(store, "t") == 5
    write(store, kind, dated(spark, 2))
    assert count(store, "t") == 2


STEPS = ["create", "torn", "forget"]


@pytest.mark.parametrize("kind", ["table", "day", "days"])
@pytest.mark.parametrize("step", STEPS)
def test_folders_survive_a_failure_at_each_step(spark, folders, monkeypatch, kind, step):
    """Before the pointer file, with a pointer file cut short, and after it."""
    store = folders
    store.retain = 0
    write(store, kind, dated(spark, 5))
    whole = versions.Files.create

    def create(self, path, text):
        if step == "torn":
            whole(self, path, text[: len(text) // 2])
        raise Lost

    def forget(self, gone, number):
        raise Lost

    if step == "forget":
        monkeypatch.setattr(versions.Pointer, "_forget", forget)
    else:
        monkeypatch.setattr(versions.Files, "create", create)
    with pytest.raises(Lost):
        write(store, kind, dated(spark, 9))
    monkeypatch.undo()
    assert count(store, "t") in ((9,) if step == "forget" else (5,))
    write(store, kind, dated(spark, 2))
    assert count(store, "t") == 2


@pytest.mark.parametrize("kind", ["table", "day"])
@pytest.mark.parametrize("step", ["ALTER", "refresh", "retire"])
def test_catalog_survives_a_failure_at_each_step(spark, catalog, monkeypatch, kind, step):
    store = catalog
    for n in (5, 6):  # in the first place of a table, and a later one
        write(store, kind, dated(spark, n))
    plain = spark.sql

    class Session:
        """The session, failing at one step."""

        def __getattr__(self, name):
            return getattr(spark, name)

        def sql(self, text):
            if step == "ALTER" and text.startswith("ALTER"):
                raise Lost
            return plain(text)

    def lost(*_):
        raise Lost

    store.spark = Session()
    if step != "ALTER":
        monkeypatch.setattr(Warehouse, "_retire", lost)
    with pytest.raises(Lost):
        write(store, kind, dated(spark, 9))
    store.spark = spark
    monkeypatch.undo()
    assert count(store, "t") == (6 if step == "ALTER" else 9)
    write(store, kind, dated(spark, 2))
    assert count(store, "t") == 2


def test_a_reader_keeps_its_rows_while_they_are_replaced(spark, folders):
    for n in range(1, 4):
        folders.replace_day(dated(spark, n), "t", DAY)
        reading = folders.read("t")
        folders.replace_day(dated(spark, 50), "t", DAY)
        assert reading.count() == n
    assert count(folders, "t") == 50


def test_replaced_rows_are_deleted_later(spark, folders, tmp_path):
    for n in range(3):
        folders.replace_day(dated(spark, n + 1), "t", DAY)
    place = tmp_path / "w" / "t"

    def held():
        return len(list(place.glob("version=*/data_dt=*")))

    assert held() == 3
    folders.retain = 0
    folders.replace_day(dated(spark, 9), "t", DAY)
    assert held() == 1 and count(folders, "t") == 9
    for n in range(12):
        folders.replace_day(dated(spark, n + 1), "t", DAY)
    assert len(list((place / "_pointer").glob("0*.json"))) <= versions.KEPT
    (place / "version=vkilled").mkdir()
    assert folders.sweep("t", older=-60) == ["version=vkilled"]
    assert count(folders, "t") == 12


def test_writers_that_meet_keep_both_days(spark, folders, monkeypatch):
    folders.replace_day(dated(spark, 1), "t", OTHER)
    plain, met = versions.Files.create, []

    def create(self, path, text):
        if not met:
            met.append(path)
            Warehouse(spark, root=folders.root).replace_day(dated(spark, 3), "t", "20240131")
        return plain(self, path, text)

    monkeypatch.setattr(versions.Files, "create", create)
    folders.replace_day(dated(spark, 2), "t", DAY)
    found = {r["data_dt"]: r["count"] for r in folders.read("t").groupBy("data_dt").count().collect()}
    assert found == {OTHER: 1, DAY: 2, "20240131": 3}


def test_folders_of_others_are_read_and_adopted(spark, folders):
    """Day folders and plain files that no pointer names."""
    path = f"{folders.root}/t"
    dated(spark, 4, OTHER).unionByName(dated(spark, 5)).write.partitionBy("data_dt").parquet(path)
    assert folders.days("t") == {OTHER, DAY} and count(folders, "t") == 9
    folders.replace_day(dated(spark, 2), "t", DAY)
    assert count(folders, "t") == 6
    assert folders.read_days("t", OTHER).count() == 4
    assert folders.read_days("t", OTHER, DAY).count() == 6
    assert folders.read("t").columns == ["id", "data_dt"]
    spark.range(7).write.parquet(f"{folders.root}/p")
    with pytest.raises(Exception, match="broken"):
        folders.replace(broken(spark.range(3)), "p")
    assert count(folders, "p") == 7
    folders.replace(spark.range(3), "p")
    assert count(folders, "p") == 3
    assert not folders.exists("q") and folders.days("q") == set()


def test_days_without_rows(spark, folders):
    folders.replace_days(dated(spark, 3), "t", {OTHER, DAY})
    assert folders.days("t") == {OTHER, DAY}
    assert folders.read_days("t", OTHER).count() == 0
    folders.drop_days("t", {OTHER, DAY})
    assert folders.days("t") == set() and folders.read("t").columns == ["id", "data_dt"]
    assert count(folders, "t") == 0
    with pytest.raises(ValueError, match="already"):
        folders.load_days(dated(spark, 1), "t")


def test_versions_are_pruned_by_day(spark, folders):
    rows = dated(spark, 4, OTHER).unionByName(dated(spark, 5))
    folders.load_days(rows, "t")
    folders.replace_day(dated(spark, 1), "t", DAY)
    df = between_days(folders.read("t"), DAY, DAY)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "data_dt" in plan[plan.index("PartitionFilters: [") :].split("]")[0]
    assert df.count() == 1


def test_catalog_tables_take_new_columns(spark, catalog):
    catalog.replace(spark.range(3), "t")
    catalog.replace(spark.range(4).withColumn("x", F.lit("a")), "t")
    assert sorted(catalog.read("t").columns) == ["id", "x"] and count(catalog, "t") == 4
    with pytest.raises(ValueError, match="lack"):
        catalog.replace(spark.range(2), "t")
    assert count(catalog, "t") == 4


def test_pointer_is_plain_json(spark, folders):
    folders.replace_day(dated(spark, 1), "t", DAY)
    pointer = versions.Pointer(spark, f"{folders.root}/t", 0)
    number, state = pointer.newest()
    text = pointer.files.text(f"{folders.root}/t/_pointer/{number:012d}.json")
    assert json.loads(text)["folders"] == state.folders and list(state.folders) == [DAY]
