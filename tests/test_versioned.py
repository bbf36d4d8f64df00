"""Upserts into a table read by name: old rows before the switch, new ones after."""

import datetime
import uuid

import pytest
from pyspark.sql import functions as F

from tabflow.operators import versioned as V


@pytest.fixture()
def name(spark, tmp_path):
    db = f"v{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {db} LOCATION '{tmp_path}/{db}'")
    yield f"{db}.t"
    spark.sql(f"DROP DATABASE {db} CASCADE")


COLS = "k int, part string, v double, day date"
DAY = datetime.date(2024, 1, 2)
BASE = [(1, "a", 10.0, DAY), (2, "a", 20.0, DAY), (3, "b", 30.0, None), (4, "c/d'e\\f", 40.0, DAY), (None, None, 50.0, DAY)]
CHANGES = [(1, "b", 11.0, None, 1), (1, "b", 12.0, None, 2), (9, "z", 90.0, DAY, 1), (4, "c/d'e\\f", 41.0, DAY, 1)]
AFTER = [(1, "b", 12.0, None), (2, "a", 20.0, DAY), (3, "b", 30.0, None), (4, "c/d'e\\f", 41.0, DAY), (9, "z", 90.0, DAY), (None, None, 50.0, DAY)]


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def upsert(spark, name, changes=CHANGES):
    V.upsert_versioned(spark, name, spark.createDataFrame(changes, COLS + ", seq int"), ["k"], [F.desc("seq")])


def test_upsert_moves_adds_and_replaces_rows(spark, name):
    table = V.create_versioned(spark.createDataFrame(BASE, COLS), name, ["part", "day"])
    assert table.columns == ["k", "part", "v", "day"] and rows(table) == sorted(BASE, key=str)
    untouched = [p for p in V.current(spark, name) if p[1][0] is None]
    upsert(spark, name)
    assert rows(spark.table(name)) == sorted(AFTER, key=str)
    assert [p for p in V.current(spark, name) if p[1][0] is None] == untouched  # generation 0 still
    upsert(spark, name, [(None, None, 51.0, DAY, 1)])  # a null key is a key
    assert (None, None, 51.0, DAY) in rows(spark.table(name)) and spark.table(name).count() == 6


def test_a_partition_whose_rows_all_moved_is_gone(spark, name):
    V.create_versioned(spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], "k int, part string, v double"), name, ["part"])
    V.upsert_versioned(spark, name, spark.createDataFrame([(1, "b", 5.0)], "k int, part string, v double"), ["k"], [F.desc("v")])
    assert rows(spark.table(name)) == [(1, "b", 5.0), (2, "b", 2.0)]
    assert [p[1] for p in V.current(spark, name)] == [("b",)]
    assert V.retire(spark, name) == 2 and len(V.partitions(spark, name)) == 1


def test_a_stop_before_the_switch_leaves_the_old_rows(spark, name, monkeypatch):
    V.create_versioned(spark.createDataFrame(BASE, COLS), name, ["part", "day"])

    def stop(*a):
        raise RuntimeError("stopped")

    with monkeypatch.context() as m:
        m.setattr(V, "_switch", stop)
        with pytest.raises(RuntimeError):
            upsert(spark, name)
    assert rows(spark.table(name)) == sorted(BASE, key=str)
    assert len(V.partitions(spark, name)) > len(V.current(spark, name))  # written, but not seen
    upsert(spark, name)  # the same upsert again
    assert rows(spark.table(name)) == sorted(AFTER, key=str)


def test_a_stop_after_the_switch_leaves_the_new_rows(spark, name, monkeypatch):
    V.create_versioned(spark.createDataFrame(BASE, COLS), name, ["part", "day"])
    switch = V._switch

    def switch_and_stop(*a):
        switch(*a)
        raise RuntimeError("stopped")

    with monkeypatch.context() as m:
        m.setattr(V, "_switch", switch_and_stop)
        with pytest.raises(RuntimeError):
            upsert(spark, name)
    assert rows(spark.table(name)) == sorted(AFTER, key=str)
    upsert(spark, name)  # again: nothing changes
    assert rows(spark.table(name)) == sorted(AFTER, key=str)


def test_a_reader_planned_before_the_switch_ends_with_the_old_rows(spark, name):
    V.create_versioned(spark.createDataFrame(BASE, COLS), name, ["part", "day"])
    reader = spark.table(name)
    reader.explain()
    upsert(spark, name)
    assert rows(reader) == sorted(BASE, key=str)


def test_one_partition_is_all_a_filter_reads(spark, name):
    from tabflow.plans.explain import explain_text

    V.create_versioned(spark.createDataFrame(BASE, COLS), name, ["part", "day"])
    upsert(spark, name)
    text = explain_text(spark.table(name).where("part = 'b'").select("v"))
    assert "PartitionFilters: [" in text and "ReadSchema: struct<v:double>" in text
    files = spark.table(name).where("part = 'b'").select(F.col("v"), F.input_file_name().alias("f"))
    assert all("part=b" in r.f for r in files.collect())


def test_no_changes_and_an_empty_table(spark, name):
    V.create_versioned(spark.createDataFrame([], COLS), name, ["part", "day"])
    assert spark.table(name).count() == 0
    upsert(spark, name, [])
    assert spark.table(name).count() == 0
    upsert(spark, name)
    assert spark.table(name).count() == 3
