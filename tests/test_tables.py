import json
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dockhand.operators.tables import APPEND, BUCKET, KEYLESS, ConcurrentChange, SnapshotTable
from dockhand.session import publish_file

SCHEMA = T.StructType().add("k", "string").add("v", "integer")


def table(spark, tmp_path, key=("k",), buckets=200, schema=SCHEMA):
    return SnapshotTable(spark, str(tmp_path), "t", schema, key, buckets)


def add(t, rows, run):
    t.write_part(t.spark.createDataFrame(rows, t.schema), run)
    t.publish(run, APPEND)


def files(tmp_path):
    return {str(p) for p in Path(tmp_path, "t", "parts").rglob("part-*.parquet")}


def contents(t):
    return {tuple(r) for r in t.read().collect()}


def test_update_of_one_row_rewrites_one_bucket(spark, tmp_path):
    t = table(spark, tmp_path)
    add(t, [(f"k{i}", i) for i in range(2000)] + [(None, 1), (None, 2)], "first")
    before = files(tmp_path)
    assert len({Path(f).parent.name for f in before}) == 201
    t.merge(spark.createDataFrame([("k7", -7)], SCHEMA), "second")
    new = files(tmp_path) - before
    assert len({Path(f).parent for f in new}) == 1 and len(new) <= 2
    assert contents(t) == {(f"k{i}", -7 if i == 7 else i) for i in range(2000)} | {(None, 1), (None, 2)}
    touched = t.buckets_of(spark.createDataFrame([("k7", 0)], SCHEMA))
    read = t.read(buckets=touched).inputFiles()
    assert len(read) <= 2 and all(f"{BUCKET}={touched[0]}/" in f for f in read)
    assert t.read(before_run="second").filter("k = 'k7'").first()["v"] == 7


def test_rows_without_key_are_only_added(spark, tmp_path):
    t = table(spark, tmp_path, buckets=4)
    add(t, [("a", 1), (None, 1)], "first")
    t.merge(spark.createDataFrame([("a", 2), (None, 2)], SCHEMA), "second")
    assert contents(t) == {("a", 2), (None, 1), (None, 2)}
    assert KEYLESS not in t.buckets_of(spark.createDataFrame([(None, 2)], SCHEMA))


def test_repeated_run_changes_nothing(spark, tmp_path):
    t = table(spark, tmp_path, buckets=4)
    for _ in range(2):
        add(t, [("a", 1)], "first")
        t.merge(spark.createDataFrame([("a", 2), ("b", 1)], SCHEMA), "second")
    assert contents(t) == {("a", 2), ("b", 1)}
    assert len(list(Path(tmp_path, "t", "log").glob("*.json"))) == 2


def test_table_of_an_earlier_layout(spark, tmp_path):
    old = table(spark, tmp_path, key=())
    add(old, [("a", 1), ("b", 1), (None, 1)], "first")
    t = table(spark, tmp_path, buckets=4)
    assert contents(t) == {("a", 1), ("b", 1), (None, 1)}
    add(t, [("c", 1)], "second")
    t.merge(spark.createDataFrame([("a", 2)], SCHEMA), "third")
    assert contents(t) == {("a", 2), ("b", 1), ("c", 1), (None, 1)}
    t.merge(spark.createDataFrame([("b", 2)], SCHEMA), "fourth")
    assert contents(t) == {("a", 2), ("b", 2), ("c", 1), (None, 1)}


def test_equal_numbers_fall_into_one_bucket(spark, tmp_path):
    schema = T.StructType().add("k", "double").add("v", "integer")
    t = table(spark, tmp_path, schema=schema)
    add(t, [(0.0, 1), (1.5, 1)], "first")
    t.merge(spark.createDataFrame([(-0.0, 2)], schema), "second")
    assert {r["v"] for r in t.read().filter("k = 0").collect()} == {2} and t.read().count() == 2


def test_two_writers_at_once(spark, tmp_path):
    tables = [table(spark, tmp_path, buckets=4) for _ in range(4)]
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda i: add(tables[i], [(f"k{i}", i)], f"run-{i}"), range(4)))
    assert contents(tables[0]) == {(f"k{i}", i) for i in range(4)}
    versions = sorted(json.loads(p.read_text())["version"] for p in Path(tmp_path, "t", "log").glob("*.json"))
    assert versions == [1, 2, 3, 4]


def test_replacing_what_another_run_changed_is_refused(spark, tmp_path, monkeypatch):
    t, other = table(spark, tmp_path, buckets=4), table(spark, tmp_path, buckets=4)
    add(t, [("a", 1)], "first")
    write = SnapshotTable.write_part

    def late(self, rows, run_id, add=False):
        if run_id == "slow" and add:
            other.merge(spark.createDataFrame([("a", 3)], SCHEMA), "quick")
        return write(self, rows, run_id, add)

    monkeypatch.setattr(SnapshotTable, "write_part", late)
    with pytest.raises(ConcurrentChange):
        t.merge(spark.createDataFrame([("a", 2)], SCHEMA), "slow")
    assert contents(t) == {("a", 3)}
    t.merge(spark.createDataFrame([("a", 2)], SCHEMA), "slow again")
    assert contents(t) == {("a", 2)}


def test_rows_of_a_key_are_added_once_by_two_writers(spark, tmp_path):
    t = table(spark, tmp_path, buckets=4)
    add(t, [("a", 1)], "first")
    seen = t.state()
    add(t, [("b", 1)], "quick")
    t.write_part(spark.createDataFrame([("b", 2)], SCHEMA), "slow")
    with pytest.raises(ConcurrentChange):
        t.publish("slow", APPEND, seen=seen)
    assert contents(t) == {("a", 1), ("b", 1)}


def test_a_file_is_published_once(spark, tmp_path):
    target = f"{tmp_path}/log/1.json"
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda i: publish_file(spark, target, f"text {i}"), range(8)))
    assert sum(won) == 1
    assert Path(target).read_text() == f"text {won.index(True)}"


def test_other_fields_are_refused(spark, tmp_path):
    add(table(spark, tmp_path), [("a", 1)], "first")
    with pytest.raises(ValueError, match="other fields"):
        table(spark, tmp_path, schema=T.StructType().add("k", "string").add("w", "integer")).read()


def test_empty_table_and_empty_part(spark, tmp_path):
    t = table(spark, tmp_path, buckets=4)
    assert t.read().count() == 0
    t.merge(spark.createDataFrame([], SCHEMA), "first")
    add(t, [], "second")
    assert t.read().count() == 0 and t.read().select(F.col("v")).columns == ["v"]
