"""Keyed tables and logs whose live files a manifest names."""

import os

import pytest
from helpers import tuples

from footfall.sinks.versions import KeyedTable, LogTable

SCHEMA = "k string, j string, v int, o int"


def rows(spark, *values):
    return spark.createDataFrame([(k, "x", v, o) for k, v, o in values], SCHEMA)


def files(path):
    return {f"{d}/{f}" for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_a_batch_of_one_key_rewrites_one_bucket(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path), SCHEMA, ("k", "j"), buckets=8)
    assert table.read().count() == 0
    table.merge(rows(spark, *[(f"k{i}", i, 0) for i in range(100)], (None, -1, 0)), 0)
    before = files(f"{tmp_path}/data")
    assert len(before) == 8 and len(table.read().inputFiles()) == 8
    table.merge(rows(spark, ("k7", 700, 0)), 1)
    assert len(files(f"{tmp_path}/data") - before) == 1
    assert len(table.read().inputFiles()) == 8  # one file for each bucket, however many commits
    table.merge(rows(spark, (None, -2, 0), ("new", 5, 0)), 2)
    want = {f"k{i}": i for i in range(100)} | {"k7": 700, None: -2, "new": 5}
    assert {r.k: r.v for r in table.read().collect()} == want
    assert {r.k: r.v for r in table.read(0).collect()}["k7"] == 7


def test_replays_and_crashes_lose_nothing(spark, tmp_path, monkeypatch):
    table = KeyedTable(spark, str(tmp_path), SCHEMA, ("k", "j"), buckets=4)
    table.merge(rows(spark, ("a", 1, 0), ("b", 1, 0)), 0)
    written = files(tmp_path)
    table.merge(rows(spark, ("a", 9, 0)), 0)  # a finished commit is not done again
    assert files(tmp_path) == written
    with monkeypatch.context() as crash:
        crash.setattr(table, "commit", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            table.merge(rows(spark, ("a", 2, 0), ("c", 2, 0)), 1)
    assert tuples(table.read(), "k", "v") == [("a", 1), ("b", 1)]
    table.merge(rows(spark, ("a", 2, 0), ("c", 2, 0)), 1)
    assert tuples(table.read(), "k", "v") == [("a", 2), ("b", 1), ("c", 2)]


def test_the_greater_order_stays(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path), SCHEMA, ("k", "j"), buckets=2, order="o")
    table.merge(rows(spark, ("a", 1, 5), ("b", 1, 5)), 0)
    table.merge(rows(spark, ("a", 2, 4), ("b", 2, 5), ("c", 2, 1)), 3)
    assert tuples(table.read(), "k", "v") == [("a", 1), ("b", 2), ("c", 2)]
    table.merge(rows(spark), 4)
    assert tuples(table.read(), "k", "v") == [("a", 1), ("b", 2), ("c", 2)]


def test_vacuum_keeps_what_the_last_manifests_name(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path), SCHEMA, ("k", "j"), buckets=2)
    for version in range(6):
        table.merge(rows(spark, ("a", version, 0), (f"k{version}", version, 0)), version)
    want = tuples(table.read(), "k", "v")
    table.vacuum(keep=2)
    assert table.versions() == [4, 5]
    assert tuples(table.read(), "k", "v") == want and table.read(4).count() == 6
    live = {table.folder(p, v) for kept in (4, 5) for p, (v, _) in table.parts(kept).items()}
    assert {os.path.dirname(f) for f in files(f"{tmp_path}/data")} == live


def test_a_log_writes_new_rows_only_and_merges_as_it_doubles(spark, tmp_path):
    table = LogTable(spark, str(tmp_path), SCHEMA)
    for version in range(16):
        assert table.append(rows(spark, (f"k{version}", version, 0)), version) == 1
        assert len(table.parts()) <= 5
    before = files(tmp_path)
    assert table.append(rows(spark), 16) == 0 and table.append(rows(spark, ("x", 1, 1)), 3) == 0
    assert files(tmp_path) == before
    assert sorted(r.v for r in table.read().collect()) == list(range(16))
    table.append(rows(spark, *[(f"m{i}", i, 0) for i in range(100)]), 17)
    assert len(table.parts()) == 1 and table.read().count() == 116
