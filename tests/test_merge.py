import hashlib

import pytest
from pyspark.sql import functions as F

from lectern.operators.merge import accepted, is_small, last_per_key, merge_upsert, union_sources

SCHEMA = "_id string, original_url string, title string, skills string, cluster int"


@pytest.fixture(scope="module")
def stored(spark):
    rows = [("i1", "u1", "one", "s1", 1), ("i2", "u2", "two", "s2", 2), ("i3", "u3", "three", None, 3)]
    return spark.createDataFrame(rows, SCHEMA)


def rows_of(df):
    return {r.original_url: r.asDict() for r in df.collect()}


@pytest.mark.parametrize("broadcast_rows", [100, 0])
class TestMerge:
    def test_fields(self, spark, stored, broadcast_rows):
        batch = spark.createDataFrame(
            [("u2", "TWO", None), ("u9", "nine", None)],
            "original_url string, title string, cluster int",
        )
        got = rows_of(merge_upsert(stored, batch, broadcast_rows=broadcast_rows))
        assert got["u1"] == {"_id": "i1", "original_url": "u1", "title": "one", "skills": "s1", "cluster": 1}
        assert got["u2"] == {"_id": "i2", "original_url": "u2", "title": "TWO", "skills": "s2", "cluster": 2}
        new_id = hashlib.sha256(b"u9").hexdigest()
        assert got["u9"] == {"_id": new_id, "original_url": "u9", "title": "nine", "skills": None, "cluster": None}
        assert len(got) == 4

    def test_null_overwrites_unless_preserved(self, spark, stored, broadcast_rows):
        batch = spark.createDataFrame(
            [("u1", None, None)], "original_url string, title string, cluster int"
        )
        kept = rows_of(merge_upsert(stored, batch, broadcast_rows=broadcast_rows))["u1"]
        assert (kept["title"], kept["cluster"]) == (None, 1)
        reset = rows_of(
            merge_upsert(stored, batch, preserve=(), broadcast_rows=broadcast_rows)
        )["u1"]
        assert reset["cluster"] is None

    def test_idempotent(self, spark, stored, broadcast_rows):
        batch = spark.createDataFrame(
            [("u2", "TWO"), ("u9", "nine")], "original_url string, title string"
        )
        once = merge_upsert(stored, batch, broadcast_rows=broadcast_rows)
        twice = merge_upsert(once, batch, broadcast_rows=broadcast_rows)
        assert rows_of(once) == rows_of(twice)

    def test_new_column_and_key_by_id(self, spark, stored, broadcast_rows):
        batch = spark.createDataFrame([("i1", 7), ("i2", 8)], "_id string, cluster int")
        got = rows_of(
            merge_upsert(
                stored.drop("cluster"), batch, "_id", preserve=(), broadcast_rows=broadcast_rows
            )
        )
        assert [got[u]["cluster"] for u in ("u1", "u2", "u3")] == [7, 8, None]
        assert len(got) == 3

    def test_into_an_empty_table(self, spark, stored, broadcast_rows):
        batch = spark.createDataFrame([("u1", "one")], "original_url string, title string")
        got = merge_upsert(stored.filter("false"), batch, broadcast_rows=broadcast_rows)
        assert [r.title for r in got.collect()] == ["one"]


def test_last_per_key_wins(spark):
    df = spark.createDataFrame(
        [("u", 1, "a"), ("u", 3, "c"), ("u", 2, "b"), ("v", 1, "x")], "k string, n int, t string"
    )
    assert {r.k: r.t for r in last_per_key(df, "k", "n").collect()} == {"u": "c", "v": "x"}


def test_last_per_key_cuts_before_the_shuffle(spark, capsys):
    df = spark.range(10).selectExpr("id % 2 AS k", "id AS n")
    last_per_key(df, "k", "n").explain()
    plan = capsys.readouterr().out
    assert "Partial" in plan and "WindowGroupLimit" in plan


def test_required_fields(spark):
    df = spark.createDataFrame(
        [("t", "u"), ("", "u"), (None, "u"), ("t", None), (" ", "u")],
        "title string, original_url string",
    )
    assert accepted(df).count() == 2


def test_union_fills_missing_columns(spark):
    a = spark.createDataFrame([("1",)], "x string")
    b = spark.createDataFrame([("2", "s")], "x string, skills string")
    got = union_sources(a, b).orderBy("x").collect()
    assert [(r.x, r.skills) for r in got] == [("1", None), ("2", "s")]


def test_a_batch_is_small_by_rows_and_by_bytes(spark):
    batch = spark.createDataFrame([("u1", "é" * 100), ("u2", None)], "k string, t string")
    assert is_small(batch, 2, 204)
    assert not is_small(batch, 1, 204)
    assert not is_small(batch, 2, 203)
    assert is_small(batch.filter("false"), 0, 0)


def test_a_small_batch_leaves_the_stored_table_where_it_is(spark, stored, capsys):
    batch = spark.createDataFrame([("u2", "TWO")], "original_url string, title string")
    merge_upsert(stored, batch).explain()
    plan = capsys.readouterr().out
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
