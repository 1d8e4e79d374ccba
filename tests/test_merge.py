import pytest
from pyspark.sql import functions as F

from lakemart.operators.merge import (DuplicateSourceKeys, delete_matching, delete_where,
                                      insert_missing, update_matching, upsert)
from tests.conftest import rows

SCHEMA = "k int, v string"


def test_upsert_replaces_and_inserts(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b"), (None, "t-null")], SCHEMA)
    s = spark.createDataFrame([(2, "B"), (3, "C"), (None, "s-null")], SCHEMA)
    # NULL keys never match: the target's stays, the source's is inserted
    assert rows(upsert(t, s, ["k"])) == [(1, "a"), (2, "B"), (3, "C"), (None, "s-null"), (None, "t-null")]


def test_upsert_idempotent(spark):
    t = spark.createDataFrame([(1, "a")], SCHEMA)
    s = spark.createDataFrame([(1, "A"), (2, "b")], SCHEMA)
    once = upsert(t, s, ["k"])
    assert rows(upsert(once, s, ["k"])) == rows(once)


def test_duplicate_source_key_raises(spark):
    # ledger L29
    t = spark.createDataFrame([(1, "a")], SCHEMA)
    s = spark.createDataFrame([(1, "x"), (1, "y")], SCHEMA)
    with pytest.raises(DuplicateSourceKeys):
        upsert(t, s, ["k"], check_unique=True)


def test_delete_matching_and_where(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], SCHEMA)
    s = spark.createDataFrame([(2, "zz")], SCHEMA)
    assert rows(delete_matching(t, s, ["k"]), "k") == [(1,), (3,)]
    assert rows(delete_where(t, F.col("k").isin(1, 3)), "k") == [(2,)]


def test_update_matching_with_condition(spark):
    t = spark.createDataFrame([(1, "a", 10), (2, "b", 20)], "k int, v string, n int")
    s = spark.createDataFrame([(1, 99), (2, 98)], "k int, n int")
    out = update_matching(t, s, ["k"], {"n": "s.n"}, when=F.col("t.v") == "a")
    assert rows(out) == [(1, "a", 99), (2, "b", 20)]


def test_insert_missing_idempotent(spark):
    t = spark.createDataFrame([(1, "a")], SCHEMA)
    s = spark.createDataFrame([(1, "A"), (2, "b")], SCHEMA)
    once = insert_missing(t, s, ["k"])
    assert rows(once) == [(1, "a"), (2, "b")]
    assert rows(insert_missing(once, s, ["k"])) == rows(once)


def test_upsert_multi_column_keys(spark):
    t = spark.createDataFrame([(1, "a", "old"), (1, "b", "old")], "k1 int, k2 string, v string")
    s = spark.createDataFrame([(1, "b", "new"), (2, "a", "new")], "k1 int, k2 string, v string")
    assert rows(upsert(t, s, ["k1", "k2"])) == [(1, "a", "old"), (1, "b", "new"), (2, "a", "new")]
