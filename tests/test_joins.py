import datetime as dt

from pyspark.sql import functions as F

from lakemart.operators.joins import (as_of_join, bounded_broadcast, lookup_key, normalized_lookup,
                                      salted_join, touched_history)
from tests.conftest import rows

T0 = dt.datetime(2024, 1, 1)


def ts(h, ms=0):
    return T0 + dt.timedelta(hours=h, milliseconds=ms)


def test_as_of_edges(spark):
    dim = spark.createDataFrame([(1, ts(1), "v1"), (1, ts(5), "v5"), (2, ts(0), "w0")],
                                "k int, start_at timestamp, attr string")
    facts = spark.createDataFrame([
        (1, 1, ts(1)),            # exactly at start
        (2, 1, ts(5, -1)),        # 1 ms before the next start -> still v1 (ledger L10)
        (3, 1, ts(0)),            # before the first version
        (4, 1, ts(99)),           # after the last
        (5, None, ts(3)),         # NULL key
        (6, 3, ts(3)),            # key without versions
        (7, 2, None),             # NULL time
    ], "fid int, k int, t timestamp")
    for strategy, skew_safe in (("broadcast", True), ("carry", True), ("carry", False)):
        out = as_of_join(facts, dim, ["k"], "t", "start_at", ["attr"], skew_safe=skew_safe,
                         strategy=strategy)
        got = dict(rows(out, "fid", "attr"))
        assert got == {1: "v1", 2: "v1", 3: None, 4: "v5", 5: None, 6: None, 7: None}, strategy
        assert out.count() == facts.count()


def test_as_of_with_end(spark):
    dim = spark.createDataFrame([(1, ts(1), ts(2), "closed")], "k int, start_at timestamp, end_at timestamp, a string")
    facts = spark.createDataFrame([(1, 1, ts(2)), (2, 1, ts(3))], "fid int, k int, t timestamp")
    for strategy in ("broadcast", "carry"):
        out = as_of_join(facts, dim, ["k"], "t", "start_at", ["a"], dim_end="end_at", strategy=strategy)
        assert dict(rows(out, "fid", "a")) == {1: "closed", 2: None}


def test_as_of_matches_range_join(spark):
    d = spark.range(200).select((F.col("id") % 7).alias("k"), (F.col("id") * 13 % 97).alias("s"),
                                F.col("id").alias("v")).dropDuplicates(["k", "s"])
    f = spark.range(500).select(F.col("id").alias("fid"), (F.col("id") % 9).alias("k"),
                                (F.col("id") * 31 % 101).alias("t"))
    got = rows(as_of_join(f, d, ["k"], "t", "s", ["v"], prefix="d_", strategy="carry"), "fid", "d_v")
    got_b = as_of_join(f, d, ["k"], "t", "s", ["v"], prefix="d_", strategy="broadcast")
    plan = got_b._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "_obkt" not in plan      # facts not shuffled
    assert rows(got_b, "fid", "d_v") == got
    # too many versions per key -> falls back to the timeline plan
    fb = as_of_join(f, d, ["k"], "t", "s", ["v"], prefix="d_", max_versions_per_key=2, skew_safe=True)
    assert "_aj_side" in fb._jdf.queryExecution().executedPlan().toString()
    assert rows(fb, "fid", "d_v") == got
    d.createOrReplaceTempView("d"); f.createOrReplaceTempView("f")
    want = spark.sql("""
        WITH dn AS (SELECT k, s, v, lead(s) OVER (PARTITION BY k ORDER BY s) AS nx FROM d)
        SELECT f.fid, dn.v AS d_v FROM f LEFT JOIN dn ON f.k = dn.k AND dn.s <= f.t
               AND (dn.nx IS NULL OR f.t < dn.nx)""")
    assert got == rows(want)


def test_as_of_splits_hot_keys(spark, monkeypatch):
    from lakemart.operators import joins
    d = spark.range(300).select((F.col("id") % 3).alias("k"), F.col("id").alias("s"), F.col("id").alias("v"))
    f = spark.range(4000).select(F.col("id").alias("fid"), F.when(F.col("id") % 4 > 0, 0).otherwise(F.col("id") % 5).alias("k"),
                                 F.when(F.col("id") % 9 == 0, F.col("id") % 400).otherwise(F.col("id") % 10 + 100).alias("t"))
    want = rows(as_of_join(f, d, ["k"], "t", "s", ["v"], prefix="d_", strategy="carry"), "fid", "d_v")
    real = joins.order_splits
    monkeypatch.setattr(joins, "order_splits", lambda *a: real(*a, rows=100))
    split = as_of_join(f, d, ["k"], "t", "s", ["v"], prefix="d_", strategy="carry")
    assert "_obkt" in split._jdf.queryExecution().executedPlan().toString()
    assert rows(split, "fid", "d_v") == want


def test_salted_equals_unsalted(spark):
    f = spark.range(2000).select(F.col("id").alias("e"), F.when(F.col("id") % 10 < 7, 0)
                                 .otherwise(F.col("id") % 50).alias("k"))
    dim = spark.range(50).select(F.col("id").alias("k"), (F.col("id") * 2).alias("d"))
    a = rows(salted_join(f, dim, "k", ["e"], buckets=8))
    b = rows(f.join(dim, "k", "left"))
    assert a == b
    # selective: only the hot key (70% of rows) is salted and replicated
    sel = salted_join(f, dim, "k", ["e"], buckets=8, hot_rows=500)
    assert rows(sel) == b
    plan = sel._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate explode" in plan


def test_bounded_broadcast_and_lookup(spark):
    small = spark.range(10).withColumnRenamed("id", "k")
    plan = small.join(bounded_broadcast(small), "k")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    big = spark.range(10_000_000)
    assert bounded_broadcast(big) is big
    assert bounded_broadcast(big, known_rows=20_000_000) is big
    f = spark.createDataFrame([(1, 2), (2, None)], "a int, b int")
    dim = spark.createDataFrame([(1, "one"), (2, "two")], "k int, name string")
    out = lookup_key(lookup_key(f, dim, "a", "k", {"a_name": "name"}), dim, "b", "k", {"b_name": "name"})
    assert rows(out) == [(1, 2, "one", "two"), (2, None, "two", None)]


def test_normalized_lookup(spark):
    df = spark.createDataFrame([("HÉLM'S dEEP",), ("Nowhere",)], "c string")
    lk = spark.createDataFrame([("Helm's Deep", "RO")], "city string, code string")
    assert rows(normalized_lookup(df, lk, "c", "city"), "c", "code") == [("HÉLM'S dEEP", "RO"), ("Nowhere", None)]


def test_touched_history_no_fanout(spark):
    # ledger L11: repeated touched keys do not multiply rows
    full = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, v string")
    touched = spark.createDataFrame([(1,), (1,), (1,)], "k int")
    assert rows(touched_history(full, touched, ["k"])) == [(1, "a"), (1, "b")]


def test_as_of_multi_column_keys(spark):
    d = spark.range(300).select((F.col("id") % 3).alias("k1"), (F.col("id") % 2).alias("k2"),
                                (F.col("id") * 17 % 211).alias("s"), F.col("id").alias("v")) \
        .dropDuplicates(["k1", "k2", "s"])
    f = spark.range(400).select(F.col("id").alias("fid"), (F.col("id") % 4).alias("k1"),
                                (F.col("id") % 2).alias("k2"), (F.col("id") * 13 % 223).alias("t"))
    got = rows(as_of_join(f, d, ["k1", "k2"], "t", "s", ["v"]), "fid", "v")
    d.createOrReplaceTempView("d2"); f.createOrReplaceTempView("f2")
    want = spark.sql("""
        WITH dn AS (SELECT k1, k2, s, v, lead(s) OVER (PARTITION BY k1, k2 ORDER BY s) AS nx FROM d2)
        SELECT f2.fid, dn.v FROM f2 LEFT JOIN dn ON f2.k1 = dn.k1 AND f2.k2 = dn.k2 AND dn.s <= f2.t
               AND (dn.nx IS NULL OR f2.t < dn.nx)""")
    assert got == rows(want)


def test_hot_keys_threshold(spark):
    from lakemart.operators.joins import hot_keys
    df = spark.createDataFrame([(k,) for k in [1] * 50 + [2] * 30 + [3] * 5], "k int")
    assert rows(hot_keys(df, "k", 10), "k") == [(1,), (2,)]
    many = spark.range(60_000).selectExpr("id % 3000 as k")
    assert hot_keys(many, "k", 20).count() == 3000      # all of them, however many


def test_long_strings_stay_a_shuffle_join(spark):
    from pyspark.sql import types as T

    from lakemart.operators.joins import plan_bytes, row_width
    from lakemart.session import cut_lineage
    assert row_width(T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])) is None
    assert row_width(T.StructType([T.StructField("a", T.LongType())])) == 16
    # few rows of long, incompressible text: their size counts, not their number
    long = cut_lineage(spark.range(400).select(F.col("id").alias("a"), F.array_join(F.transform(
        F.sequence(F.lit(1), F.lit(700)), lambda i: F.sha2((F.col("id") * 1000 + i).cast("string"), 256)), "").alias("b")))
    assert plan_bytes(long) > 16 * 1024 * 1024 * 0.5
    assert bounded_broadcast(long, known_rows=400, max_bytes=4_000_000) is long
    short = cut_lineage(long.select("a", F.substring("b", 1, 5).alias("b")))
    assert bounded_broadcast(short, max_bytes=4_000_000) is not short


def test_as_of_ties_agree_in_both_plans(spark):
    d = spark.createDataFrame([(1, 10, 5, "a"), (1, 10, 7, "b"), (1, 10, 6, "c"), (2, 1, 1, None)], "k int, s int, seq int, v string")
    f = spark.createDataFrame([(1, 1, 10), (2, 1, 11), (3, 2, 0), (4, None, 5), (5, 1, None), (6, 2, 3)], "id int, k int, t int")
    for order, want in ((["seq"], "b"), ([], "c")):
        got = [rows(as_of_join(f, d, ["k"], "t", "s", ["v"], strategy=x, skew_safe=y, dim_order=order), "id", "v")
               for x, y in (("broadcast", True), ("carry", True), ("carry", False), ("carry", "auto"))]
        assert got[0] == got[1] == got[2] == got[3] == [(1, want), (2, want), (3, None), (4, None), (5, None), (6, None)]


def test_null_keys_skip_the_timeline(spark):
    f = spark.range(9000).select(F.when(F.col("id") % 3 != 0, F.col("id") % 50).alias("k"), F.col("id").alias("t"))
    d = spark.range(50).select(F.col("id").alias("k"), F.lit(0).cast("long").alias("s"), F.col("id").alias("v"))
    out = as_of_join(f, d, ["k"], "t", "s", ["v"], strategy="carry")
    assert out.count() == 9000 and out.filter("v IS NULL").count() == 3000
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert max(sizes) < 3000


def test_salted_join_rejects_right_and_full(spark):
    import pytest
    f = spark.createDataFrame([(None, 1), (1, 2), (1, 3)], "k int, i int")
    d = spark.createDataFrame([(1, "x"), (9, "y")], "k int, v string")
    for how in ("right", "full", "full_outer"):
        with pytest.raises(ValueError):
            salted_join(f, d, "k", ["i"], how=how)
    for hot in (None, 2):
        assert rows(salted_join(f, d, "k", ["i"], hot_rows=hot), "i", "v") == rows(f.join(d, "k", "left"), "i", "v")
