import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from lakemart.operators.sequence import BUCKET, add_order_bucket, carry_forward, next_value, order_splits, with_order_bucket
from tests.conftest import rows


def _data(spark, n=3000, seed=3):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        r = rnd.random()
        k = 0 if r < 0.4 else (None if r > 0.97 else rnd.randint(1, 30))   # key 0 is hot; some NULL keys
        v = rnd.randint(0, 9) if rnd.random() < 0.3 else None
        t = rnd.randint(0, 10**6) if rnd.random() > 0.01 else None
        out.append((k, t, i, v))
    return spark.createDataFrame(out, "k int, t long, i int, v int")


def test_carry_forward_equals_window(spark):
    df = _data(spark)
    splits = order_splits(df, ["k"], "t", rows=60)
    assert {None, 0} <= {r._sk0 for r in splits.collect()}
    for incl in (True, False):
        for desc in (False, True):
            fast = carry_forward(df, ["k"], ["t", "i"], ["v"], out=["c"], include_current=incl,
                                 descending=desc, splits=splits)
            plain = carry_forward(df, ["k"], ["t", "i"], ["v"], out=["c"], include_current=incl,
                                  descending=desc, skew_safe=False)
            assert rows(fast, "i", "c") == rows(plain, "i", "c"), (incl, desc)


def test_next_value_equals_lead(spark):
    df = _data(spark).filter(F.col("t").isNotNull()).dropDuplicates(["k", "t"])
    w = Window.partitionBy("k").orderBy("t")
    want = df.withColumn("n", F.lead("t").over(w))
    got = next_value(df, ["k"], ["t"], "t", "n", splits=order_splits(df, ["k"], "t", rows=40))
    assert rows(got, "k", "t", "n") == rows(want, "k", "t", "n")


def test_auto_splits_only_hot_keys(spark):
    df = _data(spark)
    plain = carry_forward(df, ["k"], ["t", "i"], ["v"], skew_safe=False)
    assert order_splits(df, ["k"], "t") is None
    assert {r._sk0 for r in order_splits(df, ["k"], "t", rows=1000).collect()} == {0}
    auto = carry_forward(df, ["k"], ["t", "i"], ["v"], skew_safe="auto")
    assert "_obkt" not in auto._jdf.queryExecution().executedPlan().toString()
    assert rows(auto, "i", "v") == rows(plain, "i", "v")


def test_text_sequences_use_the_plain_window(spark):
    df = spark.createDataFrame([("a", "2024-01-02", 1), ("a", "2024-01-03", None), ("b", "v2", None)], "k string, t string, v int")
    assert rows(carry_forward(df, ["k"], ["t"], ["v"]), "k", "t", "v") == [
        ("a", "2024-01-02", 1), ("a", "2024-01-03", 1), ("b", "v2", None)]
    from lakemart.operators.scd import scd2_apply
    hist = scd2_apply(None, df.withColumn("at", F.lit("2024-01-01").cast("timestamp")), ["k"], "t", ["v"], start="at")
    assert rows(hist, "k", "t", "is_current") == [
        ("a", "2024-01-02", False), ("a", "2024-01-03", True), ("b", "v2", True)]


def _largest(df, splits):
    got = add_order_bucket(df, ["k"], "t", splits).groupBy("k", BUCKET).count()
    return max(r["count"] for r in got.collect())


def test_bursts_outliers_and_null_keys_are_spread(spark):
    """The largest (key, bucket) group, which one task holds, stays near the wanted size."""
    n, rows_each = 60_000, 1_000
    hour = 3_600_000_000
    i = F.col("id")
    burst = F.when(i % 10 < 9, i % hour).otherwise(i * hour)                 # nine tenths within one hour
    far = F.when(i == 0, F.lit(-10**15)).otherwise(burst)                    # and an outlier
    key = F.when(i % 3 == 0, F.lit(0)).when(i % 3 == 1, F.lit(None)).otherwise(i + 1)
    df = spark.range(n).select(key.cast("long").alias("k"), far.alias("t"), i.alias("i"),
                               F.when(i % 7 == 0, i).alias("v"))
    splits = order_splits(df, ["k"], "t", rows=rows_each)
    assert {r._sk0 for r in splits.collect()} == {0, None}
    assert _largest(df, splits) <= 1.3 * rows_each
    fast = carry_forward(df, ["k"], ["t", "i"], ["v"], out=["c"], splits=splits)
    plain = carry_forward(df, ["k"], ["t", "i"], ["v"], out=["c"], skew_safe=False)
    assert fast.exceptAll(plain).count() == 0 and fast.count() == n


def test_more_buckets_than_sketched_ranges(spark, monkeypatch):
    from lakemart.operators import sequence
    monkeypatch.setattr(sequence, "SPLITS", 8)
    df = spark.range(20_000).select(F.lit(1).alias("k"), (F.col("id") * 50 + F.col("id") % 7).alias("t"),
                                    F.when(F.col("id") % 5 == 0, F.col("id")).alias("v"))
    splits = order_splits(df, ["k"], "t", rows=200)
    assert splits.first()._parts == 13
    assert _largest(df, splits) <= 400
    fast = carry_forward(df, ["k"], ["t"], ["v"], out=["c"], splits=splits)
    plain = carry_forward(df, ["k"], ["t"], ["v"], out=["c"], skew_safe=False)
    assert fast.exceptAll(plain).count() == 0


def test_equal_and_missing_order_values(spark):
    df = spark.range(500).select(F.lit(1).alias("k"), F.lit(7).alias("t"), F.col("id").alias("i"), F.col("id").alias("v"))
    df = df.unionAll(spark.range(500, 900).selectExpr("2", "cast(null as int)", "id", "id"))
    splits = order_splits(df, ["k"], "t", rows=100)
    assert {r._sk0 for r in splits.collect()} == {1}    # nothing to sketch for key 2
    got = add_order_bucket(df, ["k"], "t", splits).select("k", BUCKET).distinct().collect()
    assert {r.k: r[BUCKET] for r in got}[2] == -1 and len(got) == 2


def test_hot_key_rows_spread_over_shuffle_partitions(spark):
    n = 60000
    df = spark.range(n).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
                               (F.col("id") * 7).alias("t"))
    splits = order_splits(df, ["k"], "t", rows=300)
    spark.conf.set("spark.sql.adaptive.enabled", "false")       # keep the 8 planned partitions
    try:
        parts = (with_order_bucket(df, ["k"], "t", splits)
                 .groupBy(F.spark_partition_id().alias("p")).count().collect())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    biggest = max(r["count"] for r in parts)
    # a third of the rows share key 0; a key-only hash would put them in one task
    assert biggest < n / 3 * 0.5
