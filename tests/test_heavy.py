import pytest
from pyspark.sql import functions as F

from lakemart.operators.heavy import heavy_keys
from tests.conftest import rows


@pytest.mark.parametrize("min_rows", [2, 40, 41, 700, 5000])
def test_heavy_keys_equal_exact_counts(spark, min_rows):
    i = F.col("id")
    df = spark.range(12_000).repartition(7).select(
        F.when(i % 3 == 0, F.lit(None)).when(i % 5 == 0, F.lit("hot")).otherwise((i % 290).cast("string")).alias("a"),
        (i % 2).alias("b"))
    want = df.groupBy("a", "b").count().filter(F.col("count") >= min_rows)
    assert rows(heavy_keys(df, ["a", "b"], min_rows)) == rows(want)
    assert rows(heavy_keys(df, ["a", "b"], min_rows, most_items=8)) == rows(want)       # all keys counted


def test_adversarial_order_misses_nothing(spark):
    """Many single keys before and after the heavy ones in every task."""
    one = spark.range(60_000).selectExpr("id + 1000000 as k")
    heavy = spark.range(9_000).selectExpr("id % 30 as k")
    df = one.unionAll(heavy).unionAll(one.selectExpr("k + 1000000 as k")).coalesce(3)
    assert rows(heavy_keys(df, ["k"], 300)) == rows(heavy.groupBy("k").count())


def test_no_row_per_key_is_shuffled(spark):
    df = spark.range(50_000).selectExpr("case when id % 4 = 0 then 7 else id end as k")
    out = heavy_keys(df, ["k"], 5_000)
    assert rows(out) == [(7, 12_501)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LeftSemi" in plan


def test_empty_and_small(spark):
    df = spark.range(5).withColumnRenamed("id", "k")
    assert heavy_keys(df.limit(0), ["k"], 1).collect() == []
    assert heavy_keys(df, ["k"], 6).collect() == []
    assert len(heavy_keys(df, ["k"], 0).collect()) == 5
