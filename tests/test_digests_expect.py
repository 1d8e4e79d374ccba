import pytest
from pyspark.sql import functions as F

from lakemart.operators.cdc import digests, snapshot_diff, snapshot_diff_tree
from lakemart.session import scratch_path
from lakemart.sinks import expect

from tests.conftest import rows


def snapshots(spark, n=3000):
    old = spark.range(n).select(F.col("id").alias("k"), F.when(F.col("id") % 7 > 0, F.col("id") * 2).alias("a"),
                                F.when(F.col("id") % 5 > 0, F.lit("x")).alias("b"))
    new = (old.filter("k <> 17").withColumn("a", F.when(F.col("k") == 99, F.lit(None)).otherwise(F.col("a")))
              .withColumn("b", F.when(F.col("k") == 500, "y").otherwise(F.col("b"))))
    return old, new.unionAll(spark.createDataFrame([(n + 1, 5, "new")], new.schema))


@pytest.mark.parametrize("levels", [(1,), (4, 10), (8, 16)])
def test_tree_equals_plain_diff(spark, levels):
    old, new = snapshots(spark)
    for a, b in ((old, new), (new, old), (old, old), (old.limit(0), new), (new, old.limit(0))):
        assert rows(snapshot_diff_tree(a, b, ["k"], 3, levels=levels)) == rows(snapshot_diff(a, b, ["k"], 3))
    wider = new.withColumn("c", F.when(F.col("k") < 3, 1))
    assert rows(snapshot_diff_tree(old, wider, ["k"], 3, levels=levels)) == rows(snapshot_diff(old, wider, ["k"], 3))
    assert rows(snapshot_diff_tree(old, new, ["k"], 3, compare=["b"], levels=levels)) == \
        rows(snapshot_diff(old, new, ["k"], 3, compare=["b"]))
    with pytest.raises(ValueError):
        snapshot_diff_tree(old, new, ["k"], 1, levels=(8, 8))


def test_digests_ignore_order_and_tell_nulls_apart(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, "a", None), (3, "b", "b"), (3, "b", "b")], "k int, x string, y string")
    cols = ["k", "x", "y"]
    one = rows(digests(df, ["k"], cols, 1))
    assert one == rows(digests(df.orderBy(F.desc("k")), ["k"], cols, 1))
    swapped = df.select("k", F.col("y").alias("x"), F.col("x").alias("y"))
    assert one != rows(digests(swapped, ["k"], cols, 1))
    assert one != rows(digests(df.distinct(), ["k"], cols, 1))      # a pair of equal rows does not cancel out


def test_only_differing_ranges_are_joined(spark):
    old, new = snapshots(spark, 20_000)
    out = snapshot_diff_tree(old, new, ["k"], 1)
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("LeftSemi") >= 2
    few = snapshot_diff_tree(old, new, ["k"], 1, levels=(8, 16))
    assert few.count() == 2 + 4                         # one delete, one insert, two updates of two rows each



def test_expectations_count_drop_and_fail(spark):
    path = scratch_path(spark, "expect")
    df = spark.createDataFrame([(1, 5), (2, None), (None, 7), (4, 50)], "id int, v int")
    rules = {"small": (expect.WARN, F.col("v") < 10), "has_id": (expect.DROP, F.col("id").isNotNull())}
    got = expect.publish_expected(df, path, rules)
    assert rows(got) == [("has_id", "drop", 4, 1, 3), ("small", "warn", 4, 2, 3)]
    assert rows(spark.read.parquet(path)) == rows(df.filter("id IS NOT NULL"))
    strict = {**rules, "not_four": (expect.FAIL, F.col("id") != 4)}
    for mode in ("replace", "append"):
        with pytest.raises(expect.ExpectationFailed, match="not_four"):
            expect.publish_expected(df.filter("id IS NOT NULL"), path, strict, mode)
        assert rows(spark.read.parquet(path)) == rows(df.filter("id IS NOT NULL"))      # as it was
    more = expect.publish_expected(df.filter("id = 1"), path, strict, "append")
    assert rows(more, "rule", "bad", "kept") == [("has_id", 0, 1), ("not_four", 0, 1), ("small", 0, 1)]
    assert spark.read.parquet(path).count() == 4
    with pytest.raises(ValueError):
        expect.expect(df, {"x": ("ignore", F.lit(True))})

