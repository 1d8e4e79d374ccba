import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakemart.operators.asof import as_of_merge
from lakemart.operators.joins import as_of_join
from tests.conftest import rows


def data(spark, hot=0.6):
    i = F.col("id")
    key = F.when(i % 10 < int(10 * hot), 0).when(i % 97 == 0, None).otherwise(i % 40)
    burst = F.when(i % 3 == 0, i % 50).when(i % 101 == 0, None).otherwise(i % 4000)
    day = lambda c: (F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(F.lit(0), F.lit(0), c)).cast("timestamp_ntz")
    facts = spark.range(0, 6000, 1, 5).select(i.alias("fid"), key.cast("int").alias("k"), day(burst.cast("int")).alias("t"),
                                                    F.to_json(F.struct(i)).alias("note"))
    dim = spark.range(900).select((i % 45).cast("int").alias("key"), day(((i * 7) % 3900).cast("int")).alias("s"),
                                  i.alias("v"), F.when(i % 6 > 0, i.cast("string")).alias("w"))
    return facts, dim.unionAll(dim.limit(60).withColumn("v", F.col("v") + 1000))       # ties at one start


ARGS = {"keys": ["k"], "fact_time": "t", "dim_start": "s", "take": ["v", "w"], "dim_keys": ["key"], "prefix": "d_"}


@pytest.mark.parametrize("rows_per_part", [100, 1_000_000])
def test_merge_equals_timeline(spark, rows_per_part):
    facts, dim = data(spark)
    want = as_of_join(facts, dim, strategy="carry", **ARGS)
    got = as_of_merge(facts, dim, rows_per_part=rows_per_part, **ARGS)
    assert got.columns == want.columns and got.schema["d_v"].dataType == want.schema["d_v"].dataType
    assert rows(got) == rows(want) and got.count() == 6000


def test_few_versions_before_many_ranges(spark):
    """A hot key whose only version starts before all its facts."""
    facts, _ = data(spark)
    dim = spark.createDataFrame([(0, dt.datetime(2023, 1, 1), 1, "a"), (0, dt.datetime(2024, 1, 1, 0, 10), 2, None), (3, None, 3, "x"),
                                 (None, dt.datetime(2023, 1, 1), 4, "y")], "key int, s timestamp_ntz, v long, w string")
    want = as_of_join(facts, dim, strategy="carry", **ARGS)
    assert rows(as_of_merge(facts, dim, rows_per_part=100, **ARGS)) == rows(want)
    for f, d in ((facts, dim.limit(0)), (facts.limit(0), dim)):
        assert rows(as_of_merge(f, d, **ARGS)) == rows(as_of_join(f, d, strategy="carry", **ARGS))


def test_dates_and_several_keys(spark):
    f = spark.createDataFrame([(1, "a", dt.date(2024, 1, 5)), (1, "b", dt.date(2024, 1, 5)), (1, None, dt.date(2024, 1, 5))],
                              "x int, y string, t date")
    d = spark.createDataFrame([(1, "a", dt.date(2024, 1, 5), 1.5), (1, "a", dt.date(2024, 1, 6), 2.5), (1, "b", dt.date(2024, 1, 6), 3.5)],
                              "x int, y string, s date, v double")
    got = as_of_merge(f, d, ["x", "y"], "t", "s", ["v"])
    assert {(r.y, r.v) for r in got.collect()} == {("a", 1.5), ("b", None), (None, None)}
