import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from lakemart.operators.rollup import (hourly_rollup, key_share, milestone_pivot, row_counts,
                                       union_distinct, high_water)
from tests.conftest import rows

T0 = dt.datetime(2024, 1, 1, 10)


def reading(i, v, mins, speed, odo, status, cargo=None):
    return (f"r{i}", v, T0 + dt.timedelta(minutes=mins), speed, 50.0, 90.0, cargo, odo, status)


S = ("reading_id string, vehicle_id string, reading_timestamp timestamp, speed_kmh double, fuel_pct double, "
     "engine_temp_c double, cargo_temp_c double, odometer_km int, vehicle_status string")


def test_hourly_rollup_measures(spark):
    df = spark.createDataFrame([reading(1, "v", 0, 10.0, 100, "moving"), reading(2, "v", 20, 21.0, 130, "idle"),
                                reading(3, "v", 59, None, 160, None, 4.0), reading(4, "v", 61, 5.0, 170, "idle")], S)
    out = {r.period_start_timestamp.hour: r for r in hourly_rollup(df).collect()}
    h = out[10]
    assert h.readings_count == 3 and h.avg_speed_kmh == 16.0 and h.max_speed_kmh == 21.0
    assert h.km_driven == 60 and h.active_readings == 2       # NULL status counts as active (L14)
    assert h.utilization_pct == 0.67 and h.min_cargo_temp_c == 4.0
    assert out[11].active_readings == 0


def test_milestone_pivot_equals_window_form(spark):
    df = spark.createDataFrame([(1, 1, "created", 5.0), (1, 2, "shipped", None), (1, 3, "created", None),
                                (2, 1, "shipped", 7.0)], "k int, t int, status string, amt double")
    out = milestone_pivot(df, "k", "status", "t", ["created", "shipped"], carry_cols=["amt"])
    w = Window.partitionBy("k").orderBy("t").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ref = (df.select("k", *[F.last(F.when(F.col("status") == s, F.col("t")), True).over(w).alias(f"{s}_ts")
                            for s in ["created", "shipped"]],
                     F.last("amt", True).over(w).alias("amt"), F.last("status", True).over(w).alias("current_status"))
             .dropDuplicates(["k"]))
    assert rows(out) == rows(ref.select(*out.columns))


def test_key_share_top(spark):
    df = spark.createDataFrame([(k,) for k in [1] * 6 + [2] * 3 + [3]], "k int")
    assert rows(key_share(df, "k", 2)) == [(1, 6, 0.6), (2, 3, 0.3)]


def test_union_distinct_counts_and_high_water(spark):
    df = spark.createDataFrame([("a", "b"), ("b", "c")], "x string, y string")
    assert rows(union_distinct(df, ["x", "y"])) == [("a",), ("b",), ("c",)]
    assert high_water(spark.range(5), "id").first()[0] == 4
    assert rows(row_counts({"a": spark.range(3), "b": spark.range(0)})) == [("a", 3), ("b", 0)]
