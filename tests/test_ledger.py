"""Semantics-ledger items not covered elsewhere."""

import datetime as dt
import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.operators.rollup import milestone_pivot
from lakemart.plans import marts
from lakemart.sources.files import read_json_lines, read_window
from tests.conftest import rows


def test_l4_cast_before_dedupe(spark):
    # "9" > "10" as text; typed first, 10 is the latest
    bronze = spark.createDataFrame([("k", "9", "old"), ("k", "10", "new")], "id string, seq string, v string")
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("seq", T.IntegerType()),
                           T.StructField("v", T.StringType())])
    assert rows(marts.silver_scd1(bronze, "id", "seq", schema), "v") == [("new",)]


def test_l12_fact_columns_have_clean_names(spark):
    ev = spark.createDataFrame([("e1", "v1", dt.date(2024, 1, 1), "x")],
                               "event_id string, vehicle_id string, event_date date, event_type string")
    dim_v = spark.createDataFrame([("v1", "sk1")], "vehicle_id string, vehicle_sk string")
    cal = marts.build_dim_date(spark, "2024-01-01", "2024-01-02")
    out = marts.build_fact_event(ev, dim_v, cal)
    assert all("." not in c for c in out.columns)
    assert out.columns[:3] == ["event_id", "vehicle_sk", "date_key"]


def test_l18_all_milestones_returned(spark):
    df = spark.createDataFrame([(1, 1, "created")], "k int, t int, status string")
    out = milestone_pivot(df, "k", "status", "t", marts.ORDER_STATUSES)
    assert [f"{s}_ts" for s in marts.ORDER_STATUSES] == [c for c in out.columns if c.endswith("_ts")]


def test_l24_underscore_files_are_ignored(spark, tmp_path):
    p = tmp_path / "feed"
    p.mkdir()
    (p / "_malformed_b1.json").write_text('{"a": 1}\n')
    (p / "malformed_b1.json").write_text('{"a": 2}\n')
    got = [r.value for r in read_json_lines(spark, str(p)).collect()]
    assert got == ['{"a": 2}']


def test_l27_window_bounds_inclusive(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1),), (dt.datetime(2024, 1, 3),),
                                (dt.datetime(2024, 1, 3, 0, 0, 1),)], "ts timestamp")
    got = rows(read_window(df, "ts", "2024-01-01", "2024-01-03"))
    # date bounds mean midnight: the end day's later instants are outside
    assert got == [(dt.datetime(2024, 1, 1),), (dt.datetime(2024, 1, 3),)]


def test_location_lookup_fixed_values(spark):
    lk = marts.location_lookup(spark)
    assert lk.count() == 26 and lk.columns == ["city", "realm_name", "realm_code", "region",
                                                "language_region"]


def test_l28_carry_list_is_a_list_not_a_substring(spark):
    df = spark.createDataFrame([(1, 1, "created", "x")], "order_id int, t int, status string, order string")
    out = milestone_pivot(df, "order_id", "status", "t", ["created"], carry_cols=["order"])
    assert rows(out, "order_id", "order") == [(1, "x")]
