import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.session import scratch_path
from lakemart.sinks.tables import compact, merge_into, publish, write_bucketed, write_json
from lakemart.operators.merge import upsert
from lakemart.sources.files import (empty_like, parse_json_rescued, quarantine_split, read_json_lines,
                                    read_window, rescued_keys, with_lineage)
from lakemart.sources.schema import detect_drift, drift_state, evolve_schema
from tests.conftest import SF, rows

SCHEMA = T.StructType([T.StructField("event_id", T.StringType()), T.StructField("temp", T.DoubleType())])


def test_parse_json_rescued_cases(spark):
    lines = spark.createDataFrame([
        ('{"event_id": "e1", "temp": 1.5}',),
        ('{"event_id": "e2", "temp": 2.0, "firmware": "fw1.2"}',),     # new field
        ('{"event_id": "e3", "temp": "NaN-ish"}',),                    # wrong type
        ('{"event_id": "e4", "order_id": "o1"',),                      # truncated
        ("this is not json at all",),                                  # garbage
    ], "value string")
    out = {i: r for i, r in enumerate(parse_json_rescued(lines, SCHEMA)
                                      .withColumn("keys", rescued_keys()).collect())}
    got = [(r.event_id, r.temp, r.keys, r._corrupt_record is not None) for r in out.values()]
    assert ("e1", 1.5, None, False) in got
    assert ("e2", 2.0, "firmware", False) in got
    assert ("e3", None, "temp", False) in got
    assert sum(1 for g in got if g[3]) == 2          # both broken lines kept, flagged
    good, bad = quarantine_split(parse_json_rescued(lines, SCHEMA))
    assert good.count() == 3 and bad.count() == 2


def test_json_lines_skip_blank_and_lineage(spark, tmp_path):
    p = tmp_path / "landing"
    p.mkdir()
    (p / "batch_1.json").write_text('{"event_id": "a", "temp": 1}\n\n{"event_id": "b"}\n')
    df = read_json_lines(spark, str(p))
    assert df.count() == 2
    assert {os.path.basename(r._source_file) for r in df.collect()} == {"batch_1.json"}


def test_read_window_inclusive_and_pushed(spark):
    o = spark.read.parquet(f"{SF}/orders.parquet")
    w = read_window(o, "o_orderdate", "1997-01-01", "1997-12-31")
    assert w.agg(F.min("o_orderdate"), F.max("o_orderdate")).first()[1].year == 1997
    plan = w._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in plan
    lin = with_lineage(o, base_name=True, ingested_col=None).select("_source_file").distinct().collect()
    assert [r[0] for r in lin] == ["orders.parquet"]


def test_schema_evolution_and_drift(spark):
    known = T.StructType([T.StructField("a", T.StringType())])
    inc = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.LongType())])
    assert evolve_schema(known, inc).fieldNames() == ["a", "b"]
    assert detect_drift(known, inc) == (["b"], "added column 'b'")
    assert detect_drift(inc, known) == ([], "none")
    audit = spark.createDataFrame([("1", "2024-01-01 00:00:00", "orders", "x"),
                                   ("2", "2024-01-02 00:00:00", "orders", "x,y"),
                                   ("2", "2024-01-02 00:00:00", "vehicles", None)],
                                  "batch_id string, run_ts string, source string, active_extra_columns string")
    st = {r.source: r.extra_columns for r in drift_state(audit).collect()}
    assert st == {"orders": ["x", "y"], "vehicles": []}
    e = empty_like(spark.range(1), T.StructType([T.StructField("z", T.DateType())]))
    assert e.count() == 0 and e.columns == ["id", "z"]


def test_bucketed_merge_equals_upsert(spark):
    path = scratch_path(spark, "t-merge")
    t = spark.range(100).select(F.col("id").alias("k"), F.lit("old").alias("v"))
    s = spark.range(90, 120).select(F.col("id").alias("k"), F.lit("new").alias("v"))
    write_bucketed(t, path, ["k"], 8)
    merge_into(spark, path, s, ["k"], 8)
    got = rows(spark.read.parquet(path).drop("_bucket"))
    assert got == rows(upsert(t, s, ["k"]))


def test_merge_empties_buckets_and_checks_keys(spark):
    import pytest

    from lakemart.operators.merge import DuplicateSourceKeys, delete_matching
    from lakemart.sinks.tables import stored_buckets
    path = scratch_path(spark, "t-merge-del")
    t = spark.range(20).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    write_bucketed(t, path, ["k"], 8)
    assert stored_buckets(spark, path) == 8
    merge_into(spark, path, t.filter("k < 10").select("k"), ["k"], how=delete_matching)
    assert rows(spark.read.parquet(path), "k") == [(k,) for k in sorted(range(10, 20), key=str)]
    with pytest.raises(DuplicateSourceKeys):
        merge_into(spark, path, spark.createDataFrame([(1, 1), (1, 2)], "k long, v long"), ["k"])
    merge_into(spark, path, t.select("k"), ["k"], how=delete_matching)          # nothing is left, the schema is
    left = spark.read.parquet(path)
    assert left.count() == 0 and set(left.columns) == {"k", "v", "_bucket"}
    merge_into(spark, path, t, ["k"])
    assert rows(spark.read.parquet(path), "k", "v") == rows(t)
    assert spark.read.parquet(path).count() == 20


def _stopping(monkeypatch, after):
    """Let the ``after``-th write or delete of a merge fail."""
    from pyspark.sql.readwriter import DataFrameWriter
    calls = []

    def stop(real):
        def run(self, *a, **k):
            calls.append(1)
            if len(calls) == after:
                raise RuntimeError("stopped")
            return real(self, *a, **k)
        return run

    for name in ("parquet", "json"):
        monkeypatch.setattr(DataFrameWriter, name, stop(getattr(DataFrameWriter, name)))


def test_stopped_merge_is_run_again(spark, monkeypatch):
    from lakemart.operators.merge import delete_matching
    t = spark.range(40).select(F.col("id").alias("k"), F.lit("old").alias("v"))
    s = spark.range(30, 50).select(F.col("id").alias("k"), F.lit("new").alias("v"))
    for how, src, want in ((upsert, s, upsert(t, s, ["k"])), (delete_matching, t.select("k"), t.limit(0))):
        for after in range(1, 6):                       # source copy, rows, description, the table, its empty file
            path = scratch_path(spark, "t-stop")
            write_bucketed(t, path, ["k"], 4)
            with monkeypatch.context() as m:
                _stopping(m, after)
                try:
                    merge_into(spark, path, src, ["k"], how=how)
                except RuntimeError:
                    pass
            merge_into(spark, path, src, ["k"], how=how)
            assert rows(spark.read.parquet(path), "k", "v") == rows(want), after
            assert not os.path.exists(path + ".next")


def test_table_partly_overwritten_is_finished(spark):
    """The state after a commit that has deleted one bucket's old files."""
    from lakemart.sinks import tables
    path = scratch_path(spark, "t-part-merge")
    t = spark.range(40).select(F.col("id").alias("k"), F.lit("old").alias("v"))
    s = spark.range(30, 50).select(F.col("id").alias("k"), F.lit("new").alias("v"))
    write_bucketed(t, path, ["k"], 4)
    real, tables.finish = tables.finish, lambda *a: None
    try:
        merge_into(spark, path, s, ["k"])
    finally:
        tables.finish = real
    assert rows(spark.read.parquet(path), "k", "v") == rows(t)      # readers still see the table before the merge
    fs, make = tables._fs(spark, path)
    assert fs.delete(make(f"{path}/_bucket=2of4"), True)
    assert tables.table_exists(spark, path)
    assert rows(spark.read.parquet(path), "k", "v") == rows(upsert(t, s, ["k"]))


def test_replacing_keeps_partition_values(spark):
    from lakemart.sinks import tables
    path = scratch_path(spark, "t-values")
    df = spark.createDataFrame([("01", 1), ("1", 2), ("2024-01-01", 3)], "p string, x int")
    for _ in range(2):
        publish(df, path, partition_by=["p"])
    fs, make = tables._fs(spark, path)
    assert sorted(f.getPath().getName() for f in fs.listStatus(make(path)) if f.isDirectory()) == ["p=01", "p=1", "p=2024-01-01"]


def test_null_safe_merges(spark):
    from lakemart.operators.merge import insert_missing
    t = spark.createDataFrame([(1, "a"), (None, "b")], "k int, v string")
    s = spark.createDataFrame([(None, "c"), (2, "d")], "k int, v string")
    assert rows(upsert(t, s, ["k"], null_safe=True)) == rows(spark.createDataFrame([(1, "a"), (None, "c"), (2, "d")], t.schema))
    assert upsert(t, s, ["k"]).count() == 4
    once = insert_missing(t, s, ["k"], null_safe=True)
    assert rows(once) == rows(spark.createDataFrame([(1, "a"), (None, "b"), (2, "d")], t.schema))
    assert rows(insert_missing(once, s, ["k"], null_safe=True)) == rows(once)


def test_replace_may_read_the_table_it_replaces(spark):
    path = scratch_path(spark, "t-replace")
    publish(spark.range(10), path)
    publish(spark.read.parquet(path).filter("id > 4"), path)
    publish(spark.range(100, 102), path, "append")
    assert spark.read.parquet(path).count() == 7


def test_compact_keeps_multiset_and_json_precision(spark):
    src = scratch_path(spark, "t-src")
    publish(spark.range(1000).repartition(20).withColumn("x", F.col("id") % 7), src)
    dst = scratch_path(spark, "t-dst")
    n = compact(spark, src, dst, rows_per_file=400)
    assert n == 3
    assert rows(spark.read.parquet(dst)) == rows(spark.read.parquet(src))
    j = scratch_path(spark, "t-json")
    ev = spark.read.parquet(f"{SF}/events.parquet").select("event_id", "ts")
    write_json(ev, j, files=2)
    back = spark.read.schema("event_id long, ts timestamp_ntz").json(j)
    assert rows(back) == rows(ev)


def test_analyze_external_table(spark):
    from lakemart.sinks.tables import analyze
    path = scratch_path(spark, "t-analyze")
    publish(spark.range(100).withColumn("x", F.col("id") % 3), path)
    spark.sql(f"CREATE TABLE IF NOT EXISTS lm_analyze_t USING parquet LOCATION '{path}'")
    analyze(spark, "lm_analyze_t", ["x"])
    desc = {r[0]: r[1] for r in spark.sql("DESCRIBE TABLE EXTENDED lm_analyze_t").collect()}
    assert "100 rows" in desc.get("Statistics", "")
    spark.sql("DROP TABLE lm_analyze_t")


def test_read_change_feed_versions_and_compact_all(spark):
    from lakemart.operators.cdc import snapshot_diff
    from lakemart.sinks.tables import compact_all
    from lakemart.sources.files import read_change_feed
    path = scratch_path(spark, "t-cdf")
    s0 = spark.createDataFrame([(1, "a")], "k int, v string")
    s1 = spark.createDataFrame([(1, "b"), (2, "c")], "k int, v string")
    publish(snapshot_diff(s0.limit(0), s0, ["k"], 1), path, "append")
    publish(snapshot_diff(s0, s1, ["k"], 2), path, "append")
    assert read_change_feed(spark, path).count() == 4
    assert rows(read_change_feed(spark, path, 2), "k", "_change_type") == [
        (1, "update_postimage"), (1, "update_preimage"), (2, "insert")]
    plan = read_change_feed(spark, path, 2)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(_commit_version,2)" in plan
    dst = scratch_path(spark, "t-cdf-c")
    assert compact_all(spark, {path: dst}, rows_per_file=10) == {path: 1}
    assert spark.read.parquet(dst).count() == 4


def test_bucketed_tables_join_without_shuffle(spark):
    from lakemart.sinks.tables import save_bucketed_table
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        o = spark.read.parquet(f"{SF}/orders.parquet")
        li = spark.read.parquet(f"{SF}/lineitem.parquet").withColumnRenamed("l_orderkey", "o_orderkey")
        a = save_bucketed_table(o, "lm_b_orders", scratch_path(spark, "b-o"), ["o_orderkey"], 8)
        b = save_bucketed_table(li, "lm_b_lines", scratch_path(spark, "b-l"), ["o_orderkey"], 8)
        j = a.join(b, "o_orderkey")
        plan = j._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert j.count() == li.join(o, "o_orderkey").count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE IF EXISTS lm_b_orders")
        spark.sql("DROP TABLE IF EXISTS lm_b_lines")


def test_read_window_prunes_partitions(spark):
    import datetime as dt
    path = scratch_path(spark, "t-part")
    df = spark.createDataFrame([(i, dt.datetime(2024, 1, 1 + i % 5, 12)) for i in range(50)],
                               "id int, ts timestamp").withColumn("d", F.to_date("ts"))
    publish(df, path, partition_by=["d"])
    w = read_window(spark.read.parquet(path), "ts", "2024-01-02", "2024-01-03", partition_col="d")
    plan = w._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(d" in plan and "2024-01-02" in plan
    assert w.count() == 10      # the 2nd at 12:00; the 3rd at 12:00 is after the end bound (midnight)
