from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.operators.scd import scd2_apply
from lakemart.session import scratch_path
from lakemart.sinks.tables import write_json
from lakemart.streaming.ingest import append_stream, apply_stream, first_deliveries, json_stream, rollup_stream
from tests.conftest import SF, rows

EV = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
                   T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
                   T.StructField("value", T.DoubleType())])


def test_stream_ingest_equals_batch_and_is_incremental(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet").select(*EV.fieldNames())
    src, out, ck = scratch_path(spark, "s-src"), scratch_path(spark, "s-out"), scratch_path(spark, "s-ck")
    write_json(ev.filter("event_type = 'click'"), f"{src}/part=1", files=2)
    append_stream(json_stream(spark, f"{src}/*", EV), out, ck)
    write_json(ev.filter("event_type <> 'click'"), f"{src}/part=2", files=2)
    append_stream(json_stream(spark, f"{src}/*", EV), out, ck)      # only the new files
    got = spark.read.parquet(out)
    assert got.count() == ev.count()
    assert rows(got.select(*EV.fieldNames())) == rows(ev)


def test_first_deliveries_keep_late_ones_and_survive_restarts(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet").select(*EV.fieldNames())
    src, out, ck = scratch_path(spark, "d-src"), scratch_path(spark, "d-out"), scratch_path(spark, "d-ck")
    days = F.dayofmonth("ts")
    for i, part in enumerate((ev.filter(days > 20), ev.filter(days <= 20), ev.filter("value > 20"))):
        write_json(part, f"{src}/drop={i}", files=3)        # the older days arrive later, then repeats
        stream = spark.readStream.schema(EV).option("maxFilesPerTrigger", 1).json(f"{src}/*")
        first_deliveries(spark, stream, out, ["event_id"], "ts", ck)
    assert rows(spark.read.parquet(out).select(*EV.fieldNames())) == rows(ev)


def test_rollup_stream_keeps_history_and_late_rows(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet").select(*EV.fieldNames())
    src, out, ck = scratch_path(spark, "r-src"), scratch_path(spark, "r-out"), scratch_path(spark, "r-ck")
    aggs = {"n": F.count("event_id"), "hi": F.max("value")}
    for i, part in enumerate((ev.filter("event_type = 'view'"), ev.filter("event_type = 'click'"),
                              ev.filter("event_type NOT IN ('view', 'click')"))):
        write_json(part, f"{src}/drop={i}", files=2)
        stream = spark.readStream.schema(EV).option("maxFilesPerTrigger", 1).json(f"{src}/*")
        rollup_stream(spark, stream, out, ["user_id"], "ts", "hour", aggs, ck)
    want = ev.groupBy("user_id", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("period_start")) \
             .agg(F.count("event_id").alias("n"), F.max("value").alias("hi"))
    assert rows(spark.read.parquet(f"{out}/windows"), "user_id", "period_start", "n", "hi") == rows(want)


def test_foreach_batch_scd2_equals_batch(spark):
    o = spark.read.parquet(f"{SF}/orders.parquet").select("o_custkey", "o_orderkey", "o_orderpriority",
                                                           "o_orderdate", "o_orderstatus")
    src, ck = scratch_path(spark, "f-src"), scratch_path(spark, "f-ck")
    for i, st in enumerate(["P", "F", "O"]):
        write_json(o.filter(F.col("o_orderstatus") == st), f"{src}/drop={i}", files=1)
    state = {}
    args = (["o_custkey"], "o_orderdate", ["o_orderkey", "o_orderpriority"])

    def fn(batch, batch_id):
        out = scd2_apply(state.get("t"), batch, *args, tiebreak=["o_orderkey"])
        p = scratch_path(spark, f"f-t{batch_id}")
        out.write.parquet(p)
        state["t"] = spark.read.parquet(p)

    stream = spark.readStream.schema(o.schema).option("maxFilesPerTrigger", 1).json(f"{src}/*")
    apply_stream(stream, fn, ck)
    want = scd2_apply(None, o, *args, tiebreak=["o_orderkey"])
    cols = ["o_custkey", "o_orderkey", "start_at", "end_at", "is_current"]
    assert rows(state["t"], *cols) == rows(want, *cols)


def test_schema_evolution_adds_columns_across_batches(spark, tmp_path):
    import json as _json
    from lakemart.sources.schema import evolve_stored_schema
    land = tmp_path / "land"
    land.mkdir()
    (land / "b1.json").write_text("\n".join(_json.dumps({"event_id": i, "value": 1.5}) for i in range(3)) + "\n")
    root = scratch_path(spark, "evo")
    base = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("value", T.DoubleType())])
    s1, a1 = evolve_stored_schema(spark, str(land), f"{root}/_schema", base)
    assert a1 == "none" and s1.fieldNames() == ["event_id", "value"]
    append_stream(json_stream(spark, str(land), s1), f"{root}/bronze", f"{root}/_ck")
    (land / "b2.json").write_text(_json.dumps({"event_id": 9, "value": 2.0, "firmware": "fw1.2"}) + "\n")
    s2, a2 = evolve_stored_schema(spark, str(land), f"{root}/_schema", base)
    assert a2 == "added column 'firmware'" and s2.fieldNames() == ["event_id", "value", "firmware"]
    # new query on the evolved schema (the stream restarts from its checkpoint)
    append_stream(json_stream(spark, str(land), s2), f"{root}/bronze", f"{root}/_ck")
    bronze = spark.read.option("mergeSchema", "true").parquet(f"{root}/bronze")
    got = {r.event_id: r.firmware for r in bronze.collect()}
    assert got == {0: None, 1: None, 2: None, 9: "fw1.2"}


def _drops(spark, name, schema, parts, run):
    src, ck = scratch_path(spark, f"{name}-src"), scratch_path(spark, f"{name}-ck")
    for i, part in enumerate(parts):
        write_json(spark.createDataFrame(part, schema), f"{src}/drop={i}", files=1)
        run(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(f"{src}/*"), ck)


def test_rollup_stream_counts_null_keys_and_times(spark):
    out = scratch_path(spark, "null-roll")
    part = [(1, "2024-01-01 10:05:00"), (None, "2024-01-01 10:06:00"), (1, None)]
    _drops(spark, "null-roll", "k int, ts string", [part, part + [(None, None)]], lambda s, ck: rollup_stream(
        spark, s.withColumn("ts", F.col("ts").cast("timestamp")), out, ["k"], "ts", "hour", {"n": F.count(F.lit(1))}, ck))
    got = {(r.k, str(r.period_start)): r.n for r in spark.read.parquet(f"{out}/windows").collect()}
    assert got == {(1, "2024-01-01 10:00:00"): 2, (None, "2024-01-01 10:00:00"): 2, (1, "None"): 2, (None, "None"): 1}


def test_first_deliveries_of_null_keys(spark):
    out = scratch_path(spark, "null-first")
    part = [(1, 5), (None, 3), (None, 2)]
    _drops(spark, "null-first", "k int, t int", [part, part], lambda s, ck: first_deliveries(spark, s, out, ["k"], "t", ck))
    assert rows(spark.read.parquet(out), "k", "t") == [(1, 5), (None, 2)]


def test_earliest_state_ignores_order_of_arrival(spark):
    from lakemart.streaming.state import earliest_state
    every = [(1, 5, "b"), (1, 3, "z"), (1, None, "a"), (None, 9, "x"), (None, 8, "y"), (2, None, "q"), (1, 3, "c")]
    want = [(1, 3, "c"), (2, None, "q"), (None, 8, "y")]
    for turn in range(3):
        parts = [every[turn::2], every[1 - turn % 2::2], every]
        out = scratch_path(spark, "earliest")
        _drops(spark, "earliest", "k int, t int, v string", parts,
               lambda s, ck: earliest_state(spark, s, out, ["k"], "t", ck))
        assert rows(spark.read.parquet(out), "k", "t", "v") == rows(spark.createDataFrame(want, "k int, t int, v string"))


def test_replayed_batch_counts_once(spark):
    """The merge of a micro-batch fails once after its state was computed."""
    from lakemart.streaming import state
    out, src, ck = (scratch_path(spark, n) for n in ("replay", "replay-src", "replay-ck"))
    calls = []
    real = state.merge_into

    def failing(*a, **k):
        calls.append(1)
        out = real(*a, **k)
        if len(calls) == 1:
            raise RuntimeError("stopped after the merge")
        return out

    def run():
        s = spark.readStream.schema("k int, v int").option("maxFilesPerTrigger", 1).json(f"{src}/*")
        state.keyed_state(spark, s, out, ["k"], {"n": F.count(F.lit(1)), "v": F.sum("v")}, ck)

    write_json(spark.createDataFrame([(1, 1), (None, 2)], "k int, v int"), f"{src}/a", files=1)
    run()
    write_json(spark.createDataFrame([(1, 10), (None, 20), (3, 30)], "k int, v int"), f"{src}/b", files=1)
    state.merge_into = failing
    try:
        run()
        raise AssertionError("should have stopped")
    except Exception as e:
        assert "stopped after the merge" in str(e)
    finally:
        state.merge_into = real
    run()
    assert rows(spark.read.parquet(out), "k", "n", "v") == [(1, 2, 11), (3, 1, 30), (None, 2, 22)]
