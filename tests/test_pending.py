"""Merges of a backlog grow with the table, not with the number of micro-batches."""

from functools import partial

import pytest
from pyspark.sql import functions as F

from lakemart.operators.scd import scd2_apply
from lakemart.plans import catalog_tables
from lakemart.session import scratch_path
from lakemart.sinks.tables import merge_into, table_exists, write_bucketed, write_json
from lakemart.streaming import ingest, state
from lakemart.streaming.ingest import merge_stream
from lakemart.streaming.pending import waiting
from tests.conftest import SF, rows


def _counted(monkeypatch, module):
    """Calls of ``module.merge_into``."""
    calls, real = [], module.merge_into

    def merge(*a, **k):
        calls.append(1)
        return real(*a, **k)

    monkeypatch.setattr(module, "merge_into", merge)
    return calls


def test_scd2_stream_merges_few_times(spark, monkeypatch):
    calls = _counted(monkeypatch, catalog_tables)
    monkeypatch.setattr(catalog_tables, "write_json", partial(write_json, files=6))     # 18 micro-batches
    got = catalog_tables.q_stream_scd2(spark, SF)
    want = scd2_apply(None, catalog_tables.order_changes(spark, SF), ["o_custkey"], "o_orderdate",
                      catalog_tables.ORDER_SCD_ATTRS, tiebreak=["o_orderkey"])
    assert rows(got, *want.columns) == rows(want)
    assert 1 <= len(calls) <= 6


def test_stopped_run_leaves_its_batches_to_the_next(spark):
    o = spark.read.parquet(f"{SF}/orders.parquet").select("o_custkey", "o_orderkey", "o_orderdate")
    src, path, ck = (scratch_path(spark, f"stop-{n}") for n in ("src", "out", "ck"))
    fail, args = [True], (["o_custkey"], "o_orderdate", ["o_orderkey"])

    def merge(changes):
        if not table_exists(spark, path):
            return write_bucketed(scd2_apply(None, changes, *args, tiebreak=["o_orderkey"]), path, ["o_custkey"])
        merge_into(spark, path, changes, ["o_custkey"],
                   how=lambda t, s, k: scd2_apply(t, s, *args, tiebreak=["o_orderkey"]))
        if fail.pop() if fail else False:
            raise RuntimeError("stopped after the merge")

    def run():
        merge_stream(spark, spark.readStream.schema(o.schema).option("maxFilesPerTrigger", 1).json(f"{src}/*"),
                     path, merge, ck)

    for i in range(3):
        write_json(o.filter(F.pmod("o_orderkey", F.lit(3)) == i), f"{src}/drop={i}", files=3)
    with pytest.raises(Exception, match="stopped after the merge"):
        run()
    assert waiting(spark, path) is not None
    run()
    assert waiting(spark, path) is None
    want = scd2_apply(None, o, *args, tiebreak=["o_orderkey"])
    assert rows(spark.read.parquet(path), *want.columns) == rows(want)


def _backlog(spark, name, ev, run):
    """Fifteen micro-batches of one file, then repeats with later times in a second run."""
    src, ck = scratch_path(spark, f"{name}-src"), scratch_path(spark, f"{name}-ck")
    again = ev.withColumn("ts", F.col("ts") + F.expr("INTERVAL 1 SECOND"))
    for i, drops in enumerate(([ev.filter("event_id % 3 = 0"), again.filter("event_id % 2 = 0"), ev.filter("event_id % 3 <> 0")],
                               [ev, again])):
        for j, part in enumerate(drops):
            write_json(part, f"{src}/drop={i}{j}", files=5)
        run(spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).json(f"{src}/*"), ck)


def _events(spark):
    return spark.read.parquet(f"{SF}/events.parquet").select(F.when(F.col("user_id") > 2, F.col("event_id")).alias("event_id"),
                                                             "ts", "value")


def test_keyed_state_merges_few_times(spark, monkeypatch):
    calls, out, ev = _counted(monkeypatch, state), scratch_path(spark, "few-state"), _events(spark)
    _backlog(spark, "few-state", ev, lambda s, ck: state.earliest_state(spark, s, out, ["event_id"], "ts", ck))
    want = ev.groupBy("event_id").agg(F.min(F.struct("ts", "value")).alias("r")).select("event_id", "r.*")
    assert rows(spark.read.parquet(out), *want.columns) == rows(want)
    assert 1 <= len(calls) <= 10                        # of 25 micro-batches in two runs


def test_first_deliveries_merge_few_times(spark, monkeypatch):
    calls, out, ev = _counted(monkeypatch, ingest), scratch_path(spark, "few-first"), _events(spark).dropna()
    _backlog(spark, "few-first", ev, lambda s, ck: ingest.first_deliveries(spark, s, out, ["event_id"], "ts", ck))
    late = F.col("event_id") % 6 > 0                    # these were repeated before their first row came, or had none before
    again = ev.filter("event_id % 2 = 0").filter(late).withColumn("ts", F.col("ts") + F.expr("INTERVAL 1 SECOND"))
    want = again.unionByName(ev.filter("event_id % 2 = 1 OR event_id % 6 = 0"))
    assert rows(spark.read.parquet(out), *want.columns) == rows(want)
    assert 1 <= len(calls) <= 10                        # of 25 micro-batches in two runs
