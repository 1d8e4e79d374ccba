"""Streams with keyed state.

Spark's streaming aggregation keeps one row of state per key in RocksDB (local
files with changes in the checkpoint, so state may exceed memory and survives
lost executors).  A micro-batch is pre-aggregated map-side, touches the state of
its keys only, and hands over the new rows of those keys, which wait beside a
bucketed table and are merged into it as they grow and when the run ends
(:mod:`lakemart.streaming.pending`).  No history is read again.  A replayed micro-batch starts from the
state before it and gives the same rows, so nothing is lost or counted twice; NULL
is a key like any other, and late rows simply update their key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.functions.dates import truncate
from lakemart.operators.dedupe import dedupe
from lakemart.operators.merge import upsert
from lakemart.sinks.tables import merge_into, table_exists, write_bucketed
from lakemart.streaming.pending import BATCH, settle, take

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
CHANGELOG = "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"


def keyed_state(spark: SparkSession, stream: DataFrame, path: str, by: Sequence[str], aggs: Mapping[str, Column],
                checkpoint: str, buckets: int | None = None) -> None:
    """Keep the bucketed table ``path`` at one row per key ``by`` with ``aggs``
    over all rows the stream has ever brought, run to completion.

    Any aggregate with a mergeable state will do (counts, sums, extremes,
    ``min_by``, sketches).
    """
    merge = partial(upsert, null_safe=True)

    def fold(rows: DataFrame) -> None:
        latest = dedupe(rows, list(by), BATCH).drop(BATCH)      # a key's row of a later micro-batch replaces the others
        if table_exists(spark, path):
            merge_into(spark, path, latest, list(by), buckets, how=merge, check_unique=False)
        else:
            write_bucketed(latest, path, list(by), buckets)

    def apply(batch: DataFrame, batch_id: int) -> None:
        take(spark, path, batch, batch_id, fold)

    settle(spark, path, fold)                           # what a stopped run has left
    rows = stream.groupBy(*by).agg(*[v.alias(k) for k, v in aggs.items()])
    before = {k: spark.conf.get(k, None) for k in (STATE_STORE, CHANGELOG)}
    spark.conf.set(STATE_STORE, ROCKS_DB)
    spark.conf.set(CHANGELOG, "true")
    try:                                                # the query keeps the settings it starts with
        q = (rows.writeStream.outputMode("update").foreachBatch(apply).option("checkpointLocation", checkpoint)
                 .trigger(availableNow=True).start())
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    q.awaitTermination()
    settle(spark, path, fold)


def rollup_state(spark: SparkSession, stream: DataFrame, path: str, keys: Sequence[str], event_time: str, unit: str,
                 aggs: Mapping[str, Column], checkpoint: str, buckets: int | None = None) -> None:
    """Tumbling-window rollup: one row per (keys, ``period_start``) in ``path``.
    Rows without a time are a window of their own."""
    start = truncate(unit, event_time, stream.schema[event_time].dataType)
    keyed_state(spark, stream.withColumn("period_start", start), path, [*keys, "period_start"], aggs, checkpoint, buckets)


def earliest_state(spark: SparkSession, stream: DataFrame, path: str, keys: Sequence[str], order: str,
                   checkpoint: str, buckets: int | None = None) -> None:
    """Each key once with the earliest of all its rows by ``order`` (NULL
    last, ties to the smaller remaining columns), whatever the order of arrival."""
    rest = [c for c in stream.columns if c not in keys]
    first = [order, *[c for c in rest if c != order]] if order in rest else rest
    row = F.min(F.struct(F.col(order).isNull().alias("_late"), *[F.col(c) for c in first]))
    keyed_state(spark, stream, path, keys, {c: row[c] for c in rest}, checkpoint, buckets)
