"""Micro-batches that wait beside the table they are merged into.

A merge reads and writes whole buckets, so merging every micro-batch on its own
costs the table's size each time: the square of the input over a backlog.  Here a
micro-batch is written beside the table (``<table>.pending/_batch=<id>``), and all
that wait are merged at once when they have as many bytes as the table, and when
the run ends.  The table doubles between such merges, so all of them together cost
a small multiple of its size, however many micro-batches there are.

Until they are merged, readers see the table as of the last merge.  A run that
stops leaves its micro-batches there and the next run merges them first.  A replayed
micro-batch is written over its own folder; if it has been merged before, it is merged
again, which must change nothing - as with any foreachBatch sink.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from lakemart.operators.joins import plan_bytes
from lakemart.sinks.tables import table_exists

BATCH = "_batch"                # column of waiting rows: the micro-batch that brought them
Merge = Callable[[DataFrame], None]


def _folder(path: str) -> str:
    return f"{path.rstrip('/')}.pending"


def waiting(spark: SparkSession, path: str) -> DataFrame | None:
    """The rows that wait beside the table ``path``, with ``BATCH``; None without any."""
    try:
        return spark.read.parquet(_folder(path))
    except AnalysisException:
        return None


def take(spark: SparkSession, path: str, batch: DataFrame, batch_id: int, merge: Merge) -> None:
    """Let a micro-batch wait beside the table ``path``; merge all that wait if
    there is no table yet or they have grown to its size."""
    batch.write.mode("overwrite").parquet(f"{_folder(path)}/{BATCH}={batch_id}")
    if not table_exists(spark, path) or _bytes(waiting(spark, path)) >= _bytes(spark.read.parquet(path)):
        settle(spark, path, merge)


def settle(spark: SparkSession, path: str, merge: Merge) -> None:
    """Merge the rows that wait, if any, by ``merge``, which also makes the table
    if there is none."""
    rows = waiting(spark, path)
    if rows is None:
        return
    merge(rows)
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(_folder(path))
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def _bytes(df: DataFrame) -> int:
    return plan_bytes(df) or 0
