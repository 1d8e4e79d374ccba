"""Structured Streaming: incremental file ingest, foreachBatch merges and
streaming deduplication.  All queries run with ``availableNow`` -- process
everything new since the checkpoint, then stop."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import partial

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.operators.dedupe import dedupe
from lakemart.operators.merge import insert_missing
from lakemart.sinks.tables import merge_into, table_exists, write_bucketed
from lakemart.sources.files import CORRUPT_COL, RESCUED_COL, parse_json_rescued
from lakemart.sources.schema import evolve_schema, field_paths, load_schema, store_schema
from lakemart.sources.variant import infer_lines
from lakemart.streaming.pending import BATCH, settle, take
from lakemart.streaming.state import rollup_state


# A landing backlog is read in micro-batches of at most this many files
# (``availableNow`` honours it), so one run never plans one giant batch.
MAX_FILES_PER_TRIGGER = 1000


def json_stream(spark: SparkSession, src: str, schema: T.StructType,
                rescue: bool = True, max_files_per_trigger: int | None = MAX_FILES_PER_TRIGGER,
                ingest_date_col: str | None = None) -> DataFrame:
    """New JSON-lines files under ``src`` as a stream.

    The file source's log in the checkpoint remembers which files were
    read, so each file is ingested once.  With ``rescue`` lines are read as
    text and parsed with :func:`parse_json_rescued` (typed columns, rescued
    extras, corrupt lines kept); without it Spark's JSON reader applies the
    schema directly.
    """
    r = spark.readStream
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    if rescue:
        lines = r.text(src).filter(F.trim(F.col("value")) != "")
        lines = lines.withColumn("_source_file", F.col("_metadata.file_path"))
        out = parse_json_rescued(lines, schema)
    else:
        out = r.schema(schema).json(src).withColumn("_source_file", F.col("_metadata.file_path"))
    out = out.withColumn("_ingested_at", F.current_timestamp())
    if ingest_date_col:
        # partition column for the bronze table: windowed reads prune by it
        out = out.withColumn(ingest_date_col, F.to_date(F.col("_ingested_at")))
    return out


def append_stream(df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet",
                  partition_by: Sequence[str] = ()) -> None:
    """Exactly-once append of a stream to a file table, run to completion."""
    w = (df.writeStream.format(fmt).outputMode("append")
           .option("checkpointLocation", checkpoint)
           .trigger(availableNow=True))
    if partition_by:
        w = w.partitionBy(*partition_by)
    q = w.start(path)
    q.awaitTermination()


def apply_stream(df: DataFrame, fn: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Run ``fn(batch_df, batch_id)`` per micro-batch (merges, SCD apply).

    ``fn`` must be idempotent for a given batch id -- the SCD operators
    are, because they rebuild from the set of changes."""
    q = (df.writeStream.foreachBatch(fn)
           .option("checkpointLocation", checkpoint)
           .trigger(availableNow=True).start())
    q.awaitTermination()


def merge_stream(spark: SparkSession, df: DataFrame, path: str, merge: Callable[[DataFrame], None], checkpoint: str,
                 prepare: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """Merge a stream into the bucketed table ``path``, run to completion.

    Every micro-batch (after ``prepare``) waits beside the table, and ``merge(rows)``
    is called with all waiting ones as they grow and when the run ends
    (:mod:`lakemart.streaming.pending`).  ``rows`` has the column ``BATCH``, the
    micro-batch that brought a row; a merge of rows merged before must change nothing.
    """
    settle(spark, path, merge)                          # what a stopped run has left
    apply_stream(df, lambda batch, batch_id: take(spark, path, prepare(batch) if prepare else batch, batch_id, merge),
                 checkpoint)
    settle(spark, path, merge)


class SchemaGrown(Exception):
    """A micro-batch brought fields that the schema of the running query lacks."""


def ingest_on_arrival(spark: SparkSession, src: str, path: str, schema_path: str, base: T.StructType, checkpoint: str,
                      ingest_date_col: str | None = None, grow: bool = True,
                      max_files_per_trigger: int | None = MAX_FILES_PER_TRIGGER) -> list[str]:
    """New JSON-lines files under ``src`` appended to ``path`` with a schema
    that grows on arrival, run to completion; returns the drift actions.

    Every micro-batch infers the schema of its own lines - one aggregate over
    VARIANT values, no file is opened that an earlier batch has read.  Fields
    that the stored schema (``base`` before anything is stored) lacks, below
    structs and arrays too, are added and stored; the query then stops and
    starts again with the grown schema, and its checkpoint hands it the same
    micro-batch.  Known fields keep their types, values that do not fit are
    rescued; without ``grow`` unknown fields are, too.  A micro-batch is the folder ``batch=<id>``; a replay writes the
    same folder again.  Read ``path`` with :func:`read_arrived`.
    """
    actions: list[str] = []
    while True:
        stored = load_schema(spark, schema_path)
        schema, grown = stored or base, []

        def apply(batch: DataFrame, batch_id: int) -> None:
            batch = batch.persist()
            try:
                wide = evolve_schema(schema, infer_lines(batch), nested=True) if grow else schema
                known = set(field_paths(schema))
                new = [p for p in field_paths(wide) if p not in known]
                if grow and (new or stored is None):
                    store_schema(spark, wide, schema_path)
                if new:
                    grown.append("added column " + ", ".join(f"'{p}'" for p in new))
                    raise SchemaGrown(grown[-1])
                out = parse_json_rescued(batch, schema).withColumn("_ingested_at", F.current_timestamp())
                if ingest_date_col:
                    out = out.withColumn(ingest_date_col, F.to_date("_ingested_at"))
                w = out.write.mode("overwrite")
                (w.partitionBy(ingest_date_col) if ingest_date_col else w).parquet(f"{path.rstrip('/')}/batch={batch_id}")
            finally:
                batch.unpersist()

        lines = spark.readStream
        if max_files_per_trigger:
            lines = lines.option("maxFilesPerTrigger", max_files_per_trigger)
        lines = lines.text(src).filter(F.trim(F.col("value")) != "").withColumn("_source_file", F.col("_metadata.file_path"))
        try:
            apply_stream(lines, apply, checkpoint)
            return actions
        except StreamingQueryException:
            if not grown:
                raise
            actions += grown                            # each restart has added a field, so they end


def read_arrived(spark: SparkSession, path: str, schema_path: str, ingest_date_col: str | None = None) -> DataFrame:
    """The table written by :func:`ingest_on_arrival` with its stored schema;
    columns that older files lack are NULL.  No file footers are merged."""
    known = load_schema(spark, schema_path)
    extra = [T.StructField("_source_file", T.StringType()), T.StructField(RESCUED_COL, T.StringType()),
             T.StructField(CORRUPT_COL, T.StringType()), T.StructField("_ingested_at", T.TimestampType()),
             T.StructField("batch", T.LongType())]
    if ingest_date_col:
        extra.append(T.StructField(ingest_date_col, T.DateType()))
    return spark.read.schema(T.StructType(extra[:1] + known.fields + extra[1:])).parquet(path)


def stream_table(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                 max_files_per_trigger: int | None = MAX_FILES_PER_TRIGGER) -> DataFrame:
    """Stream the files of a table (new files only after the first run),
    in micro-batches of at most ``max_files_per_trigger`` files."""
    r = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def first_deliveries(spark: SparkSession, stream: DataFrame, path: str, keys: Sequence[str],
                     order: str, checkpoint: str, buckets: int | None = None) -> None:
    """Append a stream to a bucketed table, each key once, run to completion.

    Every micro-batch keeps the earliest row per key, and the keys the table
    does not have are inserted (insert-only merge), those of the earliest
    micro-batch if several wait.  So late first deliveries are kept, repeats across
    batches and runs are dropped, and a replayed batch adds nothing; NULL is a
    key like any other.  No watermark and no state but the table itself.
    """
    insert = partial(insert_missing, null_safe=True)

    def merge(rows: DataFrame) -> None:
        first = dedupe(rows, list(keys), BATCH, desc=False).drop(BATCH)
        if table_exists(spark, path):
            merge_into(spark, path, first, list(keys), buckets, how=insert)
        else:
            write_bucketed(first, path, list(keys), buckets)

    merge_stream(spark, stream, path, merge, checkpoint, lambda batch: dedupe(batch, list(keys), order, desc=False))


def rollup_stream(spark: SparkSession, stream: DataFrame, path: str, keys: Sequence[str], event_time: str,
                  unit: str, aggs: dict, checkpoint: str, buckets: int | None = None) -> None:
    """Tumbling-window rollup of a stream (the streaming form of the hourly
    rollup), run to completion; the result is the bucketed table
    ``path/windows`` with one row per (keys, ``period_start``), NULL keys and
    times included.  Nothing is dropped for lateness; a micro-batch touches
    the state of its own windows (:mod:`lakemart.streaming.state`).
    """
    rollup_state(spark, stream, f"{path.rstrip('/')}/windows", keys, event_time, unit, aggs, checkpoint, buckets)
