"""Table sinks over Parquet paths: replace, append, bucketed merge,
JSON export, compaction and statistics.

Spark stages and commits every write.  What replaces rows of an existing table
is first written completely beside the table (``<table>.next``) and then written
over it: the whole table, or in a merge the touched buckets, by Spark's dynamic
partition overwrite.  If a job stops before the copy is complete, the table is as
it was; if it stops later, the copy is written over the table again by whatever
touches the table next (:func:`finish`: every write here, and
:func:`table_exists`).  A stopped merge can simply be run again.

A merge target is stored partitioned by a hash bucket of its key
(``_bucket = <b>of<n>``, ``b = pmod(xxhash64(keys), n)``); ``n`` follows the
table's size and is read back from any row.  A merge materialises the source
batch once and reads only the buckets it touches (partition pruning); a touched
bucket that ends up without rows is removed.  A bucket may have many files: rows
are rebalanced by bucket, and AQE splits large ones.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.operators.joins import plan_bytes
from lakemart.operators.merge import assert_unique_keys, upsert
from lakemart.session import cut_lineage

BUCKET_COL = "_bucket"
BUCKET_BYTES = 1 << 30          # of Spark's size estimate, per merge bucket
MIN_BUCKETS, MAX_BUCKETS = 16, 65_536
_WHAT = "by array<string>, touched array<string>, kind string"


def _fs(spark: SparkSession, path: str):
    """Hadoop file system and path maker for ``path``."""
    jvm = spark.sparkContext._jvm
    make = jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), make


def _rows(spark: SparkSession, path: str) -> DataFrame | None:
    """The Parquet table at ``path``, None without any file."""
    try:
        return spark.read.parquet(path)
    except AnalysisException:
        return None


def _next(path: str) -> str:
    return f"{path.rstrip('/')}.next"


def finish(spark: SparkSession, path: str) -> None:
    """Write over the table what a complete copy beside it holds; nothing to
    do unless an earlier write has stopped.  The description of the copy is
    written last: (partition columns, buckets to replace or null for all,
    schema)."""
    fs, make = _fs(spark, path)
    copy = _next(path)
    if not fs.exists(make(f"{copy}/what/_SUCCESS")):
        return
    what = spark.read.schema(_WHAT).json(f"{copy}/what").first()
    kinds = "spark.sql.sources.partitionColumnTypeInference.enabled"
    before = spark.conf.get(kinds)
    spark.conf.set(kinds, "false")                      # partition values are written as they are
    try:
        rows = _rows(spark, f"{copy}/rows")
    finally:
        spark.conf.set(kinds, before)
    if what.touched is None:
        _overwrite(rows, path, what.by)
    else:
        left = set()
        if rows is not None:
            rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*what.by).parquet(path)
            left = {r[0] for r in rows.select(BUCKET_COL).distinct().collect()}     # one value per bucket at most
        for b in set(what.touched) - left:
            fs.delete(make(f"{path.rstrip('/')}/{BUCKET_COL}={b}"), True)
        if _rows(spark, path) is None:
            _empty_file(spark, T.StructType.fromJson(json.loads(what.kind)), path)
    fs.delete(make(copy), True)


def _overwrite(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    w = df.write.mode("overwrite")
    (w.partitionBy(*partition_by) if partition_by else w).parquet(path)


def _write_next(df: DataFrame, path: str, by: Sequence[str], touched: Sequence[str] | None) -> None:
    """The complete copy beside ``path``: rows, then what they are."""
    spark, copy = df.sparkSession, _next(path)
    fs, make = _fs(spark, path)
    fs.delete(make(copy), True)                         # the rest of a write that never became complete
    _overwrite(df, f"{copy}/rows", by)
    spark.createDataFrame([(list(by), touched, df.schema.json())], _WHAT).coalesce(1).write.json(f"{copy}/what")


def table_exists(spark: SparkSession, path: str) -> bool:
    """Is there a readable Parquet table at ``path``?"""
    finish(spark, path)
    return _rows(spark, path) is not None


def publish(df: DataFrame, path: str, mode: str = "replace",
            partition_by: Sequence[str] = (), sort_within: Sequence[str] = ()) -> None:
    """Write ``df`` as Parquet: ``replace`` (create, or replace through a
    complete copy; ``df`` may read the table it replaces) or ``append``.

    ``sort_within`` clusters rows inside each file so min/max statistics
    skip row groups for filters on those columns.
    """
    if mode not in ("replace", "append"):
        raise ValueError("mode must be 'replace' or 'append'")
    if sort_within:
        df = df.sortWithinPartitions(*sort_within)
    spark = df.sparkSession
    known = table_exists(spark, path)
    if mode == "append":
        w = df.write.mode("append")
        (w.partitionBy(*partition_by) if partition_by else w).parquet(path)
    elif known:
        _write_next(df, path, partition_by, None)
        finish(spark, path)
    else:
        _overwrite(df, path, partition_by)


def bucket_expr(keys: Sequence[str], buckets: int):
    b = F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets)).cast("string")
    return F.concat(b, F.lit(f"of{buckets}"))


def buckets_for(df: DataFrame) -> int:
    """Number of merge buckets for a table of ``df``'s estimated size."""
    size = plan_bytes(df) or 0
    return int(min(MAX_BUCKETS, max(MIN_BUCKETS, -(-size // BUCKET_BYTES))))


def stored_buckets(spark: SparkSession, path: str) -> int | None:
    """The number of buckets a merge target was written with; None while it
    has no rows, when any number will do."""
    row = spark.read.parquet(path).select(BUCKET_COL).first()
    return int(row[0].split("of")[1]) if row else None


def _by_bucket(df: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    return df.withColumn(BUCKET_COL, bucket_expr(keys, buckets)).hint("rebalance", F.col(BUCKET_COL))


def write_bucketed(df: DataFrame, path: str, keys: Sequence[str], buckets: int | None = None,
                   sort_within: Sequence[str] = ()) -> None:
    """Initial (replacing) load of a merge target, hash-bucketed on ``keys``."""
    out = _by_bucket(df, keys, buckets or buckets_for(df))
    publish(out, path, partition_by=[BUCKET_COL], sort_within=sort_within)
    if _rows(df.sparkSession, path) is None:
        _empty_file(df.sparkSession, df.schema, path)


def _empty_file(spark: SparkSession, kind: T.StructType, path: str) -> None:
    """A file without rows, so that a table without rows keeps its schema."""
    fields = [f for f in kind.fields if f.name != BUCKET_COL]
    spark.createDataFrame([], T.StructType(fields)).coalesce(1) \
        .write.mode("overwrite").parquet(f"{path.rstrip('/')}/{BUCKET_COL}=0of1")


def _is_upsert(how: Callable) -> bool:
    return upsert in (how, getattr(how, "func", None))


def merge_into(spark: SparkSession, path: str, source: DataFrame, keys: Sequence[str],
               buckets: int | None = None,
               how: Callable[[DataFrame, DataFrame, Sequence[str]], DataFrame] = upsert,
               check_unique: bool | None = None) -> int:
    """Apply ``how(target, source, keys)`` (upsert, delete_matching, SCD
    apply, ...) to a bucketed target; returns the number of buckets written.

    Several source rows for one key stop an upsert with
    :class:`~lakemart.operators.merge.DuplicateSourceKeys`; operators that
    take several changes per key (SCD) are not checked unless
    ``check_unique`` says so.
    """
    finish(spark, path)
    n = stored_buckets(spark, path) or buckets or buckets_for(source)
    # the batch is computed once: the check, bucket ids and the merge read the copy
    src = cut_lineage(source.withColumn(BUCKET_COL, bucket_expr(keys, n)), "merge-src")
    if check_unique or (check_unique is None and _is_upsert(how)):
        assert_unique_keys(src, keys)
    # at most `n` short names reach the driver
    touched = [r[0] for r in src.select(BUCKET_COL).distinct().collect()]
    if not touched:
        return 0
    target = spark.read.parquet(path).filter(F.col(BUCKET_COL).isin(touched)).drop(BUCKET_COL)
    _write_next(_by_bucket(how(target, src.drop(BUCKET_COL), keys), keys, n), path, [BUCKET_COL], touched)
    finish(spark, path)
    return len(touched)


def load(spark: SparkSession, df: DataFrame, path: str, keys: Sequence[str], buckets: int | None,
         initial: bool,
         how: Callable[[DataFrame, DataFrame, Sequence[str]], DataFrame] = upsert) -> None:
    """Bootstrap-vs-incremental switch: first run replaces, later runs merge
    with ``how`` (default: upsert).  ``df`` must hold the whole table on the
    first run."""
    if initial:
        src = cut_lineage(df, "load-src")
        if _is_upsert(how):
            assert_unique_keys(src, keys)
        write_bucketed(src, path, keys, buckets)
    else:
        merge_into(spark, path, df, keys, buckets, how=how)


# Microsecond timestamps in JSON (the writer's default keeps milliseconds).
JSON_TS_OPTIONS = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
                   "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def write_json(df: DataFrame, path: str, files: int | None = None, mode: str = "overwrite") -> None:
    """JSON-lines export with control over the number of files; timestamps
    keep full microsecond precision."""
    out = df.repartition(files) if files else df
    out.write.mode(mode).options(**JSON_TS_OPTIONS).json(path)


def save_bucketed_table(df: DataFrame, name: str, path: str, keys: Sequence[str], buckets: int,
                        sort: bool = True) -> DataFrame:
    """Write ``df`` as a catalog table bucketed (and sorted) by ``keys`` at
    ``path`` and return it read back.

    Two tables bucketed the same way on their join key are joined without
    a shuffle of either side (sort-merge join on co-located buckets) --
    e.g. a large fact and a large SCD2 dimension that are joined on every
    run.  The bucket count must match between the tables."""
    w = df.write.mode("overwrite").bucketBy(buckets, *keys).option("path", path)
    if sort:
        w = w.sortBy(*keys)
    w.saveAsTable(name)
    return df.sparkSession.table(name)


def compact(spark: SparkSession, src: str, dst: str, rows_per_file: int = 5_000_000,
            sort_within: Sequence[str] = (), fmt: str = "parquet") -> int:
    """Rewrite many small files as few larger ones at ``dst``.

    The file count follows the row count (a metadata-only count for
    Parquet).  Rows are only moved, never changed, so the row multiset is
    preserved.  Returns the number of output partitions.
    """
    df = spark.read.format(fmt).load(src)
    n = max(1, -(-df.count() // rows_per_file))
    out = df.repartition(n)
    publish(out, dst, "replace", sort_within=sort_within)
    return n


def compact_all(spark: SparkSession, tables: dict[str, str], rows_per_file: int = 5_000_000,
                fmt: str = "parquet") -> dict[str, int]:
    """Compact a list of tables: ``{src_path: dst_path}`` -> output file
    counts.  One Spark job per table (driver-side loop over table names,
    never over rows)."""
    return {src: compact(spark, src, dst, rows_per_file, fmt=fmt) for src, dst in tables.items()}


def analyze(spark: SparkSession, table: str, columns: Sequence[str] = ()) -> None:
    """``ANALYZE TABLE .. COMPUTE STATISTICS [FOR COLUMNS ..]`` on a catalog
    table (feeds the cost-based optimizer)."""
    cols = f" FOR COLUMNS {', '.join(columns)}" if columns else ""
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS{cols}")


def column_statistics(spark: SparkSession, table: str, columns: Sequence[str]) -> DataFrame:
    """The statistics that :func:`analyze` stored in the catalog, one row per
    column: ``column``, ``rows`` of the table, ``nulls``, ``least`` and ``most``
    (as text) and the estimate ``distinct_values``.  Catalog data only."""
    size = spark.sql(f"DESCRIBE EXTENDED {table}").filter("col_name = 'Statistics'").first()["data_type"]
    rows = int(size.split(",")[1].split()[0])

    def number(x: str) -> int | None:
        return None if x == "NULL" else int(x)

    out = []
    for c in columns:
        got = {r["info_name"]: r["info_value"] for r in spark.sql(f"DESCRIBE EXTENDED {table} {c}").collect()}
        least, most = (None if got[k] == "NULL" else got[k] for k in ("min", "max"))
        out.append((c, rows, number(got["num_nulls"]), least, most, number(got["distinct_count"])))
    return spark.createDataFrame(out, "column string, rows long, nulls long, least string, most string, distinct_values long")
