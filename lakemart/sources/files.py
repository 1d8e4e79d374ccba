"""Batch sources: windowed incremental reads, JSON with rescued data,
lineage columns, literal lookup tables and empty typed frames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.operators.dedupe import dedupe
from lakemart.sources.variant import unfit

CORRUPT_COL = "_corrupt_record"
RESCUED_COL = "_rescued_data"


def read_window(df: DataFrame, ts_col: str, start, end, dedupe_keys: Sequence[str] | None = None,
                order_col: str | None = None, desc: bool = True,
                tiebreak: Sequence[str] = (), partition_col: str | None = None) -> DataFrame:
    """Rows with ``start <= ts_col <= end`` (both inclusive; date bounds
    mean midnight), optionally reduced to the latest (``desc``) or earliest
    row per ``dedupe_keys``.

    The bounds are literals cast to the column's type, so the filter is
    pushed into the Parquet scan (row-group skipping on min/max stats).
    ``partition_col`` names a date partition column derived from ``ts_col``
    (e.g. the ingest date); the same window on it prunes whole partitions.
    """
    t = df.schema[ts_col].dataType
    out = df.filter(F.col(ts_col).between(F.lit(start).cast(t), F.lit(end).cast(t)))
    if partition_col:
        out = out.filter(F.col(partition_col).between(F.to_date(F.lit(start).cast(t)),
                                                      F.to_date(F.lit(end).cast(t))))
    if dedupe_keys:
        out = dedupe(out, dedupe_keys, order_col or ts_col, desc=desc, tiebreak=tiebreak)
    return out


def with_lineage(df: DataFrame, file_col: str = "_source_file", base_name: bool = False,
                 ingested_col: str | None = "_ingested_at") -> DataFrame:
    """Add the source file of each row (hidden ``_metadata`` column of file
    sources) and the ingestion time."""
    path = F.col("_metadata.file_path")
    if base_name:
        path = F.regexp_extract(path, r"([^/]+)$", 1)
    out = df.withColumn(file_col, path)
    if ingested_col:
        out = out.withColumn(ingested_col, F.current_timestamp())
    return out


def lookup_table(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType) -> DataFrame:
    """Small literal table with an explicit schema (no inference)."""
    return spark.createDataFrame(list(rows), schema)


def empty_like(df: DataFrame, extra: T.StructType | None = None,
               drop: Sequence[str] = ()) -> DataFrame:
    """Zero-row frame with ``df``'s schema minus ``drop`` plus ``extra``
    typed columns (for creating a target before the first load)."""
    fields = [f for f in df.schema.fields if f.name not in set(drop)]
    if extra:
        names = {f.name for f in extra.fields}
        fields = [f for f in fields if f.name not in names] + list(extra.fields)
    return df.sparkSession.createDataFrame([], T.StructType(fields))


def parse_json_rescued(lines: DataFrame, schema: T.StructType, value_col: str = "value",
                       rescued_col: str = RESCUED_COL, corrupt_col: str = CORRUPT_COL,
                       keep_value: bool = False) -> DataFrame:
    """Parse JSON lines against ``schema`` without losing anything.

    * fields of ``schema`` come out typed; a value of the wrong type is
      NULL there;
    * ``rescued_col``: JSON object of every key not in the schema plus every
      schema key whose value did not fit its type (NULL when nothing was
      rescued); below structs, arrays and maps the key is the path, such as
      ``a.b[2].c``;
    * ``corrupt_col``: the whole line when it is not a JSON object at all.

    One pass, all JVM expressions: a typed ``from_json`` and an untyped
    ``from_json`` to ``map<string,string>`` of the same line; for a schema with
    nested fields also a VARIANT that is walked along the schema.  A line
    without a VARIANT form (repeated keys) is compared at its top level.
    """
    raw = F.col(value_col)
    typed = F.from_json(raw, schema, {"mode": "PERMISSIVE"})
    as_map = F.from_json(raw, T.MapType(T.StringType(), T.StringType()), {"mode": "PERMISSIVE"})
    known = F.array(*[F.lit(f.name) for f in schema.fields]).cast("array<string>")
    parsed = lines.select("*", typed.alias("_typed"), as_map.alias("_map"))
    # a schema key whose raw value exists but whose typed value is NULL did
    # not fit its type; it goes to the rescue column as well
    misfit = {f.name: F.col(f"_typed.`{f.name}`").isNull() for f in schema.fields}
    def keep(k, v):
        bad = F.lit(False)
        for name, cond in misfit.items():
            bad = bad | ((k == F.lit(name)) & cond)
        return (~F.array_contains(known, k)) | (v.isNotNull() & bad)
    rescued = F.map_filter(F.col("_map"), keep)
    if any(isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType)) for f in schema.fields):
        parsed = parsed.withColumn("_variant", F.try_parse_json(raw))
        walked = F.map_from_entries(unfit(F.col("_variant"), F.col("_typed"), schema))
        rescued = F.when(F.col("_variant").isNull(), rescued).otherwise(walked)
    parsed = parsed.withColumn("_rescued", rescued)
    base = [c for c in lines.columns if keep_value or c != value_col]
    return parsed.select(*[F.col(f"`{c}`") for c in base], *[F.col(f"_typed.`{f.name}`").alias(f.name) for f in schema.fields],
                         F.when(F.size("_rescued") > 0, F.to_json("_rescued")).alias(rescued_col),
                         F.when(F.col("_map").isNull() & raw.isNotNull(), raw).alias(corrupt_col))


def rescued_keys(col: str = RESCUED_COL) -> Column:
    """Sorted, comma-joined key list of a rescued-data JSON column."""
    m = F.from_json(F.col(col), T.MapType(T.StringType(), T.StringType()))
    return F.array_join(F.array_sort(F.map_keys(m)), ",")


def quarantine_split(df: DataFrame, corrupt_col: str = CORRUPT_COL) -> tuple[DataFrame, DataFrame]:
    """``(good, bad)`` by the corrupt-record column."""
    return df.filter(F.col(corrupt_col).isNull()), df.filter(F.col(corrupt_col).isNotNull())


def read_json_lines(spark: SparkSession, path: str) -> DataFrame:
    """Raw JSON lines as a ``value`` string column (blank lines skipped),
    with the source file name -- the input of :func:`parse_json_rescued`."""
    return (spark.read.text(path)
                 .filter(F.trim(F.col("value")) != "")
                 .withColumn("_source_file", F.col("_metadata.file_path")))


def read_change_feed(spark: SparkSession, path: str, starting_version: int = 0,
                     ending_version: int | None = None, stream: bool = False,
                     version_col: str = "_commit_version") -> DataFrame:
    """Rows of a change log (as written by
    :func:`lakemart.operators.cdc.snapshot_diff`) from ``starting_version``
    on.  Batch: the version range is a filter pushed into the Parquet scan.
    Stream: new change files as they arrive (use with ``availableNow``)."""
    if stream:
        schema = spark.read.parquet(path).schema
        df = spark.readStream.schema(schema).parquet(path)
    else:
        df = spark.read.parquet(path)
    cond = F.col(version_col) >= F.lit(starting_version)
    if ending_version is not None:
        cond = cond & (F.col(version_col) <= F.lit(ending_version))
    return df.filter(cond)
