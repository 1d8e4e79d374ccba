"""Compaction by bytes: small files of a Parquet table are packed into files of
about a target size, optionally ordered along a space-filling curve."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakemart.functions.dates import order_number
from lakemart.sinks.tables import _fs

RANGES = 256                    # of each clustering column, equally full


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """``path``, ``folder`` and ``length`` of the Parquet files below ``path``:
    a listing, no file is opened."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true")
                  .load(path).select("path", "length"))
    return files.withColumn("folder", F.regexp_extract("path", "^(.*)/[^/]*$", 1))


def bins(files: DataFrame, target_bytes: int, small: float = 0.5) -> DataFrame:
    """``path`` and ``bin`` (within its folder) of the files to rewrite: those
    below ``small`` times the target, packed in order of their names until a bin
    holds the target.  A file alone in its bin stays as it is."""
    order = Window.partitionBy("folder").orderBy("path").rowsBetween(Window.unboundedPreceding, -1)
    packed = (files.filter(F.col("length") < small * target_bytes)
                   .withColumn("bin", F.floor(F.coalesce(F.sum("length").over(order), F.lit(0)) / target_bytes)))
    return packed.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy("folder", "bin"))).filter("_n > 1").drop("_n")


def with_curve(df: DataFrame, like: DataFrame, columns: Sequence[str], out: str) -> DataFrame:
    """Add the position on a Z-order curve over equally full ranges of the
    columns of ``like`` (numbers, dates, timestamps); NULL counts as smallest."""
    def number(c: str) -> Column:
        return order_number(c, like.schema[c].dataType)

    cuts = like.select(*[F.percentile_approx(number(c), [i / RANGES for i in range(1, RANGES)], 8 * RANGES).alias(f"_c{i}")
                         for i, c in enumerate(columns)]).first()
    z = F.lit(0).cast("long")
    for i, c in enumerate(columns):
        bounds, num = sorted(set(cuts[i] or [])), number(c)
        low = F.lit(0)                                  # number of bounds at or below the value, by halving
        for bit in reversed(range(len(bounds).bit_length())):
            here = F.get(F.array(*[F.lit(x) for x in bounds]), low + (1 << bit) - 1)
            df = df.withColumn(f"_at{i}", F.when(here <= num, low + (1 << bit)).otherwise(low))
            low = F.col(f"_at{i}")
        for b in range(RANGES.bit_length() - 1):
            z = z.bitwiseOR(F.shiftleft(F.shiftright(low.cast("long"), b).bitwiseAND(F.lit(1).cast("long")), b * len(columns) + i))
    return df.withColumn(out, z).drop(*[f"_at{i}" for i in range(len(columns))])


def pack(spark: SparkSession, path: str, target_bytes: int = 512 << 20, small: float = 0.5,
         cluster_by: Sequence[str] = ()) -> int:
    """Rewrite the small files of the table at ``path`` in place, each bin as
    one file (with ``cluster_by`` ordered along the curve); larger files are not
    touched.  Returns the number of files replaced.

    The new files are written completely beside the table, then moved in, then
    the old ones deleted: :func:`finish_packing` goes on where a job stopped, and
    nothing is ever missing (a reader in between may see rows twice).  Partition
    folders keep their rows.
    """
    finish_packing(spark, path)
    chosen = bins(list_files(spark, path), target_bytes, small)
    root = path.rstrip("/")
    work = f"{root}.pack"
    chosen.write.mode("overwrite").parquet(f"{work}/old")
    old = spark.read.parquet(f"{work}/old")
    count = old.count()
    if count:
        df = spark.read.option("recursiveFileLookup", "true").parquet(path)     # partition values stay in the folders' names
        # paths as the reader shows them; listed ones are decoded already
        rows = df.withColumn("_file", F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))))
        key = old.select(F.regexp_replace("path", "^file:/+", "file:///").alias("_file"), F.col("folder").alias("_folder"),
                         F.col("bin").cast("long").alias("_bin"))
        rows = rows.withColumn("_file", F.regexp_replace("_file", "^file:/+", "file:///")).join(key, "_file").drop("_file")
        names = old.select("folder", "bin").distinct().withColumn("_to", F.row_number().over(Window.orderBy("folder", "bin")))
        rows = rows.join(names.select(F.col("folder").alias("_folder"), F.col("bin").cast("long").alias("_bin"), "_to"), ["_folder", "_bin"])
        rows = rows.repartition("_to")
        if cluster_by:
            rows = with_curve(rows, df, cluster_by, "_z").sortWithinPartitions("_to", "_z").drop("_z")
        rows.drop("_folder", "_bin").write.partitionBy("_to").mode("overwrite").parquet(f"{work}/rows")
        names.write.mode("overwrite").parquet(f"{work}/names")                  # complete now
    finish_packing(spark, path)
    return count


def finish_packing(spark: SparkSession, path: str) -> None:
    """Move complete new files in and delete the old ones; again after a stop."""
    fs, make = _fs(spark, path)
    work = f"{path.rstrip('/')}.pack"
    if fs.exists(make(f"{work}/names/_SUCCESS")):
        # one name per new file, table bytes / target_bytes at most
        for r in spark.read.parquet(f"{work}/names").select("folder", "_to").toLocalIterator():
            for f in fs.globStatus(make(f"{work}/rows/_to={r['_to']}/*.parquet")) or []:
                to = make(f"{r['folder']}/packed-{r['_to']}-{f.getPath().getName()}")
                if not fs.rename(f.getPath(), to):
                    raise OSError(f"cannot move {f.getPath()} to {to}")
        for r in spark.read.parquet(f"{work}/old").select("path").toLocalIterator():
            fs.delete(make(r["path"]), False)
    fs.delete(make(work), True)
