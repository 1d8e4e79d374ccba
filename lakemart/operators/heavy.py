"""Keys with many rows, without counting every key.

A frequent-items sketch (a mergeable space-saving summary, one row per task)
names the keys that can have the wanted number of rows; only their rows are then
counted exactly.  No shuffle has a row per key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MOST_ITEMS = 1 << 16            # entries of a sketch; when more are needed, all keys are counted


def heavy_keys(df: DataFrame, keys: Sequence[str], min_rows: int, rows: int | None = None,
               most_items: int = MOST_ITEMS) -> DataFrame:
    """Exactly the keys with at least ``min_rows`` rows: key columns and ``n``.
    NULL is a key like any other.  ``rows``: the number of rows of ``df``, if known.

    A sketch of ``m`` entries over ``N`` hashed keys errs by at most ``3.5 N / m``
    and returns every key whose lower bound is above that error, so with
    ``m >= 8 N / min_rows`` it misses no key with ``min_rows`` rows.  Keys that
    share a hash are told apart by the exact count.
    """
    spark, keys, min_rows = df.sparkSession, list(keys), max(1, int(min_rows))
    narrow = df.select(*keys)
    n = narrow.count() if rows is None else rows
    counted = narrow.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_rows)
    if n < min_rows:
        return spark.createDataFrame([], counted.schema)
    items = 8
    while items < 8 * n / min_rows:
        items *= 2
    if items > most_items:
        return counted
    hashed = F.xxhash64(*[F.col(k) for k in keys])
    found = narrow.select(hashed.alias("h")).agg(F.expr(f"approx_top_k(h, {items // 2}, {items})").alias("top")).first()["top"]
    # min_rows / 2 rows at least each, so twice n / min_rows entries at most
    candidates = [r["item"] for r in found if r["count"] >= min_rows]
    if not candidates:
        return spark.createDataFrame([], counted.schema)
    known = F.broadcast(spark.createDataFrame([(h,) for h in candidates], "_h long"))
    mine = narrow.withColumn("_h", hashed).join(known, "_h", "left_semi").drop("_h")
    return mine.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_rows)
