"""Weighted rendezvous sharding of stable record keys.

Each (key, shard) pair gets a hash ``u`` in (0, 1); the record goes to the
shard with the largest ``weight / -ln(u)``.  A shard's score depends only on
the key and that shard, so adding a shard moves records only into it, and
removing one moves only its own records.  Expected shares follow the weights.

Everything is a built-in expression over narrow columns; the text itself is
never shuffled.  Slots (positions in a shard) are numbered in two levels: a
window inside each (shard, input partition) and a running sum over one count
row per (shard, input partition), so a shard holding any share of the rows is
numbered by many tasks.

Defined results: a null key is one key like any other (all its rows share a
shard); a null text has size 1 and the checksum of no bytes; repeated rows
each get their own slot; an empty table gives no rows; further columns of
the input are ignored by :func:`assign`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemart.session import cut_lineage

_BITS = 53                      # a double's mantissa


def shard_of(keys: Sequence[str], weights: Sequence[float]) -> Column:
    """Shard number (int) of the key columns under weighted rendezvous
    hashing; equal scores go to the smaller number."""
    if not weights or any(w < 0 for w in weights) or not any(weights):
        raise ValueError("weights must be non-negative and not all zero")
    scores = []
    for s, w in enumerate(weights):
        if w == 0:
            continue
        h = F.xxhash64(*[F.col(k) for k in keys], F.lit(s))
        u = (F.shiftrightunsigned(h, 64 - _BITS).cast("double") + F.lit(0.5)) / F.lit(float(2 ** _BITS))
        scores.append(F.struct((F.lit(float(w)) / -F.log(u)).alias("score"), F.lit(-s).alias("neg")))
    return (-F.array_max(F.array(*scores))["neg"]).cast("int")


def number_slots(df: DataFrame, shard: str, slot: str = "slot") -> DataFrame:
    """Add gapless positions (from 0) inside each shard, in storage order.

    The input is written once with its physical row number, so the numbering
    stays the same when lost partitions are computed again.
    """
    rows = cut_lineage(df.select(F.struct(*[F.col(c) for c in df.columns]).alias("r"),
                                 F.col(shard).alias("shard"),
                                 F.monotonically_increasing_id().alias("rid")), "slots")
    rows = rows.withColumn("part", F.shiftright("rid", 33))
    counts = rows.groupBy("shard", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("shard", "part").orderBy("rid")
    return (rows.withColumn("k", F.row_number().over(inside))
                .join(starts, ["shard", "part"])
                .select("r.*", (F.col("start") + F.col("k") - 1).cast("long").alias(slot)))


def assign(df: DataFrame, key: str, text: str, weights: Sequence[float],
           grown_weights: Sequence[float] | None = None) -> DataFrame:
    """One row per record: key, ``size`` (UTF-8 bytes plus 1), ``text_crc32``,
    ``law`` = 'key', ``shard``, ``slot`` and the shard under ``grown_weights``
    (``grown_shard``, null when not given)."""
    body = F.coalesce(F.col(text), F.lit(""))
    grown = shard_of([key], grown_weights) if grown_weights else F.lit(None).cast("int")
    placed = df.select(F.col(key).alias(key),
                       (F.octet_length(body) + 1).cast("long").alias("size"),
                       F.crc32(F.encode(body, "UTF-8")).alias("text_crc32"),
                       F.lit("key").alias("law"),
                       shard_of([key], weights).alias("shard"),
                       grown.alias("grown_shard"))
    return number_slots(placed, "shard")


def write_shards(df: DataFrame, path: str, key: str, weights: Sequence[float]) -> None:
    """Write the records below ``path/shard=<n>/``.  Tasks write the shards of
    their own input, so no record is moved between executors."""
    (df.withColumn("shard", shard_of([key], weights))
       .write.mode("overwrite").partitionBy("shard").parquet(path))
