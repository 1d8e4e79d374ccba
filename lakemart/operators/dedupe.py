"""Deduplication, keep-first-per-key and reproducible sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _ordering(cols: Sequence[str], desc: bool, nulls_last: bool) -> list[Column]:
    out = []
    for c in cols:
        col = F.col(c)
        if desc:
            out.append(col.desc_nulls_last() if nulls_last else col.desc_nulls_first())
        else:
            out.append(col.asc_nulls_last() if nulls_last else col.asc_nulls_first())
    return out


def dedupe(df: DataFrame, keys: Sequence[str], order_col: str | Sequence[str],
           desc: bool = True, tiebreak: Sequence[str] = (), nulls_last: bool = True) -> DataFrame:
    """Keep one row per key: the latest (``desc=True``) or earliest by
    ``order_col``.

    ``tiebreak`` columns (same direction) make the choice deterministic when
    order values tie.  NULL order values rank last by default in both
    directions (a NULL timestamp never wins); ``nulls_last=False`` gives
    Spark's default placement for ascending order instead.

    Plan: ``row_number() = 1`` is planned with a partial ``WindowGroupLimit``
    before the exchange, so each map task ships at most one row per key --
    a hot key costs no more shuffle than a cold one.
    """
    order = [order_col] if isinstance(order_col, str) else list(order_col)
    w = Window.partitionBy(*keys).orderBy(*_ordering(order + list(tiebreak), desc, nulls_last))
    return (df.withColumn("_rn", F.row_number().over(w))
              .filter(F.col("_rn") == 1)
              .drop("_rn"))


def latest_per_key(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str]) -> DataFrame:
    """Latest state per key across all drops, ordered by several columns."""
    return dedupe(df, keys, list(order_cols), desc=True)


def distinct_rows(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Whole-row distinct (hash aggregate with map-side partial distinct)."""
    return (df.select(*cols) if cols else df).dropDuplicates()


def distinct_key(df: DataFrame, keys: Sequence[str], prefer: str, desc: bool = False) -> DataFrame:
    """One row per key; unlike ``dropDuplicates(keys)`` the kept row is
    deterministic: smallest (or largest) ``prefer``."""
    return dedupe(df, keys, prefer, desc=desc)


def sample_n(df: DataFrame, n: int, key: Sequence[str] | str, seed: int = 0) -> DataFrame:
    """Exactly ``n`` rows (or all if fewer), reproducible for a given seed.

    Orders by a hash of the key and takes the first ``n``: planned as a
    distributed top-k (``TakeOrderedAndProject``), no global sort.
    """
    keys = [key] if isinstance(key, str) else list(key)
    h = F.xxhash64(F.lit(seed), *[F.col(k) for k in keys])
    return df.orderBy(h, *[F.col(k) for k in keys]).limit(n)


def sample_n_md5(df: DataFrame, n: int, key: str) -> DataFrame:
    """Variant ordered by ``md5(cast(key as string))`` -- reproducible in any
    SQL engine with ``md5``."""
    return df.orderBy(F.md5(F.col(key).cast("string")), F.col(key)).limit(n)
