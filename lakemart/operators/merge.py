"""Merge operators over plain DataFrames (no row-level table format needed).

``MERGE`` semantics are rebuilt from joins: NULL keys never match (plain
``=``), unmatched target rows pass through untouched.  Each operator is
lazy; persisting the result is the job of :mod:`lakemart.sinks`.

The batch side (source keys) is broadcast when a bounded count proves it
small, so the target -- usually far larger -- is never shuffled for a
merge; past the bound both sides shuffle by key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.operators.joins import bounded_broadcast


class DuplicateSourceKeys(ValueError):
    """Several source rows match one target key (a merge must not guess)."""


def merge_condition(keys: Sequence[str], target: str = "t", source: str = "s") -> Column:
    """``t.k1 = s.k1 AND t.k2 = s.k2 ...`` (NULL never equals NULL)."""
    cond = F.lit(True)
    for k in keys:
        cond = cond & (F.col(f"{target}.{k}") == F.col(f"{source}.{k}"))
    return cond


def duplicate_keys(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once among non-NULL keys."""
    nonnull = source
    for k in keys:
        nonnull = nonnull.filter(F.col(k).isNotNull())
    return nonnull.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def assert_unique_keys(source: DataFrame, keys: Sequence[str]) -> None:
    """Raise when the source has repeated keys (a bounded ``take(1)``)."""
    if duplicate_keys(source, keys).take(1):
        raise DuplicateSourceKeys(f"source has repeated keys on {list(keys)}")


def without(rows: DataFrame, known: DataFrame, keys: Sequence[str], null_safe: bool = False) -> DataFrame:
    """Rows whose key is not among ``known`` ones (a frame of the key
    columns).  NULL keys match nothing, or with ``null_safe`` each other."""
    if not null_safe:
        return rows.join(known, list(keys), "left_anti")
    k = known.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(keys)])
    cond = F.lit(True)
    for i, c in enumerate(keys):
        cond = cond & rows[c].eqNullSafe(k[f"_k{i}"])
    return rows.join(k, cond, "left_anti")


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str],
           check_unique: bool = False, null_safe: bool = False) -> DataFrame:
    """Matched -> replaced by the source row; unmatched -> inserted.

    ``target ⟕anti source ∪ source``: the anti join only needs the source's
    key columns.  Columns missing on either side are NULL-filled.  NULL keys
    match nothing, as in a MERGE, unless ``null_safe``.
    """
    if check_unique:
        assert_unique_keys(source, keys)
    kept = without(target, bounded_broadcast(source.select(*keys)), keys, null_safe)
    return kept.unionByName(source, allowMissingColumns=True)


def delete_matching(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows whose key does not occur in the source."""
    return target.join(bounded_broadcast(source.select(*keys)), list(keys), "left_anti")


def delete_where(target: DataFrame, predicate: Column) -> DataFrame:
    """Delete by predicate (e.g. an id set via ``isin``); NULL keeps the row."""
    return target.filter(~F.coalesce(predicate, F.lit(False)))


def update_matching(target: DataFrame, source: DataFrame, keys: Sequence[str],
                    set_cols: Mapping[str, Column | str], when: Column | None = None,
                    source_cols: Sequence[str] | None = None) -> DataFrame:
    """Matched rows (and ``when`` true) get ``set_cols``; all target rows kept.

    ``set_cols`` values are expressions over ``t.*`` and ``s.*``, e.g.
    ``{"price": "s.price"}``.  The source must be unique per key.
    """
    s_cols = list(source_cols) if source_cols is not None else [c for c in source.columns]
    s = bounded_broadcast(source.select(*dict.fromkeys(list(keys) + s_cols))).alias("s")
    t = target.alias("t")
    j = t.join(s, merge_condition(keys), "left")
    matched = F.col(f"s.{keys[0]}").isNotNull()
    for k in keys[1:]:
        matched = matched & F.col(f"s.{k}").isNotNull()
    if when is not None:
        matched = matched & F.coalesce(when, F.lit(False))
    out = []
    for c in target.columns:
        if c in set_cols:
            v = set_cols[c]
            v = F.expr(v) if isinstance(v, str) else v
            out.append(F.when(matched, v).otherwise(F.col(f"t.{c}")).alias(c))
        else:
            out.append(F.col(f"t.{c}"))
    return j.select(*out)


def insert_missing(target: DataFrame, source: DataFrame, keys: Sequence[str],
                   columns: Sequence[str] | None = None, null_safe: bool = False) -> DataFrame:
    """Insert-only merge: source rows whose key is not in the target.

    Applying the same source twice adds nothing the second time, apart from
    rows with a NULL key, which match nothing as in a MERGE; with ``null_safe``
    NULL is a key like any other and the merge is idempotent for all rows.
    Use keys ``(entity, sequence)`` for versioned inserts.
    """
    new = without(source, target.select(*keys), keys, null_safe)
    if columns is not None:
        new = new.select(*columns)
    return target.unionByName(new, allowMissingColumns=True)
