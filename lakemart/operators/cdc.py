"""Change capture: produce a change feed from two snapshots, split it, and
complete sparse updates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.operators.sequence import ROWS_PER_BUCKET, carry_forward
from lakemart.session import cut_lineage

CHANGE_TYPE = "_change_type"
COMMIT_VERSION = "_commit_version"

# --- fixed values: change-feed row types -------------------------------------
INSERT = "insert"
UPDATE_PRE = "update_preimage"
UPDATE_POST = "update_postimage"
DELETE = "delete"
# ------------------------------------------------------------------------------


def snapshot_diff(old: DataFrame, new: DataFrame, keys: Sequence[str], version: int,
                  compare: Sequence[str] | None = None) -> DataFrame:
    """Change rows turning ``old`` into ``new``.

    One full outer join on the key.  Keys only in ``new`` -> ``insert``;
    only in ``old`` -> ``delete`` (carrying the removed image); in both with
    a null-safe difference on ``compare`` (default: all non-key columns)
    -> ``update_preimage`` + ``update_postimage``.  Unchanged keys emit
    nothing.  Every row gets ``_commit_version = version``.
    """
    keys = list(keys)
    # a column that only one snapshot has counts as NULL in the other
    data = [c for c in dict.fromkeys([*new.columns, *old.columns]) if c not in keys]
    for c in data:
        if c not in old.columns:
            old = old.withColumn(c, F.lit(None).cast(new.schema[c].dataType))
        if c not in new.columns:
            new = new.withColumn(c, F.lit(None).cast(old.schema[c].dataType))
    cmp = list(compare) if compare is not None else data
    o = old.select(*keys, F.struct(*[F.col(c) for c in data]).alias("_o"))
    n = new.select(*keys, F.struct(*[F.col(c) for c in data]).alias("_n"))
    j = o.join(n, keys, "full_outer")
    same = F.lit(True)
    for c in cmp:
        same = same & F.col(f"_o.{c}").eqNullSafe(F.col(f"_n.{c}"))
    o_there, n_there = F.col("_o").isNotNull(), F.col("_n").isNotNull()

    def img(src: str, kind: str):
        return F.struct(F.col(src).alias("img"), F.lit(kind).alias("kind"))

    changes = F.array(
        F.when(~o_there & n_there, img("_n", INSERT)),
        F.when(o_there & ~n_there, img("_o", DELETE)),
        F.when(o_there & n_there & ~same, img("_o", UPDATE_PRE)),
        F.when(o_there & n_there & ~same, img("_n", UPDATE_POST)),
    )
    rows = j.select(*keys, F.explode(F.filter(changes, lambda x: x.isNotNull())).alias("_c"))
    return rows.select(*keys, *[F.col(f"_c.img.{c}").alias(c) for c in data],
                       F.col("_c.kind").alias(CHANGE_TYPE),
                       F.lit(version).cast("long").alias(COMMIT_VERSION))


def digests(df: DataFrame, keys: Sequence[str], columns: Sequence[str], bits: int,
            parents: DataFrame | None = None, parent_bits: int = 0) -> DataFrame:
    """Order-independent digest of the rows of each range of the key's hash:
    ``node`` (the hash's first ``bits`` bits), number of rows, and two xors and
    two sums of row hashes that also tell NULLs apart.  A partial aggregate, at most
    ``2**bits`` rows per task.  ``parents``: only below these nodes."""
    h = F.xxhash64(*[F.col(k) for k in keys])
    cells = [F.col(c) for c in columns] + [F.col(c).isNull() for c in columns]
    rows = df.select(h.alias("_h"), F.xxhash64(*cells).alias("_a"), F.xxhash64(F.lit("second"), *cells).alias("_b"))
    if parents is not None:
        rows = rows.join(parents, F.shiftrightunsigned("_h", 64 - parent_bits) == F.col("_parent"), "left_semi")

    def total(c: str) -> Column:                        # sums that cannot overflow
        return F.sum(F.col(c).cast("decimal(38,0)"))

    return rows.groupBy(F.shiftrightunsigned("_h", 64 - bits).alias("node")).agg(
        F.struct(F.count(F.lit(1)), F.bit_xor("_a"), F.bit_xor("_b"), total("_a"), total("_b")).alias("digest"))


def snapshot_diff_tree(old: DataFrame, new: DataFrame, keys: Sequence[str], version: int,
                       compare: Sequence[str] | None = None, levels: Sequence[int] = (8, 16)) -> DataFrame:
    """The rows of :func:`snapshot_diff`, for large snapshots with few changes.

    A digest tree over ranges of the key's hash, ``levels`` giving the bits of
    each level, finds the ranges in which the snapshots differ; only their rows
    are shuffled and joined.  Each level reads both snapshots and shuffles at most
    ``2**bits`` digests per task, below differing nodes only.  The differing nodes
    (``2**bits`` numbers at most, so 20 bits are the limit) are broadcast.
    """
    if list(levels) != sorted(set(levels)) or not levels or levels[0] < 1 or levels[-1] > 20:
        raise ValueError("levels must rise from 1 to at most 20 bits")
    columns = list(dict.fromkeys([*new.columns, *old.columns]))
    if compare is not None:
        columns = [c for c in columns if c in keys or c in compare]

    def full(df: DataFrame, other: DataFrame) -> DataFrame:
        return df.select(*[F.col(c) if c in df.columns else F.lit(None).cast(other.schema[c].dataType).alias(c) for c in columns])

    parents, before = None, 0
    for bits in levels:
        a = digests(full(old, new), keys, columns, bits, parents, before)
        b = digests(full(new, old), keys, columns, bits, parents, before)
        both = a.withColumnRenamed("digest", "_x").join(b.withColumnRenamed("digest", "_y"), "node", "full_outer")
        nodes = both.filter(~F.col("_x").eqNullSafe(F.col("_y"))).select(F.col("node").alias("_parent"))
        parents, before = F.broadcast(cut_lineage(nodes, "nodes")), bits

    def below(df: DataFrame) -> DataFrame:
        h = F.shiftrightunsigned(F.xxhash64(*[F.col(k) for k in keys]), 64 - before)
        return df.withColumn("_node", h).join(parents, F.col("_node") == F.col("_parent"), "left_semi").drop("_node")

    return snapshot_diff(below(old), below(new), keys, version, compare)


def split_changes(df: DataFrame, change_col: str = CHANGE_TYPE,
                  delete_values: Sequence[str] = (DELETE,),
                  drop_values: Sequence[str] = (UPDATE_PRE,)) -> tuple[DataFrame, DataFrame]:
    """``(upserts, deletes)``: pre-images dropped, deletes split off."""
    kept = df.filter(~F.col(change_col).isin(*drop_values))
    return (kept.filter(~F.col(change_col).isin(*delete_values)),
            kept.filter(F.col(change_col).isin(*delete_values)))


def upserts_only(df: DataFrame, change_col: str = CHANGE_TYPE) -> DataFrame:
    return split_changes(df, change_col)[0]


def fill_forward(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                 cols: Sequence[str], skew_safe: bool | str = "auto",
                 rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Complete sparse updates: each of ``cols`` takes the latest non-NULL
    value seen so far for its key (a full post-image from partial ones).
    Timelines of keys with more than ``rows_per_bucket`` rows are split, that
    of the rows without key too."""
    return carry_forward(df, keys, order, cols, skew_safe=skew_safe, rows_per_bucket=rows_per_bucket)
