"""Ordered per-key primitives that stay parallel when one key is hot.

A plain ``Window.partitionBy(key).orderBy(t)`` sends every row of a key to
one task.  When a single key carries a large share of the data (a third of
all rows is the design assumption) that task holds the whole group.  The
primitives here split the timelines of hot keys into *order buckets*:
contiguous ranges of the ordering value that hold about equally many rows.
Their bounds come from a quantile sketch (KLL) of the ordering value per hot
key - mergeable, so it is aggregated map-side - and follow bursts and
outliers.  NULL is a key like any other.  The window runs per
``(key, bucket)``, so a hot key is spread over many tasks, and a small
per-bucket summary stitches the buckets back together:

* in-bucket running value -- window over ``(key, bucket)``
* bucket summary -- ``groupBy(key, bucket)`` with ``max_by``/``min_by``
  (one row per bucket, far smaller than the input)
* carry-in -- running value over the buckets of a key (window on the
  summary only)
* result -- ``coalesce(in-bucket, carry-in)`` after an equi-join on
  ``(key, bucket)``; the row side is already partitioned on that pair.

The splits are written once, and the bucket is a pure function of the row and
its key's splits, so re-computing a lost partition yields the same buckets.
Rows of one key with equal ordering values stay together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.functions.dates import order_number
from lakemart.operators.heavy import heavy_keys
from lakemart.session import cut_lineage

BUCKET = "_obkt"
ROWS_PER_BUCKET = 250_000       # of one key, about; a key with fewer rows is not split
SPLITS = 1024                   # sketched ranges of a hot key; more buckets cut these evenly by value
SKETCH = 4096                   # size parameter of the sketch: ranks are right to about 0.1 %
MAX_BROADCAST_BOUNDS = 1 << 20  # bounds of all hot keys that are broadcast, at most


def is_bucketable(df: DataFrame, order_col: str) -> bool:
    """Has the ordering column a numeric image (numbers, dates, timestamps)?
    Text sequences have none and use the plain window."""
    return isinstance(df.schema[order_col].dataType,
                      (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType))


def _number(df: DataFrame, order_col: str) -> Column:
    return order_number(order_col, df.schema[order_col].dataType).cast("double")


def _on_splits(df: DataFrame, keys: Sequence[str], splits: DataFrame) -> Column:
    cond = F.lit(True)
    for i, k in enumerate(keys):
        cond = cond & df[k].eqNullSafe(splits[f"_sk{i}"])
    return cond


def order_splits(df: DataFrame, keys: Sequence[str], order_col: str, rows: int = ROWS_PER_BUCKET,
                 null_keys: bool = True) -> DataFrame | None:
    """Splits of the hot keys, those with more than ``rows`` rows: one row
    (key columns ``_sk<i>``, ``_bounds``, ``_parts``) each, written; None
    without any.  Pass a narrow frame with the rows' keys and order.

    A frequent-items sketch finds the keys (:func:`heavy_keys`); only rows of
    hot keys are sketched.
    """
    key = [F.col(k).alias(f"_sk{i}") for i, k in enumerate(keys)]
    narrow = df.select(*key, _number(df, order_col).alias("_num"))
    if not null_keys:
        narrow = narrow.dropna(subset=[f"_sk{i}" for i in range(len(keys))])
    names = [f"_sk{i}" for i in range(len(keys))]
    total = narrow.count()
    if total <= rows:
        return None
    hot = cut_lineage(heavy_keys(narrow, names, rows + 1, total).withColumnRenamed("n", "_n"), "hot-keys")
    if hot.isEmpty():
        return None
    # hot keys are total rows / rows at most; a table of a few megabytes is broadcast, a larger one is joined
    known = hot.select(*[F.col(n).alias(f"_h{i}") for i, n in enumerate(names)], "_n")
    if hot.count() <= MAX_BROADCAST_BOUNDS // SPLITS:
        known = F.broadcast(known)
    cond = F.lit(True)
    for i, n in enumerate(names):
        cond = cond & narrow[n].eqNullSafe(known[f"_h{i}"])
    sketch = (narrow.join(known, cond).groupBy(*names, "_n")
                    .agg(F.kll_sketch_agg_double("_num", F.lit(SKETCH)).alias("_sketch")))
    ranks = F.array(*[F.lit(i / SPLITS) for i in range(SPLITS + 1)])
    wanted = F.least(F.lit(SPLITS), F.ceil(F.col("_n") / rows))
    bounds = F.filter(F.col("_all"), lambda b, i: (i == SPLITS) | (F.floor(i * wanted / SPLITS) > F.floor((i - 1) * wanted / SPLITS)))
    sketch = sketch.withColumn("_all", F.when(F.kll_sketch_get_n_double("_sketch") > 0,
                                              F.kll_sketch_get_quantile_double("_sketch", ranks)))
    parts = F.greatest(F.lit(1), F.ceil(F.col("_n") / (rows * SPLITS))).cast("int")
    return cut_lineage(sketch.select(*names, F.array_distinct(bounds).alias("_bounds"), parts.alias("_parts"))
                             .filter(F.col("_bounds").isNotNull()), "splits")


def _bucket(num: Column, bounds: Column, parts: Column) -> Column:
    """Number of bounds at or below ``num`` (binary search), times ``parts``,
    plus the part by value between the two bounds."""
    def step(a: Column, _: Column) -> Column:
        mid = F.floor((a["lo"] + a["hi"]) / 2).cast("int")
        right = (a["lo"] < a["hi"]) & (F.get(bounds, mid) <= num)
        return F.struct(F.when(right, mid + 1).otherwise(a["lo"]).alias("lo"),
                        F.when((a["lo"] < a["hi"]) & ~right, mid).otherwise(a["hi"]).alias("hi"))

    start = F.struct(F.lit(0).alias("lo"), F.size(bounds).alias("hi"))
    at = F.aggregate(F.sequence(F.lit(1), F.lit(SPLITS.bit_length() + 1)), start, step, lambda a: a["lo"])
    low, high = F.get(bounds, at - 1), F.get(bounds, at)
    inside = F.floor((num - low) / (high - low) * parts).cast("int")
    part = F.when((parts > 1) & low.isNotNull() & high.isNotNull(), F.least(F.greatest(inside, F.lit(0)), parts - 1)).otherwise(0)
    # NULL order values sort first ascending and last descending (Spark's
    # defaults); bucket -1 is first in ascending and last in descending
    # bucket order, so it holds them in both directions.  Unsplit keys are one bucket.
    return F.when(num.isNull(), F.lit(-1)).when(bounds.isNull(), F.lit(0)).otherwise(at * parts + part).cast("int")


def add_order_bucket(df: DataFrame, keys: Sequence[str], order_col: str, splits: DataFrame) -> DataFrame:
    """Add the order-bucket column."""
    if (splits.agg(F.sum(F.size("_bounds"))).first()[0] or 0) <= MAX_BROADCAST_BOUNDS:
        splits = F.broadcast(splits)
    joined = df.join(splits, _on_splits(df, keys, splits), "left")
    return joined.select(*[df[c] for c in df.columns], _number(df, order_col).alias("_num"), "_bounds", "_parts") \
                 .withColumn(BUCKET, _bucket(F.col("_num"), F.col("_bounds"), F.col("_parts"))) \
                 .drop("_num", "_bounds", "_parts")


def with_order_bucket(df: DataFrame, keys: Sequence[str], order_col: str, splits: DataFrame) -> DataFrame:
    """Add the order-bucket column and hash-partition by ``(keys, bucket)``.

    Callers that group by ``(keys, order...)`` before a :func:`carry_forward`
    (e.g. a dedupe on ``(key, sequence)``) can group by ``(keys, bucket,
    order...)`` instead -- the same groups, since the bucket is a function
    of the order value -- and pass ``bucketed=True`` to reuse this one
    shuffle for both steps.  ``splits`` without NULL keys then."""
    return add_order_bucket(df, keys, order_col, splits).repartition(*[F.col(k) for k in keys], F.col(BUCKET))


def _order_exprs(order: Sequence[str], descending: bool) -> list[Column]:
    return [F.col(c).desc() if descending else F.col(c).asc() for c in order]


def carry_forward(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                  cols: Sequence[str], out: Sequence[str] | None = None,
                  include_current: bool = True, descending: bool = False,
                  skew_safe: bool = True, splits: DataFrame | None = None, bucketed: bool = False,
                  summary_input: DataFrame | None = None, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Last non-NULL value of each of ``cols`` up to (or strictly before)
    the current row, per key, in ``order`` (first column buckets).

    Equals ``last(c, ignorenulls) OVER (PARTITION BY keys ORDER BY order
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW | 1 PRECEDING)`` when
    ``order`` is unique within a key.  ``splits``: see :func:`order_splits`;
    found from the data when not given, and without hot keys the window above
    is used.
    ``bucketed=True``: ``df`` comes from :func:`with_order_bucket` with the
    same keys and first order column and is still partitioned that way (only
    narrow steps or broadcast joins since), so no new shuffle is made.

    ``summary_input``: a cheaper frame with the same key, order and value
    columns, the same set of (key, bucket) pairs as ``df`` and the same
    per-(key, bucket) last non-NULL values -- e.g. the value-carrying rows
    plus a narrow (key, order) projection of the others.  The bucket
    summary is then a map-side partial aggregate of it instead of a second
    pass over ``df``'s shuffle (column pruning makes the two branches
    differ, so Spark cannot reuse that exchange).
    """
    keys, order, cols = list(keys), list(order), list(cols)
    out = list(out) if out is not None else list(cols)
    hi = Window.currentRow if include_current else -1
    oexpr = _order_exprs(order, descending)
    if skew_safe and splits is None and is_bucketable(df, order[0]):
        splits = order_splits(summary_input if summary_input is not None else df, keys, order[0], rows_per_bucket)
    if not skew_safe or splits is None:
        w = Window.partitionBy(*keys).orderBy(*oexpr).rowsBetween(Window.unboundedPreceding, hi)
        return df.withColumns({o: F.last(F.col(c), ignorenulls=True).over(w)
                               for c, o in zip(cols, out)})

    # the key as one struct: equal also where a part is NULL, so the stitching
    # join is a plain equi-join that reuses the rows' partitioning
    by = keys if bucketed else ["_key"]

    def keyed(x: DataFrame) -> DataFrame:
        x = x if BUCKET in x.columns else add_order_bucket(x, keys, order[0], splits)
        return x if bucketed else x.withColumn("_key", F.struct(*keys))

    rows = df if bucketed else keyed(df).repartition("_key", BUCKET)
    w_in = (Window.partitionBy(*by, BUCKET).orderBy(*oexpr)
            .rowsBetween(Window.unboundedPreceding, hi))
    tmp = [f"_cf_in_{i}" for i in range(len(cols))]
    rows = rows.withColumns({t: F.last(F.col(c), ignorenulls=True).over(w_in)
                             for c, t in zip(cols, tmp)})

    # one row per (key, bucket): the bucket's last non-NULL value of each col
    ord_struct = F.struct(*[F.col(c) for c in order])
    pick = F.min_by if descending else F.max_by
    src = keyed(summary_input) if summary_input is not None else rows
    summ = src.groupBy(*by, BUCKET).agg(*[
        pick(F.col(c), F.when(F.col(c).isNotNull(), ord_struct)).alias(f"_cf_last_{i}")
        for i, c in enumerate(cols)])
    w_b = (Window.partitionBy(*by)
           .orderBy(F.col(BUCKET).desc() if descending else F.col(BUCKET).asc())
           .rowsBetween(Window.unboundedPreceding, -1))
    summ = summ.select(*by, BUCKET, *[
        F.last(F.col(f"_cf_last_{i}"), ignorenulls=True).over(w_b).alias(f"_cf_carry_{i}")
        for i in range(len(cols))])
    s = summ.alias("_s")
    r = rows.alias("_r")
    on = F.lit(True)
    for c in by + [BUCKET]:
        on = on & (F.col(f"_r.{c}") == F.col(f"_s.{c}"))
    joined = r.join(s, on, "left")
    keep = [F.col(f"_r.{c}") for c in df.columns if c not in out and c != BUCKET]
    vals = [F.coalesce(F.col(f"_r.{t}"), F.col(f"_s._cf_carry_{i}")).alias(o)
            for i, (t, o) in enumerate(zip(tmp, out))]
    return joined.select(*keep, *vals)


def next_value(df: DataFrame, keys: Sequence[str], order: Sequence[str], col: str,
               out: str, skew_safe: bool = True, splits: DataFrame | None = None, bucketed: bool = False,
               summary_input: DataFrame | None = None) -> DataFrame:
    """Value of ``col`` on the next row of the same key in ``order``
    (``lead``) -- exact when ``col`` is non-NULL on every row, e.g. the next
    version's start in an SCD2 timeline."""
    if not skew_safe or (not bucketed and not is_bucketable(df, order[0])):
        w = Window.partitionBy(*keys).orderBy(*_order_exprs(order, False))
        return df.withColumn(out, F.lead(F.col(col)).over(w))
    return carry_forward(df, keys, order, [col], [out], include_current=False,
                         descending=True, skew_safe=True, splits=splits,
                         bucketed=bucketed, summary_input=summary_input)
