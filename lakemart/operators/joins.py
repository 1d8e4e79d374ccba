"""Joins: touched-key pull-through, dimension lookups, as-of and skew joins."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.functions.keys import normalize_expr
from lakemart.operators.heavy import heavy_keys
from lakemart.operators.sequence import carry_forward, is_bucketable, order_splits
from lakemart.session import cut_lineage

# Largest side we broadcast on our own, by Spark's own size estimate.  Estimates
# of Parquet scans are file bytes; the cap leaves room for their decompression.
DEFAULT_BROADCAST_BYTES = 16 * 1024 * 1024
MAX_BROADCAST_KEYS = 100_000    # of a written list of keys

_WIDTH = {T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.DateType: 4,
          T.FloatType: 4, T.LongType: 8, T.DoubleType: 8, T.TimestampType: 8,
          T.TimestampNTZType: 8, T.DecimalType: 16}


def row_width(schema: T.StructType) -> int | None:
    """Bytes per row of fixed-width columns; None when a column has no fixed
    width (text, arrays)."""
    widths = [_WIDTH.get(type(f.dataType)) for f in schema.fields]
    return None if None in widths else sum(widths) + 8


def plan_bytes(df: DataFrame) -> int | None:
    """Spark's estimate of the size of ``df``, from statistics; runs nothing.
    None where the plan cannot be asked (Spark Connect)."""
    try:
        return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    except AttributeError:
        return None


def bounded_broadcast(df: DataFrame, known_rows: int | None = None,
                      max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Broadcast hint only behind a size bound.

    ``known_rows`` is a static bound (a calendar of N days, a literal table)
    and counts only for fixed-width columns.  Otherwise the bound is Spark's
    own size estimate of the plan; nothing is run for it.  Past the bound the
    plain frame is returned and the join stays a shuffle join; AQE may still
    convert it at run time from measured shuffle sizes.
    """
    width = row_width(df.schema)
    size = known_rows * width if known_rows is not None and width else plan_bytes(df)
    return F.broadcast(df) if size is not None and size <= max_bytes else df


def touched_history(full: DataFrame, touched: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All rows of ``full`` whose key occurs in ``touched``.

    A left semi join: a key touched many times does not multiply rows.  The
    touched keys are de-duplicated (partial aggregation) and broadcast when
    their size estimate is small, so ``full`` is not shuffled.
    """
    return full.join(bounded_broadcast(touched.select(*keys).distinct()), list(keys), "left_semi")


def lookup_key(df: DataFrame, dim: DataFrame, on: str | Column | Sequence, dim_on: str | Sequence[str],
               take: Mapping[str, str], how: str = "left", dim_rows: int | None = None) -> DataFrame:
    """Left-join a dimension and pull ``take`` = {new_name: dim_column}.

    Call once per role (origin / destination city, order / delivery date):
    every call gets its own aliased copy of the dimension.  ``on`` may be
    an expression (e.g. ``to_date(ts)``).  The dimension side is broadcast
    only under a size bound.
    """
    ons = list(on) if isinstance(on, (list, tuple)) else [on]
    dims = [dim_on] if isinstance(dim_on, str) else list(dim_on)
    tmp_l = [f"_lk_l{i}" for i in range(len(ons))]
    tmp_r = [f"_lk_r{i}" for i in range(len(dims))]
    left = df.withColumns({t: (F.col(o) if isinstance(o, str) else o) for t, o in zip(tmp_l, ons)})
    right = dim.select(*[F.col(d).alias(t) for d, t in zip(dims, tmp_r)],
                       *[F.col(src).alias(name) for name, src in take.items()])
    right = bounded_broadcast(right, dim_rows)
    cond = F.lit(True)
    for a, b in zip(tmp_l, tmp_r):
        cond = cond & (left[a] == right[b])
    return left.join(right, cond, how).drop(*tmp_l, *tmp_r)


def normalized_lookup(df: DataFrame, lookup: DataFrame, col: str, lookup_col: str,
                      take: Sequence[str] | None = None) -> DataFrame:
    """Left join on the normalised form of a string key (accents folded,
    punctuation dropped, lower case) -- the lookup is broadcast under a
    size bound."""
    take = list(take) if take is not None else [c for c in lookup.columns]
    right = lookup.select(normalize_expr(lookup_col).alias("_nrm_r"), *take)
    right = bounded_broadcast(right)
    left = df.withColumn("_nrm_l", normalize_expr(col))
    return left.join(right, left["_nrm_l"] == right["_nrm_r"], "left").drop("_nrm_l", "_nrm_r")


def hot_keys(df: DataFrame, key: str, min_rows: int) -> DataFrame:
    """Keys with at least ``min_rows`` rows (at most ``rows / min_rows`` of
    them), found by a frequent-items sketch and counted exactly."""
    return heavy_keys(df.filter(F.col(key).isNotNull()), [key], min_rows).select(key, F.lit(True).alias("_hot"))


def salted_join(df: DataFrame, dim: DataFrame, key: str, salt_cols: Sequence[str],
                buckets: int = 16, how: str = "left", hot_rows: int | None = None) -> DataFrame:
    """Equi-join (inner, left, semi or anti) that spreads a hot key over
    ``buckets`` tasks; a right or full join would repeat the replicated
    dimension rows and is rejected.

    Each fact row of a hot key gets a deterministic salt from a hash of
    ``salt_cols`` (a recomputed partition gets the same salt); the
    dimension rows of hot keys are replicated once per salt value.  With
    ``hot_rows`` only keys with at least that many fact rows are salted, all of
    them (:func:`hot_keys`; the list is written, and broadcast when it is
    small); every other key joins with salt 0 and the
    dimension is not replicated for it; rows with a NULL key match nothing and
    are spread.  Without ``hot_rows`` every key is
    salted.  The result equals the unsalted join.  Use when a key holds a
    large share of the rows and AQE's skew-join split does not apply.
    """
    if how.replace("_", "").lower() not in ("inner", "left", "leftouter", "leftsemi", "semi", "leftanti", "anti"):
        raise ValueError(f"salted_join cannot do a {how} join")
    h = F.pmod(F.xxhash64(*[F.col(c) for c in salt_cols]), F.lit(buckets))
    all_salts = F.sequence(F.lit(0), F.lit(buckets - 1).cast("long"))
    fan = F.explode(all_salts)
    if hot_rows is None:
        f = df.withColumn("_salt", h)
        d = dim.withColumn("_salt", fan)
    else:
        hot = cut_lineage(hot_keys(df, key, hot_rows), "hot")
        if hot.count() <= MAX_BROADCAST_KEYS:
            hot = F.broadcast(hot)
        f = (df.join(hot, key, "left")
               .withColumn("_salt", F.when(F.col("_hot") | F.col(key).isNull(), h).otherwise(F.lit(0)))
               .drop("_hot"))
        d = (dim.join(hot, key, "left")
                .withColumn("_salt", F.explode(F.when(F.col("_hot"), all_salts)
                                                .otherwise(F.array(F.lit(0).cast("long")))))
                .drop("_hot"))
    return f.join(d, [key, "_salt"], how).drop("_salt")


# Broadcast as-of plan only when no key has more versions than this (each
# fact is compared with the versions of its key).
MAX_VERSIONS_PER_KEY = 1000


def as_of_join(facts: DataFrame, dim: DataFrame, keys: Sequence[str], fact_time: str,
               dim_start: str, take: Sequence[str], dim_keys: Sequence[str] | None = None,
               dim_end: str | None = None, end_inclusive: bool = True,
               prefix: str = "", skew_safe: bool | str = "auto",
               strategy: str = "auto",
               max_versions_per_key: int = MAX_VERSIONS_PER_KEY,
               dim_order: Sequence[str] = ()) -> DataFrame:
    """Validity-interval (as-of) left join: for every fact row the dimension
    version with the latest ``dim_start <= fact_time`` for the same key.

    Instead of an equi-join with a range residual (which compares every
    fact with every version of its key), facts and versions are unioned
    into one timeline per key and the version is carried forward onto the
    facts -- linear in rows, and split by order buckets so one hot key is
    not one task.  At equal instants the version precedes the fact
    (``start <= t``).  With ``dim_end`` the match is also required to
    satisfy ``t <= end`` (``t < end`` when ``end_inclusive=False``).
    Exactly one output row per fact row.  Of several versions of a key with
    one start, the one with the largest ``dim_order`` (e.g. the sequence
    column), then the largest taken values, counts - in every strategy.

    ``strategy``: ``"carry"`` always uses the timeline above (facts are
    shuffled once); ``"broadcast"`` / ``"auto"`` use a broadcast equi-join
    on the key with ``start <= t < next_start`` as residual -- the facts are
    not shuffled at all -- when the version table passes the broadcast size
    bound and no key has more than ``max_versions_per_key`` versions (both
    checked with bounded actions); otherwise they fall back to the timeline.
    """
    keys = list(keys)
    dkeys = list(dim_keys) if dim_keys else keys
    dim = _one_per_start(dim, dkeys, dim_start, list(dim_order),
                         list(dict.fromkeys([*take, *([dim_end] if dim_end else [])])))
    if strategy in ("auto", "broadcast"):
        out = _as_of_broadcast(facts, dim, keys, dkeys, fact_time, dim_start, list(take), dim_end,
                               end_inclusive, prefix, max_versions_per_key)
        if out is not None:
            return out
    elif strategy != "carry":
        raise ValueError("strategy must be 'auto', 'broadcast' or 'carry'")
    t_type = facts.schema[fact_time].dataType
    fact_cols = facts.columns
    take = list(take)
    # facts without a key or time match nothing: they skip the timeline, however many they are
    lost = F.col(fact_time).isNull()
    for k in keys:
        lost = lost | F.col(k).isNull()
    unmatched = facts.filter(lost).select(*[F.col(c) for c in fact_cols], *[
        F.lit(None).cast(dim.schema[c].dataType).alias(prefix + c) for c in take])
    facts = facts.filter(~lost)
    dim_fields = take + ([dim_end] if dim_end and dim_end not in take else [])
    dim_struct_type = T.StructType([T.StructField(c, dim.schema[c].dataType) for c in dim_fields])
    fact_struct_type = T.StructType([T.StructField(c, facts.schema[c].dataType) for c in fact_cols])

    f = facts.select(*[F.col(k).alias(f"_aj_k{i}") for i, k in enumerate(keys)],
                     F.col(fact_time).alias("_aj_t"), F.lit(1).alias("_aj_side"),
                     F.struct(*[F.col(c) for c in fact_cols]).alias("_aj_fact"),
                     F.lit(None).cast(dim_struct_type).alias("_aj_dim"))
    d = (dim.filter(F.col(dim_start).isNotNull())
            .select(*[F.col(k).alias(f"_aj_k{i}") for i, k in enumerate(dkeys)],
                    F.col(dim_start).cast(t_type).alias("_aj_t"), F.lit(0).alias("_aj_side"),
                    F.lit(None).cast(fact_struct_type).alias("_aj_fact"),
                    F.struct(*[F.col(c) for c in dim_fields]).alias("_aj_dim")))
    for i in range(len(keys)):
        d = d.filter(F.col(f"_aj_k{i}").isNotNull())
    kcols = [f"_aj_k{i}" for i in range(len(keys))]
    u = f.unionByName(d)
    # only version rows carry a value; the bucket summary needs them plus
    # the (key, time) of the facts so every bucket has a summary row -- a
    # column-pruned scan and a partial aggregate, not a second full shuffle
    presence = f.select(*kcols, "_aj_t", "_aj_side", F.lit(None).cast(fact_struct_type).alias("_aj_fact"),
                        F.lit(None).cast(dim_struct_type).alias("_aj_dim"))
    both = d.unionByName(presence)
    splits = order_splits(both, kcols, "_aj_t") if skew_safe and is_bucketable(both, "_aj_t") else None
    carried = carry_forward(u, kcols, ["_aj_t", "_aj_side"], ["_aj_dim"], skew_safe=splits is not None,
                            splits=splits, summary_input=both)
    out = carried.filter(F.col("_aj_side") == 1)
    valid = F.lit(True)
    if dim_end:
        end = F.col(f"_aj_dim.{dim_end}").cast(t_type)
        inside = (F.col("_aj_t") <= end) if end_inclusive else (F.col("_aj_t") < end)
        valid = valid & (end.isNull() | inside)
    dim_val = F.when(valid, F.col("_aj_dim"))
    matched = out.select(*[F.col(f"_aj_fact.{c}").alias(c) for c in fact_cols],
                         *[dim_val.getField(c).alias(prefix + c) for c in take])
    return matched.union(unmatched)


def _one_per_start(dim: DataFrame, keys, start: str, order, fields) -> DataFrame:
    """One version per (key, start): the largest in ``order``, then in ``fields``."""
    rest = [c for c in fields if c not in keys and c != start]
    own = F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate([*order, *rest])], F.lit(0).alias("_z"))
    picked = dim.groupBy(*keys, start).agg(F.max(own).alias("_v"))
    return picked.select(*keys, start, *[F.col(f"_v._o{len(order) + i}").alias(c) for i, c in enumerate(rest)])


def _as_of_broadcast(facts: DataFrame, dim: DataFrame, keys, dkeys, fact_time: str, dim_start: str,
                     take, dim_end, end_inclusive: bool, prefix: str,
                     max_versions: int) -> DataFrame | None:
    """Broadcast plan of :func:`as_of_join`, or None when its bounds fail."""
    from pyspark.sql import Window

    t_type = facts.schema[fact_time].dataType
    fields = list(dict.fromkeys(take + ([dim_end] if dim_end else [])))
    v = dim.filter(F.col(dim_start).isNotNull())
    for k in dkeys:
        v = v.filter(F.col(k).isNotNull())
    v = v.select(*[F.col(k).alias(f"_ab_k{i}") for i, k in enumerate(dkeys)],
                 F.col(dim_start).cast(t_type).alias("_ab_s"),
                 *[F.col(c).alias(f"_ab_v{i}") for i, c in enumerate(fields)])
    kc = [f"_ab_k{i}" for i in range(len(dkeys))]
    small = bounded_broadcast(v)
    if small is v:                                        # too large to broadcast
        return None
    per_key = v.groupBy(*kc).agg(F.count(F.lit(1)).alias("_n")).agg(F.max("_n")).first()[0]
    if per_key is not None and per_key > max_versions:
        return None
    w = Window.partitionBy(*kc).orderBy("_ab_s")
    v = F.broadcast(v.withColumn("_ab_next", F.lead("_ab_s").over(w)))
    t = F.col(fact_time)
    cond = F.lit(True)
    for i, k in enumerate(keys):
        cond = cond & (F.col(k) == F.col(f"_ab_k{i}"))
    cond = cond & (F.col("_ab_s") <= t) & (F.col("_ab_next").isNull() | (t < F.col("_ab_next")))
    if dim_end:
        end = F.col(f"_ab_v{fields.index(dim_end)}").cast(t_type)
        cond = cond & (end.isNull() | ((t <= end) if end_inclusive else (t < end)))
    j = facts.join(v, cond, "left")
    return j.select(*[facts[c] for c in facts.columns],
                    *[F.col(f"_ab_v{fields.index(c)}").alias(prefix + c) for c in take])

