"""Slowly changing dimensions, type 1 and type 2.

SCD2 is applied as a *timeline rebuild of the touched keys* rather than a
sequence of close / insert / tombstone merges:

1. touched = keys present in the change batch;
2. versions = (target rows of touched keys) ∪ (upserts of the batch),
   deduplicated on (key, sequence) -- a replayed batch adds nothing;
3. tombstones = smallest delete sequence per key (this batch's deletes
   and those already recorded on the target);  versions at or after it
   are dropped, the rest are flagged deleted;
4. next start per key (skew-safe ``lead``) gives ``end_at = next - 1 ms``
   and ``is_current = next IS NULL AND NOT deleted``;
5. a deleted key left without any version keeps one tombstone row
   (attributes NULL, ``_is_delete`` true) that carries ``_delete_seq``;
6. result = (target rows of untouched keys) ∪ rebuilt rows.

Because the outcome depends only on the set of changes, not on how they
were batched or in which order batches arrived, late changes, equal
sequences, replays and deletes that precede re-inserts all come out the
same as one in-order load.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.functions.dates import minus_millis
from lakemart.operators.cdc import DELETE, UPDATE_PRE
from lakemart.operators.dedupe import dedupe
from lakemart.operators.merge import upsert
from lakemart.operators.joins import bounded_broadcast
from lakemart.operators.sequence import BUCKET, is_bucketable, next_value, order_splits, with_order_bucket

START, END, CURRENT, DELETED, DELETE_SEQ = "start_at", "end_at", "is_current", "_is_delete", "_delete_seq"


# ----------------------------------------------------------------- type 1

def scd1_apply(target: DataFrame | None, changes: DataFrame, keys: Sequence[str], seq: str,
               tiebreak: Sequence[str] = (), guard_sequence: bool = True,
               desc: bool = True) -> DataFrame:
    """Current state per key.

    The batch is reduced to its latest row per key (earliest with
    ``desc=False``: first delivery wins, e.g. events delivered at least
    once).  With ``guard_sequence`` (default) a target row survives when it
    is newer (older) than the incoming one, so batches may arrive in any
    order; ties are decided by ``tiebreak`` and then by the rows' content,
    never by arrival.  Without the guard the incoming row always replaces
    the target row (plain upsert).
    """
    keys = list(keys)
    latest = dedupe(changes, keys, seq, desc=desc, tiebreak=tiebreak)
    if target is None:
        return latest
    if not guard_sequence:
        return upsert(target, latest, keys)
    touched = bounded_broadcast(latest.select(*keys))     # unique already: one row per key
    old = target.join(touched, keys, "left_semi").withColumn("_src", F.lit(0))
    cand = old.unionByName(latest.withColumn("_src", F.lit(1)), allowMissingColumns=True)
    # data decides ties, arrival last: the same state whatever the order of batches
    cand = cand.withColumn("_h", F.xxhash64(*[F.col(c) for c in latest.columns]))
    win = dedupe(cand, keys, [seq, *tiebreak, "_h", "_src"], desc=desc).drop("_src", "_h")
    rest = target.join(touched, keys, "left_anti")
    return rest.unionByName(win, allowMissingColumns=True)


# ----------------------------------------------------------------- type 2

def scd2_schema(changes: DataFrame, keys: Sequence[str], seq: str, attrs: Sequence[str],
                start: str | None = None) -> T.StructType:
    start_type = changes.schema[start or seq].dataType
    fields = [changes.schema[c] for c in list(keys) + list(attrs)]
    if seq not in list(keys) + list(attrs):
        fields.append(changes.schema[seq])
    fields += [T.StructField(START, start_type), T.StructField(END, start_type),
               T.StructField(CURRENT, T.BooleanType()), T.StructField(DELETED, T.BooleanType()),
               T.StructField(DELETE_SEQ, changes.schema[seq].dataType)]
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in fields])


def scd2_apply(target: DataFrame | None, changes: DataFrame, keys: Sequence[str], seq: str,
               attrs: Sequence[str], start: str | None = None,
               change_col: str | None = None, delete_values: Sequence[str] = (DELETE,),
               drop_values: Sequence[str] = (UPDATE_PRE,), tiebreak: Sequence[str] = (),
               end_offset_ms: int = 1, skew_safe: bool | str = "auto",
               stamp_col: str | None = None, close_deleted: bool = False) -> DataFrame:
    """Apply a batch of changes to an SCD2 table (see module doc).

    ``seq`` orders versions; ``start`` (default ``seq``) is the instant a
    version becomes valid.  With ``change_col`` set, rows whose change type
    is in ``drop_values`` are ignored and rows in ``delete_values`` are
    deletes.  Output columns: keys, attrs, seq, ``start_at``, ``end_at``,
    ``is_current``, ``_is_delete``, ``_delete_seq`` (and ``stamp_col``: the
    run time on rebuilt rows, kept on untouched ones -- the high-water
    column for incremental downstream reads).

    The last version of a deleted key keeps an open end; ``close_deleted``
    ends it at the delete sequence (which must then be the start column).

    ``skew_safe='auto'`` (default): one shuffle by key and a plain ``lead``
    window, unless some key has more rows than a task should hold
    (:func:`~lakemart.operators.sequence.order_splits`); then timelines are
    split into order buckets.  Sequences without a numeric image (text)
    always use the plain window.
    """
    keys, attrs = list(keys), list(attrs)
    start = start or seq
    if close_deleted and start != seq:
        raise ValueError("close_deleted needs the sequence to be the start column")
    payload = list(dict.fromkeys(keys + attrs + [seq, start]))
    spark = changes.sparkSession
    schema = scd2_schema(changes, keys, seq, attrs, start)
    if stamp_col:
        schema = schema.add(stamp_col, T.TimestampType())
    initial = target is None
    if initial:
        target = spark.createDataFrame([], schema)

    ch = changes.filter(~F.col(change_col).isin(*drop_values)) if change_col else changes
    if change_col:
        ups = ch.filter(~F.col(change_col).isin(*delete_values))
        dels = ch.filter(F.col(change_col).isin(*delete_values))
    else:
        ups, dels = ch, None

    touched = ups.select(*keys)
    if dels is not None:
        touched = touched.unionByName(dels.select(*keys))
    # distinct (partial aggregation): a key changed a million times is one
    # row on the build side of the semi / anti joins
    touched = touched.distinct()
    if not initial:
        # a batch touches few keys: broadcast them (bounded) so the target
        # is filtered in place rather than shuffled
        touched = bounded_broadcast(touched)

    hist = target.join(touched, keys, "left_semi")
    hist_cols = [F.col(START).alias(c) if (c == start and c not in target.columns) else F.col(c)
                 for c in payload]
    versions = ups.select(*payload, F.lit(1).alias("_src"))
    # narrow (key, seq) image of the same rows: surviving keys and the lead's
    # bucket summary are read from it instead of re-running the full plan
    narrow = ups.select(*keys, seq)
    if not initial:   # initial load: no history to pull through
        versions = hist.select(*hist_cols, F.lit(0).alias("_src")).unionByName(versions)
        narrow = hist.select(*keys, seq).unionByName(narrow)
    versions = versions.withColumn("_h", F.xxhash64(*[F.col(c) for c in attrs]) if attrs else F.lit(0))
    group = keys + [seq]
    splits = None
    if skew_safe and is_bucketable(changes, seq):
        splits = order_splits(narrow, keys, seq, null_keys=False)
    skew_safe = splits is not None
    if skew_safe:
        # one shuffle by (key, order bucket) serves the dedupe below and the
        # `lead` window; the splits come from the narrow image of the versions
        versions = with_order_bucket(versions, keys, seq, splits)
        group = keys + [BUCKET, seq]       # same groups: the bucket is a function of seq
    # data first, arrival last: equal (key, seq) resolve the same way whatever
    # the batch order; only exact replays fall through to `_src`
    versions = dedupe(versions, group, [*tiebreak, "_h", "_src"], desc=True)

    # tombstones: smallest delete sequence per key, new or already recorded
    tomb = None if initial else \
        hist.filter(F.col(DELETE_SEQ).isNotNull()).select(*keys, F.col(DELETE_SEQ).alias("_ds"))
    if dels is not None:
        d_t = dels.select(*keys, F.col(seq).alias("_ds"))
        tomb = d_t if tomb is None else tomb.unionByName(d_t)
    still_bucketed = skew_safe
    if tomb is None:
        # initial load without deletes: nothing can be tombstoned
        versions = versions.withColumn("_ds", F.lit(None).cast(schema[DELETE_SEQ].dataType))
    else:
        tomb = tomb.groupBy(*keys).agg(F.min("_ds").alias("_ds"))
        # one row per deleted key: a broadcast under the size bound keeps the
        # (key, bucket) partitioning; otherwise the lead re-shuffles
        small = bounded_broadcast(tomb)
        still_bucketed = skew_safe and small is not tomb
        alive = F.col("_ds").isNull() | (F.col(seq) < F.col("_ds"))
        versions = versions.join(small, keys, "left").filter(alive)
        narrow = narrow.join(small, keys, "left").filter(alive).select(*keys, seq)

    if skew_safe and not still_bucketed:
        versions = versions.drop(BUCKET)
    # duplicates of a (key, seq) share the start when start == seq, so the
    # lead's per-bucket summary can be a partial aggregate of `narrow`
    versions = next_value(versions, keys, [seq], start, "_next", skew_safe=skew_safe,
                          splits=splits, bucketed=still_bucketed,
                          summary_input=narrow if (skew_safe and start == seq) else None)
    deleted = F.col("_ds").isNotNull()
    rebuilt = versions.select(
        *[F.col(c) for c in keys + attrs + ([seq] if seq not in keys + attrs else [])],
        F.col(start).alias(START),
        minus_millis(F.coalesce("_next", "_ds") if close_deleted else "_next", end_offset_ms).alias(END),
        (F.col("_next").isNull() & ~deleted).alias(CURRENT),
        deleted.alias(DELETED),
        F.col("_ds").cast(schema[DELETE_SEQ].dataType).alias(DELETE_SEQ),
        *([F.current_timestamp().alias(stamp_col)] if stamp_col else []),
    )
    cols = schema.fieldNames()
    out = rebuilt.select(*cols)
    if tomb is None:
        return out
    # a deleted key with no surviving version keeps one tombstone row, so a
    # later batch carrying older versions of it is still blocked
    markers = tomb.join(narrow.select(*keys).distinct(), keys, "left_anti").select(
        *keys,
        *[F.lit(None).cast(schema[c].dataType).alias(c) for c in attrs if c != seq],
        *([F.col("_ds").cast(schema[seq].dataType).alias(seq)] if seq not in keys + attrs else []),
        F.lit(None).cast(schema[START].dataType).alias(START),
        F.lit(None).cast(schema[END].dataType).alias(END),
        F.lit(False).alias(CURRENT), F.lit(True).alias(DELETED),
        F.col("_ds").cast(schema[DELETE_SEQ].dataType).alias(DELETE_SEQ),
        *([F.current_timestamp().alias(stamp_col)] if stamp_col else []))
    out = out.unionByName(markers.select(*cols))
    if not initial:
        out = target.join(touched, keys, "left_anti").select(*cols).unionByName(out)
    return out
