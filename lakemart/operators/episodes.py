"""SCD2 histories in which a deleted key may come back.

The table keeps every event of a key, upserts and deletes, each with the instant
at which the next one ends it.  A key's live times are islands of upserts between
deletes: ``episode_start`` names the island of a version.  All columns follow from
the set of events alone, so batches may come in any order, split or repeated;
late deletes cut an island in two, late upserts reopen one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.functions.dates import minus_millis
from lakemart.operators.cdc import DELETE, UPDATE_PRE
from lakemart.operators.dedupe import dedupe
from lakemart.operators.joins import bounded_broadcast
from lakemart.operators.merge import without
from lakemart.operators.sequence import carry_forward, is_bucketable, order_splits

START, END, CURRENT, DELETED, EPISODE, ENDED_BY = "start_at", "end_at", "is_current", "_is_delete", "episode_start", "ended_by"


def reopen_apply(target: DataFrame | None, changes: DataFrame, keys: Sequence[str], seq: str, attrs: Sequence[str],
                 change_col: str, delete_values: Sequence[str] = (DELETE,), drop_values: Sequence[str] = (UPDATE_PRE,),
                 tiebreak: Sequence[str] = (), end_offset_ms: int = 1) -> DataFrame:
    """Apply a batch of changes; ``target`` is an earlier result or None.

    One row per key and instant ``seq``: a version (``attrs``) or a delete
    (``_is_delete``, attributes NULL).  A version ends ``end_offset_ms`` before the
    key's next event (``ended_by`` ``update`` or ``delete``), or is current.  At
    one instant a delete beats an upsert, then the larger ``tiebreak`` and
    attributes win.  Rows without ``seq`` are ignored; NULL keys are a key.
    """
    keys, attrs = list(keys), list(attrs)
    ch = changes.filter(~F.coalesce(F.col(change_col).isin(*drop_values), F.lit(False)) & F.col(seq).isNotNull())
    gone = F.coalesce(F.col(change_col).isin(*delete_values), F.lit(False))
    cols = list(dict.fromkeys([*keys, seq, *attrs, *tiebreak]))
    batch = ch.select(*[F.col(c) if c in (*keys, seq) else F.when(~gone, F.col(c)).alias(c) for c in cols], gone.alias(DELETED))
    events = batch
    if target is not None:
        touched = bounded_broadcast(batch.select(*keys).distinct())
        rest = without(target, touched, keys, null_safe=True)
        history = target.join(touched.select(*[F.col(k).alias(f"_t{i}") for i, k in enumerate(keys)]),
                              [F.col(k).eqNullSafe(F.col(f"_t{i}")) for i, k in enumerate(keys)], "left_semi")
        events = history.select(*cols, DELETED).unionByName(batch)
    events = dedupe(events, [*keys, seq], [DELETED, *tiebreak, *[a for a in attrs if a not in tiebreak]])

    splits = order_splits(events.select(*keys, seq), keys, seq) if is_bucketable(events, seq) else None

    def carry(df: DataFrame, cols: list[str], out: list[str], **kw) -> DataFrame:
        return carry_forward(df, keys, [seq], cols, out, skew_safe=splits is not None, splits=splits, **kw)

    events = carry(events, [DELETED], ["_before"], include_current=False)
    events = events.withColumn("_at", F.col(seq))
    events = carry(events, ["_at", DELETED], ["_next", "_next_gone"], include_current=False, descending=True)
    opens = ~F.col(DELETED) & F.coalesce(F.col("_before"), F.lit(True))
    events = carry(events.withColumn("_open", F.when(opens, F.col(seq))), ["_open"], ["_island"])
    version = ~F.col(DELETED)
    out = events.select(
        *cols, F.col(seq).alias(START),
        F.when(version, minus_millis("_next", end_offset_ms)).alias(END),
        (version & F.col("_next").isNull()).alias(CURRENT), DELETED,
        F.when(version, F.col("_island")).alias(EPISODE),
        F.when(version, F.when(F.col("_next_gone"), "delete").when(F.col("_next").isNotNull(), "update")).alias(ENDED_BY))
    return out if target is None else rest.select(*out.columns).unionByName(out)


def live_intervals(history: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key and island: ``episode_start``, ``episode_end`` (NULL while
    live) and the number of ``versions``."""
    return (history.filter(~F.col(DELETED)).groupBy(*keys, EPISODE)
            .agg(F.when(~F.max(CURRENT), F.max(END)).alias("episode_end"), F.count(F.lit(1)).alias("versions")))
