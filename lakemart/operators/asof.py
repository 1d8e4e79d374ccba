"""As-of join as a merge of two sorted streams.

Facts and versions go to partitions by (key, range of time): hot keys are cut at
the quantiles of their facts' times, other keys are one range.  Each range of a hot
key is handed the key's last version before it, so a partition needs nothing from
its neighbours.  Facts are shuffled once, with their own columns only, versions
once; in each partition two cursors run over both, and rows are taken by position.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.functions.dates import order_number
from lakemart.operators.joins import _one_per_start
from lakemart.operators.sequence import BUCKET, add_order_bucket, order_splits

ROWS_PER_PART = 500_000         # facts merged at once, about


def as_of_merge(facts: DataFrame, dim: DataFrame, keys: Sequence[str], fact_time: str, dim_start: str,
                take: Sequence[str], dim_keys: Sequence[str] | None = None, prefix: str = "",
                dim_order: Sequence[str] = (), rows_per_part: int = ROWS_PER_PART) -> DataFrame:
    """Every fact with ``take`` of the version of its key that has the latest
    ``dim_start <= fact_time``, NULL without one (facts without key or time too):
    the rows of :func:`~lakemart.operators.joins.as_of_join`.

    Of several versions of a key with one start, the one with the largest
    ``dim_order``, then the largest taken values, counts.
    """
    keys, take = list(keys), list(take)
    dkeys = list(dim_keys) if dim_keys else keys
    kind = facts.schema[fact_time].dataType
    names = [f"_k{i}" for i in range(len(keys))]
    versions = _one_per_start(dim, dkeys, dim_start, list(dim_order), take).dropna(subset=[*dkeys, dim_start]).select(
        *[F.col(k).alias(n) for k, n in zip(dkeys, names)], F.col(dim_start).cast(kind).alias("_s"),
        *[F.col(c).alias(f"_v{i}") for i, c in enumerate(take)])
    versions = versions.withColumn("_t", order_number("_s", kind))
    rows = facts.select(F.struct(*facts.columns).alias("_row"), *[F.col(k).alias(n) for k, n in zip(keys, names)],
                        order_number(fact_time, kind).alias("_t"))
    known = rows.select(*names, "_t").dropna()
    n = known.count()
    splits = order_splits(known, names, "_t", rows_per_part, null_keys=False) if n > rows_per_part else None
    if splits is None:
        rows, versions = rows.withColumn(BUCKET, F.lit(0)), versions.withColumn(BUCKET, F.lit(0))
    else:
        rows = add_order_bucket(rows, names, "_t", splits)
        versions = add_order_bucket(versions, names, "_t", splits)
        # a version is also handed to the later ranges up to the one in which the next version of its key starts
        last = splits.select(*[F.col(f"_sk{i}").alias(c) for i, c in enumerate(names)],
                             (F.size("_bounds") * F.col("_parts")).cast("int").alias("_last"))
        following = F.lead(BUCKET).over(Window.partitionBy(*names).orderBy("_t"))
        versions = versions.withColumn("_next", following).join(last, names, "left")
        until = F.coalesce("_next", "_last", F.lit(0))
        more = F.when(until > F.col(BUCKET), F.sequence(F.col(BUCKET) + 1, until)).otherwise(F.array().cast("array<int>"))
        versions = versions.withColumn(BUCKET, F.explode(F.concat(F.array(BUCKET), more))).drop("_next", "_last")
    parts = max(1, -(-n // rows_per_part)) * 2
    whole = F.lit(True)
    for c in [*names, "_t"]:
        whole = whole & F.col(c).isNotNull()
    place = F.pmod(F.xxhash64(*names, BUCKET), F.lit(parts))
    # facts that match nothing are spread by their contents
    rows = rows.withColumn("_part", F.when(whole, place).otherwise(F.pmod(F.xxhash64(F.to_json("_row")), F.lit(parts)))).drop(BUCKET)
    versions = versions.withColumn("_part", place).drop(BUCKET, "_s")
    out = T.StructType([*facts.schema.fields, *[T.StructField(prefix + c, dim.schema[c].dataType) for c in take]])

    def merge(left: pa.Table, right: pa.Table) -> pa.Table:
        fact = left["_row"].combine_chunks()
        fact = fact if isinstance(fact, pa.StructArray) else pa.concat_arrays(fact.chunks)
        a = left.select([*names, "_t"]).to_pandas().assign(_at=np.arange(left.num_rows)).dropna().sort_values("_t", kind="stable")
        b = right.select([*names, "_t"]).to_pandas().assign(_v=np.arange(right.num_rows)).sort_values("_t", kind="stable")
        found = np.full(left.num_rows, -1, np.int64)
        if len(a) and len(b):
            same = {c: b[c].dtype for c in [*names, "_t"]}
            m = pd.merge_asof(a.astype(same), b, on="_t", by=names, direction="backward")
            found[m["_at"].to_numpy()] = m["_v"].fillna(-1).to_numpy(np.int64)
        pick = pa.array(np.maximum(found, 0), mask=found < 0)
        return pa.Table.from_arrays([*fact.flatten(), *[right[f"_v{i}"].take(pick) for i in range(len(take))]],
                                    names=out.fieldNames())

    return rows.groupBy("_part").cogroup(versions.groupBy("_part")).applyInArrow(merge, out)
