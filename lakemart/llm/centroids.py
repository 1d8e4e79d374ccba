"""Exact centroid clustering with heap-ordered bounds.

Vectors of whole numbers are assigned to their nearest centroid (squared
Euclidean distance, ties to the smaller number), centroids move to the floor
of their vectors' means, and so on.  A scanned vector leaves its *gap*: the
distance to the second nearest centroid (lower bound of all others) less the
distance to its own (upper bound).  When centroid ``j`` moves by ``p_j``, the
gaps of its cluster shrink by at most ``p_j`` plus the largest other move.  That
drift is not subtracted from every vector but accumulated per cluster, and gaps
are stored with the drift at their time added: a vector can change its cluster
only once its stored gap is no more than its cluster's drift now.

The heap of a cluster is a set of sorted runs in storage: every round writes the
vectors it scanned, ordered by (cluster, gap) within each file.  Popping all
expired vectors is a range read, ``drift before < gap <= drift now`` of each
cluster, which skips the row groups and pages above it; runs are never
rewritten, and a vector is alive in the one run where its gap lies above the
drift.  No round shuffles vectors.  Means come from sums that are updated by the
vectors that moved.  The driver holds ``k`` centroids and their sums.

Distances are whole numbers, computed exactly; gaps are rounded down and drifts
up, so that rounding can only cause a needless scan.

Defined results: rows whose vector is null, has another number of components
than ``dims`` or holds null or non-finite ones take no part; components beyond
``+-2**26`` after scaling are clamped there, which keeps distances within 64
bits; an inertia beyond 64 bits is null; rows with a null identifier are
clustered like others but start a centroid only after all the rest; repeated rows
count as often as they occur; equal hashes are ordered by components; with fewer
rows than ``k`` there are fewer centroids; a centroid without vectors stays;
empty tables give no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.session import cut_lineage

LIMIT = 1 << 26                 # of scaled components
EXACT = 1 << 21                 # up to here products are exact in doubles
SLACK = 1e-9                    # relative rounding allowance of gaps and drifts


def scaled(vec: str, dims: int, scale: int) -> Column:
    """``floor(scale * x)`` of every component as array<int>, null for
    vectors that take no part."""
    v = F.col(vec)
    fits = F.coalesce((F.size(v) == dims) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x)
                                                     & (F.abs(x) < F.lit(float("inf")))), F.lit(False))
    whole = F.transform(v, lambda x: F.floor(F.greatest(F.lit(-float(LIMIT)), F.least(F.lit(float(LIMIT)),
                                                        x.cast("double") * F.lit(float(scale))))).cast("int"))
    return F.when(fits, whole)


def distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances (int64) of rows ``x`` to all centroids."""
    far = max(np.abs(x).max(initial=0), np.abs(centroids).max(initial=0))
    x, c = (x.astype(np.float64), centroids.astype(np.float64)) if far <= EXACT else (x.astype(np.int64), centroids)
    out = (x * x).sum(axis=1)[:, None] - 2 * (x @ c.T) + (c * c).sum(axis=1)[None, :]
    return out.astype(np.int64)


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _scan(rows: DataFrame, centroids: np.ndarray, drift: np.ndarray) -> DataFrame:
    """Nearest centroid and stored gap of each row of (vec_id, v, cluster);
    the cluster it had before is ``was``.  Written as a sorted run."""
    dims = centroids.shape[1]
    out = T.StructType([rows.schema["vec_id"], T.StructField("v", T.ArrayType(T.IntegerType())),
                        T.StructField("was", T.IntegerType()), T.StructField("cluster", T.IntegerType()),
                        T.StructField("gap", T.DoubleType())])

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            d = distances(_matrix(b["v"], dims), centroids)
            own = d.argmin(axis=1)
            at = np.arange(len(d))
            upper = np.sqrt(d[at, own].astype(np.float64))
            if d.shape[1] > 1:
                d[at, own] = np.iinfo(np.int64).max
                lower = np.sqrt(d.min(axis=1).astype(np.float64))
                gap = lower - upper + drift[own] - SLACK * (lower + upper + drift[own] + 1)
            else:
                gap = np.full(len(d), np.inf)
            yield pa.record_batch([b["vec_id"], b["v"], b["cluster"], pa.array(own.astype(np.int32)), pa.array(gap)],
                                  names=out.fieldNames())

    return cut_lineage(rows.mapInArrow(run, out).sortWithinPartitions("cluster", "gap"), "gap-run")


def _moved(run: DataFrame, k: int, dims: int) -> tuple[list[int], list[list[int]]]:
    """Change of each cluster's number of vectors and component sums by the
    vectors of ``run`` that changed their cluster."""
    def part(batches):
        change = np.zeros((k, dims + 1), np.int64)
        for b in batches:
            x = _matrix(b["v"], dims).astype(np.int64)
            x = np.concatenate([np.ones((len(x), 1), np.int64), x], axis=1)
            to, was = b["cluster"].to_numpy(), b["was"].to_numpy()
            np.add.at(change, to, x)
            np.subtract.at(change, was[was >= 0], x[was >= 0])
        at = np.flatnonzero(change.any(axis=1))
        if len(at):
            yield pa.record_batch([pa.array(at.astype(np.int32)), pa.array(change[at].tolist(), pa.list_(pa.int64()))],
                                  names=["cluster", "change"])

    parts = run.filter("was <> cluster").select("v", "was", "cluster").mapInArrow(part, "cluster int, change array<bigint>")
    total = (parts.select("cluster", F.posexplode("change").alias("j", "s"))
                  .groupBy("cluster", "j").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")))
    n, sums = [0] * k, [[0] * dims for _ in range(k)]
    for r in total.collect():                           # k x (dims + 1) rows at most
        if r.j:
            sums[r.cluster][r.j - 1] = int(r.s)
        else:
            n[r.cluster] = int(r.s)
    return n, sums


def _drifted(before: np.ndarray, after: np.ndarray) -> np.ndarray:
    """By how much the gaps of each cluster can have shrunk, rounded up."""
    move = np.sqrt(((after - before) ** 2).sum(axis=1).astype(np.float64)) * (1 + SLACK)
    others = np.array([np.delete(move, j).max(initial=0.0) for j in range(len(move))])
    return (move + others) * (1 + SLACK)


def _within(low: np.ndarray | None, high: np.ndarray | None) -> Column:
    """``low < gap <= high`` of the row's cluster, as a filter that reaches
    the scan; None: no bound."""
    k = len(low if low is not None else high)
    each = []
    for j in range(k):
        cond = F.col("cluster") == j
        if low is not None:
            cond = cond & (F.col("gap") > float(low[j]))
        if high is not None:
            cond = cond & (F.col("gap") <= float(high[j]))
        each.append(cond)
    return reduce(or_, each)


def cluster(df: DataFrame, id_col: str, vec_col: str, k: int = 16, rounds: int = 3, dims: int = 64,
            scale: int = 64) -> DataFrame:
    """Clusters of the vectors of ``df`` after ``rounds`` rounds of assigning
    and moving and one more assignment: one row per vector with ``vec_id``,
    ``cluster``, ``distance`` (squared, to its centroid), ``cluster_inertia``,
    ``inertia`` and ``centroid_sha256``.

    The first centroids are the ``k`` vectors whose ``1:<identifier>`` has the
    smallest SHA-256.
    """
    spark = df.sparkSession
    kept = (df.select(F.col(id_col).alias("vec_id"), scaled(vec_col, dims, scale).alias("v"))
              .filter(F.col("v").isNotNull()).withColumn("cluster", F.lit(-1)))
    order = F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    first = [r.v for r in kept.select("v", order.alias("h")).orderBy(F.col("h").asc_nulls_last(), "v").limit(k).collect()]
    out = T.StructType([kept.schema["vec_id"], T.StructField("cluster", T.IntegerType()),
                        T.StructField("distance", T.LongType())])
    if not first:
        return spark.createDataFrame([], out).withColumns(
            {"cluster_inertia": F.lit(None).cast("long"), "inertia": F.lit(None).cast("long"),
             "centroid_sha256": F.lit(None).cast("string")})
    k, at = len(first), np.asarray(first, np.int64)
    n, sums = [0] * k, [[0] * dims for _ in range(k)]
    drift = [np.zeros(k)]                               # of each round, accumulated
    runs = [_scan(kept, at, drift[0])]
    for r in range(1, rounds + 1):
        more, change = _moved(runs[-1], k, dims)
        n = [a + b for a, b in zip(n, more)]
        sums = [[a + b for a, b in zip(x, y)] for x, y in zip(sums, change)]
        after = np.asarray([[s // n[j] for s in sums[j]] if n[j] else at[j] for j in range(k)], np.int64)
        drift.append(drift[-1] + _drifted(at, after))
        at = after
        # a run is asked for the first time in the round after it was written, from then on above the last drift
        popped = [run.filter(_within(None if i == r - 1 else drift[r - 1], drift[r])) for i, run in enumerate(runs)]
        runs.append(_scan(reduce(DataFrame.unionAll, popped).select("vec_id", "v", "cluster"), at, drift[r]))
    alive = [run.filter(_within(drift[-1], None)) for run in runs[:-1]] + runs[-1:]

    def measure(batches):
        for b in batches:
            if b.num_rows:
                own = b["cluster"].to_numpy()
                x = _matrix(b["v"], dims).astype(np.int64) - at[own]
                yield pa.record_batch([b["vec_id"], b["cluster"], pa.array((x * x).sum(axis=1))], names=out.fieldNames())

    done = cut_lineage(reduce(DataFrame.unionAll, alive).select("vec_id", "v", "cluster").mapInArrow(measure, out), "clusters")
    inertia = dict.fromkeys(range(k), 0)
    inertia |= {r[0]: int(r[1]) for r in done.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)"))).collect()}

    def whole(x: int) -> Column:
        return F.lit(x if x < 1 << 63 else None).cast("long")

    digests = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in at]
    return done.select("vec_id", "cluster", "distance",
                       F.array(*[whole(inertia[j]) for j in range(k)])[F.col("cluster")].alias("cluster_inertia"),
                       whole(sum(inertia.values())).alias("inertia"),
                       F.array(*[F.lit(x) for x in digests])[F.col("cluster")].alias("centroid_sha256"))


def sql(k: int = 16, rounds: int = 3, dims: int = 64, scale: int = 64) -> str:
    """The same clusters in DuckDB's SQL (table ``embeddings``), every vector
    compared with every centroid in each round."""
    parts = [f"""
kept AS MATERIALIZED (
  SELECT vec_id, [CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
  FROM embeddings
  WHERE len(embedding) = {dims} AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = {dims}),
x AS MATERIALIZED (SELECT vec_id, unnest(range({dims})) AS j, unnest(v) AS c FROM kept),
first AS (SELECT vec_id, row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS k FROM kept),
c0 AS MATERIALIZED (SELECT k, j, c FROM x JOIN first USING (vec_id) WHERE k < {k})"""]
    for r in range(rounds + 1):
        parts.append(f"""
d{r} AS (
  SELECT vec_id, c{r}.k, sum((x.c - c{r}.c) * (x.c - c{r}.c))::BIGINT AS d FROM x JOIN c{r} USING (j) GROUP BY ALL),
a{r} AS MATERIALIZED (
  SELECT vec_id, k, d FROM d{r} QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, k) = 1)""")
        if r < rounds:
            parts.append(f"""
s{r} AS (SELECT k, j, sum(c) AS s, count(*) AS n FROM x JOIN a{r} USING (vec_id) GROUP BY ALL),
c{r + 1} AS MATERIALIZED (
  SELECT k, j, coalesce(((s - ((s % n) + n) % n) // n)::BIGINT, c) AS c FROM c{r} LEFT JOIN s{r} USING (k, j))""")
    return f"""WITH {','.join(parts)},
shown AS (SELECT k, sha256(string_agg(c::VARCHAR, ',' ORDER BY j)) AS centroid_sha256 FROM c{rounds} GROUP BY k)
SELECT vec_id, k::INTEGER AS cluster, d AS distance,
       sum(d) OVER (PARTITION BY k)::BIGINT AS cluster_inertia, sum(d) OVER ()::BIGINT AS inertia, centroid_sha256
FROM a{rounds} JOIN shown USING (k)"""
