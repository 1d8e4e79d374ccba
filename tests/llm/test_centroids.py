"""Centroid clustering against plain rounds."""

import hashlib
import math

import numpy as np
import pytest

from lakemart.llm import centroids


def plain(rows, k=16, rounds=3, dims=64, scale=64):
    """Every vector against every centroid in every round, whole numbers only."""
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1]))
    c = [v for _, v in order[:k]]

    def assign():
        out = []
        for _, v in kept:
            d = [sum((a - b) ** 2 for a, b in zip(v, x)) for x in c]
            out.append((d.index(min(d)), min(d)))
        return out

    for _ in range(rounds):
        own = assign()
        for j in range(len(c)):
            mine = [v for (_, v), (a, _) in zip(kept, own) if a == j]
            if mine:
                c[j] = [sum(col) // len(mine) for col in zip(*mine)]
    own = assign()
    inertia = [sum(d for a, d in own if a == j) for j in range(len(c))]
    sha = [hashlib.sha256(",".join(map(str, x)).encode()).hexdigest() for x in c]
    return sorted(((i, a, d, inertia[a], sum(inertia), sha[a]) for (i, _), (a, d) in zip(kept, own)),
                  key=lambda r: (r[0] is None, r))


def found(spark, rows, **kw):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, cluster string, gap int").repartition(3)
    out = centroids.cluster(df, "vec_id", "embedding", **kw)
    return sorted((tuple(r) for r in out.collect()), key=lambda r: (r[0] is None, r))


@pytest.mark.parametrize("seed,spread", [(1, 0.2), (2, 1.0), (3, 4.0)])
def test_equals_plain_rounds(spark, seed, spread):
    r = np.random.default_rng(seed)
    centre = r.normal(size=(6, 8)) * spread
    rows = [(i, [float(np.float32(x)) for x in centre[i % 6] + r.normal(size=8)], "x", 1) for i in range(400)]
    kw = {"k": 7, "rounds": 5, "dims": 8, "scale": 64}
    assert found(spark, rows, **kw) == plain([x[:2] for x in rows], **kw)


def test_odd_rows(spark):
    same = [0.5, -1.25, 3.0]
    rows = ([(i, same, "x", 1) for i in range(40)] + [(1, same, "x", 1), (None, [9.0, 9.0, 9.0], "x", 1)]
            + [(50 + i, [float(i % 3), float(-i % 5), 0.0], "x", 1) for i in range(60)]
            + [(900, None, "x", 1), (901, [], "x", 1), (902, [1.0, 2.0], "x", 1), (903, [1.0, None, 2.0], "x", 1),
               (904, [float("nan"), 1.0, 1.0], "x", 1), (905, [float("inf"), 1.0, 1.0], "x", 1)])
    for k in (1, 4, 16):
        kw = {"k": k, "rounds": 3, "dims": 3, "scale": 4}
        assert found(spark, rows, **kw) == plain([x[:2] for x in rows], **kw)
    few = [(1, same, "x", 1), (2, [0.0, 0.0, 0.0], None, None)]
    assert found(spark, few, dims=3) == plain([x[:2] for x in few], dims=3)
    assert found(spark, rows[-6:], dims=3) == []
    assert found(spark, [], dims=3) == []


def test_large_components(spark):
    top = centroids.LIMIT / 64
    rows = [(i, [top * (1 if i & 1 else -1), float(i)], "x", 1) for i in range(12)]
    kw = {"k": 3, "rounds": 3, "dims": 2, "scale": 64}
    assert found(spark, rows, **kw) == plain([x[:2] for x in rows], **kw)
    beyond = [(i, [3e38 if i & 1 else -3e38, float(i)], "x", 1) for i in range(12)]
    assert found(spark, beyond, **kw) == found(spark, rows, **kw)


def test_only_expired_vectors_are_scanned(spark, monkeypatch):
    r = np.random.default_rng(5)
    rows = [(i, [float(10 * (i % 4)), *map(float, r.normal(size=3))], "x", 1) for i in range(2_000)]
    scanned = []
    real = centroids._scan

    def counting(df, *rest):
        out = real(df, *rest)
        scanned.append(out.count())
        return out

    monkeypatch.setattr(centroids, "_scan", counting)
    kw = {"k": 4, "rounds": 6, "dims": 4, "scale": 64}
    assert found(spark, rows, **kw) == plain([x[:2] for x in rows], **kw)
    assert scanned[0] == 2_000 and scanned[-1] < 1_000


def test_gap_filter_reaches_the_scan(spark):
    df = spark.range(10).selectExpr("cast(id as int) AS cluster", "cast(id as double) AS gap")
    path = centroids.cut_lineage(df, "gaps")
    plan = path.filter(centroids._within(np.array([1.0, 2.0]), np.array([3.0, 4.0])))._jdf.queryExecution().toString()
    assert "PushedFilters: [Or(" in plan and "GreaterThan(gap" in plan
