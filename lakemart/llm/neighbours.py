"""Approximate nearest neighbours by inner product: NN-descent and greedy search.

Graph: every distinct vector keeps its ``degree`` best neighbours found so
far.  The start is a few random-projection orders, in which blocks of nearby
rows are compared.  Then rounds of neighbours of neighbours: each node gathers
a sample of its neighbours and of the nodes that list it (Spark joins), the
pairs among them are compared with one matrix product per node, and a pair
that beats the worst neighbour of either end is offered to it.  Rounds end
when few lists change.

Search: a beam per query starts at the query's own node, which is always among
the nodes scored at the end; every node that has a link is in at least one
list.  Each hop joins the
best unexpanded nodes of the beam with the graph, scores their neighbours and
keeps the ``beam`` best, until every node in the beam is expanded.  Candidate
vectors are not sent to the queries: requests go to blocks of vectors of
fixed size and only scores that enter a beam come back.  The whole beam is
scored anew by the SQL sum that gives the reported scores.

Vectors are packed without loss and all products are in double precision:
among near copies the scores differ by less than single floats resolve.

Inner products become distances of unit vectors by one further component
(``sqrt(M^2 - |x|^2)``, M the largest norm), so long vectors are found too.

Equal vectors are one node: a group of copies, however large, is searched
once and expanded to its smallest identifiers at the end.

Defined results: rows whose vector or identifier is null, whose vector is
empty, all zero, or holds null or non-finite components take no part; shorter
vectors count as padded with zeros; repeated identifiers count once, with the
smallest of their vectors; fewer candidates than asked for are all returned;
ties go to the smaller identifier; empty tables give no rows; extra columns
are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from lakemart.llm.common import short_batches
from lakemart.session import cut_lineage, release_shuffles

DEGREE = 30                     # neighbours kept per node
SAMPLE = 15                     # neighbours of each kind that take part in a round
REVERSE = 15                    # reverse links added to each list for the search
ORDERS = 4                      # random-projection orders of the start
BLOCK = 64                      # rows compared with each other in an order
ROUNDS = 12                     # at most; rounds end earlier when lists settle
SETTLED = 0.03                  # share of changed neighbours below which lists are settled
BEAM = 400                      # nodes kept per query
EXPAND = 100                    # nodes expanded per hop
HOPS = 60                       # a guard; beams end when all their nodes are expanded
STORE = 4096                    # vectors per block during the search
ROWS = 8192                     # rows per Arrow batch; rows are narrow
NOTHING = float("-inf")         # a floor that any score passes


# ------------------------------------------------------------- vectors

def usable(vec: str) -> Column:
    """Is the vector fit to take part?"""
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.col(vec).isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(vec, lambda x: x != 0)


def _dot(a: Column, b: Column) -> Column:
    """Inner product in double precision; the shorter vector is padded with zeros."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.coalesce(x.cast("double") * y.cast("double"), F.lit(0.0))),
                       F.lit(0.0), lambda s, x: s + x)


def _pack(vec: str, dim: int, kind: str) -> Column:
    """Vector padded with zeros, as packed numbers of type ``kind``."""

    @F.arrow_udf("binary")
    def run(rows: pa.Array) -> pa.Array:
        return _binary(_padded(rows, dim), kind)

    return run(F.col(vec))


def _padded(rows: pa.Array, dim: int) -> np.ndarray:
    flat = rows.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    ends = np.cumsum(rows.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)) if len(rows) else np.zeros(0, int)
    out = np.zeros((len(rows), dim))
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64) if len(rows) else ends
    row = np.repeat(np.arange(len(rows)), ends - starts)
    out[row, np.arange(len(flat)) - starts[row]] = flat
    return out


def _binary(x: np.ndarray, kind: str) -> pa.Array:
    data = np.ascontiguousarray(x, kind)
    width = data.shape[1] * data.itemsize
    raw = data.tobytes()
    return pa.array([raw[i * width:(i + 1) * width] for i in range(len(data))], pa.binary())


def _matrix(col: pa.Array, kind: str) -> np.ndarray:
    rows = col.to_pylist()
    return np.frombuffer(b"".join(rows), kind).reshape(len(rows), -1).astype(np.float64)


def _completed(col: pa.Array, kind: str, largest: float) -> np.ndarray:
    """Vectors scaled to the largest norm and completed to length one."""
    x = _matrix(col, kind) / largest
    rest = np.sqrt(np.maximum(0.0, 1.0 - np.einsum("ij,ij->i", x, x)))
    return np.hstack([x, rest[:, None]])


def _by_key(batches, key: str, least: int):
    """Regroup batches sorted by ``key`` into tables that end at a key's end
    and have at least ``least`` rows if more follow."""
    held, n = [], 0
    for b in batches:
        held.append(b)
        n += b.num_rows
        if n >= least:
            t = pa.Table.from_batches(held)
            k = t.column(key).to_numpy()
            cut = int(np.searchsorted(k, k[-1], side="left"))
            if cut:
                yield t.slice(0, cut)
                held, n = t.slice(cut).to_batches(), len(k) - cut
    if n:
        yield pa.Table.from_batches(held)


# ------------------------------------------------------------- start

def _start(nodes: DataFrame, n: int, dim: int, kind: str, largest: float, seed: int) -> DataFrame:
    """Links (u, v, s) among rows that are close in an order by random
    hyperplanes."""
    bits = max(1, min(30, int(np.log2(max(2, n / BLOCK)))))
    rng = np.random.default_rng(seed)
    planes = rng.standard_normal((dim + 1, bits + 1))

    @F.arrow_udf("double")
    def place(vecs: pa.Array) -> pa.Array:
        p = _completed(vecs, kind, largest) @ planes
        code = (p[:, :bits] > 0) @ (1 << np.arange(bits, dtype=np.int64))
        return pa.array(code + 0.5 + np.arctan(p[:, bits]) / np.pi)

    def compare(batches):
        rest = None
        for b in batches:
            t = pa.Table.from_batches([b])
            rest = t if rest is None else pa.concat_tables([rest, t])
            whole = rest.num_rows // BLOCK * BLOCK
            if whole:
                yield from best(rest.slice(0, whole))
                rest = rest.slice(whole)
        if rest is not None and rest.num_rows > 1:
            yield from best(rest)

    def best(t):
        ids, x = t.column("node").to_numpy(), _completed(t.column("vec").combine_chunks(), kind, largest)
        for i in range(0, len(ids), BLOCK):
            own, y = ids[i:i + BLOCK], x[i:i + BLOCK]
            s = y @ y.T
            np.fill_diagonal(s, -9)
            k = min(len(own) - 1, DEGREE if len(ids) <= BLOCK else DEGREE // 2)
            if k > 0:
                top = np.argpartition(-s, k - 1, axis=1)[:, :k]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(own, k)), pa.array(own[top].reshape(-1)),
                     pa.array(np.take_along_axis(s, top, 1).reshape(-1))], names=["u", "v", "s"])

    placed = nodes.withColumn("at", place("vec"))
    return (placed.repartitionByRange(max(1, n // 2048), "at").sortWithinPartitions("at")
            .select("node", "vec").mapInArrow(compare, "u long, v long, s double"))


# ------------------------------------------------------------- descent

def _merge(links: DataFrame, turn: int) -> DataFrame:
    """The best ``DEGREE`` links of each node from (u, v, s, new), in one
    shuffle by node, with ``pick``: whether a link takes part in the next
    round, and on each node's first link (``k`` = 1) ``worst``: the score an
    offer has to beat."""
    node = Window.partitionBy("u")
    best = node.orderBy(F.desc("s"), "v")
    draw = Window.partitionBy("u", "new").orderBy(F.xxhash64("u", "v", F.lit(turn)), "v")
    kept = (links.repartition("u").groupBy("u", "v").agg(F.max("s").alias("s"), F.min("new").alias("new"))
            .withColumn("k", F.row_number().over(best)).filter(F.col("k") <= DEGREE))
    # a list that is not full takes any offer
    full = F.max("k").over(node) >= DEGREE
    return (kept.withColumn("worst", F.when(full, F.min("s").over(node)).otherwise(F.lit(-9.0)))
            .withColumn("pick", F.row_number().over(draw) <= SAMPLE))


def _compare_round(kind: str, largest: float):
    """Local joins: (u, v, new, vec, worst) sorted by u -> offers (u, v, s)."""

    def run(batches):
        for t in _by_key(batches, "u", 40_000):
            u, v = t.column("u").to_numpy(), t.column("v").to_numpy()
            fresh, worst = t.column("new").to_numpy(zero_copy_only=False), t.column("worst").to_numpy()
            x = _completed(t.column("vec").combine_chunks(), kind, largest)
            first = np.concatenate([[0], np.flatnonzero(np.diff(u)) + 1])
            sizes = np.diff(np.concatenate([first, [len(u)]]))
            groups = np.repeat(np.arange(len(first)), sizes)
            place = np.arange(len(u)) - first[groups]
            a, b, s = [], [], []
            for lo in range(0, len(first), 256):
                rows = slice(first[lo], first[lo + 256] if lo + 256 < len(first) else len(u))
                g, p, m = groups[rows] - lo, place[rows], int(sizes[lo:lo + 256].max())
                k = min(256, len(first) - lo)
                ids, new = np.full((k, m), -1), np.zeros((k, m), bool)
                bound, y = np.full((k, m), np.inf), np.zeros((k, m, x.shape[1]))
                has = np.zeros((k, m), bool)
                ids[g, p], new[g, p], bound[g, p], y[g, p], has[g, p] = v[rows], fresh[rows], worst[rows], x[rows], True
                score = y @ y.transpose(0, 2, 1)
                ok = (has[:, :, None] & has[:, None, :] & (new[:, :, None] | new[:, None, :])
                      & (ids[:, :, None] != ids[:, None, :]) & (score > bound[:, :, None]))
                i, j, l = np.nonzero(ok)
                a.append(ids[i, j]), b.append(ids[i, l]), s.append(score[i, j, l])
            a, b, s = np.concatenate(a), np.concatenate(b), np.concatenate(s)
            order = np.lexsort((b, a))
            a, b, s = a[order], b[order], s[order]
            once = np.ones(len(a), bool)
            once[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
            yield pa.RecordBatch.from_arrays([pa.array(a[once]), pa.array(b[once]), pa.array(s[once])], names=["u", "v", "s"])

    return run


def graph(nodes: DataFrame, n: int, dim: int, kind: str, largest: float) -> DataFrame:
    """NN-descent over (node, vec), packed as ``kind``: the links (u, v, s)."""
    spark = nodes.sparkSession
    links = None
    for t in range(ORDERS):
        some = _start(nodes, n, dim, kind, largest, 17 + t)
        links = some if links is None else links.union(some)
    links = cut_lineage(_merge(links.withColumn("new", F.lit(True)), 0), "graph")
    for turn in range(1, ROUNDS + 1):
        changed = links.filter("new").count()
        if changed <= SETTLED * n * DEGREE:
            break
        picked = links.filter("pick")
        both = picked.select("u", "v", "new").union(picked.select(F.col("v").alias("u"), F.col("u").alias("v"), "new"))
        draw = Window.partitionBy("u", "new").orderBy(F.xxhash64("u", "v", F.lit(turn)), "v")
        both = (both.repartition("u").groupBy("u", "v").agg(F.max("new").alias("new"))
                .withColumn("k", F.row_number().over(draw)).filter(F.col("k") <= SAMPLE).drop("k"))
        worst = links.filter("k = 1").select(F.col("u").alias("node"), "worst")
        known = nodes.join(worst, "node", "left").select(
            F.col("node").alias("v"), "vec", F.coalesce("worst", F.lit(-9.0)).alias("worst"))
        offers = (both.join(known, "v").select("u", "v", "new", "vec", "worst").repartition("u").sortWithinPartitions("u")
                  .mapInArrow(_compare_round(kind, largest), "u long, v long, s double").withColumn("new", F.lit(True)))
        older = links.select("u", "v", "s", (F.col("new") & ~F.col("pick")).alias("new"))
        links = cut_lineage(_merge(older.union(offers), turn), "graph")
        release_shuffles(spark)
    return links.select("u", "v", "s")


# ------------------------------------------------------------- search

def _score_requests(kind: str):
    """Rows sorted by (block, kind): vectors of a block (kind 0), then requests
    (kind 1: query, query vector, floor, nodes) -> (q, node, s) not below the floor."""

    def run(batches):
        block, parts, ids, x = None, [], None, None
        for b in batches:
            t = pa.Table.from_batches([b])
            blocks, kinds = t.column("block").to_numpy(), t.column("kind").to_numpy()
            cuts = np.flatnonzero((np.diff(blocks) != 0) | (np.diff(kinds) != 0)) + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(blocks)]):
                part = t.slice(lo, hi - lo)
                if blocks[lo] != block:
                    block, parts, ids = blocks[lo], [], None
                if kinds[lo] == 0:
                    parts.append((part.column("id").to_numpy(), _matrix(part.column("vec").combine_chunks(), kind)))
                    continue
                if not parts:
                    continue
                if ids is None:
                    ids, x = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
                    order = np.argsort(ids)
                    ids, x = ids[order], x[order]
                y, floors = _matrix(part.column("vec").combine_chunks(), kind), part.column("floor").to_numpy()
                lists = part.column("nodes").combine_chunks()
                flat, width = lists.flatten().to_numpy(), lists.value_lengths().to_numpy()
                row = np.repeat(np.arange(len(width)), width)
                at = np.searchsorted(ids, flat)
                q, out = part.column("id").to_numpy(), ([], [], [])
                for i in range(0, len(flat), 50_000):
                    r = row[i:i + 50_000]
                    s = np.einsum("ij,ij->i", x[at[i:i + 50_000]], y[r])
                    good = s >= floors[r]      # equal scores go to the smaller node
                    for o, v in zip(out, (q[r][good], flat[i:i + 50_000][good], s[good])):
                        o.append(v)
                if out[0]:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(o)) for o in out], names=["q", "node", "s"])

    return run


def _lists(links: DataFrame) -> DataFrame:
    """(node, near): each node's links, the ``REVERSE`` best of the nodes that
    list it, and the nodes that would else be in no list.  Such a node joins
    the list of the one of its neighbours that the fewest nodes list, so that
    a neighbour of many nodes does not get a long list."""
    better = Window.partitionBy("u").orderBy(F.desc("s"), "v")
    back = (links.select(F.col("v").alias("u"), F.col("u").alias("v"), "s")
            .withColumn("k", F.row_number().over(better)).filter(F.col("k") <= REVERSE).select("u", "v"))
    near = cut_lineage(links.select("u", "v").union(back).distinct(), "near")
    missing = links.join(near.select(F.col("v").alias("u")).distinct(), "u", "left_anti")
    listed = links.groupBy("v").agg(F.count("*").alias("n"))
    fewest = Window.partitionBy("u").orderBy("n", F.desc("s"), "v")
    kept = (missing.join(listed, "v").withColumn("k", F.row_number().over(fewest)).filter("k = 1")
            .select(F.col("v").alias("u"), F.col("u").alias("v")))
    return near.union(kept).groupBy(F.col("u").alias("node")).agg(F.collect_set("v").alias("near"))


def _own_score(vec: str, kind: str) -> Column:
    @F.arrow_udf("double")
    def run(rows: pa.Array) -> pa.Array:
        x = _matrix(rows, kind)
        return pa.array(np.einsum("ij,ij->i", x, x))

    return run(F.col(vec))


def search(links: DataFrame, nodes: DataFrame, queries: DataFrame, n: int, kind: str, beam: int = BEAM) -> DataFrame:
    """Greedy search for ``queries`` (q: a node, qvec): beams (q, node, s)."""
    spark = nodes.sparkSession
    blocks = max(1, -(-n // STORE))
    block = F.pmod(F.xxhash64("node"), F.lit(blocks)).cast("int")
    lists = cut_lineage(_lists(links), "lists")
    store = cut_lineage(nodes.withColumn("block", block), "store").select(
        "block", F.lit(0).alias("kind"), F.col("node").alias("id"), "vec",
        F.lit(None).cast("double").alias("floor"), F.lit(None).cast("array<long>").alias("nodes"))
    queries = cut_lineage(queries, "queries")
    beams = cut_lineage(queries.select("q", F.col("q").alias("node"), _own_score("qvec", kind).alias("s"),
                                       F.lit(False).alias("done"), F.lit(True).alias("pick"),
                                       F.lit(NOTHING).alias("floor")), "beams")
    for hop in range(HOPS):
        picks = beams.filter("pick").select("q", "node", "floor")
        if picks.isEmpty():
            break
        asked = (picks.join(lists, "node").select("q", "floor", F.explode("near").alias("node"))
                 .withColumn("block", block).repartition("q")
                 .groupBy("q", "block").agg(F.collect_set("node").alias("nodes"), F.max("floor").alias("floor")))
        asked = asked.join(queries, "q").select(
            "block", F.lit(1).alias("kind"), F.col("q").alias("id"), F.col("qvec").alias("vec"), "floor", "nodes")
        scored = (store.union(asked).repartition("block").sortWithinPartitions("block", "kind")
                  .mapInArrow(_score_requests(kind), "q long, node long, s double"))
        older = beams.select("q", "node", "s", (F.col("done") | F.col("pick")).alias("done"))
        beams = cut_lineage(_next_beams(older.union(scored.withColumn("done", F.lit(False))), beam), "beams")
        release_shuffles(spark)
    return beams.select("q", "node", "s")


def _next_beams(found: DataFrame, beam: int) -> DataFrame:
    """The ``beam`` best nodes of each query, in one shuffle by query, with
    the nodes to expand next (``pick``) and the score to beat (``floor``)."""
    query = Window.partitionBy("q")
    order = query.orderBy(F.desc("s"), "node")
    undone = Window.partitionBy("q", "done").orderBy(F.desc("s"), "node")
    kept = (found.repartition("q").groupBy("q", "node").agg(F.max("s").alias("s"), F.max("done").alias("done"))
            .withColumn("k", F.row_number().over(order)).filter(F.col("k") <= beam))
    full = F.max("k").over(query) >= beam
    return (kept.withColumn("floor", F.when(full, F.min("s").over(query)).otherwise(F.lit(NOTHING)))
            .withColumn("pick", ~F.col("done") & (F.row_number().over(undone) <= EXPAND)).drop("k"))


# ------------------------------------------------------------- whole operator

RESULT = "query_id long, rank int, vec_id long, score double"


def nearest(df: DataFrame, id_col: str, vec_col: str, is_query: Column, k: int = 20, beam: int = BEAM) -> DataFrame:
    """The ``k`` nearest other rows of every row with ``is_query`` (an
    expression of ``id_col``): query_id, rank, vec_id, score."""
    spark = df.sparkSession
    short_batches(spark, ROWS)
    rows = (df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("v"), is_query.alias("asks"))
            .filter(F.col("id").isNotNull() & usable("v"))
            .groupBy("id").agg(F.min("v").alias("v"), F.max("asks").alias("asks")))
    rows = cut_lineage(rows, "vectors")
    # equal vectors are one node, named by its smallest identifier
    nodes = cut_lineage(rows.groupBy("v").agg(F.min("id").alias("node")), "nodes")
    seen = nodes.agg(F.count("*"), F.max(F.size("v")), F.max(F.sqrt(_dot(F.col("v"), F.col("v"))))).first()
    n, dim, largest = seen
    if n == 0:
        return spark.createDataFrame([], RESULT)
    kind = "<f4" if isinstance(df.schema[vec_col].dataType.elementType, FloatType) else "<f8"
    packed = cut_lineage(nodes.select("node", _pack("v", dim, kind).alias("vec")), "packed")
    links = graph(packed, n, dim, kind, largest)
    members = cut_lineage(rows.join(nodes, "v").select("id", "node", "asks"), "members")
    asking = members.filter("asks")
    of_node = packed.join(asking.select("node").distinct(), "node")
    beams = search(links, packed, of_node.select(F.col("node").alias("q"), F.col("vec").alias("qvec")), n, kind,
                   max(beam, k + 1))
    # the whole beam and the query's own node, scored by one fixed sum
    own = of_node.select(F.col("node").alias("q"), "node")
    top = beams.select("q", "node").union(own).distinct()
    top = top.join(nodes.withColumnRenamed("v", "b"), "node").join(
        nodes.select(F.col("node").alias("q"), F.col("v").alias("a")), "q")
    exact = top.select("q", "node", _dot(F.col("a"), F.col("b")).alias("score"))
    # k + 1 members of a node are enough for any query
    by_id = Window.partitionBy("node").orderBy("id")
    some = members.withColumn("k", F.row_number().over(by_id)).filter(F.col("k") <= k + 1).select("node", "id")
    by_score = Window.partitionBy("q").orderBy(F.desc("score"), "id")
    found = cut_lineage(exact.join(some, "node").withColumn("k", F.row_number().over(by_score))
                        .filter(F.col("k") <= k + 1).select("q", "id", "score"), "found")
    last = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.join(asking.select(F.col("node").alias("q"), F.col("id").alias("query_id")), "q")
            .filter(F.col("id") != F.col("query_id")).select("query_id", F.col("id").alias("vec_id"), "score")
            .withColumn("rank", F.row_number().over(last)).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
