"""SimHash near-duplicates with pigeonring candidate filtering.

Fingerprints: every word shingle of a text is hashed with XXH64 (seed 42);
bit ``b`` of the fingerprint is set when more than half of the hashes have
it.  Two texts are linked when their fingerprints differ in at most
``distance`` bits; groups are the connected components of the links.

Candidates: a fingerprint is a ring of ``SEGMENTS`` equal segments.  If two
rings differ in at most ``t`` bits in total, some segment starts a chain
around the ring whose first ``l`` segments together differ in at most
``floor(l * t / SEGMENTS)`` bits, for every ``l`` (the pigeonring principle).
With four segments and three bits the budgets are 0, 1, 2, 3: the first
segment is equal, the second adds at most one bit.  Those two conditions are
one equi-join on 32 bits (the side that has the extra bit set also offers the
key with the bit cleared); the third prunes inside the join, before and
with the full Hamming check.  Every pair within the distance is found; there
is no cap on a key's rows.

Work is on distinct fingerprints: copies of a text, however many, are one
row after a partial aggregate.  Components come from iterated star
contractions on the links (:mod:`lakemart.llm.components`).

Defined results: a null text counts as empty, an empty text has fingerprint
zero and is linked like any other; fewer words than a shingle make one
shingle of the whole sequence; a null identifier loses against any other as
the smallest of its component; repeated rows each get a row; empty tables
give no rows; extra columns are ignored.
"""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import short_batches
from lakemart.llm.components import connected
from lakemart.session import cut_lineage

SEGMENTS = 4
WIDTH = 64 // SEGMENTS
SEED = 42


def fingerprint_of(text: str, shingle: int) -> int:
    """Signed 64-bit SimHash of one text."""
    words = text.encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    joined, digest = b" ".join(words), xxhash.xxh64_digest
    if len(words) <= shingle:
        hashes = [digest(joined, SEED)]
    else:
        ends = list(accumulate((len(w) + 1 for w in words)))
        starts = [0, *ends]
        hashes = [digest(joined[s:e - 1], SEED) for s, e in zip(starts, ends[shingle - 1:])]
    n = len(hashes)
    bits = np.unpackbits(np.frombuffer(b"".join(hashes), np.uint8).reshape(n, 8), axis=1)
    ones = bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n).view(">i8")[0])


def fingerprint(text: str | Column, shingle: int = 3) -> Column:
    """SimHash (long) of a text column."""

    @F.arrow_udf("long")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([fingerprint_of(t or "", shingle) for t in texts.to_pylist()], pa.int64())

    return run(F.col(text) if isinstance(text, str) else text)


def _segment(fp: Column, i: int) -> Column:
    return F.shiftrightunsigned(fp, WIDTH * (i % SEGMENTS)).bitwiseAND(F.lit((1 << WIDTH) - 1))


def links(prints: DataFrame, distance: int = 3, fp: str = "fp") -> DataFrame:
    """All pairs (a < b) of the distinct fingerprints in ``prints`` that
    differ in at most ``distance`` bits."""
    budget = [n * distance // SEGMENTS for n in range(SEGMENTS + 1)]
    if budget[1] != 0 or budget[2] > 1:
        raise ValueError(f"distance must be below {SEGMENTS}")
    base = prints.select(F.col(fp).alias("fp"))

    def key(i: int, cleared: int | None = None) -> Column:
        second = _segment(F.col("fp"), i + 1)
        if cleared is not None:
            second = second.bitwiseXOR(F.lit(1 << cleared))
        return F.shiftleft(_segment(F.col("fp"), i), WIDTH).bitwiseOR(second)

    def rows(flips: bool) -> DataFrame:
        options = []
        for i in range(SEGMENTS):
            options.append(F.struct(F.lit(i).alias("i"), key(i).alias("k"), F.lit(False).alias("flip")))
            if flips and budget[2] == 1:
                for b in range(WIDTH):
                    has = _segment(F.col("fp"), i + 1).bitwiseAND(F.lit(1 << b)) != 0
                    options.append(F.when(has, F.struct(F.lit(i).alias("i"), key(i, b).alias("k"),
                                                        F.lit(True).alias("flip"))))
        return base.select("fp", F.explode(F.filter(F.array(*options), lambda x: x.isNotNull())).alias("o")) \
                   .select("fp", "o.i", "o.k", "o.flip")

    p, x = rows(True).alias("p"), rows(False).drop("flip").alias("x")
    diff = F.col("p.fp").bitwiseXOR(F.col("x.fp"))
    # differing bits of the first three segments of the chain: all but those of the last one
    last = F.when(F.col("p.i") == 0, _segment(diff, SEGMENTS - 1))
    for i in range(1, SEGMENTS):
        last = last.when(F.col("p.i") == i, _segment(diff, i + SEGMENTS - 1))
    third = F.bit_count(diff) - F.bit_count(last)
    on = ((F.col("p.i") == F.col("x.i")) & (F.col("p.k") == F.col("x.k"))
          & (F.col("p.flip") | (F.col("p.fp") < F.col("x.fp")))
          & (third <= budget[3]) & (F.bit_count(diff) <= distance))
    found = p.join(x, on).select(F.least("p.fp", "x.fp").alias("a"), F.greatest("p.fp", "x.fp").alias("b"))
    return found.distinct()


def _grouped(df: DataFrame, id_col: str, text_col: str, shingle: int, distance: int) -> DataFrame:
    """(doc_id, text hash, fp, root fingerprint, component_id) of every row."""
    short_batches(df.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit(""))
    docs = cut_lineage(df.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("th"),
                                 fingerprint(text_col, shingle).alias("fp")), "simhash")
    prints = cut_lineage(docs.groupBy("fp").agg(F.min("doc_id").alias("least")), "prints")
    found = cut_lineage(links(prints, distance), "links")
    roots = connected(found)                            # node, root: only linked fingerprints
    linked = cut_lineage(prints.join(roots, F.col("fp") == F.col("node")).select("fp", "root", "least"), "linked")
    least = linked.groupBy("root").agg(F.min("least").alias("of_root"))
    named = linked.join(least, "root").select("fp", "root", "of_root")
    named = cut_lineage(prints.join(named, "fp", "left")
                        .select("fp", F.coalesce("root", "fp").alias("root"),
                                F.when(F.col("root").isNull(), F.col("least")).otherwise(F.col("of_root"))
                                .alias("component_id")), "named")
    return docs.join(named, "fp").select("doc_id", "th", "fp", "root", "component_id")


def near_groups(df: DataFrame, id_col: str, text_col: str, shingle: int = 3, distance: int = 3) -> DataFrame:
    """One row per document: ``doc_id``, ``fp`` (long), ``component_id`` (the
    smallest identifier reachable over links, its own included)."""
    return _grouped(df, id_col, text_col, shingle, distance).select("doc_id", "fp", "component_id")


def keep_rows(df: DataFrame, id_col: str, text_col: str, shingle: int = 3, distance: int = 3) -> DataFrame:
    """One row of ``df`` for each group of near copies: the row with the
    smallest identifier (null when the group has none).  Of several rows with
    that identifier the one with the smallest text hash stays; of rows equal
    in both, any one."""
    found = cut_lineage(_grouped(df, id_col, text_col, shingle, distance), "near")
    first = F.col("doc_id").eqNullSafe(F.col("component_id"))
    keeper = (found.filter(first).groupBy("root", "th").agg(F.count("*").alias("n"), F.min("doc_id").alias("doc_id"))
              .groupBy("root").agg(F.min(F.struct("th", "n", "doc_id")).alias("k")))
    keeper = cut_lineage(keeper.select("root", F.col("k.th").alias("keep_th"), F.col("k.n").alias("n"),
                                       F.col("k.doc_id").alias("keep_id")), "keeper")
    gone = (found.join(keeper, "root").filter(~(first & (F.col("th") == F.col("keep_th"))))
            .select(F.col("doc_id").alias("i"), F.col("th").alias("h")).distinct())
    repeated = keeper.filter("n > 1").select(F.col("keep_id").alias("i"), F.col("keep_th").alias("h"))
    has_repeats = not repeated.isEmpty()
    gone = cut_lineage(gone.union(repeated) if has_repeats else gone, "gone")

    def same(other: DataFrame):
        return (df[id_col].eqNullSafe(other["i"])
                & (F.xxhash64(F.coalesce(df[text_col], F.lit(""))) == other["h"]))

    out = df.join(gone, same(gone), "left_anti")
    if has_repeats:
        again = df.join(repeated, same(repeated), "left_semi")
        again = (again.groupBy(F.col(id_col), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))))
                 .agg(F.first(F.struct(*[F.col(c) for c in df.columns])).alias("row")).select("row.*"))
        out = out.unionByName(again)
    return out
