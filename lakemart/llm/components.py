"""Connected components of a link table by alternating star contractions.

Each round replaces a node's links by links to the smallest node it knows:
the large star moves the larger neighbours of every node to the smallest of
its neighbourhood, the small star moves the smaller ones.  Rounds needed grow
with the logarithm of the number of nodes.  Every round is two partial
aggregates and two joins on narrow rows, written to the shared checkpoint
folder; the driver only sees one count and one checksum a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.session import cut_lineage

MAX_ROUNDS = 60                 # far above log2 of any table; guards against a fault


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = cut_lineage(both, "both")
    least = cut_lineage(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "least")
    return both.filter(F.col("b") > F.col("a")).join(least, "a").select(F.col("m").alias("a"), "b")


def _small_star(links: DataFrame) -> DataFrame:
    # a < b holds for every link: b's smaller neighbours move to the smallest of them
    least = cut_lineage(links.groupBy("b").agg(F.min("a").alias("m")), "least")
    moved = links.join(least, "b").filter(F.col("a") != F.col("m")).select(F.col("m").alias("a"), F.col("a").alias("b"))
    return moved.union(least.select(F.col("m").alias("a"), "b"))


def connected(links: DataFrame) -> DataFrame:
    """``links``: long columns ``a`` < ``b``.  Returns ``node``, ``root`` (the
    smallest node of its component) for every node that has a link."""
    current, seen = cut_lineage(links.select("a", "b").distinct(), "star"), None
    for _ in range(MAX_ROUNDS):
        state = current.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state == seen or state[0] == 0:
            break
        seen = state
        large = cut_lineage(_large_star(current).distinct(), "star")
        current = cut_lineage(_small_star(large).distinct(), "star")
    else:
        raise RuntimeError("components did not converge")
    return current.select(F.col("b").alias("node"), F.col("a").alias("root")) \
                  .union(current.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())
