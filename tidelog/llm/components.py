"""Connected components of a graph given as edges, by alternating large-star and small-star steps.

Each round is joins and grouped minima (pre-aggregated before the shuffle); a node of any degree is only more rows, and
nothing is collected but a fingerprint of the edge set. Rounds are cut by written tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import stored


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of `edges` (a, b): root is the smallest node that is reachable from it.

    Loops and repeated edges change nothing; no edges give no rows.
    """
    edges = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = stored(edges, "edges")
    before, now = None, _fingerprint(edges)
    while before != now:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        smallest = both.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(smallest, F.col("a") == F.col("u")).filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        near = large.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
        moved = large.join(near, F.col("a") == F.col("u")).filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = stored(moved.unionByName(near.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct(), "edges")
        before, now = now, _fingerprint(edges)
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
