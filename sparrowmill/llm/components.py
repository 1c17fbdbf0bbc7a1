"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparrowmill.session import materialize


def _nearest(pairs: DataFrame) -> DataFrame:
    """(u, v, m): m is the smallest of u and all its v."""
    least = pairs.groupBy(F.col("u").alias("_u")).agg(F.min("v").alias("m"))
    return pairs.join(least, F.col("u") == F.col("_u")).select("u", "v", F.least("u", "m").alias("m"))


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node with a link; root is the smallest node that links reach.

    Alternating star contraction: every node hands its larger neighbours, then its smaller ones, to the
    smallest neighbour, until each node hangs on its root. The number of rounds grows with the
    logarithm of the longest path. Each round is a grouped minimum and a join, so no component and no
    hub is ever in one task; rounds are stored, so a lost executor costs no more than one of them.
    """
    edges = links.filter(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    edges, mark = materialize(edges), None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _nearest(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = _nearest(large)
        small = small.select("u", F.col("m").alias("v")).union(small.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")))
        edges = materialize(small.distinct())
        seen = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == tuple(seen):
            break
        mark = tuple(seen)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
