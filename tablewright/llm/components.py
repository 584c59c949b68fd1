"""Connected components of a graph given as edges.

Alternating star contraction: each round hangs every node's larger neighbours, then its smaller ones, on the least node
seen, which needs a number of rounds logarithmic in the size of a component. A node's neighbours are never gathered:
a round is two minima with map-side combining and two joins with one row per node on the other side, which adaptive
execution can split where a node has very many neighbours. Each round is written, so lineage stays short.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tablewright.llm.shared import written


def _least(pairs: DataFrame) -> DataFrame:
    """The least of each node's neighbours; written, so that a join with it meets plain exchanges."""
    return written(pairs.groupBy("u").agg(F.min("v").alias("m")), "component-least")


def _all_stars(pairs: DataFrame) -> bool:
    """Whether every node hangs on one other that itself hangs on none."""
    ends = pairs.select(F.col("u").alias("x"), F.lit(1).alias("hangs"), F.lit(0).alias("holds"))
    ends = ends.unionByName(pairs.select(F.col("v").alias("x"), F.lit(0).alias("hangs"), F.lit(1).alias("holds")))
    sums = ends.groupBy("x").agg(F.sum("hangs").alias("hangs"), F.max("holds").alias("holds"))
    return sums.filter("hangs > 1 or hangs = 1 and holds = 1").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """``edges`` has whole numbers ``a`` and ``b``; returns ``node`` and ``component``, the least node it can reach.

    Loops and repeated edges do no harm. Nodes without an edge to another node are not returned.
    """
    larger, smaller = F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    pairs = written(edges.filter("a <> b").select(larger, smaller).distinct(), "components")
    while not _all_stars(pairs):
        # Large star: neighbours above u go to the least of u and its neighbours.
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = _least(both)
        hung = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
        hung = written(hung.distinct(), "components")
        # Small star: neighbours below u, and u, go to the least of them.
        least = _least(hung)
        moved = hung.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        pairs = written(moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "components")
    roots = pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
