"""Connected components of a graph of links, by alternating large-star and small-star steps.

Every step is a join and a grouped minimum; nothing is collected. The edges
of each round are stored, so a lost executor repeats at most a round, and no
plan grows with the number of rounds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heartwood.llm.common import anew, release, store


def _minimum(pairs: DataFrame) -> DataFrame:
    """(w, m): the least of u's neighbours and u itself, for every node w = u of (u, v)."""
    return pairs.groupBy("u").agg(F.min("v").alias("m")).select(anew("u").alias("w"), F.least("u", "m").alias("m"))


def _large(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    joined = both.join(_minimum(both), F.col("u") == F.col("w"))
    return joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = _minimum(down)
    joined = down.join(low, F.col("u") == F.col("w")).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return joined.unionByName(low.select(F.col("w").alias("u"), F.col("m").alias("v"))).where("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (u, v long); root is the least node of its component.

    The rounds end when the edges settle, which takes about the square of the
    logarithm of the longest path at most; an empty graph gives no rows.
    """
    edges = store(links.where("u <> v").select("u", "v").distinct(), "edges")
    seen = None
    while True:
        after = store(_small(_large(edges)), "edges")
        release(edges)
        edges = after
        # the edge set is a star forest, and stays as it is, once a round changes neither count nor sums
        now = edges.agg(F.count(F.lit(1)), F.sum(F.col("u").cast("decimal(38,0)")), F.sum(F.col("v").cast("decimal(38,0)")), F.sum(F.hash("u", "v").cast("long"))).first()
        if tuple(now) == seen:
            break
        seen = tuple(now)
    roots = edges.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
