"""Connected components of a table of links, without gathering it anywhere.

Links are contracted by alternating star steps: every node's larger
neighbours are linked to its smallest one, then its smaller neighbours are.
Each step is one grouped minimum and one join, both split by node; the
number of links never grows, and components become stars in few rounds
(about the logarithm of their diameter).  Every round is written to the
shared folder, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nestflow.llm.common import saved


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, root (the component's smallest node) for every node of a link but the roots themselves.

    ``links`` may hold a link twice, in either direction, or from a node to itself.
    """
    low, high = F.least(a, b), F.greatest(a, b)
    # A star has every link from a larger node to the component's smallest.
    edges = saved(links.select(high.alias("u"), low.alias("v")).where("u <> v").distinct(), "links")
    while True:
        large = _large_star(edges)
        small = saved(_small_star(large), "links")
        # Done when no node has two links down and no target has a link down.
        tops = small.select(F.col("v").alias("u")).distinct()
        open_nodes = small.join(tops, "u", "left_semi").limit(1).count()
        doubled = small.groupBy("u").count().where("count > 1").limit(1).count()
        edges = small
        if not open_nodes and not doubled:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node's larger neighbours are linked to its smallest neighbour or itself."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours are linked to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                                                            F.struct(F.col("u").alias("u"), F.col("m").alias("v")))).alias("x"))
    return moved.select("x.u", "x.v").where("u <> v").distinct()
