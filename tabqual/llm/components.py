"""Connected components of a graph given as a table of edges.

Alternating large-star and small-star steps: each step joins the edges with the
smallest neighbour of each node, so no neighbourhood is gathered in one place. Smallest
neighbours are written before they are joined, so that a hot centre is a plain skewed
join, which Spark splits. Every step is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabqual.llm.shared import save


def _state(edges: DataFrame) -> tuple:
    h = F.xxhash64("u", "v")
    row = edges.agg(F.count("*"), F.bit_xor(h), F.sum(h.cast("decimal(38,0)"))).first()
    return tuple(row)


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``edges (u, v)``; a component is named by its smallest node.

    Loops and repeated edges count once. No edges give an empty table.
    """
    edges = edges.select("u", "v").filter("u <> v")
    edges = save(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    state = _state(edges)
    while state[0]:
        # large star: every larger neighbour of u joins u's smallest neighbour (or u itself)
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = save(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v")
        # small star: every smaller neighbour of u, and u, join the smallest of them
        large = save(large, "large")
        least = save(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = save(least.select("u", F.col("m").alias("v")).unionByName(small).distinct(), "edges")
        new = _state(edges)
        if new == state:
            break
        state = new
    star = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return star.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
