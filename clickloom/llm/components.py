"""Connected components of an edge list by alternating large-star and small-star rounds.

Every round links each node to the smallest neighbour it knows of; the edge list never grows beyond its number of
nodes and edges, and a node with very many edges is handled by partial minima and a join that Spark splits. Each
round is written to the shared folder, so lineage stays short and lost executors cost one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.session import materialise


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.min(F.xxhash64("u", "v"))).first())


def connected_components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """(node, component) of all nodes that have an edge; the component is its smallest node.

    Edges may repeat, point both ways or to themselves; edges with a null end are left out.
    """
    u, v = F.col(left), F.col(right)
    current = materialise(
        edges.where(u != v).select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).distinct(), "edges"
    )
    before = _state(current)
    while before[0]:
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        smallest = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.join(smallest, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(smallest, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        current = materialise(small.unionByName(smallest.withColumnRenamed("m", "v")).distinct(), "edges")
        after = _state(current)
        if after == before:
            break
        before = after
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
