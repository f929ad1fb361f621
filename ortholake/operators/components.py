"""Connected components of an edge table, by alternating large-star and small-star steps.

Every step is a grouped ``min`` (combined map-side) and a join with that written minimum, so
a node with millions of neighbours is split by adaptive execution and never meets in one
task. The loop runs until every component is a star; there is no cap on rounds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ortholake.session import materialise


def _settled(edges: DataFrame) -> bool:
    """Whether every node has one smaller neighbour at most, and none that has one is a root:
    then each component is a star around its smallest node."""
    ends = edges.select(F.col("hi").alias("v"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("lo").alias("v"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    bad = ends.groupBy("v").agg(F.sum("up").alias("up"), F.max("down").alias("down")).filter("up > 1 or (up = 1 and down = 1)")
    return bad.isEmpty()


def star_forest(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """(id, component) for every node that has an edge: ``component`` is the smallest id that
    can be reached. Self loops, repeated edges and edges with a null end add nothing."""
    a, b = F.col(src), F.col(dst)
    e = materialise(edges.filter(a != b).select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).distinct(), "edges")
    while not _settled(e):
        both = e.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
            e.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        low = materialise(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "large")
        large = both.filter(F.col("v") > F.col("u")).join(low, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo"))
        large = materialise(large.distinct(), "large-star")
        low = materialise(large.groupBy("hi").agg(F.min("lo").alias("m")), "small")
        down = large.join(low, "hi").filter(F.col("lo") != F.col("m")).select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        e = materialise(down.unionByName(low.select("hi", F.col("m").alias("lo"))).distinct(), "small-star")
    roots = e.select(F.col("lo").alias("id"), F.col("lo").alias("component")).distinct()
    return e.select(F.col("hi").alias("id"), F.col("lo").alias("component")).unionByName(roots)


def connected_components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, component = smallest id reachable) for every node of ``nodes`` (its first column)."""
    ids = nodes.select(F.col(nodes.columns[0]).alias("id")).distinct()
    found = star_forest(edges)
    return ids.join(found, "id", "left").select("id", F.coalesce("component", "id").alias("component"))
