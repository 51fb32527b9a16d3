"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeloom.llm.shared import keep


def _least(edges: DataFrame) -> DataFrame:
    # Written, so that the join below it shuffles both of its sides and Spark can split a hot node.
    return keep(edges.groupBy("u").agg(F.min("v").alias("m")))


def _state(edges: DataFrame):
    return edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the edges (u, v): the least node that it is connected to.

    Alternates two steps until nothing changes: each node passes the least of its neighbours and
    itself to its larger neighbours, then each node passes the least of its smaller neighbours to
    the others of them. The edges become stars around the least nodes; their number never grows and
    no step holds the neighbours of a node in one place. Loops, repeated edges and both directions
    of an edge are allowed; edges with a null are left out.
    """
    found = edges.where(F.col("u") != F.col("v"))
    found = keep(found.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before = None
    while (now := _state(found)) != before:
        before = now
        both = found.union(found.select("v", "u"))
        large = both.join(_least(both).withColumn("m", F.least("m", "u")), "u").where(F.col("v") > F.col("u"))
        large = keep(large.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        small = large.join(_least(large), "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
        found = keep(small.where(F.col("u") != F.col("v")).distinct())
    return found.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        found.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
