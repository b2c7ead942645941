"""Connected components of a distributed edge list, by alternating large and small stars.

Each round joins every node's neighbours to the least of them; components become stars around their least
node in a number of rounds that grows with the logarithm of their size.  A hub's neighbours never meet in one
task: minima are summed by map tasks, and the join with them is split by AQE where a hub is hot (both of its
sides are read from tables, which lets it).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import written


#: Edges in one file of an intermediate table.
FILE_EDGES = 200_000


def _star(edges: DataFrame, large: bool, files: int) -> DataFrame:
    """(a, b) pairs with a > b: large stars join the greater neighbours of a node to its least, small stars the
    lesser ones and the node itself."""
    if large:
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = edges
    least = written(both.groupBy("a").agg(F.min("b").alias("m")).coalesce(files), "least")
    joined = both.join(least, "a").select("a", "b", F.least("a", "m").alias("m"))
    if large:
        out = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
    return written(out.where("a > b").distinct().coalesce(files), "star")


def _unfinished(edges: DataFrame) -> bool:
    """Whether some node has two edges to lesser nodes, or both a lesser and a greater neighbour."""
    ends = edges.select(F.col("a").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("b").alias("x"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    each = ends.groupBy("x").agg(F.sum("up").alias("up"), F.sum("down").alias("down"))
    return each.agg(F.count_if(F.expr("up > 1 or up > 0 and down > 0"))).first()[0] > 0


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node of an edge list of longs; root is the least node of its component.  Nulls,
    loops and repeated edges are ignored."""
    edges = edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"), F.col(a).alias("x"), F.col(b).alias("y"))
    edges = written(edges.where("x is not null and y is not null and a > b").select("a", "b").distinct(), "edges")
    files = 1 + edges.count() // FILE_EDGES
    while _unfinished(edges):
        edges = _star(_star(edges, True, files), False, files)
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
