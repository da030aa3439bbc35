"""Connected components by alternating large and small stars.

Each half of a round is one shuffle over the edges that are left and one join with
the smallest neighbours; the edges of a half are stored in the shared folder, so
lineage and plans stay short. Edges always lead from the larger node to the smaller.
Rounds end when the edges are stars already, which is asked before the first one
too. Edges or components never reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.tables import stored


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node has either one edge to a smaller node or only edges from larger ones."""
    end = lambda node, up: F.struct(F.col(node).alias("node"), F.lit(up).alias("up"))
    ends = edges.select(F.explode(F.array(end("u", 1), end("v", 0))).alias("e")).select("e.*")
    nodes = ends.groupBy("node").agg(F.sum("up").alias("ups"), F.min("up").alias("least"))
    return nodes.filter("ups > 1 or (ups = 1 and least = 0)").count() == 0


def _least(edges: DataFrame, name: str) -> DataFrame:
    """(name, m): the smallest neighbour of every node that has a smaller one."""
    return edges.groupBy(F.col("u").alias(name)).agg(F.min("v").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node linked to the smallest neighbour of its smaller neighbour, or to that one itself."""
    return edges.join(_least(edges, "v"), "v", "left").select("u", F.coalesce("m", "v").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours linked to the smallest of these."""
    met = edges.join(_least(edges, "u"), "u")
    return met.select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))


def components(edges: DataFrame, label: str) -> DataFrame:
    """(u, root) for every node that has an edge and isn't a root itself.

    ``edges`` has two columns of node numbers, in any direction, with repeats.
    The root is the smallest node of the component.
    """
    a, b = edges.columns
    now = stored(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct(), label
    )
    while not _are_stars(now):
        wide = stored(_large_star(now), label)
        now = stored(_small_star(wide).distinct(), label)
    return now.select("u", F.col("v").alias("root"))
