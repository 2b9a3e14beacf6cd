"""Connected components of a graph given by its edges, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weir.llm.common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Link each node's larger neighbours to the smallest of its neighbourhood."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("least"))
    linked = both.where("b > a").join(least, "a")
    return linked.select(F.col("b").alias("a"), F.col("least").alias("b")).where("a <> b")


def _small_star(edges: DataFrame) -> DataFrame:
    """Link each node and its smaller neighbours to the smallest of these; edges point from a down to b."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    linked = edges.join(least, "a").where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return linked.unionByName(least.select("a", F.col("least").alias("b"))).distinct()


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node with an edge down has one only, and none that leads to it; edges point from a down to b, none repeats."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up")).unionByName(
        edges.select(F.col("b").alias("node"), F.lit(0).alias("down"), F.lit(1).alias("up")))
    return ends.groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up")).where("down > 1 OR down = 1 AND up = 1").isEmpty()


def _ends(edges: DataFrame, a: str, b: str) -> DataFrame:
    """The edges, pointing from their larger end down, without loops and nulls."""
    ends = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    return ends.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))


def _round(edges: DataFrame) -> DataFrame:
    """A large and a small star, in fewer files than shuffle partitions: an edge is two ids, far narrower than other rows."""
    spark = edges.sparkSession
    files = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")) // 8)
    return stored(_small_star(_large_star(edges)).coalesce(files), "edges")


def contracted(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(a, b): edges that join the same nodes into the same components, one round nearer to stars; at most as many."""
    return _round(_ends(edges, a, b))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for each node of an edge: the smallest node it is connected with.

    Nodes are of any sortable type; loops and edges with a null are dropped, repeated edges do no harm. Each
    round works on at most as many edges as the last, written to the shared folder; it ends when only stars are
    left, after a number of rounds that grows with the logarithm of the components' sizes. A node
    with many edges is summed up per task before it is shuffled.
    """
    now = _ends(edges, a, b)
    while True:
        now = _round(now)
        if _are_stars(now):
            return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
