"""Connected components of an edge table, by alternating large and small stars.

Each round points the neighbours of every node at its least neighbour; stars
remain when nothing changes. Minima are reduced before they move, and every
round is cut, so a lost executor costs no more than a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, cut


#: Parts to which the edges of a node are dealt where a join shuffles them.
SALTS = 16


def _state(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return r["n"], r["h"]


def _pointed(edges: DataFrame, least: DataFrame) -> DataFrame:
    """Edges with the least of their first node. A hub has as many edges as its bucket has nodes, so a join that shuffles is salted."""
    if least.count() <= BROADCAST_ROWS:
        return edges.join(F.broadcast(least), "a")
    dealt = least.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return edges.withColumn("salt", F.pmod(F.xxhash64("b"), F.lit(SALTS)).cast("int")).join(dealt, ["a", "salt"]).drop("salt")


def components(edges: DataFrame, rounds: int = 50) -> DataFrame:
    """(node, root) of all nodes of undirected edges (a, b): root is the least node of the component.

    Rounds grow with the logarithm of the nodes, so 50 is far more than any
    corpus needs; without convergence within them it is an error, never a result.
    """
    edges = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = _state(edges)
    for _ in range(rounds):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = cut(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")))
        large = cut(_pointed(both, least).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct())
        least = cut(large.groupBy("a").agg(F.min("b").alias("m")))
        small = _pointed(large, least).select(F.explode(F.array(F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.a", "e.b")
        edges = cut(small.where("a <> b").distinct())
        after = _state(edges)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not converge in {rounds} rounds")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
