"""Connected components of an edge table, by alternating stars.

Large star: each node points its larger neighbours to its smallest one.
Small star: each node points its smaller neighbours to the smallest.  The
two repeat until the edges are stars; then every node points to the smallest
node of its component.  Each half is one aggregate and one join on the node,
so a node with a third of all edges is pre-aggregated and its join is split
by adaptive execution.  Edges stay in the cluster; each round is written to
the checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanlens.session import checkpoint_dir

_ROUNDS = 50


def _settle(df: DataFrame) -> DataFrame:
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _to_smallest(pairs: DataFrame) -> DataFrame:
    """(u, v, m): each pair with the smallest of u and its partners."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return pairs.join(least, "u")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("v", "u"))
    return _to_smallest(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """``edges`` run from the larger to the smaller node."""
    led = _to_smallest(edges)
    return (led.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(edges.groupBy("u").agg(F.min("v").alias("v")))
            .where("u <> v").distinct())


def _are_stars(edges: DataFrame) -> bool:
    """Whether each larger node has one edge and no node is at both kinds of ends."""
    ends = (edges.select(F.col("u").alias("x"), F.lit(1).alias("out"), F.lit(0).alias("into"))
            .union(edges.select("v", F.lit(0), F.lit(1))))
    return (ends.groupBy("x").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
            .where(F.col("out") + F.col("into") > 1).isEmpty())


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of an edge; edges are (u, v) longs.

    ``component`` is the smallest node reachable.  Loops and repeated edges
    do no harm; an empty table gives an empty table.
    """
    edges = _settle(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                    .distinct())
    for _ in range(_ROUNDS):
        if _are_stars(edges):
            break
        edges = _settle(_small_star(_large_star(edges)))
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("component"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
