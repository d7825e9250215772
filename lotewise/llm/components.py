"""Connected components by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotewise.operators.joins import many_to_one
from lotewise.session import keep


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of `edges` (a, b); component: its smallest node.

    Each round hangs every neighbour of a node on the smallest node near it, first the
    larger neighbours, then the smaller ones; the edges become stars after a number of
    rounds that grows with the logarithm of the longest path. The smallest neighbour is
    combined before the shuffle, so a node with a third of all edges is no hot task, and
    Spark splits its rows in the join. The edges of a round are written to the shared
    folder: a lost executor costs one round. Loops and repeated edges are dropped;
    no edges give no rows.
    """
    now = keep(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        "edges",
    )
    before = None
    while before != (before := _fingerprint(now)):
        now = keep(_small_star(_large_star(now)).distinct(), "edges")
    roots = now.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "node")
    return roots.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _fingerprint(edges: DataFrame) -> tuple:
    mixed = F.xxhash64("u", "v")
    row = edges.agg(
        F.count(F.lit(1)).alias("n"), F.sum(mixed.cast("decimal(38,0)")).alias("s"), F.bit_xor(mixed).alias("x")
    ).first()
    return tuple(row)


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (
        many_to_one(both, least, ["u"])
        .filter("v > u and v <> m")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
    )


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    hung = many_to_one(edges, least, ["u"]).filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hung.unionByName(least.select("u", F.col("m").alias("v")))
