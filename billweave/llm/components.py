"""Connected components of a graph given as pairs of numbers, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

# Parts that the edges of one node are dealt into.
SALTS = 32


def components(pairs: DataFrame) -> DataFrame:
    """``pairs`` (a, b) to (node, root): the smallest number each node is connected with. Lone nodes are left out.

    Each round links every node's larger neighbours, then its smaller ones, to the smallest of them, until the
    pairs stay the same: a number of rounds that grows with the logarithm of the largest component.
    """
    edges = stored(_downwards(pairs.filter("a <> b")), "component-pairs")
    before = _state(edges)
    while True:
        edges = stored(_small_star(_large_star(edges)), "component-pairs")
        after = _state(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _downwards(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _state(edges: DataFrame) -> tuple:
    total = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count("*"), total).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Links each node's larger neighbours to its smallest neighbour, or to itself if it has no smaller one.

    Only nodes in the middle, with neighbours of both kinds, take part in the join; once stars are found there
    are none. The other side is dealt by node and salt, so that the centre of a large star is split.
    """
    middle = edges.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "b").join(
        edges.select("b").distinct(), "b", "left_semi"
    )
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    salted = edges.withColumn("salt", F.pmod(F.xxhash64("a"), F.lit(SALTS)).cast("int"))
    return salted.join(middle.select("b", "m", salts), ["b", "salt"], "left").select(
        "a", F.coalesce("m", "b").alias("b")
    ).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    linked = edges.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return linked.unionByName(least.select("a", F.col("m").alias("b"))).distinct()
