"""Connected components of links between 64-bit nodes, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablemill.llm.common import written

MAX_ROUNDS = 100


def connected_components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """``node, label`` for every node of ``links`` (``a``, ``b``); the label is the component's smallest node.

    A star step hangs neighbours of a node below the smallest of them. Both steps find that node with a grouped
    minimum and join it back, so a node with very many neighbours is combined on the map side and its join partition
    can be split. Each round is written to the shared folder. An empty table gives no rows.
    """
    edges = written(spark, _downward(links.select("a", "b")), "links")
    state = _state(edges)
    for _ in range(MAX_ROUNDS):
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _star(both, both.where("b > a"))
        small = _star(large, large)
        edges = written(spark, small, "links")
        state, last = _state(edges), state
        if state == last:
            break
    else:
        raise RuntimeError(f"no fixed point after {MAX_ROUNDS} rounds")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
    )


def _downward(edges: DataFrame) -> DataFrame:
    return edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _star(neighbours: DataFrame, moved: DataFrame) -> DataFrame:
    """For each edge (a, b) of ``moved``: b linked with the smallest of a and a's neighbours, and a likewise."""
    least = neighbours.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    hung = moved.join(least, "a")
    return _downward(
        hung.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
    )


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())
