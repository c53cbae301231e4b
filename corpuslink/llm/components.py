"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslink.llm.scratch import written


def _flat(edges: DataFrame) -> bool:
    """Does every edge lead to the top of its tree?"""
    tops = edges.select(F.col("b").alias("a")).distinct()
    return edges.join(tops, "a", "left_semi").isEmpty()


def _large(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node joins the least of its neighbourhood."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(
        "a", F.least("m", "a").alias("m"))
    return both.where("b > a").join(least, "a").select(
        F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours join the least of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.where("a <> b").union(least).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b); the component is its least
    node. Edges become trees of height one; each round is written, so no plan grows and a lost executor costs one round;
    the rounds grow with the logarithm of the longest path."""
    now = written(_small(edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()), "edges")
    while not _flat(now):
        now = written(_small(_large(now)), "edges")
    tops = now.select(F.col("b").alias("node")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        tops.select("node", F.col("node").alias("component")))
