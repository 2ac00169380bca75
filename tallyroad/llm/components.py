"""Connected components of an edge table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyroad.llm import common


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link the neighbours of every node to the smallest of them (and the node itself)."""
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("m"))
    joined = both.join(least, both["a"] == least["node"])
    if large:
        out = joined.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(least.select(F.col("node").alias("a"), F.col("m").alias("b")))
    return out.where(F.col("a") != F.col("b")).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node each node of ``edges`` (a, b) can reach. Nodes without edges are absent."""
    edges = common.materialize(edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).where("a != b").distinct(), "edges")
    before = None
    while True:
        half = common.materialize(_star(edges, True), "edges")
        whole = common.materialize(_star(half, False), "edges")
        common.discard(edges, half)
        edges = whole
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            return edges.groupBy("a").agg(F.min("b").alias("component")).unionAll(edges.groupBy("b").agg(F.min("b").alias("component"))).groupBy(F.col("a").alias("node")).agg(F.min("component").alias("component"))
        before = state
