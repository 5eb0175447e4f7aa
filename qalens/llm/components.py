"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qalens.llm.common import written


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (columns a, b; long): root is the component's least node.

    Alternating star contraction: each node's neighbours are hooked to its least neighbour, first the larger ones
    and then the smaller ones, until the edges are stars around the roots. Every round is written to the shared
    folder (short lineage, safe when executors are lost); nothing but a row count and a checksum reaches the driver.
    A node of many edges is met by partial aggregation and a join that Spark may split, never by one group.
    """
    edges = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = None
    while True:
        state = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state == seen:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")) \
                .unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        seen = state
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        lower = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lower, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b")) \
            .unionByName(lower.select("a", F.col("m").alias("b"))).distinct()
        edges = written(small, "edges")
