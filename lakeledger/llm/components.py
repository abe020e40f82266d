"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeledger.llm.common import durable
from lakeledger.operators.joins import splittable_join


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); root is the smallest node of the component.

    Loops and repeated edges are allowed. Every step is an aggregate and an
    equi-join that adaptive execution can split (``splittable_join``): the
    edges of a node with very many are spread over tasks. Each round is a checkpoint; the
    driver sees two numbers per round. Empty input gives an empty result.
    """
    edges = durable(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    before = _mark(edges)
    while before[0]:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        large = (
            splittable_join(both, least, ["a"], "inner")
            .where("b > a")
            .select(F.col("b").alias("a"), F.least("m", "a").alias("b"))
            .distinct()
        )
        large = durable(large)
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = splittable_join(large, least, ["a"], "inner").select(
            F.explode(
                F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))
            ).alias("e")
        )
        edges = durable(small.select("e.a", "e.b").where("a <> b").distinct())
        after = _mark(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _mark(edges: DataFrame) -> tuple:
    """Number of edges and a checksum of them: equal when a round changed nothing."""
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())
