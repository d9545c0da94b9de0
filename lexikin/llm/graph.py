"""Connected components of a large graph."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lexikin.llm.common import written


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("lo", "hi"))).first())


def components(edges: DataFrame) -> DataFrame:
    """node, root for every node of ``edges`` (lo < hi) that isn't its own root.

    Alternates two steps until nothing changes: each node ties its larger neighbours,
    then its smaller ones, to the smallest node it knows. Every step aggregates per node
    before rows move, and its result is written, so a hub's edges are never gathered.
    """
    edges = written(edges.select("lo", "hi").distinct(), "edges")
    state = _state(edges)
    while True:
        both = edges.union(edges.select(F.col("hi").alias("lo"), F.col("lo").alias("hi")))
        least = both.groupBy("lo").agg(F.least("lo", F.min("hi")).alias("root"))
        large = (
            both.where("hi > lo").join(least, "lo").select(F.col("root").alias("lo"), "hi").distinct()
        )
        least = large.groupBy("hi").agg(F.min("lo").alias("root"))
        small = (
            large.join(least, "hi")
            .select(F.col("root"), F.col("lo").alias("node"))
            .union(least.select("root", F.col("hi").alias("node")))
            .where("root < node")
            .select(F.col("root").alias("lo"), F.col("node").alias("hi"))
            .distinct()
        )
        edges, before = written(small, "edges"), state
        state = _state(edges)
        if state == before:
            return edges.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
