"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from lakeforge.llm.common import materialise, temporary


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): every node of the edges with the smallest node of its component.

    Alternates two steps until nothing changes: every node points its larger
    neighbours to its smallest one, then its smaller neighbours.  Edges never
    leave the executors, each round's edges are written to the shared folder,
    and a node with many neighbours is a grouped minimum and a join on the
    node, so no task gathers its neighbourhood.  The number of rounds grows
    with the logarithm of the nodes.  A round is one execution, whose write
    also counts its edges: the driver keeps something of every execution.
    """
    with temporary() as keep:
        now = keep(_settled(edges, a, b))
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _settled(edges: DataFrame, a: str, b: str) -> DataFrame:
    now, state = _written(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct())
    before = None
    while state != before:
        # large star: (larger neighbour, smallest of the neighbourhood and the node itself)
        both = now.select("u", "v").unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # small star: each node's smaller neighbours and itself to the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").unionByName(low.select("u", F.col("m").alias("v"))).distinct()
        before = state
        now, state = _written(small)
    return now


def _written(edges: DataFrame) -> tuple[DataFrame, dict]:
    """The edges as a written table, and what tells whether a round changed them."""
    seen = Observation()
    made = materialise(edges.observe(seen, F.count("*").alias("edges"), F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0)).alias("digest")), "edges")
    return made, seen.get
