"""Connected components by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardlake.llm.common import stored


def _low(edges: DataFrame, node: str) -> DataFrame:
    return edges.groupBy(F.col(node).alias("node")).agg(F.min("other").alias("low"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the smallest of the node and its neighbours."""
    both = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("a").alias("other"))
    )
    low = _low(both, "node").withColumn("low", F.least("low", "node"))
    return (
        both.filter("other > node")
        .join(low, "node")
        .select(F.col("low").alias("a"), F.col("other").alias("b"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are tied to the smallest neighbour."""
    down = edges.select(F.col("b").alias("node"), F.col("a").alias("other"))
    low = _low(down, "node")
    tied = down.join(low, "node").filter("other > low").select(F.col("low").alias("a"), F.col("other").alias("b"))
    return tied.unionByName(low.select(F.col("low").alias("a"), F.col("node").alias("b"))).distinct()


def components(edges: DataFrame, folder: str | None = None) -> DataFrame:
    """``(node, label)`` for every end of the edges ``(a, b)``, label the component's least node.

    ``a < b`` in every row. Each round halves the depth of the trees or better; rounds go
    through the shared folder. The hot centre of a star is a key of a join only, which
    adaptive execution can split, and its minimum is combined before the shuffle. Tables go below
    ``folder`` if there is one.
    """
    edges = stored(edges.select("a", "b").distinct(), "edges", folder)
    before = None
    while True:
        edges = stored(_small_star(_large_star(edges)), "edges", folder)
        state = edges.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")), F.bit_xor(F.xxhash64("b", "a"))
        ).first()
        if state == before:
            break
        before = state
    return edges.select(F.col("b").alias("node"), F.col("a").alias("label")).unionByName(
        edges.select(F.col("a").alias("node"), F.col("a").alias("label")).distinct()
    )
