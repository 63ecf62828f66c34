"""Connected components of an edge table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalens.staging import stage


def _large_star(edges: DataFrame) -> DataFrame:
    """Tie every larger neighbour of a node to the least of the node and its neighbours."""
    both = edges.select("hi", "lo").unionByName(edges.select(F.col("lo").alias("hi"), F.col("hi").alias("lo")))
    least = both.groupBy("hi").agg(F.min("lo").alias("least")).withColumn("least", F.least("hi", "least"))
    return (
        both.join(least, "hi").filter("lo > hi and lo > least")
        .select(F.col("lo").alias("hi"), F.col("least").alias("lo")).distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Tie a node and its smaller neighbours to the least of them."""
    least = edges.groupBy("hi").agg(F.min("lo").alias("least"))
    tied = edges.join(least, "hi")
    moved = tied.filter("lo > least").select(F.col("lo").alias("hi"), F.col("least").alias("lo"))
    return moved.unionByName(least.select("hi", F.col("least").alias("lo"))).distinct()


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node that is not the least of its component.

    ``edges`` holds undirected links of two long columns; loops and repeats are harmless, nulls are
    ignored. Nodes without a link, and the least node of each component, have no row: join from the
    left and coalesce. Rounds work on edges only, their number grows with the logarithm of the longest
    chain; each round is written to the shared folder, so a lost executor costs no recomputation of
    earlier rounds. A hub is never gathered: its minimum is a partial aggregate, and the join back is
    an equi-join that adaptive execution can split.
    """
    a, b = F.col(a), F.col(b)
    now = stage(
        edges.filter(a != b).select(F.greatest(a, b).cast("long").alias("hi"), F.least(a, b).cast("long").alias("lo")).distinct()
    )
    mark = _mark(now)
    while mark[0]:
        now = stage(_small_star(_large_star(now)))
        before, mark = mark, _mark(now)
        if mark == before:
            break
    return now.select(F.col("hi").alias("node"), F.col("lo").alias("component"))


def _mark(edges: DataFrame) -> tuple:
    """Row count and an order-free digest: equal marks of two rounds mean that nothing moved."""
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
    return row[0], row[1]
