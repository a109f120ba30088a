"""Connected components of a graph given by its edges, as alternating star joins.

Each round points all larger neighbours of a node to the smallest node it knows, then all
smaller ones (large star, small star), which halves paths until only stars are left. A round
is two partial minima and two joins; its edges are written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow.llm import common


def _stars(edges: DataFrame) -> DataFrame:
    """One round; edges point from ``a`` to a smaller ``b``."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    # Written, so that the join has a plain shuffle on either side and Spark can split the
    # partition of a node with very many neighbours.
    least = common.written(both.groupBy("a").agg(F.min("b").alias("m")).select(
        "a", F.least("a", "m").alias("m")
    ), "least")
    # Large star: what is larger than a now points to the smallest node that a knows.
    large = both.filter("b > a").join(least, "a").select(
        F.col("b").alias("a"), F.col("m").alias("b")
    ).filter("a <> b").distinct()
    # Small star: what a points to, and a itself, now points to the smallest of that.
    small = large.groupBy("a").agg(F.min("b").alias("m"))
    moved = large.join(small, "a").select(
        F.explode(F.array(
            F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b"))
        )).alias("edge")
    )
    return moved.select("edge.*").filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component): each node of ``edges`` (a, b) and the smallest node it reaches."""
    now = common.written(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "edges",
    )
    state = None
    while True:
        mark = now.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if mark == state or not mark[0]:
            break
        state = mark
        now = common.written(_stars(now), "edges")
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
