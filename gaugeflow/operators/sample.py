"""Monte-Carlo estimate of pi."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: points per partition of the sample job.
POINTS_PER_PARTITION = 100_000


def monte_carlo_pi(spark: SparkSession, partitions: int = 2, seed: int | None = None) -> DataFrame:
    """One row with ``points``, ``hits`` and ``pi`` from random points in a square."""
    points = spark.range(0, POINTS_PER_PARTITION * partitions, 1, partitions)
    # The random columns sit in a projection: an aggregate over rand() is refused.
    second = None if seed is None else seed + 1
    drawn = points.select(
        (F.rand(seed) * 2 - 1).alias("x"), (F.rand(second) * 2 - 1).alias("y")
    )
    return _estimate(drawn)


def monte_carlo_pi_of(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The same estimate with one repeatable point per row, drawn from a hash of ``columns``."""
    text = F.concat_ws(":", *[F.col(c).cast("string") for c in columns])
    digest = df.select(F.md5(text.cast("binary")).alias("digest"))

    def coordinate(start: int):
        number = F.conv(F.substr("digest", F.lit(start), F.lit(8)), 16, 10).cast("double")
        return number / F.lit(float(2**31)) - 1

    return _estimate(digest.select(coordinate(1).alias("x"), coordinate(9).alias("y")))


def _estimate(points: DataFrame) -> DataFrame:
    hit = F.col("x") * F.col("x") + F.col("y") * F.col("y") <= 1
    counted = points.agg(
        F.count(F.lit(1)).alias("points"), F.count_if(hit).alias("hits")
    )
    return counted.select("points", "hits", (F.lit(4.0) * F.col("hits") / F.col("points")).alias("pi"))
