"""Exact top-k inner product search by columnar branch and bound.

Vectors lie in vertical layout (a row for each dimension). Scores grow block of dimensions
by block; after each block the mass that remains on either side bounds what a candidate can
still gain or lose (Cauchy-Schwarz), the k-th best lower bound is the threshold, and the
candidates that can still reach it are compacted.

Queries are dealt into blocks and candidates into slices of bounded size; a pair of them is
one task's work and yields k rows for each query, so no group grows with the data.

Defined results: a vector that is null, empty of values it needs, or holds a null or
non-finite component takes no part, nor does one without ``vec_id``. Vectors of different
lengths are not compared; empty ones score 0 with each other. A repeated row is a candidate
of its copies, and each copy of a query gets its own rows. Scores beyond 64 bits are clipped.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gaugeflow.llm import common

#: Queries of a block and candidates of a slice.
BLOCK_QUERIES, SLICE_ROWS = 4096, 16_384
#: Dimensions accumulated between two looks at the bounds.
BLOCK_DIMS = 8
#: Queries whose first block is multiplied at once.
_TOGETHER = 64


def quantised(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """Distinct (vec_id, xs) with their number of copies and a row number."""
    x = F.col("embedding")
    usable = (
        x.isNotNull() & F.col("vec_id").isNotNull()
        & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    )
    xs = F.transform(x, lambda v: F.floor(v.cast("double") * scale).cast("long"))
    return (
        vectors.filter(F.coalesce(usable, F.lit(False)))
        .select(F.col("vec_id").cast("long").alias("vec_id"), xs.alias("xs"))
        .groupBy("vec_id", "xs").agg(F.count(F.lit(1)).alias("copies"))
        .withColumn("number", F.monotonically_increasing_id())
    )


def _matrix(column: pa.ChunkedArray, dims: int) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(-1, dims) if dims else np.zeros((len(column), 0), np.int64)


def search_slice(
    queries: np.ndarray, own: np.ndarray, xs: np.ndarray, ids: np.ndarray, numbers: np.ndarray,
    copies: np.ndarray, k: int,
) -> list[tuple[int, int, int]]:
    """(query's place, vec_id, score) of each query's k best rows of one slice.

    ``own`` and ``numbers`` name the rows: a query does not meet its own row, but does meet
    the other copies of it.
    """
    dims, found = xs.shape[1], []
    most = int(np.abs(queries).max(initial=0)) * int(np.abs(xs).max(initial=0)) * max(dims, 1)
    exact = most < 1 << 52
    order = np.argsort(-np.abs(xs.astype(np.float64)).sum(axis=0), kind="stable")
    blocks = [order[i:i + BLOCK_DIMS] for i in range(0, dims, BLOCK_DIMS)]
    columns = np.ascontiguousarray(xs.T.astype(np.float64 if exact else object))
    wide = queries.astype(np.float64 if exact else object)

    def remaining(rows: np.ndarray) -> np.ndarray:
        """By block: the length of what the later blocks hold, rounded up."""
        masses = [np.square(rows[:, b].astype(np.float64)).sum(axis=1) for b in blocks[1:]]
        rest = np.zeros((len(blocks) + 1, len(rows)))
        for i in range(len(masses) - 1, -1, -1):
            rest[i] = rest[i + 1] + masses[i]
        return np.sqrt(rest) * (1 + 1e-9)

    rest_x, rest_q = remaining(xs), remaining(queries)
    for at in range(0, len(queries), _TOGETHER):
        if blocks and exact:
            firsts = wide[at:at + _TOGETHER, blocks[0]] @ columns[blocks[0]]
        for q in range(at, min(at + _TOGETHER, len(queries))):
            alive = np.flatnonzero((numbers != own[q]) | (copies > 1))
            if not exact:
                score = wide[q] @ columns[:, alive] if len(alive) else np.zeros(0, object)
            elif not blocks:
                score = np.zeros(len(alive))
            else:
                score = firsts[q - at, alive]
                for i, block in enumerate(blocks[1:]):
                    if len(alive) > k:
                        slack = rest_x[i, alive] * rest_q[i, q] + 1e-3
                        threshold = np.partition(score - slack, len(alive) - k)[len(alive) - k]
                        keep = score + slack >= threshold
                        alive, score = alive[keep], score[keep]
                    score = score + wide[q, block] @ columns[np.ix_(block, alive)]
            places = sorted(zip((-score).tolist(), ids[alive].tolist(), alive.tolist()))
            left = k
            for value, vec_id, place in places:
                times = min(left, int(copies[place]) - int(numbers[place] == own[q]))
                clipped = max(-(1 << 63), min((1 << 63) - 1, -int(value)))
                found += [(q, vec_id, clipped)] * times
                left -= times
                if not left:
                    break
    return found


def top_k(
    vectors: DataFrame, every: int = 50, k: int = 5,
    block_queries: int = BLOCK_QUERIES, slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k best rows for each row whose id ``every`` divides."""
    rows = common.written(quantised(vectors), "vectors").withColumn("dims", F.size("xs"))
    queries = rows.filter(F.col("vec_id") % every == 0)
    n_blocks = -(-queries.count() // block_queries) or 1
    n_slices = -(-rows.count() // slice_rows) or 1
    key = ["dims", "block", "slice"]

    def dealt(df: DataFrame, block, slice_) -> DataFrame:
        return df.withColumn("block", block).withColumn("slice", slice_)

    def every_one(n: int):
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))

    left = dealt(queries, F.pmod(F.xxhash64("number"), F.lit(n_blocks)), every_one(n_slices))
    right = dealt(rows, every_one(n_blocks), F.pmod(F.xxhash64("number"), F.lit(n_slices)))

    def run(ours: pa.Table, theirs: pa.Table) -> pa.Table:
        found = []
        if ours.num_rows and theirs.num_rows:
            dims = ours.column("dims")[0].as_py()
            found = search_slice(
                _matrix(ours.column("xs"), dims), ours.column("number").to_numpy(),
                _matrix(theirs.column("xs"), dims), theirs.column("vec_id").to_numpy(),
                theirs.column("number").to_numpy(), theirs.column("copies").to_numpy(), k,
            )
        place = pa.array([f[0] for f in found], pa.int64())
        return pa.table({
            "number": ours.column("number").take(place),
            "query_id": ours.column("vec_id").take(place),
            "times": ours.column("copies").take(place),
            "vec_id": pa.array([f[1] for f in found], pa.int64()),
            "score": pa.array([f[2] for f in found], pa.int64()),
        })

    best = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(
        run, "number long, query_id long, times long, vec_id long, score long"
    )
    ranked = Window.partitionBy("number").orderBy(F.desc("score"), "vec_id")
    return (
        best.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k)
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "times")))
        .select("query_id", "rank", "vec_id", "score")
    )
