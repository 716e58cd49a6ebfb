"""Nearest neighbours by a block matrix join with int8 tiles and exact recomputation.

Candidates are dealt by hash into tiles of about ``TILE`` vectors and queries into blocks of
about ``BLOCK``; each (tile, block) pair is one task group. There every vector is rounded to
int8 with its own scale. The products of the rounded vectors give distances, and the lengths
of the two rounding errors bound how far off these are; a candidate whose lower bound exceeds
the k-th upper bound of a query cannot be among its k nearest. The rest are recomputed in double
precision from the original vectors, the k best by a heap are kept per group, and the groups'
lists are merged by rank. Nothing can be lost, so the recall is 1.

Vectors that are null, empty, zero or hold a null or non-finite component take no part; only
vectors of equal length are compared. Rows without id take no part; of rows with equal ids
one takes part (the least vector). Ties go to the smaller id.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TILE, BLOCK = 4096, 1024
#: Rounded components are at most 127, so float32 sums of so many products are exact.
EXACT = (1 << 24) // (127 * 127)
#: Room for rounding in the bounds themselves, relative to the lengths involved.
SLACK = 1e-5


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0),
                      F.lit(False))


def side(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors (double), one of each id, by id."""
    ids = table.column("id").to_numpy()
    column = table.column("vector").combine_chunks()
    vectors = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    vectors = vectors.reshape(len(ids), -1)
    order = np.lexsort((*vectors.T[::-1], ids))
    ids, vectors = ids[order], vectors[order]
    first = np.concatenate([[True], ids[1:] != ids[:-1]])
    return ids[first], vectors[first]


def rounded(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 vectors, their scales, and the lengths of the rounding errors."""
    scale = np.abs(vectors).max(axis=1) / 127
    small = np.rint(vectors / scale[:, None]).astype(np.int8)
    return small, scale, np.linalg.norm(vectors - small * scale[:, None], axis=1)


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    out = np.zeros((len(left), len(right)))
    for k in range(0, left.shape[1], EXACT):
        out += left[:, k:k + EXACT].astype(np.float32) @ right[:, k:k + EXACT].astype(np.float32).T
    return out


def tile_nearest(queries: pa.Table, candidates: pa.Table, k: int) -> pa.Table:
    """query_id, vec_id, score: the k nearest of one tile for each query of one block."""
    rows: list[tuple[int, int, float]] = []
    if queries.num_rows and candidates.num_rows:
        q_ids, q = side(queries)
        c_ids, c = side(candidates)
        q8, q_scale, q_error = rounded(q)
        c8, c_scale, c_error = rounded(c)
        q_length, c_length = (np.linalg.norm(x * s[:, None], axis=1)
                              for x, s in ((q8, q_scale), (c8, c_scale)))
        near = (q_length[:, None] ** 2 + c_length ** 2
                - 2 * q_scale[:, None] * c_scale * products(q8, c8))
        near = np.sqrt(np.maximum(near, 0))
        error = (q_error[:, None] + c_error) + SLACK * (q_length[:, None] + c_length)
        near[q_ids[:, None] == c_ids] = np.inf
        most = min(k, len(c_ids)) - 1
        limit = np.partition(near + error, most, axis=1)[:, most]
        for i, j in enumerate(near - error <= limit[:, None]):
            left = np.flatnonzero(j & (c_ids != q_ids[i]))
            exact = np.sqrt(np.cumsum((c[left] - q[i]) ** 2, axis=1)[:, -1])  # in order, as SQL sums
            best = heapq.nsmallest(k, zip(exact.tolist(), c_ids[left].tolist()))
            rows += [(int(q_ids[i]), v, d) for d, v in best]
    return pa.table({"query_id": pa.array([r[0] for r in rows], pa.int64()),
                     "vec_id": pa.array([r[1] for r in rows], pa.int64()),
                     "score": pa.array([r[2] for r in rows], pa.float64())})


def parts(rows: DataFrame, size: int) -> int:
    return max(1, -(-rows.count() // size))


def nearest(queries: DataFrame, candidates: DataFrame, k: int = 10) -> DataFrame:
    """query_id, rank, vec_id, score; both inputs have id (long) and vector (array)."""
    queries, candidates = (x.where(F.col("id").isNotNull() & usable(F.col("vector"))).select(
        F.col("id").cast("long").alias("id"), F.col("vector").cast("array<double>").alias("vector"),
        F.size("vector").alias("dim")) for x in (queries, candidates))
    tiles, blocks = parts(candidates, TILE), parts(queries, BLOCK)
    own, others = (lambda n: F.pmod(F.xxhash64("id"), F.lit(n)).cast("int"),
                   lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    left = queries.withColumns({"block": own(blocks), "tile": others(tiles)})
    right = candidates.withColumns({"tile": own(tiles), "block": others(blocks)})
    group = ("dim", "tile", "block")
    found = left.groupBy(*group).cogroup(right.groupBy(*group)).applyInArrow(
        lambda a, b: tile_nearest(a, b, k), "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
