"""Nearest neighbours by largest inner product, from stable projections in kd-trees.

Every vector gets one more component that makes all lengths equal (a query's
is 0), so that the largest inner product is the smallest distance. Gaussian
projections to a few dimensions are 2-stable: the squared projected distance
over the squared distance follows a chi-square law. Rows are dealt to blocks,
each with a kd-tree over its projected vectors. A query takes the tree's
leaves in the order of their projected distance and verifies their vectors in
full, until a vector as near as its k-th best would, by the chi-square law,
have turned up with probability CONFIDENCE.
"""

from __future__ import annotations

import sys
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

DIMENSIONS = 8  # of the projection
CONFIDENCE = 0.95
BLOCK_ROWS = 8_192  # vectors in a kd-tree
BLOCK_QUERIES = 4_096  # queries that meet a block at a time
LEAF = 32
SEED = 20_240_601


def chi_square_quantile(p: float, k: int) -> float:
    """Where the chi-square distribution of even ``k`` degrees reaches ``p``, by bisection of its closed form."""

    def upto(x: float) -> float:
        term = total = 1.0
        for i in range(1, k // 2):
            term *= x / 2 / i
            total += term
        return 1 - np.exp(-x / 2) * total

    low, high = 0.0, 1000.0
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if upto(middle) < p else (low, middle)
    return high


def leaves(points: np.ndarray) -> list[np.ndarray]:
    """The leaves of a kd-tree: halved at the median of the widest dimension."""
    done, todo = [], [np.arange(len(points))]
    while todo:
        rows = todo.pop()
        if len(rows) <= LEAF:
            done.append(np.sort(rows))
            continue
        part = points[rows]
        axis = int(np.argmax(part.max(axis=0) - part.min(axis=0)))
        order = np.argpartition(part[:, axis], len(rows) // 2)
        todo += [rows[order[: len(rows) // 2]], rows[order[len(rows) // 2 :]]]
    return done


def search(
    ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int, longest: float
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each query's ``k`` best ids of one block, each with its best row: query ids, vector ids and inner products."""
    order = np.argsort(ids, kind="stable")
    ids, vectors = ids[order], vectors[order]
    square = (vectors**2).sum(axis=1)
    lifted = np.sqrt(np.maximum(longest - square, 0.0))
    draw = np.random.default_rng(SEED).standard_normal((vectors.shape[1] + 1, DIMENSIONS))
    points = vectors @ draw[:-1] + lifted[:, None] * draw[-1]
    asked = queries @ draw[:-1]
    tree = leaves(points)
    low = np.array([points[leaf].min(axis=0) for leaf in tree])
    high = np.array([points[leaf].max(axis=0) for leaf in tree])
    flat = np.concatenate(tree)
    first = np.concatenate([[0], np.cumsum([len(leaf) for leaf in tree])])
    stored, stored_ids = vectors[flat], ids[flat]
    enough = chi_square_quantile(CONFIDENCE, DIMENSIONS)
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for q in range(len(queries)):
        gap = np.maximum(low - asked[q], 0.0) + np.maximum(asked[q] - high, 0.0)
        bound = (gap**2).sum(axis=1)
        nearest = np.argsort(bound, kind="stable")
        norm = float(queries[q] @ queries[q]) + longest
        best_ids, best, at, step = np.zeros(0, np.int64), np.zeros(0), 0, max(8, k // LEAF + 1)
        while at < len(nearest):
            if len(best) == k and bound[nearest[at]] > enough * max(norm - 2 * best[-1], 0.0):
                break
            taken = nearest[at : at + step]
            rows = np.concatenate([np.arange(first[t], first[t + 1]) for t in taken])
            product, found = stored[rows] @ queries[q], stored_ids[rows]
            other = found != query_ids[q]
            if len(best) == k:
                other &= product >= best[-1]
            product, found = np.concatenate([best, product[other]]), np.concatenate([best_ids, found[other]])
            ranked = np.lexsort((found, -product))
            keep = ranked[np.sort(np.unique(found[ranked], return_index=True)[1])[:k]]  # of rows that repeat an id only the best
            best, best_ids = product[keep], found[keep]
            at, step = at + step, step * 2
        out.append((np.full(len(best), query_ids[q]), best_ids, best))
    return tuple(np.concatenate([o[i] for o in out]) if out else np.zeros(0) for i in range(3))  # type: ignore[return-value]


FOUND = "query_id bigint, vec_id bigint, score double"


def searcher(k: int, longest: float) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def matrix(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        lists = table.column("embedding").combine_chunks()
        values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        return table.column("vec_id").to_numpy().astype(np.int64), values.reshape(table.num_rows, -1)

    def find(data: pa.Table, asked: pa.Table) -> pa.Table:
        if not data.num_rows or not asked.num_rows:
            found = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        else:
            found = search(*matrix(data), *matrix(asked), k, longest)
        return pa.table({"query_id": pa.array(found[0], pa.int64()), "vec_id": pa.array(found[1], pa.int64()), "score": pa.array(found[2], pa.float64())})

    return find


def nearest(vectors: DataFrame, queries: Column, k: int = 20, block_rows: int = BLOCK_ROWS, block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """For each row of ``vectors`` (vec_id, embedding) for which ``queries`` holds, the ``k`` nearest other rows.

    Returns query_id, rank (from 1), vec_id and score, the inner product of
    the original vectors in double precision; nearest first, ties to the
    smaller vec_id; fewer rows if there are fewer candidates. Rows with a null
    id, and vectors that are null, empty or zero or hold a null or non-finite
    component, take no part. Vectors are only compared with those of equally
    many components. Rows that repeat a vec_id are one candidate, with its
    best score, and one query. Other columns are not looked at; an empty table
    gives an empty table.

    Blocks of queries meet blocks of vectors; both are dealt by a hash of the
    id, so common vectors spread over all blocks.
    """
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = (
        vectors.select(F.col("vec_id").cast("bigint"), F.col("embedding").cast("array<double>"), queries.alias("is_query"))
        .where("vec_id is not null and embedding is not null")
        .where(finite & F.exists("embedding", lambda x: x != 0))
        .withColumn("size", F.size("embedding"))
    )
    square = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x * x)
    total, asked, longest = rows.agg(F.count("*"), F.count_if("is_query"), F.max(square)).first()
    blocks, asks = max(1, -(-total // block_rows)), max(1, -(-asked // block_queries))
    data = rows.select("vec_id", "embedding", "size", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).alias("block"))
    asked_rows = rows.where("is_query").select("vec_id", "embedding", "size", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(asks)).alias("ask"))
    data = data.withColumn("ask", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(asks - 1).cast("bigint"))))
    asked_rows = asked_rows.withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint"))))
    keys = ["size", "block", "ask"]
    found = data.groupBy(*keys).cogroup(asked_rows.groupBy(*keys)).applyInArrow(searcher(k, longest or 0.0), FOUND)
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
