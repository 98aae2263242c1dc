"""Nearest neighbours through low-dimensional stable projections and a kd-tree.

Gaussian projections keep Euclidean distances in law: the squared projected distance over the
squared true one is chi-square with ``DIMENSIONS`` degrees of freedom. A kd-tree over the
projected points gives leaves in the order of their projected distance from the query; their
points are verified by true distance, until the chance that a point nearer than the k-th found
still lies beyond the projected distance reached is below 1 - ``CONFIDENCE``.

Vectors are dealt to shards by the hash of their id, queries to blocks likewise; each shard and
block is one group of bounded expected size, so no task grows with the table. Copies of a vector
beyond the k + 1 smallest ids are left out of the index: k others at the same distance come
before them in every answer.

Defined results: null vectors and ids, zero vectors, empty vectors and vectors that hold a null,
infinite or not-a-number component take no part, as query or as candidate. Vectors of different
length are never compared. A candidate with the query's own id is the query itself. Rows that
repeat an id and a vector count once; an id with two vectors gets the answers of both.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

NEAREST = 10
EVERY = 100
DIMENSIONS = 8
CONFIDENCE = 0.99
LEAF = 64
SHARD_ROWS = 8_192
BLOCK_ROWS = 8_192
SEED = 7


def chi_square_quantile(share: float, degrees: int) -> float:
    """By bisection on the closed form for even degrees of freedom."""

    def below(x):
        term = total = math.exp(-x / 2)
        for k in range(1, degrees // 2):
            term *= x / 2 / k
            total += term
        return 1 - total

    low, high = 0.0, 1000.0
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if below(middle) < share else (low, middle)
    return high


class Tree:
    """kd-tree over projected points: medians by place, so that equal points split too."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        self.points = points
        self.order = np.arange(len(points))
        self.nodes: list[tuple] = []  # (low corner, high corner, from, to, left, right)
        self._build(0, len(points), leaf)

    def _build(self, start: int, stop: int, leaf: int) -> int:
        own = self.points[self.order[start:stop]]
        low, high = own.min(axis=0), own.max(axis=0)
        k = len(self.nodes)
        self.nodes.append(())
        left = right = -1
        if stop - start > leaf:
            axis, middle = int(np.argmax(high - low)), (stop - start) // 2
            self.order[start:stop] = self.order[start:stop][np.argpartition(own[:, axis], middle)]
            left = self._build(start, start + middle, leaf)
            right = self._build(start + middle, stop, leaf)
        self.nodes[k] = (low, high, start, stop, left, right)
        return k

    def _distance(self, k: int, query: np.ndarray) -> float:
        low, high = self.nodes[k][:2]
        gap = np.maximum(np.maximum(low - query, query - high), 0.0)
        return float(gap @ gap)

    def leaves(self, query: np.ndarray):
        """(squared projected distance, members) of leaves, nearest first."""
        heap = [(self._distance(0, query), 0)]
        while heap:
            distance, k = heapq.heappop(heap)
            _, _, start, stop, left, right = self.nodes[k]
            if left < 0:
                yield distance, self.order[start:stop]
            else:
                heapq.heappush(heap, (self._distance(left, query), left))
                heapq.heappush(heap, (self._distance(right, query), right))


class Index:
    def __init__(self, ids: np.ndarray, vectors: np.ndarray, dimensions=DIMENSIONS):
        self.ids, self.vectors = ids, vectors
        directions = np.random.default_rng(SEED).standard_normal((vectors.shape[1], dimensions))
        self.directions = directions
        self.projected = vectors @ directions
        self.tree = Tree(self.projected)

    def search(self, vector: np.ndarray, k: int, limit: float):
        """The k nearest found as (distance, id), by distance and id. ``limit`` is the squared
        ratio of projected to true distance that a point exceeds with chance 1 - confidence."""
        query = vector @ self.directions
        best_d = np.full(k, np.inf)
        best_i = np.full(k, np.iinfo(np.int64).max)
        for reached, members in self.tree.leaves(query):
            radius = best_d[-1] ** 2 * limit
            if reached > radius:
                break
            gaps = self.projected[members] - query
            near = members[np.einsum("ij,ij->i", gaps, gaps) <= radius] if radius < np.inf else members
            if not len(near):
                continue
            distance = np.sqrt(((self.vectors[near] - vector) ** 2).sum(axis=1))
            better = distance <= best_d[-1]
            if better.any():
                d = np.concatenate([best_d, distance[better]])
                i = np.concatenate([best_i, self.ids[near[better]]])
                top = np.lexsort((i, d))[:k]
                best_d, best_i = d[top], i[top]
        found = np.isfinite(best_d)
        return best_d[found], best_i[found]


def usable(column: Column) -> Column:
    """Whether a vector takes part."""
    odd = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return (
        column.isNotNull()
        & (F.size(column) > 0)
        & ~F.exists(column, odd)
        & F.exists(column, lambda x: x != 0)
    )


def _answers(left: pd.DataFrame, right: pd.DataFrame, k: int, limit: float) -> pd.DataFrame:
    names = ["query_id", "vec_id", "score"]
    if left.empty or right.empty:
        return pd.DataFrame([], columns=names).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})
    # In the order of ids, so that a result does not depend on the order of arrival.
    left = left.sort_values("vec_id", kind="stable")
    index = Index(
        left["vec_id"].to_numpy(np.int64), np.vstack(left["v"].to_numpy()).astype(np.float64)
    )
    out, known = [], {}
    for query_id, vector in zip(right["vec_id"], right["v"], strict=True):
        vector = np.asarray(vector, dtype=np.float64)
        key = vector.tobytes()
        if key not in known:
            known[key] = index.search(vector, k + 1, limit)
        distance, ids = known[key]
        other = ids != query_id
        n = min(k, int(other.sum()))
        out.append((np.full(n, query_id), ids[other][:n], distance[other][:n]))
    columns = [np.concatenate(c) for c in zip(*out, strict=True)]
    return pd.DataFrame(dict(zip(names, columns, strict=True)))


def searched(
    vectors: DataFrame,
    key="vec_id",
    vector="embedding",
    k: int = NEAREST,
    every: int = EVERY,
    confidence: float = CONFIDENCE,
    shard_rows: int = SHARD_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """query_id, rank, vec_id, score: for each row whose id is divisible by ``every``, the k
    nearest other rows found."""
    rows = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    rows = rows.where(F.col("vec_id").isNotNull() & usable(F.col("v")))
    rows = rows.dropDuplicates(["vec_id", "v"]).withColumn("n", F.size("v"))
    n_rows = rows.count()
    shards, blocks = -(-n_rows // shard_rows) or 1, -(-n_rows // (every * block_rows)) or 1
    limit = chi_square_quantile(confidence, DIMENSIONS)

    of_copies = Window.partitionBy("v").orderBy("vec_id")
    candidates = rows.withColumn("copy", F.row_number().over(of_copies)).where(
        F.col("copy") <= k + 1
    )
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    slot = lambda n, salt: F.pmod(F.xxhash64("vec_id", F.lit(salt)), F.lit(n)).cast("int")
    left = candidates.select("vec_id", "v", "n", slot(shards, 1).alias("shard"), each(blocks).alias("block"))
    right = rows.where(F.col("vec_id") % every == 0).select(
        "vec_id", "v", "n", slot(blocks, 2).alias("block"), each(shards).alias("shard")
    )
    keys = ["n", "shard", "block"]
    near = (
        left.groupBy(*keys)
        .cogroup(right.groupBy(*keys))
        .applyInPandas(
            lambda a, b: _answers(a, b, k, limit), "query_id long, vec_id long, score double"
        )
    )
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    best = near.withColumn("rank", F.row_number().over(order))
    return best.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
