"""Approximate nearest neighbours by inner product: projections, kd-tree, chi-square stop.

Largest inner product becomes smallest distance: with M the largest norm of all vectors, x gets
the extra coordinate sqrt(M**2 - |x|**2) and a query q is scaled to length M with extra coordinate
0; then |q - x|**2 = 2 M**2 - 2 (M / |q|) q.x. Points are projected to a few dimensions by a fixed
Gaussian (2-stable) matrix: the squared projected distance of two points is their squared distance
times a chi-square variable. A kd-tree over the projected points gives its leaves in order of
projected distance; their points are verified one batch of leaves after another with exact inner
products, until the next leaf lies so far out (r) that a point within the k-th best distance (d)
would be projected beyond it with probability 1 - `confidence` at most:
chi-square CDF (r**2 / d**2) >= confidence. So each true neighbour is found with probability
`confidence` or more, whatever the data. On data without structure most leaves pass that test and
the search approaches a full scan; on clustered data it ends early.

Rows are dealt by a hash of their id into blocks, queries into query blocks, and each (block,
query block) is one task with one kd-tree; every row is indexed. Equal vectors spread over all
blocks. A task holds `block_rows` vectors and `query_rows` queries, however many there are; the
best k of each block are merged by a window with a rank limit.

Scores are exactly rounded inner products of the original values, so equal vectors tie exactly,
and ties go to the smaller id. Cases: null, zero, or vectors with null or non-finite components
take no part, nor do vectors of another length than most (the longer on a tie); null ids take no
part; a repeated query id is asked once (with its smallest vector), a repeated candidate row may
be returned twice; other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.session import materialize

DIMENSIONS = 16  # of the projection; even
CONFIDENCE = 0.99
BLOCK_ROWS = 8_192
QUERY_ROWS = 1_024
LEAF = 32
BATCH = 512  # points verified between two tests
SEED = 20


def chi_square_quantile(probability: float, degrees: int) -> float:
    """Quantile of the chi-square distribution with an even number of degrees of freedom."""

    def cdf(x: float) -> float:
        term, total = 1.0, 1.0
        for i in range(1, degrees // 2):
            term *= x / 2 / i
            total += term
        return 1 - math.exp(-x / 2) * total

    low, high = 0.0, 1.0
    while cdf(high) < probability:
        high *= 2
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if cdf(middle) < probability else (low, middle)
    return high


class KdTree:
    """Leaves of a kd-tree: rows in leaf order, bounds of each leaf, and its bounding box."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        rows, leaves, todo = [], [], [np.arange(len(points))]
        while todo:
            part = todo.pop()
            if len(part) > leaf:
                own = points[part]
                axis = int(np.argmax(own.max(0) - own.min(0)))
                half = len(part) // 2
                order = np.argpartition(own[:, axis], half)
                todo += [part[order[half:]], part[order[:half]]]
            else:
                rows.append(part)
                leaves.append((points[part].min(0), points[part].max(0)))
        self.rows = np.concatenate(rows)
        self.ends = np.cumsum([len(r) for r in rows])
        self.low = np.array([low for low, _ in leaves])
        self.high = np.array([high for _, high in leaves])

    def squared_distances(self, point: np.ndarray) -> np.ndarray:
        gap = np.maximum(np.maximum(self.low - point, point - self.high), 0)
        return np.einsum("ij,ij->i", gap, gap)


class Index:
    """One block of vectors, searchable."""

    def __init__(self, ids, vectors, largest: float, dimensions: int, seed: int = SEED):
        self.largest = largest
        spare = np.sqrt(np.maximum(largest**2 - np.einsum("ij,ij->i", vectors, vectors), 0))
        rng = np.random.default_rng(seed)
        self.matrix = rng.standard_normal((vectors.shape[1] + 1, dimensions))
        self.tree = KdTree(np.column_stack([vectors, spare]) @ self.matrix)
        self.ids, self.vectors = ids[self.tree.rows], vectors[self.tree.rows]

    def search(self, own: int, query: np.ndarray, k: int, quantile: float):
        """(id, score) of the k best rows but those with the query's own id."""
        # Scaled first: the square of a very short vector would be zero.
        scale = float(np.abs(query).max())
        unit = query / scale
        unit_length = math.sqrt(float(unit @ unit))
        length = scale * unit_length
        point = (unit * (self.largest / unit_length)) @ self.matrix[:-1]
        outer = self.tree.squared_distances(point)
        order = np.argsort(outer, kind="stable")
        sizes = np.diff(self.tree.ends, prepend=0)[order]
        starts = self.tree.ends[order] - sizes
        # Scores equal up to rounding are kept together; they are told apart exactly at the end.
        slack = 1e-12 * length * self.largest
        best = np.zeros(0)
        found, scores, at, bound = [], [], 0, -np.inf
        while at < len(order):
            if len(best) == k:
                distance = max(2 * self.largest**2 - 2 * self.largest * (bound / length), 0.0)
                if outer[order[at]] > quantile * distance + 1e-9 * self.largest**2:
                    break
            to = at + max(1, int(np.searchsorted(np.cumsum(sizes[at:]), BATCH)))
            rows = np.concatenate([np.arange(s, s + n) for s, n in zip(starts[at:to], sizes[at:to])])
            at = to
            rows = rows[self.ids[rows] != own]
            score = self.vectors[rows] @ query
            near = score >= bound - slack
            found.append(rows[near])
            scores.append(score[near])
            best = np.sort(np.concatenate([best, score[near]]))[-k:]
            bound = best[0] if len(best) == k else -np.inf
        rows, score = np.concatenate(found), np.concatenate(scores)
        rows = rows[score >= bound - slack]
        if len(rows) > 4 * k:  # many ties: equal vectors are scored once
            _, first, of = np.unique(self.vectors[rows], axis=0, return_index=True, return_inverse=True)
            exact = np.array([self._exact(rows[i], query) for i in first])[of.ravel()]
        else:
            exact = np.array([self._exact(r, query) for r in rows])
        order = np.lexsort((self.ids[rows], -exact))[:k]
        return self.ids[rows[order]], exact[order]

    def _exact(self, row: int, query: np.ndarray) -> float:
        return math.fsum((self.vectors[row] * query).tolist())


def _usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    vector = F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), vector.alias("v")).where(
        "id is not null and v is not null"
    )

    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))

    rows = rows.where(F.forall("v", finite) & F.exists("v", lambda x: x != 0))
    return rows.withColumn("norm2", F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 20,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    dimensions: int = DIMENSIONS,
    confidence: float = CONFIDENCE,
    block_rows: int = BLOCK_ROWS,
    query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """query_id, rank, id, score: the k nearest of `vectors` found for each row of `queries`."""
    spark = vectors.sparkSession
    rows = materialize(_usable(vectors, id_col, vector_col), "vectors")
    lengths = rows.groupBy(F.size("v").alias("n")).agg(
        F.count("*").alias("rows"), F.max("norm2").alias("norm2")
    )
    usual = lengths.orderBy(F.desc("rows"), F.desc("n")).first()
    schema = "query_id long, vec_id long, score double"
    if usual is None:
        found = spark.createDataFrame([], schema)
    else:
        size, largest = usual["n"], math.sqrt(usual["norm2"]) * (1 + 1e-12)
        asked = _usable(queries, id_col, vector_col).groupBy("id").agg(F.min("v").alias("v"))
        asked = materialize(asked.where(F.size("v") == size), "queries")
        blocks = max(1, -(-usual["rows"] // block_rows))
        query_blocks = max(1, -(-asked.count() // query_rows))

        def dealt(df: DataFrame, own: str, n: int, other: str, copies: int) -> DataFrame:
            number = F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")
            every = F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))
            return df.select("id", "v", number.alias(own), every.alias(other))

        quantile = chi_square_quantile(confidence, dimensions)

        def search(data: pd.DataFrame, ask: pd.DataFrame) -> pd.DataFrame:
            out = []
            if len(data) and len(ask):
                index = Index(
                    data["id"].to_numpy(), np.stack(data["v"].to_list()), largest, dimensions
                )
                for own, query in zip(ask["id"], ask["v"]):
                    ids, scores = index.search(own, np.asarray(query), k, quantile)
                    out.append(pd.DataFrame({"query_id": own, "vec_id": ids, "score": scores}))
            if not out:
                return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype(
                    {"query_id": "int64", "vec_id": "int64"}
                )
            return pd.concat(out)

        data = dealt(rows.where(F.size("v") == size), "block", blocks, "ask", query_blocks)
        ask = dealt(asked, "ask", query_blocks, "block", blocks)
        found = (
            data.groupBy("block", "ask")
            .cogroup(ask.groupBy("block", "ask"))
            .applyInPandas(search, schema)
        )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.col("vec_id"))
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", F.col("vec_id").alias(id_col), "score")
    )
