"""Approximate nearest neighbours by collision counting over single projections.

Every block of rows keeps, for each of ``LINES`` random lines, its projections in sorted order. A query opens a
window around its own projection on every line and widens all windows together (virtual rehashing:
radius R opens half-width ``HALF`` * R); each row that a window takes in counts one collision. A row
whose collisions reach ``ALPHA`` of the lines is verified with its exact distance. A query is done
in a block when its k-th verified distance is within R, or when the windows hold the whole block.

Every row is in exactly one block and every block is searched for every query; a block's k best go
on, and the k best of these are the answer. Lines are drawn from a fixed seed; nothing is fitted.
Blocks stream: a task holds one block's index and one batch of queries.

Defined results: vectors that are null, empty, zero or hold a null or non-finite component take no
part, nor do rows with a null id; vectors of different lengths are never compared; rows with the query's id are
its own; a query id on several rows is searched once, with its least vector; ties in distance go
to the smaller id; fewer than k candidates give all of them; empty tables give no rows. Only the named columns are used.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

K = 10
BLOCK_ROWS = 16384
#: A row at distance d collides on a line with probability P(|N(0, 1)| <= HALF * R / d): 0.826 at d = R, 0.733 at 1.23 R. With so many
#: lines, ALPHA lies 1.2 deviations below the first rate and 1.3 above the second, so that most rows beyond R are not verified.
LINES, HALF, ALPHA = 128, 1.36, 0.785
#: Radii start at FIRST_RADIUS, in units of the spread of the block's projections, and grow fast below FINE_FROM, where few rows collide.
FIRST_RADIUS, FINE_FROM, FAST, FINE = 0.05, 0.3, 1.5, 1.08
SEED = 20_240_601


class Block:
    """The index of one block."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        self.lines = np.random.default_rng(SEED).standard_normal((LINES, vectors.shape[1]))
        at = (vectors @ self.lines.T).T
        self.order = np.argsort(at, axis=1, kind="stable").astype(np.int32)
        self.unit = float(np.median(at.std(axis=1))) or 1.0
        # All lines in one sorted array, each moved past the one before, so that one search serves all of them.
        self.low, self.high = at.min(), at.max()
        self.first = np.arange(LINES) * (2 * (self.high - self.low) + 1)
        self.sorted = (np.take_along_axis(at, self.order, axis=1) - self.low + self.first[:, None]).ravel()
        self.n_verified = 0

    def _cuts(self, at: np.ndarray, side: str) -> np.ndarray:
        """On each line, the place of a value among the rows."""
        flat = np.searchsorted(self.sorted, np.clip(at, self.low - 0.25, self.high + 0.25) - self.low + self.first, side)
        return flat - np.arange(LINES) * len(self.ids)

    def search(self, own: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, distances) of the k best verified rows, nearest first."""
        n = len(self.ids)
        at = self.lines @ query
        left = self._cuts(at, "left")
        right = left.copy()
        hits = np.zeros(n, dtype=np.int32)
        checked = self.ids == own
        got = np.zeros(0, dtype=np.int64)
        dist = np.zeros(0)
        radius = FIRST_RADIUS * self.unit
        while True:
            a, b = np.minimum(self._cuts(at - HALF * radius, "left"), left), np.maximum(self._cuts(at + HALF * radius, "right"), right)
            parts = [o[i:j] for o, x, y in zip(self.order, zip(a, left, strict=True), zip(right, b, strict=True), strict=True) for i, j in (x, y) if i < j]
            left, right = a, b
            if parts:
                hits += np.bincount(np.concatenate(parts), minlength=n).astype(np.int32)
            whole = bool((left == 0).all() and (right == n).all())
            new = np.flatnonzero((hits >= (0 if whole else ALPHA * LINES)) & ~checked)
            if len(new):
                checked[new] = True
                self.n_verified += len(new)
                got = np.concatenate((got, new))
                gap = self.vectors[new] - query
                dist = np.concatenate((dist, np.sqrt(np.einsum("ij,ij->i", gap, gap))))
                best = np.lexsort((self.ids[got], dist))[:k]
                got, dist = got[best], dist[best]
            if whole or (len(dist) >= k and dist[k - 1] <= radius):
                return self.ids[got], dist
            radius *= FAST if radius < FINE_FROM * self.unit else FINE


def _search(k: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Sorted rows (dim, block, is_query, id, vector): a block's rows before its queries."""
        key, ids, vectors, index = None, [], [], None
        for batch in batches:
            out = []
            for dim, block, is_query, i, v in zip(batch["dim"], batch["block"], batch["is_query"], batch["id"], batch["vector"], strict=True):
                if (dim, block) != key:
                    key, ids, vectors, index = (dim, block), [], [], None
                if not is_query:
                    ids.append(i)
                    vectors.append(v)
                elif ids:
                    index = index or Block(np.array(ids, dtype=np.int64), np.array(vectors, dtype=np.float64))
                    out += [(i, int(a), float(d)) for a, d in zip(*index.search(i, np.asarray(v, dtype=np.float64), k), strict=True)]
            yield pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})
    return run


def usable(vector: Column) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~bad & F.exists(vector, lambda x: x != 0)


def search(rows: DataFrame, queries: DataFrame, k: int = K, id_col: str = "vec_id", vector: str = "embedding",
           block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k nearest found rows by Euclidean distance."""
    def clean(df: DataFrame) -> DataFrame:
        own = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"))
        return own.where(F.col("id").isNotNull() & usable(F.col("vector"))).withColumn("dim", F.size("vector"))

    n = max(1, -(-rows.count() // block_rows))
    points = clean(rows).withColumn("block", F.pmod(F.xxhash64("id"), F.lit(n)).cast("int"))
    asked = clean(queries).groupBy("id").agg(F.min("vector").alias("vector")).withColumn("dim", F.size("vector"))
    asked = asked.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    cols = ["dim", "block", "is_query", "id", "vector"]
    both = points.withColumn("is_query", F.lit(False)).select(cols).unionByName(asked.withColumn("is_query", F.lit(True)).select(cols))
    found = both.repartition("dim", "block").sortWithinPartitions("dim", "block", "is_query", "id").mapInPandas(
        _search(k), "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
