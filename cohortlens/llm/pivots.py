"""Exact top-k by integer inner product, with a pivot table that eliminates candidates.

* Components become floor(scale * x). ``PIVOTS`` pivots are chosen farthest-first from a bounded sample (``SAMPLE`` rows by
  hash; only the speed depends on it); every row's distances to all pivots are computed once and kept beside the row.
* For a query q and a row x the largest |d(q, p) - d(x, p)| over the pivots is a lower bound L of d(q, x), so that their inner product is
  at most (|q|^2 + |x|^2 - L^2) / 2.
* Rows live in cells by nearest pivot, cells in blocks of about ``BLOCK_ROWS``. A query first visits one block of its own cell, which
  gives its k-th score so far; then those blocks of all cells whose bound, from the cell's least and largest distance to each
  pivot, reaches that score. Within a block, rows are evaluated in the order of their bounds until the next bound is
  below the k-th score. All that is not evaluated is proven to score lower, so results are exact.

Blocks stream: a task holds one block and passes queries by one at a time; a hot cell is many blocks. The driver holds the
pivots and one row of 2 * PIVOTS numbers for each cell (at most PIVOTS for each vector length).

Defined results: vectors that are null or empty or hold a null or non-finite component take no part, nor do rows with a null id or
a component beyond ``LARGEST`` after scaling (whose scores could leave 64 bits); vectors of different lengths are never compared; rows with
the query's id are its own; a query id on several rows is searched once, with its least vector; repeated rows are candidates of their own;
ties go to the smaller id; fewer than k candidates give all of them; empty tables give no rows. Only the named columns are used.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.session import materialize

K = 10
SCALE = 1024
PIVOTS, SAMPLE = 64, 1024
BLOCK_ROWS = 4096
FIRST = 64  # rows evaluated at first; doubles
LARGEST = 1 << 24
#: Share of the squared sizes by which bounds are widened: far above the rounding of distances kept in single precision.
SLACK = 2e-6
POINT = "row long, id long, dim int, cell int, norm double, vector binary, dists binary"
ROUTED = "dim int, cell int, block int, is_query boolean, id long, vector binary, dists binary, least long"


def resized(pivots: np.ndarray, dim: int) -> np.ndarray:
    """Any points are right pivots: cut or filled with zeros to the length of the vectors."""
    out = np.zeros((len(pivots), dim))
    out[:, :min(dim, pivots.shape[1])] = pivots[:, :dim]
    return out


def choose(sample: np.ndarray, n: int = PIVOTS) -> np.ndarray:
    """Farthest-first traversal of a sample."""
    if not len(sample):
        return np.zeros((1, 1))
    picked, gap = [0], np.linalg.norm(sample - sample[0], axis=1)
    while len(picked) < n and gap.max() > 0:
        picked.append(int(gap.argmax()))
        gap = np.minimum(gap, np.linalg.norm(sample - sample[picked[-1]], axis=1))
    return sample[picked]


def _describe(batches: Iterator[pd.DataFrame], pivots: np.ndarray) -> Iterator[pd.DataFrame]:
    """Rows with their distances to all pivots."""
    for batch in batches:
        for dim, rows in batch.groupby("dim"):
            x, p = np.stack(rows["vector"].to_numpy()).astype(np.float64), resized(pivots, dim)
            d = np.sqrt(np.maximum((x * x).sum(axis=1)[:, None] + (p * p).sum(axis=1) - 2 * x @ p.T, 0))
            yield pd.DataFrame({"row": rows["row"], "id": rows["id"], "dim": dim, "cell": d.argmin(axis=1), "norm": (x * x).sum(axis=1),
                                "vector": [v.tobytes() for v in x.astype("<i4")], "dists": [v.tobytes() for v in d.astype("<f4")]})


def _ranges(batches: Iterator[pd.DataFrame], n: int) -> Iterator[pd.DataFrame]:
    for batch in batches:
        out = []
        for (dim, cell), rows in batch.groupby(["dim", "cell"]):
            d = np.frombuffer(b"".join(rows["dists"]), "<f4").reshape(-1, n).astype(np.float64)
            out += [(dim, cell, p, lo, hi, rows["norm"].max(), len(rows)) for p, (lo, hi) in enumerate(zip(d.min(axis=0), d.max(axis=0), strict=True))]
        yield pd.DataFrame(out, columns=["dim", "cell", "pivot", "lo", "hi", "norm", "n"])


class Block:
    """The rows of one block, their distances to the pivots and their norms."""

    def __init__(self, ids: list[int], vectors: list[bytes], dists: list[bytes]):
        self.ids = np.array(ids, dtype=np.int64)
        self.x = np.frombuffer(b"".join(vectors), "<i4").reshape(len(ids), -1).astype(np.float64)
        self.d = np.frombuffer(b"".join(dists), "<f4").reshape(len(ids), -1)
        self.norm = (self.x * self.x).sum(axis=1)
        self.size, self.largest = float(np.sqrt(self.norm.max())), float(np.abs(self.x).max(initial=0))
        self.n_scored = 0

    def scores(self, at: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Inner products, exactly: in doubles where every sum is below 2^53."""
        if self.largest * np.abs(q).max(initial=0) * len(q) < 2.0 ** 53:
            return (self.x[at] @ q).astype(np.int64)
        return self.x[at].astype(np.int64) @ q.astype(np.int64)

    def search(self, own: int, q: np.ndarray, dists: np.ndarray, least: int | None, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the k best rows that reach ``least``, best first."""
        gap = np.abs(self.d - dists).max(axis=1).astype(np.float64)
        norm = float(q @ q)
        most = (norm + self.norm - gap * gap) / 2 + SLACK * (np.sqrt(norm) + self.size) ** 2 + 1
        most[self.ids == own] = -np.inf
        order = np.argsort(-most, kind="stable")
        bound = most[order]
        ids, got = np.zeros(0, np.int64), np.zeros(0, np.int64)
        at, step, floor = 0, FIRST, -np.inf if least is None else least
        while at < len(order) and bound[at] >= floor and bound[at] > -np.inf:
            # Of the next rows, those whose bound reaches the k-th score.
            take = order[at:at + step][bound[at:at + step] >= max(floor, -1e300)]
            at, step, self.n_scored = at + step, 2 * step, self.n_scored + len(take)
            ids, got = np.concatenate((ids, self.ids[take])), np.concatenate((got, self.scores(take, q)))
            best = np.lexsort((ids, -got))[:k]
            ids, got = ids[best], got[best]
            if len(got) == k:
                floor = max(floor, got[-1])
        ok = got >= floor if least is not None else slice(None)
        return ids[ok], got[ok]


def _search(batches: Iterator[pd.DataFrame], k: int) -> Iterator[pd.DataFrame]:
    """Sorted rows (dim, cell, block, is_query, ...): a block's rows before its queries."""
    key, rows, block = None, [], None
    for batch in batches:
        out = []
        for *own, is_query, i, vector, dists, least in batch.itertuples(index=False, name=None):
            if own != key:
                key, rows, block = own, [], None
            if not is_query:
                rows.append((i, vector, dists))
                continue
            if rows and block is None:
                block = Block(*zip(*rows, strict=True))
            if block is not None:
                q = np.frombuffer(vector, "<i4").astype(np.float64)
                found = block.search(i, q, np.frombuffer(dists, "<f4"), None if pd.isna(least) else int(least), k)
                out += [(i, int(a), int(s)) for a, s in zip(*found, strict=True)]
        yield pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype("int64")


def _route(batches: Iterator[pd.DataFrame], cells: dict) -> Iterator[pd.DataFrame]:
    """A query's row for each block that may hold one of its best, its first block excepted."""
    for batch in batches:
        out = []
        for dim, cell, block, i, vector, dists, least in batch.itertuples(index=False, name=None):
            d, q = np.frombuffer(dists, "<f4").astype(np.float64), np.frombuffer(vector, "<i4").astype(np.float64)
            norm = float(q @ q)
            for other, (lo, hi, most, n) in cells.get(dim, {}).items():
                gap = max(0.0, float(np.maximum(lo - d, d - hi).max()))
                bound = (norm + most - gap * gap) / 2 + SLACK * (np.sqrt(norm) + np.sqrt(most)) ** 2 + 1
                if pd.isna(least) or bound >= least:
                    out += [(dim, other, b, True, i, vector, dists, least) for b in range(n) if (other, b) != (cell, block)]
        yield pd.DataFrame(out, columns=[c.split()[0] for c in ROUTED.split(", ")]).astype({"least": "Int64"})


def search(rows: DataFrame, queries: DataFrame, k: int = K, id_col: str = "vec_id", vector: str = "embedding", scale: int = SCALE,
           block_rows: int = BLOCK_ROWS, n_pivots: int = PIVOTS) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` largest inner products."""
    def clean(df: DataFrame) -> DataFrame:
        own = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
        bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) * scale > LARGEST))  # infinite ones too
        own = own.where(F.col("id").isNotNull() & (F.size("v") > 0) & ~bad)
        return own.select("id", F.size("v").alias("dim"), F.transform("v", lambda x: F.floor(x * scale)).alias("vector"))

    points = clean(rows)
    sample = points.orderBy(F.xxhash64("id"), "vector").limit(SAMPLE).select("vector").collect()
    dim = max((len(r[0]) for r in sample), default=1)
    pivots = choose(resized_rows([r[0] for r in sample], dim), n_pivots)
    describe = lambda df: df.withColumn("row", F.monotonically_increasing_id()).mapInPandas(partial(_describe, pivots=pivots), POINT)
    points = materialize(describe(points), "pivot-points")
    asked = materialize(describe(clean(queries).groupBy("id").agg(F.min(F.struct("dim", "vector")).alias("v")).select("id", "v.*")), "pivot-queries")

    ranges = points.select("dim", "cell", "norm", "dists").mapInPandas(partial(_ranges, n=len(pivots)), "dim int, cell int, pivot int, lo double, hi double, norm double, n long")
    ranges = ranges.groupBy("dim", "cell", "pivot").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.max("norm").alias("norm"), F.sum("n").alias("n"))
    cells: dict[int, dict] = {}  # at most len(pivots) cells for each length
    for (d, c), g in ranges.toPandas().sort_values("pivot").groupby(["dim", "cell"]):
        cells.setdefault(int(d), {})[int(c)] = (g["lo"].to_numpy(), g["hi"].to_numpy(), float(g["norm"].max()), -(-int(g["n"].max()) // block_rows))
    blocks = rows.sparkSession.createDataFrame([(d, c, v[3]) for d, own in cells.items() for c, v in own.items()], "dim int, cell int, blocks int")

    none, cols = F.lit(None).cast("long"), [c.split()[0] for c in ROUTED.split(", ")]
    dealt = points.join(F.broadcast(blocks), ["dim", "cell"]).withColumn("block", F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int"))
    dealt = dealt.select(*cols[:3], F.lit(False).alias("is_query"), "id", "vector", "dists", none.alias("least"))

    def visit(routed: DataFrame, tag: str) -> DataFrame:
        both = dealt.unionByName(routed.select(cols)).repartition("dim", "cell", "block").sortWithinPartitions("dim", "cell", "block", "is_query")
        return materialize(both.mapInPandas(partial(_search, k=k), "query_id long, vec_id long, score long"), tag)

    home = asked.join(F.broadcast(blocks), ["dim", "cell"], "left").withColumn("block", F.pmod(F.xxhash64("id"), F.coalesce("blocks", F.lit(1))).cast("int"))
    first = visit(home.withColumns({"is_query": F.lit(True), "least": none}), "pivot-first")
    reached = first.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("least")).where(F.col("n") >= k)
    routed = home.join(reached, F.col("id") == F.col("query_id"), "left").select("dim", "cell", "block", "id", "vector", "dists", "least")
    rest = visit(routed.mapInPandas(partial(_route, cells=cells), ROUTED), "pivot-rest")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return first.unionByName(rest).withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def resized_rows(vectors: list, dim: int) -> np.ndarray:
    out = np.zeros((len(vectors), dim))
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out
