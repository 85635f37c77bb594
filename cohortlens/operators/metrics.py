"""Clustering scores: MT1-MT9 (WCSS, silhouette, Davies-Bouldin, Calinski-Harabasz, ARI,
sentinels, validity) on a labelled frame ``(id, cluster, features...)``.

Centroid-based scores are aggregates: one ``groupBy(cluster)`` for the centroids (k rows), one
pass over the rows joined to those k rows; adaptive execution picks the join by the table's bytes.

The exact Euclidean silhouette is quadratic by definition. It is computed by a blocked plan:
rows are hashed into B blocks of bounded size, every unordered pair of blocks is one cogrouped
task that reduces its distance tiles to sums per row and cluster inside NumPy, for the rows of both
blocks — no pair row is ever emitted — and the sums are combined with a partial aggregation. Where many
clusters make those sums wider than the rows, each block is one task that all rows stream through instead, and a
row's silhouettes leave it once.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.session import materialize

INF = float("inf")
TILE_ROWS, TILE_COLUMNS = 128, 1024  # distances held at once in a task
FEW_COLUMNS = 16  # that a product of matrices sums faster
BLOCK_ROWS, BLOCK_NUMBERS = 1 << 16, 1 << 21  # the most rows, and the most numbers of vectors, of a block
NO_LABEL = -(1 << 63)  # null labels are a cluster
MOST_CLUSTERS = 256  # of all labellings, whose sums travel side by side
STREAM_ROWS, STREAM_NUMBERS = 1 << 18, 1 << 24  # the most rows, and the most numbers, of a block that rows stream through
STREAM_COLUMNS = 8  # vectors of more numbers meet in pairs of blocks, which compute each distance once
STREAM_TILE_ROWS, STREAM_TILE_COLUMNS = 16, 2048
NEAR = 1e-6  # of two vectors' squared sizes: a lesser squared distance would lose more than nine of its digits


def _cols(cols: Sequence[str]):
    return [F.col(c).cast("double") for c in cols]


def centroids(df: DataFrame, cols: Sequence[str], cluster: str = "cluster") -> DataFrame:
    """(cluster, n, m_0..m_{d-1}): one aggregate, partial sums map-side."""
    return df.groupBy(F.col(cluster).alias("_k")).agg(
        F.count(F.lit(1)).alias("_n"), *[F.avg(F.col(c).cast("double")).alias(f"_m{i}") for i, c in enumerate(cols)])


def _with_centroid(df: DataFrame, cols: Sequence[str], cluster: str) -> DataFrame:
    cent = centroids(df, cols, cluster)
    d2 = sum(((F.col(c).cast("double") - F.col(f"_m{i}")) ** 2 for i, c in enumerate(cols)), F.lit(0.0))
    return df.join(cent, F.col(cluster) == F.col("_k")).withColumn("_d2", d2)


def wcss(df: DataFrame, cols: Sequence[str], cluster: str = "cluster") -> DataFrame:
    """MT1: sum of squared distances to the own centroid (one row: wcss)."""
    return _with_centroid(df, cols, cluster).agg(F.sum("_d2").alias("wcss"))


def centroid_scores(df: DataFrame, cols: Sequence[str], cluster: str = "cluster") -> DataFrame:
    """MT1 + MT3 + MT4 in one row: n_rows, n_labels, wcss, davies_bouldin, calinski_harabasz."""
    (n, k, w, db, ch), = centroid_scores_many(df, cols, [cluster]).values()
    return df.sparkSession.createDataFrame(
        [(n, k, w, db, ch)], "n_rows LONG, n_labels LONG, wcss DOUBLE, davies_bouldin DOUBLE, calinski_harabasz DOUBLE")


CENTROID_BLOCK = 1024  # centroids on either side of a Davies-Bouldin tile


def _worst_ratio(d: int):
    """A tile of centroid pairs: for each left centroid the largest (s_i + s_j) / distance; coincident centroids give 0."""
    def kernel(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({"lab": [], "k": [], "r": []})
        m = [f"m{i}" for i in range(d)]
        a, b = left[m].to_numpy(), right[m].to_numpy()
        dist = np.sqrt(((a[:, None, :] - b[None, :, :]) ** 2).sum(-1))
        pair = left["s"].to_numpy()[:, None] + right["s"].to_numpy()[None, :]
        ratio = np.where((dist > 0) & (left["k"].to_numpy()[:, None] != right["k"].to_numpy()[None, :]), pair / np.where(dist > 0, dist, 1.0), 0.0)
        return pd.DataFrame({"lab": left["lab"], "k": left["k"], "r": ratio.max(axis=1)})
    return kernel


def centroid_scores_many(df: DataFrame, cols: Sequence[str], clusters: Sequence[str]) -> dict:
    """``centroid_scores`` for several label columns of the same rows in the same two passes:
    every row yields one (labelling, cluster) key per label column, exploded map-side before the
    partial aggregate. Centroids stay a table: rows meet them by an equi-join, and the Davies-Bouldin
    maximum runs over tiles of CENTROID_BLOCK centroids, so many labels grow no driver structure.
    Returns {label column: (n_rows, n_labels, wcss, davies_bouldin, calinski_harabasz)}."""
    clusters = list(clusters)
    d = len(cols)
    keyed = F.explode(F.array(*[F.struct(F.lit(j).alias("lab"), F.col(c).cast("long").alias("k"))
                                for j, c in enumerate(clusters)])).alias("_lk")
    rows = df.select(keyed, *[x.alias(f"x{i}") for i, x in enumerate(_cols(cols))]).select("_lk.lab", "_lk.k", *[f"x{i}" for i in range(d)])
    cent = rows.groupBy("lab", "k").agg(F.count(F.lit(1)).alias("n"), *[F.avg(f"x{i}").alias(f"m{i}") for i in range(d)])
    d2 = sum(((F.col(f"x{i}") - F.col(f"m{i}")) ** 2 for i in range(d)), F.lit(0.0))
    per = rows.join(cent, ["lab", "k"]).withColumn("d2", d2).groupBy("lab", "k").agg(
        F.first("n").alias("n"), *[F.first(f"m{i}").alias(f"m{i}") for i in range(d)], F.avg(F.sqrt("d2")).alias("s"), F.sum("d2").alias("ss"))
    per = materialize(per, "centroids")
    total = per.groupBy("lab").agg(F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_labels"), F.sum("ss").alias("wcss"),
                                   *[(F.sum(F.col("n") * F.col(f"m{i}")) / F.sum("n")).alias(f"g{i}") for i in range(d)])
    off = sum(((F.col(f"m{i}") - F.col(f"g{i}")) ** 2 for i in range(d)), F.lit(0.0))
    between = per.join(total, "lab").groupBy("lab").agg(F.sum(F.col("n") * off).alias("between"))
    blocks = max(1, math.ceil(per.count() / CENTROID_BLOCK))
    side = per.withColumn("a", F.pmod(F.xxhash64("k"), F.lit(blocks)).cast("int")).withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    other = side.select("lab", F.col("b").alias("a"), F.col("a").alias("b"), *[F.col(c).alias(c) for c in ("k", "s", *[f"m{i}" for i in range(d)])])
    worst = side.groupBy("lab", "a", "b").cogroup(other.groupBy("lab", "a", "b")).applyInPandas(_worst_ratio(d), "lab int, k long, r double")
    db = worst.groupBy("lab", "k").agg(F.max("r").alias("r")).groupBy("lab").agg(F.avg("r").alias("db"))
    out = {}
    for r in total.join(between, "lab").join(db, "lab").collect():  # one row per labelling
        n, k, wcss = int(r["n_rows"]), int(r["n_labels"]), float(r["wcss"])
        ch = float("nan") if k < 2 else 1.0 if wcss == 0 else r["between"] * (n - k) / (wcss * (k - 1))
        out[clusters[r["lab"]]] = (n, k, wcss, float(r["db"]) if k >= 2 else float("nan"), ch)
    return out


def _grouped(dist: np.ndarray, of: np.ndarray, axis: int) -> np.ndarray:
    """``dist @ of`` (axis 1) or ``dist.T @ of`` (axis 0). Many columns: runs of equal rows of ``of`` are summed first, if long."""
    if of.shape[1] <= FEW_COLUMNS:
        return (dist if axis else dist.T) @ of
    starts = np.concatenate([[0], np.flatnonzero((of[1:] != of[:-1]).any(axis=1)) + 1])
    if len(starts) * 8 <= len(of):
        dist, of = np.add.reduceat(dist, starts, axis=axis), of[starts]
    return (dist if axis else dist.T) @ of


def _add_distance_sums(a: np.ndarray, b: np.ndarray, of_b: np.ndarray, left: np.ndarray, of_a: np.ndarray | None = None, right: np.ndarray | None = None,
                       same: bool = False) -> None:
    """Adds the distances of the rows of ``a`` and ``b``, weighted by the columns of ``of_b``, to ``left`` and, if asked for, by those of
    ``of_a`` to ``right``. One tile of TILE_ROWS x TILE_COLUMNS distances, which a core's cache holds, at a time."""
    one = lambda x: np.ones((len(x), 1))
    size = lambda x: (x * x).sum(axis=1)[:, None]
    p, q = np.hstack([a, size(a), one(a)]), np.ascontiguousarray(np.hstack([-2.0 * b, one(b), size(b)]).T)
    for lo in range(0, len(a), TILE_ROWS):
        for co in range(0, len(b), TILE_COLUMNS):
            dist = p[lo:lo + TILE_ROWS] @ q[:, co:co + TILE_COLUMNS]
            np.maximum(dist, 0.0, out=dist)
            np.sqrt(dist, out=dist)
            if same:
                i = np.arange(max(lo, co), min(lo + len(dist), co + dist.shape[1]))
                dist[i - lo, i - co] = 0.0
            left[lo:lo + TILE_ROWS] += _grouped(dist, of_b[co:co + TILE_COLUMNS], axis=1)
            if right is not None:
                right[co:co + TILE_COLUMNS] += _grouped(dist, of_a[lo:lo + TILE_ROWS], axis=0)


def _block_pair_sums(labels: list[np.ndarray]):
    """Of a pair of blocks: for every row of either one the summed distances to each (labelling, cluster) of the other. Each
    distance is computed once; a block that meets itself gives its rows once."""
    width, first = sum(len(v) for v in labels), np.cumsum([0, *[len(v) for v in labels]])

    def members(block: pd.DataFrame) -> np.ndarray:
        c, out = np.stack(block["c"].to_numpy()).astype(np.int64), np.zeros((len(block), width))
        for j, v in enumerate(labels):
            out[np.arange(len(block)), first[j] + np.searchsorted(v, c[:, j])] = 1.0
        return out

    def rows(block: pd.DataFrame, sums: np.ndarray, n: int) -> pd.DataFrame:
        return pd.DataFrame({"id": block["id"].to_numpy(), "c": block["c"].to_numpy(), "n": np.full(len(block), n, np.int64), "s": list(sums)})

    def ordered(block: pd.DataFrame) -> pd.DataFrame:
        """Rows of the same labels side by side."""
        block = block.sort_values("id", kind="stable")
        return block.iloc[np.lexsort(np.stack(block["c"].to_numpy()).T)]

    def kernel(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:  # a block without rows: the others' rows are counted where they meet themselves
            return pd.DataFrame({"id": [], "c": [], "n": [], "s": []})
        same, left, right = key[0] == key[1], ordered(left), ordered(right)
        a, of_a, sums = np.stack(left["x"].to_numpy()).astype(np.float64), members(left), np.zeros((len(left), width))
        if same:
            _add_distance_sums(a, a, of_a, sums, same=True)
            return rows(left, sums, 1)
        b, of_b, back = np.stack(right["x"].to_numpy()).astype(np.float64), members(right), np.zeros((len(right), width))
        _add_distance_sums(a, b, of_b, sums, of_a, back)
        return pd.concat([rows(left, sums, 0), rows(right, back, 0)], ignore_index=True)
    return kernel


def _block_rows(n: int, d: int, block_rows: int | None) -> int:
    """Rows of a block: as many as a task may hold, so that rows travel to few partners, but several blocks where that pays."""
    return block_rows or max(1, min(BLOCK_ROWS, BLOCK_NUMBERS // max(1, d), max(2048, math.ceil(n / 8))))


def _run_starts(codes: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))


def _by_differences(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The squared distances of the columns of ``a`` to those of ``b``, of 0 for equal ones."""
    return sum((x - y) ** 2 for x, y in zip(a, b, strict=True))


def _stream_distance_sums(a: np.ndarray, b: np.ndarray, codes: np.ndarray, members, sums: np.ndarray) -> None:
    """Adds to ``sums`` the distances of the columns of ``a`` to those of ``b`` by cluster. Runs of equal codes are summed
    first, if long. A tile's squares are one product of matrices, about a common centre; squares below NEAR times the sizes in
    it, which would lose digits (and all of a tile with infinite sizes), are computed by differences: equal rows are at distance 0."""
    center = a.mean(axis=1, keepdims=True)
    center = np.where(np.isfinite(center), center, 0.0)
    p, q = a - center, b - center
    size_p, size_q = (p * p).sum(axis=0), (q * q).sum(axis=0)
    p = np.ascontiguousarray(np.vstack([p, size_p, np.ones_like(size_p)]).T)
    q = np.vstack([-2.0 * q, np.ones_like(size_q), size_q])
    squares, small = np.empty(STREAM_TILE_ROWS * STREAM_TILE_COLUMNS), np.empty(STREAM_TILE_ROWS * STREAM_TILE_COLUMNS, dtype=bool)
    for co in range(0, b.shape[1], STREAM_TILE_COLUMNS):
        part, own = b[:, co:co + STREAM_TILE_COLUMNS], codes[co:co + STREAM_TILE_COLUMNS]
        other, largest, one = np.ascontiguousarray(q[:, co:co + STREAM_TILE_COLUMNS]), size_q[co:co + STREAM_TILE_COLUMNS].max(), np.ones(len(own))
        starts = _run_starts(own)
        runs = len(starts) * 8 <= len(own)
        of = members(own[starts] if runs else own)
        for lo in range(0, a.shape[1], STREAM_TILE_ROWS):
            rows = a[:, lo:lo + STREAM_TILE_ROWS]
            size = rows.shape[1] * len(own)
            dist, near = squares[:size].reshape(-1, len(own)), small[:size]
            least = NEAR * (size_p[lo:lo + STREAM_TILE_ROWS].max() + largest)
            np.matmul(p[lo:lo + STREAM_TILE_ROWS], other, out=dist)
            np.less(squares[:size], least, out=near)
            found = np.count_nonzero(near)
            if found * 16 > size or not least < INF:
                dist[:] = _by_differences(rows[:, :, None], part[:, None, :])
            elif found:
                at = np.flatnonzero(near)
                squares[at] = _by_differences(rows[:, at // len(own)], part[:, at % len(own)])
            np.sqrt(dist, out=dist)
            if runs and len(starts) == 1:
                sums[lo:lo + STREAM_TILE_ROWS] += (dist @ one)[:, None] * of
            else:
                sums[lo:lo + STREAM_TILE_ROWS] += (np.add.reduceat(dist, starts, axis=1) if runs else dist) @ of


def _row_silhouettes(own: np.ndarray, n: np.ndarray, sums: np.ndarray, sizes: list[np.ndarray]) -> np.ndarray:
    """The silhouettes of rows, a column per labelling: ``own`` the places of their clusters among the labelling's, ``n`` the rows that
    each stands for, ``sums`` their summed distances to each (labelling, cluster), ``sizes`` the rows of those."""
    out, at = np.zeros(own.shape), 0
    for j, size in enumerate(sizes):
        part, row = sums[:, at:at + len(size)], np.arange(len(own))
        at += len(size)
        if len(size) < 2:
            continue
        mine, rows = part[row, own[:, j]], n * size[own[:, j]]
        means = part / (n[:, None] * size)
        means[row, own[:, j]] = np.nan
        b = np.fmin.reduce(means, axis=1)
        with np.errstate(divide="ignore", invalid="ignore"):
            a = mine / (rows - 1)
            most = np.maximum(a, b)
            out[:, j] = np.where((rows <= 1) | (most == 0), 0.0, (b - a) / most)
    return out


def _streamed_block(labels: list[np.ndarray], d: int, sizes: list[np.ndarray] | None = None):
    """Of a partition (b, side, id, code, x0...) ordered by block, side and code: the rows of side 0 are the block, those of side 1
    stream past it. For every row of the block its summed distances to each (labelling, cluster) or, given the ``sizes`` of these, its
    silhouette in each labelling; rows of equal id and labels are one."""
    width, first = sum(len(v) for v in labels), np.cumsum([0, *[len(v) for v in labels]])
    radix = np.cumprod([1, *[len(v) for v in labels]])

    def members(codes: np.ndarray) -> np.ndarray:
        out = np.zeros((len(codes), width))
        for j, v in enumerate(labels):
            out[np.arange(len(codes)), first[j] + codes // radix[j] % len(v)] = 1.0
        return out

    def vectors(batches: list[pa.RecordBatch]) -> np.ndarray:
        return np.stack([np.concatenate([r.column(f"x{i}").to_numpy(zero_copy_only=False) for r in batches]) for i in range(d)])

    def finished(block: list[pa.RecordBatch], sums: np.ndarray):
        ids = pa.concat_arrays([r.column("id") for r in block])
        codes = np.concatenate([r.column("code").to_numpy() for r in block])
        same = ids.dictionary_encode(null_encoding="encode").indices.to_numpy()
        starts = np.flatnonzero(np.concatenate([[True], (codes[1:] != codes[:-1]) | (same[1:] != same[:-1])]))
        n, sums = np.diff([*starts, len(codes)]), np.add.reduceat(sums, starts, axis=0)
        for lo in range(0, len(starts), TILE_ROWS * 64):
            at = starts[lo:lo + TILE_ROWS * 64]
            place = np.column_stack([codes[at] // radix[j] % len(v) for j, v in enumerate(labels)])
            own = np.column_stack([v[place[:, j]] for j, v in enumerate(labels)])
            some, of = n[lo:lo + len(at)], sums[lo:lo + len(at)]
            values = of if sizes is None else _row_silhouettes(place, some, of, sizes)
            listed = lambda x: pa.ListArray.from_arrays(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32), x.ravel())
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(at)), listed(own), pa.array(some, pa.int64()), listed(values)],
                                             names=["id", "c", "n", "s"])

    def kernel(batches):
        block, a, sums, current = [], None, None, None
        for batch in batches:
            key = batch.column("b").to_numpy() * 2 + batch.column("side").to_numpy()
            bounds = [*_run_starts(key), len(key)] if len(key) else []
            for lo, hi in zip(bounds[:-1], bounds[1:]):
                part, b, side = batch.slice(lo, hi - lo), key[lo] // 2, key[lo] % 2
                if b != current:
                    if block:
                        yield from finished(block, sums)
                    block, a, current = [], None, b
                if side == 0:
                    block.append(part)
                elif block:
                    if a is None:
                        a = vectors(block)
                        sums = np.zeros((a.shape[1], width))
                    _stream_distance_sums(a, vectors([part]), part.column("code").to_numpy(), members, sums)
        if block:
            yield from finished(block, sums)
    return kernel


def _streamed_sums(base: DataFrame, n: int, d: int, labels: list[np.ndarray], id_type: str, block_rows: int | None,
                   sizes: list[np.ndarray] | None = None) -> DataFrame:
    """(id, c, n, s) per row of ``base`` (id, c, x): its sums by (labelling, cluster) or, given the ``sizes`` of these, its silhouettes by
    labelling. One task a block; every row streams through each of them as its vector and one number for all its labels."""
    width = sum(len(v) for v in labels)
    most = max(1, min(STREAM_ROWS, STREAM_NUMBERS // (width + d)))
    few = min(2 * base.sparkSession.sparkContext.defaultParallelism, math.ceil(n / 2048))
    blocks = math.ceil(n / block_rows) if block_rows else max(1, few, math.ceil(n / most))
    code, radix = F.lit(0).cast("long"), 1
    for j, v in enumerate(labels):
        code = code + (F.array_position(F.array(*[F.lit(int(k)) for k in v]).cast("array<bigint>"), F.col("c")[j]) - 1) * F.lit(radix).cast("long")
        radix *= len(v)
    rows = base.select("id", code.alias("code"), *[F.col("x")[i].alias(f"x{i}") for i in range(d)])
    rest = ["code", *[f"x{i}" for i in range(d)]]
    block = rows.select(F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("b"), F.lit(0).alias("side"), "id", *rest)
    stream = rows.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("b"), F.lit(1).alias("side"), F.lit(None).cast(id_type).alias("id"), *rest)
    dealt = block.unionByName(stream).repartitionById(blocks, F.col("b")).sortWithinPartitions("b", "side", "code", "id")
    return dealt.mapInArrow(_streamed_block(labels, d, sizes), f"id {id_type}, c array<bigint>, n long, s array<double>")


def _shared(counts: list[int]) -> tuple[list[list[int]], list[int]]:
    """Labellings by their numbers of clusters: groups whose sums travel side by side, and those of too many clusters."""
    groups, alone = [], [j for j, k in enumerate(counts) if k > MOST_CLUSTERS]
    for j, k in enumerate(counts):
        if k > MOST_CLUSTERS:
            continue
        own = groups[-1] + [j] if groups else []
        if own and sum(counts[i] for i in own) <= MOST_CLUSTERS and math.prod(counts[i] for i in own) < 1 << 62:
            groups[-1] = own
        else:
            groups.append([j])
    return groups, alone


def silhouettes_exact(df: DataFrame, id_col: str, cols: Sequence[str] | None = None,
                      clusters: Sequence[str] = ("cluster",), vector: str | None = None,
                      block_rows: int | None = None) -> DataFrame:
    """MT2 (exact, Euclidean) for several labellings of the same rows in one blocked pass:
    one row (labelling, silhouette, n_rows, mode) per label column. Noise (-1) counts as a cluster.

    Few clusters: n^2 / 2 distances (shared by all labellings) in B (B + 1) / 2 bounded tasks of two blocks; a row leaves each of its
    B tasks with its sums to all clusters side by side. More than FEW_COLUMNS clusters, whose sums would outweigh the rows: n^2
    distances in a task a block (``_streamed_sums``), which a row's silhouettes leave once. Labellings share a pass up to MOST_CLUSTERS
    clusters in all; one of more clusters goes alone, through ``silhouette_rows``.
    """
    clusters = list(clusters)
    x = F.col(vector).cast("array<double>") if vector else F.array(*_cols(cols))
    id_type = df.schema[id_col].dataType.simpleString()
    base = materialize(df.select(F.col(id_col).alias("id"), F.array(*[F.coalesce(F.col(c).cast("long"), F.lit(NO_LABEL)) for c in clusters]).alias("c"), x.alias("x")), "silhouette-rows")
    sizes = base.select(F.posexplode("c").alias("lab", "k")).groupBy("lab", "k").agg(F.count(F.lit(1)).alias("n"))
    counts = {r["lab"]: r["k"] for r in sizes.groupBy("lab").agg(F.count(F.lit(1)).alias("k")).collect()}  # a row per labelling
    groups, alone = _shared([counts.get(j, 0) for j in range(len(clusters))])
    out = None
    for j in alone:
        one = silhouette_rows(base.select("id", F.col("c")[j].alias("c"), "x"), block_rows=block_rows)
        one = one.agg(F.avg("s").alias("silhouette"), F.count(F.lit(1)).alias("n_rows")).select(F.lit(clusters[j]).alias("labelling"), "silhouette", "n_rows", F.lit("exact").alias("mode"))
        out = one if out is None else out.unionByName(one)
    for group in groups:
        part = base if len(group) == len(clusters) else base.withColumn("c", F.array(*[F.col("c")[j] for j in group]))
        known = sizes.where(F.col("lab").isin(group)).orderBy("lab", "k").collect()  # at most MOST_CLUSTERS rows
        some = _silhouettes_shared(part, [clusters[j] for j in group], [[r for r in known if r["lab"] == j] for j in group], id_type, block_rows)
        out = some if out is None else out.unionByName(some)
    return out


def _silhouettes_shared(base: DataFrame, clusters: list[str], of: list[list], id_type: str, block_rows: int | None) -> DataFrame:
    """``silhouettes_exact`` of the written rows (id, c, x); ``of``: for each labelling its clusters k and their rows n."""
    sizes = [r for rows in of for r in rows]
    n, d = sum(r["n"] for r in of[0]), base.select(F.max(F.size("x"))).first()[0] or 0
    labels = [np.array([r["k"] for r in rows], dtype=np.int64) for rows in of]
    if len(sizes) > FEW_COLUMNS and 0 < d <= STREAM_COLUMNS:
        # a row's silhouettes, not its sums, leave the task: expressions over that many columns would cost Spark more than the pairs
        per = _streamed_sums(base, n, d, labels, id_type, block_rows, [np.array([r["n"] for r in rows], dtype=np.int64) for rows in of])
        listed = F.explode(F.array(*[F.struct(F.lit(name).alias("labelling"), F.col("s")[j].alias("s")) for j, name in enumerate(clusters)]))
    else:
        blocks = max(1, math.ceil(n / _block_rows(n, d, block_rows)))
        base = base.withColumn("blk", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
        # a pair of blocks (a <= b) is one task
        left = base.withColumn("b", F.explode(F.sequence(F.col("blk"), F.lit(blocks - 1)))).select(F.col("blk").alias("a"), "b", "id", "c", "x")
        right = base.withColumn("a", F.explode(F.sequence(F.lit(0), F.col("blk")))).select(
            "a", F.col("blk").alias("b"), *[F.col(c).alias(c) for c in ("id", "c", "x")])
        tiles = left.groupBy("a", "b").cogroup(right.groupBy("a", "b")).applyInPandas(_block_pair_sums(labels), f"id {id_type}, c array<bigint>, n long, s array<double>")
        per = tiles.groupBy("id", "c").agg(F.sum("n").alias("n"), *[F.sum(F.col("s")[i]).alias(f"s{i}") for i in range(len(sizes))])
        scores, at = [], 0
        for j, rows in enumerate(of):
            own_sum, own_cnt, means = F.lit(None).cast("double"), F.lit(None).cast("long"), []
            for r in rows:
                mine = F.col("c")[j] == F.lit(r["k"])
                own_sum, own_cnt = F.when(mine, F.col(f"s{at}")).otherwise(own_sum), F.when(mine, F.col("n") * r["n"]).otherwise(own_cnt)
                means.append(F.when(~mine, F.col(f"s{at}") / (F.col("n") * r["n"])))
                at += 1
            a, b = own_sum / (own_cnt - 1), F.array_min(F.array(*means)) if means else F.lit(None).cast("double")
            s = F.when((own_cnt <= 1) | b.isNull(), F.lit(0.0)).otherwise(
                F.when(F.greatest(a, b) == 0, F.lit(0.0)).otherwise((b - a) / F.greatest(a, b)))
            scores.append(F.struct(F.lit(clusters[j]).alias("labelling"), s.alias("s")))
        listed = F.explode(F.array(*scores))
    return (per.select(listed.alias("_l")).groupBy("_l.labelling").agg(F.avg("_l.s").alias("silhouette"), F.count(F.lit(1)).alias("n_rows"))
            .select("labelling", "silhouette", "n_rows", F.lit("exact").alias("mode")))


FEW_CLUSTERS, DIRECT_ROWS = 16, 1 << 14
PRUNE_NUMBERS = 1 << 21  # numbers of a centroid table that tasks may hold; beyond it no cluster is left out


def _labelled_vectors(df: DataFrame, id_col: str, cols: Sequence[str] | None, cluster: str, vector: str | None) -> DataFrame:
    x = F.col(vector).cast("array<double>") if vector else F.array(*_cols(cols))
    return df.select(F.col(id_col).alias("id"), F.col(cluster).cast("long").alias("c"), x.alias("x"))


def _needed_clusters(labels: np.ndarray, centers: np.ndarray, spread: np.ndarray):
    """For rows (x, c): the labels of the own cluster and of those that may have the least mean distance.

    The mean distance of a row to a cluster is at least its distance g to the centroid and at most sqrt(g^2 + spread), spread
    being the cluster's mean squared distance to its centroid. Clusters whose least value is above the best largest one are out."""
    step = max(1, (1 << 21) // max(1, len(labels)))

    @F.pandas_udf("array<long>")
    def needed(x: pd.Series, c: pd.Series) -> pd.Series:
        out = []
        for lo in range(0, len(x), step):
            part, own = np.stack(x.iloc[lo:lo + step].to_numpy()).astype(np.float64), c.iloc[lo:lo + step].to_numpy()
            g2 = np.zeros((len(part), len(labels)))
            for i in range(part.shape[1]):
                g2 += (part[:, i, None] - centers[None, :, i]) ** 2
            mine = own[:, None] == labels[None, :]
            least = np.where(mine, np.inf, np.sqrt(g2 + spread)).min(axis=1, initial=np.inf)
            keep = mine | (np.sqrt(g2) <= least[:, None] * (1 + 1e-9) + 1e-12)
            out += [labels[k] for k in keep]
        return pd.Series(out)
    return needed


def _distance_sums(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    """The summed distances of every left row to the rows of one block of a cluster."""
    if left.empty or right.empty:
        return pd.DataFrame({"id": [], "own": [], "other": [], "sum_d": []})
    a, b = np.stack(left["x"].to_numpy()).astype(np.float64), np.stack(right["x"].to_numpy()).astype(np.float64)
    sums = np.zeros((len(a), 1))
    _add_distance_sums(a, b, np.ones((len(b), 1)), sums)
    return pd.DataFrame({"id": left["id"], "own": left["own"], "other": key[0], "sum_d": sums[:, 0]})


def silhouette_pairs(rows: DataFrame, asked: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """For rows (id, c, x): the clusters that each asked row (all rows by default) must meet, as (id, own, x, other), and the
    cluster sizes (c, n). Written tables."""
    d = rows.select(F.size("x")).first()
    d = d[0] if d else 0
    size = F.aggregate("x", F.lit(0.0), lambda acc, v: acc + v * v)
    per = rows.groupBy("c").agg(F.count(F.lit(1)).alias("n"), F.avg(size).alias("q"), *[F.avg(F.col("x")[i]).alias(f"m{i}") for i in range(d)])
    per = materialize(per, "silhouette-centroids")
    asked = rows if asked is None else asked
    if per.count() * (d + 1) <= PRUNE_NUMBERS:
        table = per.orderBy("c").toPandas()
        center, q = table[[f"m{i}" for i in range(d)]].to_numpy(), table["q"].to_numpy()
        spread = np.maximum(q - (center * center).sum(axis=1), 0) + 1e-9 * q  # never too small
        others = F.explode(_needed_clusters(table["c"].to_numpy(dtype=np.int64), center, spread)("x", "c")).alias("other")
        met = asked.select("id", F.col("c").alias("own"), "x", others)
    else:
        met = asked.select("id", F.col("c").alias("own"), "x").crossJoin(per.select(F.col("c").alias("other")))
    return materialize(met, "silhouette-pairs"), per.select("c", "n")


def silhouette_rows(rows: DataFrame, asked: DataFrame | None = None, block_rows: int | None = None) -> DataFrame:
    """(id, own, s): the silhouette of the asked rows among ``rows`` (id, c, x).

    A row meets its own cluster and the clusters that may be its nearest (``silhouette_pairs``). Clusters and the rows that
    meet them are cut into blocks of about ``block_rows``; a task holds one pair of blocks and emits one sum a row."""
    met, sizes = silhouette_pairs(rows, asked)
    if not block_rows:
        seen = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("x")).alias("d")).first()
        block_rows = _block_rows(seen["n"], seen["d"] or 0, None)
    blocks = sizes.join(met.groupBy("other").agg(F.count(F.lit(1)).alias("m")), F.col("c") == F.col("other")).select(
        F.col("c").alias("other"), F.ceil(F.col("n") / block_rows).cast("int").alias("nb"), F.ceil(F.col("m") / block_rows).cast("int").alias("mb"))
    dealt = lambda b: F.pmod(F.xxhash64("id"), F.col(b)).cast("int")
    every = lambda b: F.explode(F.sequence(F.lit(0), F.col(b) - 1))
    left = met.join(blocks, "other").withColumn("a", dealt("mb")).withColumn("b", every("nb")).select("other", "a", "b", "id", "own", "x")
    right = rows.withColumnRenamed("c", "other").join(blocks, "other").withColumn("b", dealt("nb")).withColumn("a", every("mb")).select("other", "a", "b", "x")
    id_type = rows.schema["id"].dataType.simpleString()
    tiles = left.groupBy("other", "a", "b").cogroup(right.groupBy("other", "a", "b")).applyInPandas(_distance_sums, f"id {id_type}, own long, other long, sum_d double")
    per = tiles.groupBy("id", "own", "other").agg(F.sum("sum_d").alias("sum_d")).join(sizes, F.col("other") == F.col("c"))
    mine = F.col("own") == F.col("other")
    one = per.groupBy("id", "own").agg(F.max(F.when(mine, F.col("sum_d"))).alias("own_sum"), F.max(F.when(mine, F.col("n"))).alias("own_n"),
                                       F.min(F.when(~mine, F.col("sum_d") / F.col("n"))).alias("b"))
    a, b = F.col("own_sum") / (F.col("own_n") - 1), F.col("b")
    s = F.when((F.col("own_n") <= 1) | b.isNull() | (F.greatest(a, b) == 0), F.lit(0.0)).otherwise((b - a) / F.greatest(a, b))
    return one.select("id", "own", s.alias("s"))


def silhouette_exact(df: DataFrame, id_col: str, cols: Sequence[str] | None = None, cluster: str = "cluster",
                     vector: str | None = None, block_rows: int | None = None) -> DataFrame:
    """MT2 (exact, Euclidean): mean silhouette over all rows; noise (-1) counts as a cluster. One row (silhouette, n_rows,
    mode). Clusters that cannot be a row's nearest are proven so by their centroids and not compared (``silhouette_pairs``).
    Few clusters, of which a row must meet half anyway, and tables of at most DIRECT_ROWS rows, whose pairs cost less than that
    proof's jobs, are compared in full, each pair of rows once (``silhouettes_exact``): the same value."""
    if df.select(cluster).distinct().limit(FEW_CLUSTERS + 1).count() <= FEW_CLUSTERS or df.limit(DIRECT_ROWS + 1).count() <= DIRECT_ROWS and not block_rows:
        return silhouettes_exact(df, id_col, cols, [cluster], vector, block_rows).drop("labelling")
    rows = materialize(_labelled_vectors(df, id_col, cols, cluster, vector), "silhouette-rows")
    return silhouette_rows(rows, block_rows=block_rows).agg(F.avg("s").alias("silhouette"), F.count(F.lit(1)).alias("n_rows")).withColumn("mode", F.lit("exact"))


def silhouette_sampled(df: DataFrame, id_col: str, cols: Sequence[str] | None = None, cluster: str = "cluster", vector: str | None = None,
                       per_cluster: int = 1000, seed: int = 42, block_rows: int | None = None) -> DataFrame:
    """MT2 (``sampled`` mode, asked for by name): the exact silhouettes, among all rows, of ``per_cluster`` rows of each cluster
    (by hash of seed and id), weighted by cluster sizes. One row (silhouette, n_rows, mode, n_sampled, standard_error)."""
    rows = materialize(_labelled_vectors(df, id_col, cols, cluster, vector), "silhouette-rows")
    order = F.row_number().over(Window.partitionBy("c").orderBy(F.xxhash64(F.lit(seed), "id"), "id"))
    asked = materialize(rows.withColumn("__r", order).where(F.col("__r") <= per_cluster).drop("__r"), "silhouette-sample")
    sizes = rows.groupBy(F.col("c").alias("own")).agg(F.count(F.lit(1)).alias("n"))
    strata = silhouette_rows(rows, asked, block_rows).groupBy("own").agg(
        F.count(F.lit(1)).alias("m"), F.avg("s").alias("mean"), F.coalesce(F.var_samp("s"), F.lit(0.0)).alias("v")).join(sizes, "own")
    total = F.sum("n").alias("n_rows")
    error = F.sum(F.col("n") * F.col("n") * F.when(F.col("m") > 1, F.col("v")).otherwise(0.0) / F.col("m") * (1 - F.col("m") / F.col("n")))
    return strata.agg(total, F.sum(F.col("n") * F.col("mean")).alias("__s"), F.sum("m").alias("n_sampled"), error.alias("__e")).select(
        (F.col("__s") / F.col("n_rows")).alias("silhouette"), "n_rows", F.lit("sampled").alias("mode"), "n_sampled",
        (F.sqrt("__e") / F.col("n_rows")).alias("standard_error"))


def silhouette_squared(df: DataFrame, cols: Sequence[str], cluster: str = "cluster") -> float:
    """MT2 (``squared`` mode): Spark ML's linear-time closed form on squared Euclidean distance.
    A different number from the Euclidean silhouette; use it where n^2 work is out of reach."""
    from pyspark.ml.evaluation import ClusteringEvaluator
    from pyspark.ml.feature import VectorAssembler
    vec = VectorAssembler(inputCols=list(cols), outputCol="_f").transform(
        df.select(*cols, F.col(cluster).cast("double").alias("_p")))
    return ClusteringEvaluator(featuresCol="_f", predictionCol="_p", distanceMeasure="squaredEuclidean").evaluate(vec)


def adjusted_rand(labels: DataFrame, truth: DataFrame, id_col: str, cluster: str = "cluster",
                  truth_col: str = "truth") -> DataFrame:
    """MT5: ARI of a labelling against a truth table, matched by id (never by position).

    Contingency = groupBy(truth, cluster).count on the id join; marginals and the pair counts
    are aggregates over that (labels x clusters)-sized table. Pair counts and their products are exact
    integers of 38 digits, which hold n^4 up to n = 2 * 10^9.
    """
    j = labels.select(id_col, cluster).join(truth.select(id_col, truth_col), id_col)
    return ari_of_contingency(j.groupBy(truth_col, cluster).agg(F.count(F.lit(1)).alias("nij")), cluster, truth_col)


def ari_of_contingency(cont: DataFrame, cluster: str = "cluster", truth_col: str = "truth") -> DataFrame:
    """(n_matched, ari) of a table (truth, cluster, nij)."""
    whole = lambda c: c.cast("decimal(38,0)")
    cont = cont.withColumn("nij", whole(F.col("nij")))
    a = cont.groupBy(truth_col).agg(F.sum("nij").alias("ai"))
    b = cont.groupBy(cluster).agg(F.sum("nij").alias("bj"))
    square = lambda c: whole(F.sum(whole(whole(F.col(c)) * whole(F.col(c)))))
    sum_a2 = a.select(square("ai")).scalar()
    sum_b2 = b.select(square("bj")).scalar()
    tot = cont.agg(whole(F.sum("nij")).alias("n"), square("nij").alias("s2"))
    out = tot.select("n", "s2", sum_a2.alias("a2"), sum_b2.alias("b2"))
    tp = whole(F.col("s2") - F.col("n"))
    fp = whole(F.col("b2") - F.col("s2"))
    fn = whole(F.col("a2") - F.col("s2"))
    tn = whole(whole(F.col("n") * F.col("n")) - fp - fn - F.col("s2"))
    times = lambda x, y: whole(whole(x) * whole(y))
    above = whole(times(tp, tn) - times(fn, fp)).cast("double")
    below = whole(times(tp + fn, fn + tn) + times(tp + fp, fp + tn)).cast("double")
    ari = F.when((fn == 0) & (fp == 0), F.lit(1.0)).otherwise(2.0 * above / below)
    return out.select(F.col("n").cast("long").alias("n_matched"), ari.alias("ari"))


def with_sentinels(scores: DataFrame, n_clusters: str = "n_labels") -> DataFrame:
    """MT6 + MT9: fewer than 2 labels -> silhouette -1, Davies-Bouldin +Inf, CH 0; validity flag."""
    few = F.col(n_clusters) < 2
    out = scores
    if "silhouette" in scores.columns:
        out = out.withColumn("silhouette", F.when(few, F.lit(-1.0)).otherwise(F.col("silhouette")))
    out = (out.withColumn("davies_bouldin", F.when(few, F.lit(INF)).otherwise(F.col("davies_bouldin")))
           .withColumn("calinski_harabasz", F.when(few, F.lit(0.0)).otherwise(F.col("calinski_harabasz"))))
    valid = ~few & (F.col("silhouette") > -1) if "silhouette" in scores.columns else ~few
    return out.withColumn("is_valid", valid)
