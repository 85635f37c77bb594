"""K-Means: assignment (ML1a), Lloyd from given centers (ML1b), fits with restarts (ML1),
convergence flag (ML2), k-sweep (ML3) and best k (ML4).

Centers are model-sized (k x d numbers): like Spark ML's own K-Means, each iteration runs one
distributed aggregate (partial sums map-side, k groups after the shuffle) and brings the k new
centers to the driver; rows never leave the executors.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.functions.vectors import nearest
from cohortlens.operators.kmeans_many import fit_many


EXPR_CENTERS = 32  # up to this many centers the nearest-center search is one codegen expression


def nearest_columns(cols: Sequence[str], centers: Sequence[Sequence[float]]):
    """(center id, squared distance) columns; ties -> lowest center id.

    Few centers: a column expression (whole-stage codegen). Many centers (micro-clusters): the
    expression would outgrow the 64 KB codegen limit, so an Arrow-batched ``pandas_udf`` takes
    only the feature columns and does the batch x centers search in NumPy."""
    if len(centers) <= EXPR_CENTERS:
        return nearest([F.col(c) for c in cols], centers)
    best = _nearest_udf(np.asarray(centers, dtype=np.float64))(*[F.col(c).cast("double") for c in cols])
    return best["j"], best["d"]


def assign(df: DataFrame, cols: Sequence[str], centers: Sequence[Sequence[float]], out: str = "cluster",
           dist: str | None = None) -> DataFrame:
    """ML1a: nearest center by squared Euclidean distance; ties -> lowest center id."""
    j, d = nearest_columns(cols, centers)
    df = df.withColumn(out, j.cast("int"))
    return df.withColumn(dist, d) if dist else df


def _nearest_udf(c: np.ndarray, rows_per_step: int = 4096):
    from pyspark.sql.functions import pandas_udf

    @pandas_udf("struct<j:int,d:double>")
    def nearest_center(*xs: pd.Series) -> pd.DataFrame:
        x = np.column_stack([v.to_numpy(dtype=np.float64) for v in xs])
        j = np.empty(len(x), np.int32)
        dd = np.empty(len(x))
        for lo in range(0, len(x), rows_per_step):  # bounded: rows_per_step x centers x d at a time
            diff = x[lo:lo + rows_per_step, None, :] - c[None, :, :]
            d2 = (diff * diff).sum(-1)
            j[lo:lo + rows_per_step] = d2.argmin(1)  # first minimum: ties -> lowest center id
            dd[lo:lo + rows_per_step] = d2[np.arange(len(d2)), j[lo:lo + rows_per_step]]
        return pd.DataFrame({"j": j, "d": dd})
    return nearest_center


def first_rows_as_centers(df: DataFrame, id_col: str, cols: Sequence[str], k: int) -> list[list[float]]:
    """The k rows with the smallest ids (a distributed top-k, k rows to the driver)."""
    rows = df.orderBy(id_col).select(*cols).limit(k).collect()
    return [[float(r[c]) for c in cols] for r in rows]


def update_centers(df: DataFrame, cols: Sequence[str], centers: list[list[float]]) -> tuple[list[list[float]], list[int]]:
    """One Lloyd update: mean of the rows assigned to each center; an empty cluster keeps its center."""
    j, _ = nearest_columns(cols, centers)
    stats = (df.select(j.alias("_c"), *cols).groupBy("_c")
             .agg(F.count(F.lit(1)).alias("_n"), *[F.avg(c).alias(c) for c in cols]).collect())
    new = [list(c) for c in centers]
    sizes = [0] * len(centers)
    for r in stats:
        new[r["_c"]] = [float(r[c]) for c in cols]
        sizes[r["_c"]] = int(r["_n"])
    return new, sizes


def lloyd_many(df: DataFrame, cols: Sequence[str], starts: dict[int, list[list[float]]],
               iterations: int) -> dict[int, list[list[float]]]:
    """ML1b for several k at once: every iteration is ONE scan for all k. Each row yields one
    (k, nearest center) pair per k (exploded map-side, before the partial aggregate), so the
    shuffle carries sum(k) groups per partition; centers come back exactly as ``lloyd`` gives them."""
    centers = {k: [list(c) for c in v] for k, v in starts.items()}
    for _ in range(iterations):
        pick = F.array(*[F.struct(F.lit(k).alias("k"), nearest_columns(cols, centers[k])[0].alias("c")) for k in centers])
        stats = (df.select(F.explode(pick).alias("_kc"), *cols)
                 .groupBy(F.col("_kc.k").alias("_k"), F.col("_kc.c").alias("_c"))
                 .agg(*[F.avg(c).alias(c) for c in cols]).collect())
        new = {k: [list(c) for c in v] for k, v in centers.items()}  # an empty cluster keeps its center
        for r in stats:
            new[r["_k"]][r["_c"]] = [float(r[c]) for c in cols]
        centers = new
    return centers


def lloyd(df: DataFrame, cols: Sequence[str], centers: list[list[float]], iterations: int,
          tol: float | None = None) -> tuple[list[list[float]], int]:
    """ML1b: ``iterations`` center updates from the given centers (or fewer once the shift is <= tol).

    ``df`` should be persisted by the caller; each iteration is one scan + one small aggregate.
    """
    n_iter = 0
    for _ in range(iterations):
        new, _ = update_centers(df, cols, centers)
        n_iter += 1
        shift = max(sum((a - b) ** 2 for a, b in zip(c0, c1)) for c0, c1 in zip(centers, new))
        centers = new
        if tol is not None and shift <= tol:
            break
    return centers, n_iter


def canonical_order(centers: Sequence[Sequence[float]]) -> list[int]:
    """Relabelling that sorts centers ascending in feature order: old id -> new id."""
    order = sorted(range(len(centers)), key=lambda i: tuple(centers[i]))
    mapping = [0] * len(centers)
    for new_id, old_id in enumerate(order):
        mapping[old_id] = new_id
    return mapping


def _ordered(fit: dict) -> dict:
    """A fit with its centers in canonical order."""
    centers = fit["centers"]
    return {**fit, "centers": [c for _, c in sorted(zip(canonical_order(centers), centers, strict=True))]}


TASK_ROWS, MOST_TASK_ROWS = 1 << 13, 1 << 20  # a task is worth so many rows; it gets no more than that


def dealt(df: DataFrame, id_col: str | None) -> DataFrame:
    """The rows in a few parts a core, for fits that scan them many times: each scan sends a small result a part to the driver, and
    the shuffle that made the rows may have left one part or thousands."""
    n = df.count()
    parts = max(1, min(2 * df.sparkSession.sparkContext.defaultParallelism, math.ceil(n / TASK_ROWS)), math.ceil(n / MOST_TASK_ROWS))
    return df.repartition(parts, *([id_col] if id_col else df.columns))


def fit_kmeans_many(df: DataFrame, cols: Sequence[str], ks: Sequence[int], seed: int = 42, restarts: int = 10, max_iter: int = 300,
                    tol: float = 1e-4, id_col: str | None = None) -> dict[int, dict]:
    """ML1 + ML2 for several k: all restarts of all k in the same scans; of each k the fit of least cost."""
    vec = dealt(df.select(*([id_col] if id_col else []), *cols), id_col).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        fits = fit_many(vec, cols, [(k, seed + r) for k in ks for r in range(restarts)], id_col, max_iter, tol)
    finally:
        vec.unpersist()
    return {k: _ordered(min((f for (own, _), f in fits.items() if own == k), key=lambda f: f["inertia"])) for k in ks}


def fit_kmeans(df: DataFrame, cols: Sequence[str], k: int, seed: int = 42, restarts: int = 10,
               max_iter: int = 300, tol: float = 1e-4, id_col: str | None = None) -> dict:
    """ML1 + ML2: K-Means (k-means|| starts) over several seeds; keeps the least cost.

    Returns centers renumbered canonically (ascending), inertia, iterations and a converged flag
    (false if the centers still moved after ``max_iter``).
    """
    return fit_kmeans_many(df, cols, [k], seed, restarts, max_iter, tol, id_col)[k]


def lloyd_sql(scaled: str, id_col: str, cols: Sequence[str], k: int, iterations: int, prefix: str = "") -> str:
    """SQL twin of ML1b: WITH-clause fragments ending in relation ``{prefix}assign_final(id, cluster, d2)``.

    ``scaled`` names a relation with ``id_col`` and ``cols``.
    """
    zc = ", ".join(cols)
    p = prefix
    parts = [f"{p}c0 AS (SELECT CAST(row_number() OVER (ORDER BY {id_col}) - 1 AS INTEGER) AS cluster, {zc} "
             f"FROM (SELECT * FROM {scaled} ORDER BY {id_col} LIMIT {k}) t)"]

    def assign_cte(name: str, centers: str) -> str:
        d2 = " + ".join(f"(s.{c} - c.{c}) * (s.{c} - c.{c})" for c in cols)
        return (f"{name} AS (SELECT {id_col}, cluster, d2 FROM (SELECT s.{id_col}, c.cluster, {d2} AS d2, "
                f"row_number() OVER (PARTITION BY s.{id_col} ORDER BY {d2}, c.cluster) AS rn "
                f"FROM {scaled} s, {centers} c) t WHERE rn = 1)")

    for it in range(iterations):
        parts.append(assign_cte(f"{p}a{it}", f"{p}c{it}"))
        avgs = ", ".join(f"COALESCE(m.{c}, pc.{c}) AS {c}" for c in cols)
        means = ", ".join(f"AVG(s.{c}) AS {c}" for c in cols)
        parts.append(
            f"{p}c{it + 1} AS (SELECT pc.cluster, {avgs} FROM {p}c{it} pc LEFT JOIN "
            f"(SELECT a.cluster, {means} FROM {p}a{it} a JOIN {scaled} s ON a.{id_col} = s.{id_col} GROUP BY a.cluster) m "
            f"ON pc.cluster = m.cluster)")
    parts.append(assign_cte(f"{p}assign_final", f"{p}c{iterations}"))
    return ",\n".join(parts)


def sweep(df: DataFrame, id_col: str, cols: Sequence[str], ks: Sequence[int], fit: str = "lloyd",
          iterations: int = 3, seed: int = 42, restarts: int = 10, max_iter: int = 300,
          silhouette: bool | str = True) -> DataFrame:
    """ML3: one row per k (k, wcss, silhouette, davies_bouldin, calinski_harabasz, warning).

    ``fit='lloyd'``: ML1b from the k rows with the smallest ids (deterministic, oracle-checked);
    ``fit='library'``: ML1 (k-means|| with restarts, all of all k in the same scans). A k that
    the rows do not admit (fewer rows than k) keeps its row, with null scores and a warning; every
    other error ends the sweep. ``silhouette``: True or "exact", "sampled", "squared" (linear), or False.
    ``df`` should be persisted by the caller.
    """
    from cohortlens.operators import metrics as M

    centers, failed = {}, {}
    if fit == "lloyd":  # all k share each iteration's scan; the k seeds are the max(k) smallest ids
        seeds = first_rows_as_centers(df, id_col, cols, max(ks)) if ks else []
        centers = lloyd_many(df, cols, {k: seeds[:k] for k in ks if len(seeds) >= k}, iterations)
    else:
        n = df.count()
        wanted = [k for k in ks if k <= n]
        fits = fit_kmeans_many(df, cols, wanted, seed, restarts, max_iter, id_col=id_col) if wanted else {}
        centers = {k: f["centers"] for k, f in fits.items()}
    failed = {k: f"fewer than {k} rows" for k in ks if k not in centers}
    # every k's labels as one column each: the scores of all k share their scans
    labelled = df.select(id_col, *cols, *[nearest_columns(cols, centers[k])[0].cast("int").alias(f"_c{k}") for k in centers])
    fits = {}
    if centers:
        many = M.centroid_scores_many(labelled, cols, [f"_c{k}" for k in centers])
        fits = {k: (centers[k], dict(zip(("n_rows", "n_labels", "wcss", "davies_bouldin", "calinski_harabasz"),
                                         many[f"_c{k}"]))) for k in centers}
    sil = {}
    scored = [k for k, (_, sc) in fits.items() if sc["n_labels"] >= 2]
    if silhouette == "squared":
        sil = {k: M.silhouette_squared(labelled, cols, f"_c{k}") for k in scored}
    elif silhouette == "sampled":
        sil = {k: M.silhouette_sampled(labelled, id_col, cols, f"_c{k}").first()["silhouette"] for k in scored}
    elif silhouette and scored:
        for r in M.silhouettes_exact(labelled, id_col, cols, [f"_c{k}" for k in scored]).collect():
            sil[int(r["labelling"][2:])] = r["silhouette"]
    rows = []
    for k, (_, sc) in fits.items():
        if sc["n_labels"] < 2:
            s_k, db, ch = -1.0, float("inf"), 0.0
        else:
            s_k, db, ch = sil.get(k), sc["davies_bouldin"], sc["calinski_harabasz"]
        rows.append((int(k), float(sc["wcss"]), None if s_k is None else float(s_k), float(db), float(ch), None))
    rows += [(int(k), None, None, None, None, why) for k, why in failed.items()]
    return df.sparkSession.createDataFrame(
        rows, "k INT, wcss DOUBLE, silhouette DOUBLE, davies_bouldin DOUBLE, calinski_harabasz DOUBLE, warning STRING")


def best_k(sweep_df: DataFrame) -> DataFrame:
    """ML4: best k per metric (silhouette max, Davies-Bouldin min, CH max; ties -> smallest k);
    the selected k is the silhouette's. The sweep table has one row per k (bounded by the range)."""
    return sweep_df.where("wcss is not null").agg(
        F.max_by("k", F.struct(F.col("silhouette"), -F.col("k"))).alias("best_k_silhouette"),
        F.max_by("k", F.struct(-F.col("davies_bouldin"), -F.col("k"))).alias("best_k_davies_bouldin"),
        F.max_by("k", F.struct(F.col("calinski_harabasz"), -F.col("k"))).alias("best_k_calinski"),
    ).withColumn("selected_k", F.col("best_k_silhouette"))
