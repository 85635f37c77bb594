"""Catalogue part 5: k-sweep, mixtures, algorithm comparison (ML3, ML4, CH4, ML9a, MT8,
MT10, MT11, CH5, EX12) and the library fits that have no SQL twin (ML1, ML3, ML5, ML6, ML9)."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Window
from pyspark.sql import functions as F

from cohortlens.functions import rules as R
from cohortlens.operators import gmm as G
from cohortlens.operators import kmeans as KM
from cohortlens.operators import kmeans_many as KMM
from cohortlens.operators import metrics as M
from cohortlens.operators import ward as W
from cohortlens.operators import ward_rounds as WR
from cohortlens.plans import context as X
from cohortlens.plans.catalog import CAT, ID, register, sql_scaled_cte
from cohortlens.plans.q_density import dbscan_sql
from cohortlens.plans.q_metrics import ARI_SQL, _seg_sql, _zdist, scores_sql, silhouette_sql
from cohortlens.sources import tables as T

Z = X.ZCOLS
KS = X.SWEEP_KS


def _r6(c):
    return F.round(c, 6).alias(c)


# --- ML3 / ML4 / CH4 over ML1b fits ------------------------------------------------------------

def _sweep_sql() -> str:
    parts = [sql_scaled_cte()]
    selects = []
    for k in KS:
        p = f"k{k}_"
        parts.append(KM.lloyd_sql("scaled", ID, Z, k, X.LLOYD_ITERS, prefix=p))
        parts.append(f"{p}lab AS (SELECT s.*, a.cluster FROM scaled s JOIN {p}assign_final a USING ({ID}))")
        parts.append(scores_sql(f"{p}lab", Z, p))
        parts.append(silhouette_sql(f"{p}lab", ID, _zdist(), p))
        selects.append(f"SELECT {k} AS k, sc.wcss, sil.silhouette, sc.davies_bouldin, "
                       f"CASE WHEN sc.wcss = 0 THEN 1.0 ELSE sc.between_ss * (sc.n_rows - sc.n_labels) / (sc.wcss * (sc.n_labels - 1)) END "
                       f"AS calinski_harabasz FROM {p}sc sc, {p}sil sil")
    return "WITH " + ",\n".join(parts) + ",\nsweep AS (" + " UNION ALL ".join(selects) + ")\n"


SWEEP_SQL = _sweep_sql()


@register("sweep_lloyd", SWEEP_SQL + """SELECT CAST(k AS INTEGER) AS k, ROUND(wcss, 6) AS wcss, ROUND(silhouette, 6) AS silhouette,
       ROUND(davies_bouldin, 6) AS davies_bouldin, ROUND(calinski_harabasz, 6) AS calinski_harabasz FROM sweep""")
def sweep_lloyd(spark, sf):
    """ML3: WCSS, silhouette, Davies-Bouldin, CH for k = 2..6 (ML1b fits)."""
    s = X.lloyd_sweep(spark, sf)
    return s.select("k", *[_r6(c) for c in ("wcss", "silhouette", "davies_bouldin", "calinski_harabasz")])


@register("best_k", SWEEP_SQL + """SELECT
  CAST((SELECT k FROM sweep ORDER BY silhouette DESC, k LIMIT 1) AS INTEGER) AS best_k_silhouette,
  CAST((SELECT k FROM sweep ORDER BY davies_bouldin, k LIMIT 1) AS INTEGER) AS best_k_davies_bouldin,
  CAST((SELECT k FROM sweep ORDER BY calinski_harabasz DESC, k LIMIT 1) AS INTEGER) AS best_k_calinski,
  CAST((SELECT k FROM sweep ORDER BY silhouette DESC, k LIMIT 1) AS INTEGER) AS selected_k""")
def best_k(spark, sf):
    """ML4: best k by each metric; the selected k is the silhouette's (ties -> smallest k)."""
    return KM.best_k(X.lloyd_sweep(spark, sf))


@register("sweep_curves", SWEEP_SQL + """SELECT CAST(k AS INTEGER) AS k, ROUND(wcss, 6) AS wcss, ROUND(silhouette, 6) AS silhouette,
       ROUND(davies_bouldin, 6) AS davies_bouldin, ROUND(calinski_harabasz, 6) AS calinski_harabasz,
       ROUND(MAX(silhouette) OVER (), 6) AS best_silhouette, ROUND(MIN(davies_bouldin) OVER (), 6) AS best_davies_bouldin,
       ROUND(MAX(calinski_harabasz) OVER (), 6) AS best_calinski FROM sweep""")
def sweep_curves(spark, sf):
    """CH4: the sweep with the best-value reference lines (window over the k-row sweep table)."""
    s = X.lloyd_sweep(spark, sf)
    w = Window.partitionBy(F.lit(0))
    return s.select("k", *[_r6(c) for c in ("wcss", "silhouette", "davies_bouldin", "calinski_harabasz")],
                    F.round(F.max("silhouette").over(w), 6).alias("best_silhouette"),
                    F.round(F.min("davies_bouldin").over(w), 6).alias("best_davies_bouldin"),
                    F.round(F.max("calinski_harabasz").over(w), 6).alias("best_calinski"))


# --- ML9a / MT8: E-step with parameters read off the Lloyd labels -----------------------------

def _estep_sql() -> str:
    d = len(Z)
    params = ", ".join([f"AVG({z}) AS m{i}" for i, z in enumerate(Z)] + [f"VAR_POP({z}) AS v{i}" for i, z in enumerate(Z)])
    logd = " + ".join(f"LN(2 * PI() * p.v{i}) + (l.{z} - p.m{i}) * (l.{z} - p.m{i}) / p.v{i}" for i, z in enumerate(Z))
    from cohortlens.plans.catalog import sql_lloyd_cte
    return f"""WITH {sql_lloyd_cte()},
par AS (SELECT cluster, COUNT(*) * 1.0 / (SELECT COUNT(*) FROM labelled) AS w, {params} FROM labelled GROUP BY cluster),
comp AS (SELECT l.{ID}, p.cluster, LN(p.w) - 0.5 * ({logd}) AS lg FROM labelled l, par p),
mx AS (SELECT {ID}, MAX(lg) AS m FROM comp GROUP BY {ID}),
rowll AS (SELECT c.{ID}, mx.m + LN(SUM(EXP(c.lg - mx.m))) AS ll FROM comp c JOIN mx USING ({ID}) GROUP BY c.{ID}, mx.m),
best AS (SELECT {ID}, cluster FROM (SELECT {ID}, cluster, row_number() OVER (PARTITION BY {ID} ORDER BY lg DESC, cluster) AS rn FROM comp) t WHERE rn = 1),
estep AS (SELECT r.{ID}, b.cluster, r.ll FROM rowll r JOIN best b USING ({ID}))
""" + f"-- d={d}\n"


def _estep_frame(spark, sf):
    lab = X.lloyd_labelled(spark, sf)
    weights, means, covs, _ = X.memo(spark, sf, "diagparams", lambda: G.diagonal_parameters(lab, Z))
    return G.e_step(lab, Z, weights, means, covs)


@register("gmm_estep", _estep_sql() + f"""SELECT {ID}, CAST(cluster AS INTEGER) AS cluster, ROUND(ll, 6) AS log_likelihood FROM estep""")
def gmm_estep(spark, sf):
    """ML9a: per-row log-likelihood and most probable component under diagonal parameters."""
    e = _estep_frame(spark, sf)
    return e.select(ID, "cluster", F.round("log_likelihood", 6).alias("log_likelihood"))


_P_DIAG = G.n_parameters(X.LLOYD_K, len(Z), "diag")


@register("gmm_bic_aic", _estep_sql() + f"""SELECT ROUND(SUM(ll), 4) AS log_likelihood, COUNT(*) AS n_rows,
       ROUND(-2 * SUM(ll) + {_P_DIAG} * LN(COUNT(*)), 4) AS bic, ROUND(-2 * SUM(ll) + 2 * {_P_DIAG}, 4) AS aic,
       {_P_DIAG} AS n_parameters FROM estep""")
def gmm_bic_aic(spark, sf):
    """MT8: log-likelihood, BIC and AIC of the diagonal mixture (parameter count for 'diag')."""
    e = _estep_frame(spark, sf)
    agg = e.agg(F.sum("log_likelihood").alias("ll"), F.count(F.lit(1)).alias("n_rows"))
    bic, aic = G.information_criteria(F.col("ll"), F.col("n_rows"), X.LLOYD_K, len(Z), "diag")
    return agg.select(F.round("ll", 4).alias("log_likelihood"), "n_rows", F.round(bic, 4).alias("bic"),
                      F.round(aic, 4).alias("aic"), F.lit(_P_DIAG).alias("n_parameters"))


# --- ML9: three full-covariance EM steps from the Lloyd labels -----------------------------------

EM_STEPS = 3


def _em_sql() -> str:
    """Unrolled EM for three features; the inverse of a covariance by cofactors."""
    from cohortlens.plans.catalog import sql_lloyd_cte

    z, reg = Z, G.REGULARISATION
    pairs = [(i, j) for i in range(3) for j in range(i, 3)]
    first = ", ".join([f"AVG({c}) AS m{i}" for i, c in enumerate(z)] + [f"COVAR_POP({z[i]}, {z[j]}){f' + {reg}' if i == j else ''} AS c{i}{j}" for i, j in pairs])
    parts = [sql_lloyd_cte(), f"p0 AS (SELECT cluster AS k, COUNT(*) * 1.0 / (SELECT COUNT(*) FROM labelled) AS w, {first} FROM labelled GROUP BY cluster)"]
    for t in range(EM_STEPS):
        parts.append(f"""q{t} AS (SELECT *, c11 * c22 - c12 * c12 AS a00, c02 * c12 - c01 * c22 AS a01, c01 * c12 - c02 * c11 AS a02,
  c00 * c22 - c02 * c02 AS a11, c01 * c02 - c00 * c12 AS a12, c00 * c11 - c01 * c01 AS a22 FROM p{t}),
i{t} AS (SELECT *, c00 * a00 + c01 * a01 + c02 * a02 AS det FROM q{t})""")
        y = [f"(l.{c} - i.m{i})" for i, c in enumerate(z)]
        quad = " + ".join(f"{'' if i == j else '2 * '}i.a{i}{j} * {y[i]} * {y[j]}" for i, j in pairs)
        parts.append(f"""g{t} AS (SELECT l.{ID}, i.k, {", ".join(f"l.{c}" for c in z)}, LN(i.w) - 0.5 * (3 * LN(2 * PI()) + LN(i.det) + ({quad}) / i.det) AS lg FROM labelled l, i{t} i),
x{t} AS (SELECT {ID}, MAX(lg) AS m FROM g{t} GROUP BY {ID}),
l{t} AS (SELECT g.{ID}, MAX(m) + LN(SUM(EXP(lg - m))) AS ll FROM g{t} g JOIN x{t} x ON g.{ID} = x.{ID} GROUP BY g.{ID}),
r{t} AS (SELECT g.*, ll, EXP(lg - ll) AS r FROM g{t} g JOIN l{t} l ON g.{ID} = l.{ID}),
h{t} AS (SELECT r.*, SUM(r) OVER (PARTITION BY k) AS nk, {", ".join(f"SUM(r * {c}) OVER (PARTITION BY k) / SUM(r) OVER (PARTITION BY k) AS u{i}" for i, c in enumerate(z))} FROM r{t} r)""")
        cov = ", ".join(f"SUM(r * ({z[i]} - u{i}) * ({z[j]} - u{j})) / MAX(nk){f' + {reg}' if i == j else ''} AS c{i}{j}" for i, j in pairs)
        parts.append(f"p{t + 1} AS (SELECT k, MAX(nk) / COUNT(*) AS w, {', '.join(f'MAX(u{i}) AS m{i}' for i in range(3))}, {cov} FROM h{t} GROUP BY k)")
    values = ", ".join([f"ROUND({c}, 6) AS {c}" for c in ["w", *[f"m{i}" for i in range(3)], *[f"c{i}{j}" for i, j in pairs]]])
    return "WITH " + ",\n".join(parts) + f"\nSELECT CAST(k AS INTEGER) AS component, {values}, (SELECT ROUND(AVG(ll), 6) FROM l{EM_STEPS - 1}) AS mean_log_likelihood FROM p{EM_STEPS}"


@register("gmm_em3", _em_sql())
def gmm_em3(spark, sf):
    """ML9: the parameters after three EM steps from the Lloyd labels, and the mean log-likelihood of the third E-step."""
    lab = X.lloyd_labelled(spark, sf)
    fit = G.em(lab, Z, *G.full_parameters(lab, Z), max_iter=EM_STEPS, tol=0.0)
    rows = [(c, *[round(float(v), 6) for v in (fit["weights"][c], *fit["means"][c], *[fit["covs"][c][i][j] for i in range(3) for j in range(i, 3)], fit["mean_log_likelihood"])])
            for c in range(fit["k"])]
    names = ["w", *[f"m{i}" for i in range(3)], *[f"c{i}{j}" for i in range(3) for j in range(i, 3)], "mean_log_likelihood"]
    return spark.createDataFrame(rows, "component int, " + ", ".join(f"{n} double" for n in names))


# --- ML1: k-means|| rounds with fixed seeds --------------------------------------------------------

INIT_SEEDS, INIT_WANTED, INIT_ROUNDS = (42, 43), 10, 2


def _rounds_sql() -> str:
    """For each seed: the first row, then the rows that each round draws."""
    draw = lambda s, t: f"CAST('0x' || substr(md5('{s}:{t}:' || {ID}), 1, 8) AS BIGINT) / 4294967296.0"
    parts, out = [sql_scaled_cte()], []
    for s in INIT_SEEDS:
        zs = ", ".join(Z)
        parts.append(f"s{s}_0 AS (SELECT 0 AS round, {ID}, {zs} FROM scaled ORDER BY {draw(s, 0)}, CAST({ID} AS VARCHAR) LIMIT 1)")
        for t in range(1, INIT_ROUNDS + 1):
            d2 = " + ".join(f"(l.{c} - c.{c}) * (l.{c} - c.{c})" for c in Z)
            parts.append(f"d{s}_{t} AS (SELECT l.{ID}, {', '.join(f'l.{c}' for c in Z)}, MIN({d2}) AS d FROM scaled l, s{s}_{t - 1} c GROUP BY ALL)")
            parts.append(f"s{s}_{t} AS (SELECT * FROM s{s}_{t - 1} UNION ALL SELECT {t} AS round, {ID}, {zs} FROM d{s}_{t} "
                         f"WHERE {draw(s, t)} * (SELECT SUM(d) FROM d{s}_{t}) < {INIT_WANTED} * d)")
        out.append(f"SELECT {s} AS seed, round, CAST({ID} AS VARCHAR) AS row_id FROM s{s}_{INIT_ROUNDS}")
    return "WITH " + ",\n".join(parts) + "\n" + " UNION ALL ".join(out)


@register("kmeans_parallel_rounds", _rounds_sql())
def kmeans_parallel_rounds(spark, sf):
    """ML1: the candidates that two k-means|| rounds draw for two seeds at once."""
    got = KMM.candidates(X.scaled(spark, sf), Z, INIT_SEEDS, F.col(ID), INIT_WANTED, INIT_ROUNDS)
    return spark.createDataFrame([(s, r, key) for s, own in got.items() for r, key, _ in own], "seed int, round int, row_id string")


# --- MT10 / MT11 / CH5 over three label sets ---------------------------------------------------

RUN_ORDER = (("KMeans", 0), ("DBSCAN", 1), ("Segments", 2))


def comparison_frame(spark, sf):
    """One metrics row per labelling: Lloyd K-Means, density clustering, market segment."""
    def build():
        truth = T.table(spark, sf, "customer").select(F.col("c_custkey").alias(ID), F.col("c_mktsegment").alias("truth"))
        # the three labellings of the same scaled rows side by side: scores share their scans
        joint = KM.assign(X.segment_labelled(spark, sf).withColumnRenamed("cluster", "_c2"), Z,
                          X.lloyd_centers(spark, sf), out="_c0")
        joint = joint.join(X.dbscan_labels(spark, sf).withColumnRenamed("cluster", "_c1"), ID).persist(
            StorageLevel.MEMORY_AND_DISK)
        labs = [f"_c{i}" for i in range(3)]
        fr = joint.agg(*[F.count_distinct(F.when(F.col(c) != -1, F.col(c))).alias(c) for c in labs]).first()
        found = [fr[c] for c in labs]
        aris = [M.adjusted_rand(joint.select(ID, F.col(c).alias("cluster")), truth, ID).first()["ari"] for c in labs]
        scored = [i for i in range(3) if found[i] >= 2]
        sc = M.centroid_scores_many(joint, Z, [labs[i] for i in scored]) if scored else {}
        sil = {int(r["labelling"][2:]): r["silhouette"] for r in
               M.silhouettes_exact(joint, ID, Z, [labs[i] for i in scored]).collect()} if scored else {}
        stats = [(found[i], aris[i], sc.get(labs[i])) for i in range(3)]
        joint.unpersist()
        rows = []
        for i, ((name, order), (found, ari, sc)) in enumerate(zip(RUN_ORDER, stats)):
            if found < 2:
                s_i, db, ch = -1.0, float("inf"), 0.0
            else:
                s_i, db, ch = sil[i], sc[3], sc[4]
            rows.append((name, order, int(found), float(s_i), float(db), float(ch), float(ari), found > 1 and s_i > -1))
        return spark.createDataFrame(rows, "algorithm STRING, run_order INT, n_clusters BIGINT, silhouette DOUBLE, "
                                           "davies_bouldin DOUBLE, calinski_harabasz DOUBLE, ari DOUBLE, is_valid BOOLEAN")
    return X.memo(spark, sf, "comparison", build)


def _comparison_sql() -> str:
    from cohortlens.plans.catalog import CAT as _CAT  # noqa: F401
    parts = [sql_scaled_cte(), KM.lloyd_sql("scaled", ID, Z, X.LLOYD_K, X.LLOYD_ITERS),
             f"km AS (SELECT s.*, a.cluster FROM scaled s JOIN assign_final a USING ({ID}))",
             dbscan_sql(with_scaled=False), _seg_sql(),
             "truth AS (SELECT c_custkey, c_mktsegment AS truth FROM customer)"]
    selects = []
    for (name, order), rel in zip(RUN_ORDER, ("km", "dlabelled", "seglab")):
        p = f"{name.lower()}_"
        parts.append(scores_sql(rel, Z, p))
        parts.append(silhouette_sql(rel, ID, _zdist(), p))
        ari = ARI_SQL.replace("ari_in AS", f"{p}ari_in AS").replace("FROM cont", f"FROM {p}cont") \
            .replace("ari AS (SELECT n,", f"{p}ari AS (SELECT n,").replace("FROM ari_in)", f"FROM {p}ari_in)")
        ari_ctes, ari_select = ari.split("\nSELECT ", 1)
        parts.append(f"{p}cont AS (SELECT t.truth, l.cluster, CAST(COUNT(*) AS DOUBLE) AS nij FROM {rel} l "
                     f"JOIN truth t USING ({ID}) GROUP BY t.truth, l.cluster)")
        parts.append(ari_ctes)
        parts.append(f"{p}found AS (SELECT COUNT(DISTINCT cluster) FILTER (WHERE cluster <> -1) AS n FROM {rel})")
        ari_val = ("CASE WHEN fn = 0 AND fp = 0 THEN 1.0 ELSE 2.0 * (tp * tn - fn * fp) / "
                   "((tp + fn) * (fn + tn) + (tp + fp) * (fp + tn)) END")
        ch = "CASE WHEN sc.wcss = 0 THEN 1.0 ELSE sc.between_ss * (sc.n_rows - sc.n_labels) / (sc.wcss * (sc.n_labels - 1)) END"
        selects.append(
            f"SELECT '{name}' AS algorithm, {order} AS run_order, f.n AS n_clusters, "
            f"CASE WHEN f.n < 2 THEN -1.0 ELSE sil.silhouette END AS silhouette, "
            f"CASE WHEN f.n < 2 THEN CAST('Infinity' AS DOUBLE) ELSE sc.davies_bouldin END AS davies_bouldin, "
            f"CASE WHEN f.n < 2 THEN 0.0 ELSE {ch} END AS calinski_harabasz, "
            f"(SELECT {ari_val} FROM {p}ari) AS ari FROM {p}sc sc, {p}sil sil, {p}found f")
    return "WITH " + ",\n".join(parts) + ",\ncmp AS (" + " UNION ALL ".join(selects) + ")\n"


COMPARISON_SQL = _comparison_sql()


@register("comparison", COMPARISON_SQL + """SELECT algorithm, CAST(run_order AS INTEGER) AS run_order, CAST(n_clusters AS BIGINT) AS n_clusters,
       ROUND(silhouette, 6) AS silhouette, ROUND(davies_bouldin, 6) AS davies_bouldin,
       ROUND(calinski_harabasz, 6) AS calinski_harabasz, ROUND(ari, 6) AS ari,
       (n_clusters > 1 AND silhouette > -1) AS is_valid FROM cmp""")
def comparison(spark, sf):
    """MT10 (+ MT5, MT6, MT9): scores of three labellings in run order."""
    c = comparison_frame(spark, sf)
    return c.select("algorithm", "run_order", "n_clusters", *[_r6(x) for x in ("silhouette", "davies_bouldin",
                                                                                "calinski_harabasz", "ari")], "is_valid")


@register("best_algorithm", COMPARISON_SQL + """SELECT algorithm, ROUND(silhouette, 6) AS silhouette
FROM cmp ORDER BY silhouette DESC, run_order LIMIT 1""")
def best_algorithm(spark, sf):
    """MT11: highest silhouette, first in run order on ties (a top-1 report)."""
    c = comparison_frame(spark, sf)
    return c.orderBy(F.col("silhouette").desc(), "run_order").limit(1).select("algorithm", _r6("silhouette"))


@register("algorithm_bars", COMPARISON_SQL + """SELECT algorithm, ROUND(silhouette, 6) AS silhouette,
       ROUND(LEAST(davies_bouldin, 5.0), 6) AS davies_bouldin_capped,
       CASE WHEN davies_bouldin = CAST('Infinity' AS DOUBLE) THEN 'inf' ELSE printf('%.3f', davies_bouldin) END AS davies_bouldin_label,
       ROUND(calinski_harabasz, 6) AS calinski_harabasz FROM cmp""")
def algorithm_bars(spark, sf):
    """CH5 + EX12: bar-chart data with Davies-Bouldin capped at 5 and an 'inf' label."""
    c = comparison_frame(spark, sf)
    db = F.col("davies_bouldin")
    label = R.capped_label(db)
    return c.select("algorithm", _r6("silhouette"), F.round(R.capped(db), 6).alias("davies_bouldin_capped"),
                    label.alias("davies_bouldin_label"), _r6("calinski_harabasz"))


# --- whole fits (their number of steps follows the data: rows-only checks and q_checks) -------------

@register("kmeans_fit")
def kmeans_fit(spark, sf):
    """ML1 + ML2: k-means|| with 10 restarts (seed 42..51), least cost kept; canonical labels."""
    df = X.scaled(spark, sf)
    fit = X.memo(spark, sf, "kmfit", lambda: KM.fit_kmeans(df, Z, X.LLOYD_K, seed=X.CFG.seed, restarts=X.CFG.kmeans_restarts,
                                                           max_iter=X.CFG.kmeans_max_iter, id_col=ID))
    lab = KM.assign(df, Z, fit["centers"])
    return lab.groupBy("cluster").agg(F.count(F.lit(1)).alias("size")).select(
        "cluster", "size", F.lit(fit["inertia"]).alias("inertia"), F.lit(fit["n_iter"]).alias("n_iter"),
        F.lit(fit["converged"]).alias("converged"))


@register("k_sweep")
def k_sweep(spark, sf):
    """ML3 with library fits for k = 2..10 and all restarts, WCSS, exact silhouette, DB and CH per k."""
    df = X.scaled(spark, sf)
    return X.memo(spark, sf, "ksweep", lambda: KM.sweep(df, ID, Z, X.CFG.k_range, fit="library", seed=X.CFG.seed, restarts=X.CFG.kmeans_restarts,
                                                      max_iter=X.CFG.kmeans_max_iter).persist())


@register("gmm_fit")
def gmm_fit(spark, sf):
    """ML9 + ML9a + MT8: full-covariance mixture, then labels, log-likelihood, BIC and AIC
    recomputed by one E-step pass over the final parameters."""
    df = X.scaled(spark, sf)
    fit = X.memo(spark, sf, "gmmfit", lambda: G.fit_gmm(df, Z, X.LLOYD_K, seed=X.CFG.seed, max_iter=X.CFG.gmm_max_iter, id_col=ID))
    e = G.e_step(df, Z, fit["weights"], fit["means"], fit["covs"])
    agg = e.groupBy("cluster").agg(F.count(F.lit(1)).alias("size"), F.sum("log_likelihood").alias("ll"))
    total = e.select(F.sum("log_likelihood")).scalar()
    n = e.select(F.count(F.lit(1))).scalar()
    bic, aic = G.information_criteria(total, n, X.LLOYD_K, len(Z), "full")
    return agg.select("cluster", "size", bic.alias("bic"), aic.alias("aic"), F.lit(fit["n_iter"]).alias("n_iter"),
                      F.lit(fit["converged"]).alias("converged"))


@register("ward_labels")
def ward_labels(spark, sf):
    """ML5: micro-cluster Ward (m = 256) cut at k = 5; sizes per cluster and the mode used."""
    labels, _, mode = X.memo(spark, sf, "ward", lambda: W.ward(X.scaled(spark, sf), ID, Z, X.LLOYD_K,
                                                               micro=X.CFG.ward_micro_clusters, seed=X.CFG.seed))
    return labels.groupBy("cluster").agg(F.count(F.lit(1)).alias("size")).withColumn("mode", F.lit(mode))


@register("ward_merges")
def ward_merges(spark, sf):
    """ML6: the merge table (step, left, right, height, size) of the micro-cluster Ward."""
    _, merges, _ = X.memo(spark, sf, "ward", lambda: W.ward(X.scaled(spark, sf), ID, Z, X.LLOYD_K,
                                                           micro=X.CFG.ward_micro_clusters, seed=X.CFG.seed))
    return W.merge_table(spark, merges)


# --- ML5 / ML6: exact Ward over the nations ---------------------------------------------------------

NATIONS = """SELECT c_nationkey AS id, AVG(c_acctbal) / 100.0 AS x0, COUNT(*) / 10.0 AS x1 FROM customer GROUP BY c_nationkey"""


def _ward_sql(n: int = 25) -> str:
    """Sequential Ward by the Lance-Williams recurrence, one pair a step, unrolled."""
    pair = "2.0 * p.n * q.n / (p.n + q.n) * ((p.x0 - q.x0) * (p.x0 - q.x0) + (p.x1 - q.x1) * (p.x1 - q.x1))"
    parts = [f"pts AS MATERIALIZED ({NATIONS})", "s0 AS MATERIALIZED (SELECT id, CAST(1 AS BIGINT) AS n FROM pts)",
             f"d0 AS MATERIALIZED (SELECT p.id AS i, q.id AS j, {pair} AS d FROM (SELECT *, 1 AS n FROM pts) p, (SELECT *, 1 AS n FROM pts) q WHERE p.id < q.id)"]
    for t in range(n - 1):
        parts += [f"m{t} AS MATERIALIZED (SELECT i AS a, j AS b, d, (SELECT n FROM s{t} WHERE id = i) AS na, (SELECT n FROM s{t} WHERE id = j) AS nb FROM d{t} ORDER BY d, i, j LIMIT 1)",
                  f"s{t + 1} AS MATERIALIZED (SELECT id, CASE WHEN id = m.a THEN na + nb ELSE n END AS n FROM s{t}, m{t} m WHERE id <> m.b)",
                  f"u{t} AS MATERIALIZED (SELECT s.id, m.a, ((s.n + na) * ea.d + (s.n + nb) * eb.d - s.n * m.d) / (s.n + na + nb) AS d FROM s{t} s, m{t} m, d{t} ea, d{t} eb "
                  f"WHERE s.id <> m.a AND s.id <> m.b AND ea.i = LEAST(s.id, m.a) AND ea.j = GREATEST(s.id, m.a) AND eb.i = LEAST(s.id, m.b) AND eb.j = GREATEST(s.id, m.b))",
                  f"d{t + 1} AS MATERIALIZED (SELECT e.i, e.j, e.d FROM d{t} e, m{t} m WHERE e.i NOT IN (m.a, m.b) AND e.j NOT IN (m.a, m.b) "
                  f"UNION ALL SELECT LEAST(id, a), GREATEST(id, a), d FROM u{t})"]
    rows = " UNION ALL ".join(f"SELECT {t} AS step, CAST(a AS BIGINT) AS a, CAST(b AS BIGINT) AS b, ROUND(SQRT(d), 6) AS height, na + nb AS size FROM m{t}" for t in range(n - 1))
    return "WITH " + ",\n".join(parts) + "\n" + rows


@register("ward_nations", _ward_sql())
def ward_nations(spark, sf):
    """ML5 + ML6: the merges of exact Ward over the nations' mean balance and number of customers, by reciprocal rounds."""
    points = T.table(spark, sf, "customer").groupBy(F.col("c_nationkey").cast("long").alias("id")).agg(
        (F.avg("c_acctbal") / 100.0).alias("x0"), (F.count(F.lit(1)) / 10.0).alias("x1"))
    merges = WR.merge_rounds(points, 2, local_rows=4)
    step = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("height", "size", "a", "b")) - 1  # 24 rows
    return merges.select(step.alias("step"), "a", "b", F.round("height", 6).alias("height"), "size")
