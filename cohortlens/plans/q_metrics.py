"""Catalogue part 3: K-Means steps and clustering scores (ML1a, ML1b, MT1-MT6, MT9, AG14)."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortlens.operators import kmeans as KM
from cohortlens.operators import metrics as M
from cohortlens.operators import profile as P
from cohortlens.plans import context as X
from cohortlens.plans.catalog import CAT, ID, register, sql_lloyd_cte, sql_scaled_cte
from cohortlens.sources import tables as T

Z = X.ZCOLS


def _seg_sql() -> str:
    """Relation ``seglab``: scaled rows labelled by the market segment coded in alphabetical order."""
    return (f"segcodes AS (SELECT {CAT} AS v, CAST(row_number() OVER (ORDER BY {CAT}) - 1 AS INTEGER) AS code "
            f"FROM (SELECT DISTINCT {CAT} FROM scaled WHERE {CAT} IS NOT NULL) t),\n"
            f"seglab AS (SELECT s.*, COALESCE(c.code, -1) AS cluster FROM scaled s LEFT JOIN segcodes c ON s.{CAT} = c.v)")


def silhouette_sql(rel: str, id_col: str, dist: str, p: str = "") -> str:
    """Exact Euclidean silhouette over ``rel(id_col, cluster, ...)``; ``dist`` uses aliases a, b.
    Ends in relation ``{p}sil(silhouette, n_rows)``."""
    return f"""{p}pairs AS (SELECT a.{id_col} AS id, a.cluster AS own, b.cluster AS other, {dist} AS d FROM {rel} a, {rel} b),
{p}per AS (SELECT id, own, other, SUM(d) AS s, COUNT(*) AS c FROM {p}pairs GROUP BY id, own, other),
{p}prow AS (SELECT id, MAX(CASE WHEN own = other THEN s END) AS own_sum, MAX(CASE WHEN own = other THEN c END) AS own_cnt,
                MIN(CASE WHEN own <> other THEN s / c END) AS b FROM {p}per GROUP BY id),
{p}sil AS (SELECT AVG(CASE WHEN own_cnt <= 1 OR b IS NULL THEN 0.0
                        WHEN GREATEST(own_sum / (own_cnt - 1), b) = 0 THEN 0.0
                        ELSE (b - own_sum / (own_cnt - 1)) / GREATEST(own_sum / (own_cnt - 1), b) END) AS silhouette,
               COUNT(*) AS n_rows FROM {p}prow)"""


def _zdist() -> str:
    return "sqrt(" + " + ".join(f"(a.{z} - b.{z}) * (a.{z} - b.{z})" for z in Z) + ")"


def scores_sql(rel: str, cols: list[str], p: str = "") -> str:
    """WCSS, Davies-Bouldin, Calinski-Harabasz over ``rel(cluster, cols...)`` -> relation ``{p}sc``."""
    d = len(cols)
    means = ", ".join(f"AVG({c}) AS m{i}" for i, c in enumerate(cols))
    d2 = " + ".join(f"(r.{c} - k.m{i}) * (r.{c} - k.m{i})" for i, c in enumerate(cols))
    cd = "sqrt(" + " + ".join(f"(pp.m{i} - q.m{i}) * (pp.m{i} - q.m{i})" for i in range(d)) + ")"
    gm = ", ".join(f"AVG({c}) AS g{i}" for i, c in enumerate(cols))
    between = " + ".join(f"(k.m{i} - g.g{i}) * (k.m{i} - g.g{i})" for i in range(d))
    return f"""{p}cen AS (SELECT cluster, COUNT(*) AS n, {means} FROM {rel} GROUP BY cluster),
{p}rd AS (SELECT r.cluster, {d2} AS d2 FROM {rel} r JOIN {p}cen k ON r.cluster = k.cluster),
{p}per_k AS (SELECT k.*, (SELECT AVG(sqrt(d2)) FROM {p}rd rd WHERE rd.cluster = k.cluster) AS s,
                 (SELECT SUM(d2) FROM {p}rd rd WHERE rd.cluster = k.cluster) AS ss FROM {p}cen k),
{p}worst AS (SELECT pp.cluster, COALESCE(MAX(CASE WHEN {cd} > 0 THEN (pp.s + q.s) / {cd} ELSE 0.0 END), 0.0) AS w
          FROM {p}per_k pp JOIN {p}per_k q ON pp.cluster <> q.cluster GROUP BY pp.cluster),
{p}gmean AS (SELECT {gm} FROM {rel}),
{p}sc AS (SELECT (SELECT SUM(n) FROM {p}per_k) AS n_rows, (SELECT COUNT(*) FROM {p}per_k) AS n_labels,
              (SELECT SUM(ss) FROM {p}per_k) AS wcss,
              CASE WHEN (SELECT MAX(ABS(s)) FROM {p}per_k) = 0
                     OR (SELECT COALESCE(MAX({cd}), 0) FROM {p}per_k pp, {p}per_k q) = 0 THEN 0.0
                   ELSE (SELECT SUM(w) FROM {p}worst) / (SELECT COUNT(*) FROM {p}per_k) END AS davies_bouldin,
              (SELECT SUM(k.n * ({between})) FROM {p}per_k k, {p}gmean g) AS between_ss)"""


SCORES_OUT_SQL = """SELECT CAST(n_rows AS BIGINT) AS n_rows, CAST(n_labels AS BIGINT) AS n_labels, ROUND(wcss, 6) AS wcss,
       ROUND(davies_bouldin, 6) AS davies_bouldin,
       ROUND(CASE WHEN wcss = 0 THEN 1.0 ELSE between_ss * (n_rows - n_labels) / (wcss * (n_labels - 1)) END, 6) AS calinski_harabasz
FROM sc"""


def _round_scores(df):
    return df.select(F.col("n_rows").cast("long").alias("n_rows"), F.col("n_labels").cast("long").alias("n_labels"),
                     *[F.round(c, 6).alias(c) for c in ("wcss", "davies_bouldin", "calinski_harabasz")])


# --- K-Means steps ----------------------------------------------------------------------------

@register("kmeans_assign", f"""WITH {sql_scaled_cte()},
{KM.lloyd_sql('scaled', ID, Z, X.LLOYD_K, 0)}
SELECT {ID}, CAST(cluster AS INTEGER) AS cluster, ROUND(d2, 6) AS d2 FROM assign_final""")
def kmeans_assign(spark, sf):
    """ML1a: nearest of the 5 starting centers (rows with the smallest ids); ties -> lowest id."""
    df = X.scaled(spark, sf)
    init = KM.first_rows_as_centers(df, ID, Z, X.LLOYD_K)
    return KM.assign(df, Z, init, dist="d2").select(ID, "cluster", F.round("d2", 6).alias("d2"))


@register("kmeans_lloyd3", f"WITH {sql_lloyd_cte()} SELECT {ID}, CAST(cluster AS INTEGER) AS cluster FROM labelled")
def kmeans_lloyd3(spark, sf):
    """ML1b: labels after 3 Lloyd updates from the 5 given centers."""
    return X.lloyd_labelled(spark, sf).select(ID, "cluster")


@register("centroids", f"""WITH {sql_lloyd_cte()}
SELECT CAST(cluster AS INTEGER) AS cluster, COUNT(*) AS n, {', '.join(f'ROUND(AVG({z}), 6) AS {z}' for z in Z)}
FROM labelled GROUP BY cluster""")
def centroids(spark, sf):
    c = M.centroids(X.lloyd_labelled(spark, sf), Z)
    return c.select(F.col("_k").alias("cluster"), F.col("_n").alias("n"), *[F.round(f"_m{i}", 6).alias(z) for i, z in enumerate(Z)])


@register("inertia", f"""WITH {sql_lloyd_cte()},
cen AS (SELECT cluster, {', '.join(f'AVG({z}) AS {z}' for z in Z)} FROM labelled GROUP BY cluster)
SELECT ROUND(SUM({' + '.join(f'(l.{z} - c.{z}) * (l.{z} - c.{z})' for z in Z)}), 6) AS wcss
FROM labelled l JOIN cen c ON l.cluster = c.cluster""")
def inertia(spark, sf):
    """MT1: within-cluster sum of squares of the Lloyd labels (scaled features)."""
    return M.wcss(X.lloyd_labelled(spark, sf), Z).select(F.round("wcss", 6).alias("wcss"))


# --- silhouette -------------------------------------------------------------------------------

@register("silhouette_exact", f"""WITH {sql_lloyd_cte()},
{silhouette_sql('labelled', ID, _zdist())}
SELECT ROUND(silhouette, 6) AS silhouette, n_rows, 'exact' AS mode FROM sil""")
def silhouette_exact(spark, sf):
    """MT2: exact Euclidean silhouette of the Lloyd labels over all rows."""
    s = M.silhouette_exact(X.lloyd_labelled(spark, sf), ID, Z)
    return s.select(F.round("silhouette", 6).alias("silhouette"), "n_rows", "mode")


@register("silhouette_segments", f"""WITH {sql_scaled_cte()},
{_seg_sql()},
{silhouette_sql('seglab', ID, _zdist())}
SELECT ROUND(silhouette, 6) AS silhouette, n_rows, 'exact' AS mode FROM sil""")
def silhouette_segments(spark, sf):
    """MT2 with the market segment as the labelling."""
    s = M.silhouette_exact(X.segment_labelled(spark, sf), ID, Z)
    return s.select(F.round("silhouette", 6).alias("silhouette"), "n_rows", "mode")


@register("silhouette_embeddings", f"""WITH emb AS (SELECT vec_id, label AS cluster, embedding::DOUBLE[] AS e FROM embeddings),
{silhouette_sql('emb', 'vec_id', 'list_distance(a.e, b.e)')}
SELECT ROUND(silhouette, 6) AS silhouette, n_rows, 'exact' AS mode FROM sil""")
def silhouette_embeddings(spark, sf):
    """MT2 on 64-d embeddings labelled by ``label`` (high dimension, same blocked plan)."""
    e = T.table(spark, sf, "embeddings").select("vec_id", F.col("label").alias("cluster"), "embedding")
    s = M.silhouette_exact(e, "vec_id", vector="embedding")
    return s.select(F.round("silhouette", 6).alias("silhouette"), "n_rows", "mode")


# --- centroid scores --------------------------------------------------------------------------

@register("cluster_scores", f"WITH {sql_lloyd_cte()},\n{scores_sql('labelled', Z)}\n{SCORES_OUT_SQL}")
def cluster_scores(spark, sf):
    """MT1 + MT3 + MT4 of the Lloyd labels."""
    return _round_scores(M.centroid_scores(X.lloyd_labelled(spark, sf), Z))


@register("segment_scores", f"WITH {sql_scaled_cte()},\n{_seg_sql()},\n{scores_sql('seglab', Z)}\n{SCORES_OUT_SQL}")
def segment_scores(spark, sf):
    """MT1 + MT3 + MT4 with the market segment as the labelling."""
    return _round_scores(M.centroid_scores(X.segment_labelled(spark, sf), Z))


@register("metric_sentinels", f"""WITH {sql_scaled_cte()}
SELECT CAST(COUNT(*) AS BIGINT) AS n_rows, CAST(1 AS BIGINT) AS n_labels, CAST(-1.0 AS DOUBLE) AS silhouette,
       CAST('Infinity' AS DOUBLE) AS davies_bouldin, CAST(0.0 AS DOUBLE) AS calinski_harabasz, FALSE AS is_valid FROM scaled""")
def metric_sentinels(spark, sf):
    """MT6 + MT9: a single-label clustering gets the sentinel scores and is not valid."""
    lab = X.scaled(spark, sf).withColumn("cluster", F.lit(0))
    sc = M.centroid_scores(lab, Z).withColumn("silhouette", F.lit(None).cast("double"))
    out = M.with_sentinels(sc)
    return out.select(F.col("n_rows").cast("long").alias("n_rows"), F.col("n_labels").cast("long").alias("n_labels"),
                      "silhouette", "davies_bouldin", "calinski_harabasz", "is_valid")


# --- external validation ----------------------------------------------------------------------

ARI_SQL = """ari_in AS (SELECT SUM(nij) AS n, SUM(nij * nij) AS s2,
                   (SELECT SUM(ai * ai) FROM (SELECT SUM(nij) AS ai FROM cont GROUP BY truth) t) AS a2,
                   (SELECT SUM(bj * bj) FROM (SELECT SUM(nij) AS bj FROM cont GROUP BY cluster) t) AS b2 FROM cont),
ari AS (SELECT n, s2 - n AS tp, b2 - s2 AS fp, a2 - s2 AS fn, n * n - (b2 - s2) - (a2 - s2) - s2 AS tn FROM ari_in)
SELECT CAST(n AS BIGINT) AS n_matched,
       ROUND(CASE WHEN fn = 0 AND fp = 0 THEN 1.0
                  ELSE 2.0 * (tp * tn - fn * fp) / ((tp + fn) * (fn + tn) + (tp + fp) * (fp + tn)) END, 6) AS ari FROM ari"""


@register("ari_table", f"""WITH {sql_lloyd_cte()},
truth AS (SELECT c_custkey, c_mktsegment AS truth FROM customer),
cont AS (SELECT t.truth, l.cluster, CAST(COUNT(*) AS DOUBLE) AS nij FROM labelled l JOIN truth t USING ({ID}) GROUP BY t.truth, l.cluster),
{ARI_SQL}""")
def ari_table(spark, sf):
    """MT5: ARI of the Lloyd labels against the market segment, matched by id."""
    truth = T.table(spark, sf, "customer").select(F.col("c_custkey").alias(ID), F.col("c_mktsegment").alias("truth"))
    a = M.adjusted_rand(X.lloyd_labelled(spark, sf), truth, ID)
    return a.select("n_matched", F.round("ari", 6).alias("ari"))


@register("contingency", f"""WITH {sql_lloyd_cte()}
SELECT c.c_mktsegment AS truth, CAST(l.cluster AS INTEGER) AS cluster, COUNT(*) AS n
FROM labelled l JOIN customer c ON l.{ID} = c.c_custkey GROUP BY c.c_mktsegment, l.cluster""")
def contingency(spark, sf):
    lab = X.lloyd_labelled(spark, sf).select(ID, "cluster")
    truth = T.table(spark, sf, "customer").select(F.col("c_custkey").alias(ID), F.col("c_mktsegment").alias("truth"))
    return lab.join(truth, ID).groupBy("truth", "cluster").agg(F.count(F.lit(1)).alias("n"))


@register("label_codes", """SELECT c_mktsegment, MIN(c_custkey) AS first_id,
       CAST(row_number() OVER (ORDER BY MIN(c_custkey)) - 1 AS INTEGER) AS code FROM customer GROUP BY c_mktsegment""")
def label_codes(spark, sf):
    """AG14: labels numbered by first appearance."""
    return P.label_codes(T.table(spark, sf, "customer"), "c_custkey", "c_mktsegment")


@register("ari_embeddings_self", """WITH cont AS (SELECT label AS truth, label AS cluster, CAST(COUNT(*) AS DOUBLE) AS nij
                                          FROM embeddings GROUP BY label),
""" + ARI_SQL)
def ari_embeddings_self(spark, sf):
    """MT5 identity: a labelling against itself has ARI 1 (embeddings table)."""
    e = T.table(spark, sf, "embeddings").select("vec_id", F.col("label").alias("cluster"))
    t = T.table(spark, sf, "embeddings").select("vec_id", F.col("label").alias("truth"))
    a = M.adjusted_rand(e, t, "vec_id")
    return a.select("n_matched", F.round("ari", 6).alias("ari"))
