"""Catalogue part 1: sources, cleaning, descriptive statistics (IO1, IO5, CL1-CL16, AG1-AG8, CH6, CH7)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.operators import clean as CL
from cohortlens.operators import scale as SC
from cohortlens.operators import stats as ST
from cohortlens.plans import context as X
from cohortlens.plans.catalog import CAT, FEATS, ID, register, sql_clean_cte, sql_lloyd_cte, sql_scaled_cte
from cohortlens.sources import tables as T

def _feat_nulls(spark, sf):
    """Feature table with nulls and NaNs injected by row conditions, over all customers and orders."""
    f = T.customer_features(spark, sf)
    return f.select(
        ID, CAT, F.when(F.col("c_acctbal") < -900, F.lit(float("nan"))).otherwise(F.col("c_acctbal")).alias("c_acctbal"),
        "order_count", F.when(F.col("order_count") >= 8, F.col("total_spend")).alias("total_spend"))


FEAT_NULLS_SQL = (f"base0 AS ({T.customer_features_sql()}),\n"
                  f"feat AS (SELECT {ID}, {CAT}, CASE WHEN c_acctbal < -900 THEN CAST('NaN' AS DOUBLE) ELSE c_acctbal END AS c_acctbal, "
                  f"order_count, CASE WHEN order_count >= 8 THEN total_spend END AS total_spend FROM base0)")


def _feat_inf(spark, sf):
    """Feature table with -Inf injected by a data condition (very negative balances) and a
    non-feature column that holds +Inf for heavy buyers."""
    f = T.customer_features(spark, sf)
    return f.select(
        ID, CAT,
        F.when(F.col("c_acctbal") < -900, F.lit(float("-inf"))).otherwise(F.col("c_acctbal")).alias("c_acctbal"),
        "order_count", "total_spend",
        F.when(F.col("order_count") >= 20, F.lit(float("inf"))).otherwise(F.lit(1.0)).alias("bonus"))


FEAT_INF_SQL = (f"base AS ({T.customer_features_sql()}),\n"
                f"feat AS (SELECT {ID}, {CAT}, CASE WHEN c_acctbal < -900 THEN CAST('-Infinity' AS DOUBLE) ELSE c_acctbal END AS c_acctbal, "
                f"order_count, total_spend, CASE WHEN order_count >= 20 THEN CAST('Infinity' AS DOUBLE) ELSE 1.0 END AS bonus FROM base)")


@register("load_customers", "SELECT c_custkey, c_name, c_mktsegment, c_acctbal FROM customer")
def load_customers(spark: SparkSession, sf: str) -> DataFrame:
    """IO1 + IO3 + IO4: read with the schema check (no job), project the role columns."""
    df = T.read_customers(spark, os.path.join(sf, "customer.parquet"), fmt="parquet")
    T.check_schema(df, X.CUSTOMER_CHECK_ROLES)
    return df.select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")


@register("shape_summary", f"WITH {FEAT_NULLS_SQL} SELECT COUNT(*) AS n_rows, CAST((SELECT len(json_keys(to_json(f))) FROM feat f LIMIT 1) AS INTEGER) AS n_cols FROM feat")
def shape_summary(spark, sf):
    return T.shape_summary(_feat_nulls(spark, sf))


@register("null_report", f"""WITH {FEAT_NULLS_SQL}
SELECT * FROM (VALUES ('c_acctbal', (SELECT COUNT(*) FROM feat WHERE c_acctbal IS NULL OR isnan(c_acctbal))),
                      ('order_count', (SELECT COUNT(*) FROM feat WHERE order_count IS NULL OR isnan(order_count))),
                      ('total_spend', (SELECT COUNT(*) FROM feat WHERE total_spend IS NULL OR isnan(total_spend)))) v(feature, null_count)""")
def null_report(spark, sf):
    return CL.null_report(_feat_nulls(spark, sf), FEATS)


@register("clean_missing", f"""WITH {FEAT_NULLS_SQL}
SELECT {ID}, {CAT}, c_acctbal, order_count, ROUND(total_spend, 2) AS total_spend FROM feat
WHERE c_acctbal IS NOT NULL AND NOT isnan(c_acctbal) AND order_count IS NOT NULL AND total_spend IS NOT NULL""")
def clean_missing(spark, sf):
    df = CL.drop_missing(_feat_nulls(spark, sf), FEATS)
    return df.select(ID, CAT, "c_acctbal", "order_count", F.round("total_spend", 2).alias("total_spend"))


@register("inf_report", f"""WITH {FEAT_INF_SQL}
SELECT CAST(COUNT(*) AS BIGINT) AS inf_rows FROM feat
WHERE c_acctbal IN ('Infinity'::DOUBLE, '-Infinity'::DOUBLE) OR order_count IN ('Infinity'::DOUBLE, '-Infinity'::DOUBLE)
   OR total_spend IN ('Infinity'::DOUBLE, '-Infinity'::DOUBLE)""")
def inf_report(spark, sf):
    return CL.inf_report(_feat_inf(spark, sf), FEATS)


@register("clean_inf", f"""WITH {FEAT_INF_SQL},
g AS (SELECT COUNT(*) > 0 AS has_inf FROM feat WHERE c_acctbal IN ('Infinity'::DOUBLE, '-Infinity'::DOUBLE)
      OR order_count IN ('Infinity'::DOUBLE, '-Infinity'::DOUBLE) OR total_spend IN ('Infinity'::DOUBLE, '-Infinity'::DOUBLE)),
n AS (SELECT {ID}, {CAT},
        CASE WHEN g.has_inf AND c_acctbal IN ('Infinity'::DOUBLE, '-Infinity'::DOUBLE) THEN NULL ELSE c_acctbal END AS c_acctbal,
        CASE WHEN g.has_inf AND order_count IN ('Infinity'::DOUBLE, '-Infinity'::DOUBLE) THEN NULL ELSE order_count END AS order_count,
        CASE WHEN g.has_inf AND total_spend IN ('Infinity'::DOUBLE, '-Infinity'::DOUBLE) THEN NULL ELSE total_spend END AS total_spend,
        CASE WHEN g.has_inf AND bonus IN ('Infinity'::DOUBLE, '-Infinity'::DOUBLE) THEN NULL ELSE bonus END AS bonus
      FROM feat, g)
SELECT {ID}, {CAT}, c_acctbal, order_count, ROUND(total_spend, 2) AS total_spend, bonus FROM n
WHERE c_acctbal IS NOT NULL AND NOT isnan(c_acctbal) AND order_count IS NOT NULL AND NOT isnan(order_count)
  AND total_spend IS NOT NULL AND NOT isnan(total_spend)""")
def clean_inf(spark, sf):
    df = CL.drop_inf(_feat_inf(spark, sf), FEATS)
    return df.select(ID, CAT, "c_acctbal", "order_count", F.round("total_spend", 2).alias("total_spend"), "bonus")


def _q_sql(f, p):
    return f"quantile_cont({f}, {p})"


@register("outlier_report", f"""WITH {sql_clean_cte()},
q AS ({' UNION ALL '.join(f"SELECT '{f}' AS feature, {_q_sql(f, 0.25)} AS q1, {_q_sql(f, 0.75)} AS q3, {i} AS o FROM clean" for i, f in enumerate(FEATS))})
SELECT q.feature, ROUND(q1, 4) AS q1, ROUND(q3, 4) AS q3, ROUND(q1 - 3.0 * (q3 - q1), 4) AS lower_fence,
       ROUND(q3 + 3.0 * (q3 - q1), 4) AS upper_fence,
       CAST(CASE q.feature {' '.join(f"WHEN '{f}' THEN (SELECT COUNT(*) FROM clean WHERE {f} < q1 - 3.0 * (q3 - q1) OR {f} > q3 + 3.0 * (q3 - q1))" for f in FEATS)} END AS BIGINT) AS n_outliers
FROM q""")
def outlier_report(spark, sf):
    r = CL.outlier_report(X.clean_features(spark, sf), FEATS, multiplier=X.CFG.outlier_iqr)
    return r.select("feature", *[F.round(c, 4).alias(c) for c in ("q1", "q3", "lower_fence", "upper_fence")], "n_outliers")


@register("scaled_features", f"""WITH {sql_scaled_cte()}
SELECT {ID}, {', '.join(f'ROUND({z}, 6) AS {z}' for z in X.ZCOLS)} FROM scaled""")
def scaled_features(spark, sf):
    return X.scaled(spark, sf).select(ID, *[F.round(z, 6).alias(z) for z in X.ZCOLS])


@register("drop_label", f"""WITH {sql_clean_cte()}
SELECT {ID}, c_acctbal, order_count, ROUND(total_spend, 2) AS total_spend FROM clean""")
def drop_label(spark, sf):
    """CL8: the label column removed before clustering."""
    df = X.clean_features(spark, sf).drop(CAT)
    return df.withColumn("total_spend", F.round("total_spend", 2))


@register("clip_trunc", """SELECT c_custkey,
  CASE WHEN c_acctbal IS NULL THEN NULL ELSE GREATEST(0.0, LEAST(5000.0, c_acctbal)) END AS acctbal_clipped,
  CAST(trunc(c_acctbal) AS INTEGER) AS acctbal_int FROM customer""")
def clip_trunc(spark, sf):
    """CL9 + CL10 on the customer table."""
    return T.table(spark, sf, "customer").select(
        "c_custkey", CL.clip("c_acctbal", 0.0, 5000.0).alias("acctbal_clipped"), CL.truncate_int("c_acctbal").alias("acctbal_int"))


@register("preview10", f"""WITH {sql_clean_cte()}
SELECT {ID}, {CAT}, c_acctbal, order_count, ROUND(total_spend, 2) AS total_spend FROM clean ORDER BY {ID} LIMIT 10""")
def preview10(spark, sf):
    df = CL.preview(X.clean_features(spark, sf), ID, 10)
    return df.select(ID, CAT, "c_acctbal", "order_count", F.round("total_spend", 2).alias("total_spend"))


@register("sample_n_count", f"""WITH {sql_clean_cte()}
SELECT LEAST(100, COUNT(*)) AS n_sampled, LEAST(100, COUNT(DISTINCT {ID})) AS n_distinct FROM clean""")
def sample_n_count(spark, sf):
    """CL14: a seeded 100-row sample (the sampling operator itself; counts are the comparable part)."""
    s = CL.sample_rows(X.clean_features(spark, sf), ID, 100, seed=X.CFG.seed)
    return s.agg(F.count(F.lit(1)).alias("n_sampled"), F.count_distinct(ID).alias("n_distinct"))


@register("reid_rows", f"""WITH {sql_clean_cte()}
SELECT COUNT(*) AS n_rows, CAST(1 AS BIGINT) AS min_id, CAST(COUNT(*) AS BIGINT) AS max_id,
       COUNT(*) AS n_distinct, CAST(SUM({ID}) AS BIGINT) AS key_sum FROM clean""")
def reid_rows(spark, sf):
    """CL15: permute + dense re-id 1..n (distributed numbering); checks that ids are 1..n exactly once."""
    r = CL.shuffle_reid(X.clean_features(spark, sf), ID, seed=X.CFG.seed)
    return r.agg(F.count(F.lit(1)).alias("n_rows"), F.min("new_id").alias("min_id"), F.max("new_id").alias("max_id"),
                 F.count_distinct("new_id").alias("n_distinct"), F.sum(ID).cast("long").alias("key_sum"))


@register("stack_tables", """SELECT 'customer' AS entity, c_custkey AS entity_key, c_acctbal AS acctbal FROM customer
UNION ALL SELECT 'supplier' AS entity, s_suppkey AS entity_key, s_acctbal AS acctbal FROM supplier""")
def stack_tables(spark, sf):
    """CL16: stack two tables by column name."""
    c = T.table(spark, sf, "customer").select(F.lit("customer").alias("entity"), F.col("c_custkey").alias("entity_key"),
                                              F.col("c_acctbal").alias("acctbal"))
    s = T.table(spark, sf, "supplier").select(F.lit("supplier").alias("entity"), F.col("s_suppkey").alias("entity_key"),
                                              F.col("s_acctbal").alias("acctbal"))
    return c.unionByName(s)


@register("cluster_members", f"""WITH {sql_lloyd_cte()}
SELECT {ID}, {CAT}, cluster FROM labelled WHERE cluster = 2""")
def cluster_members(spark, sf):
    """CL11: the rows of one cluster (here cluster 2 of the Lloyd labels)."""
    return X.lloyd_labelled(spark, sf).where(F.col("cluster") == 2).select(ID, CAT, "cluster")


# --- statistics -------------------------------------------------------------------------------

def _describe_sql(f):
    return (f"SELECT '{f}' AS feature, COUNT({f}) AS count, ROUND(AVG({f}), 2) AS mean, ROUND(STDDEV_SAMP({f}), 2) AS std, "
            f"ROUND(MIN({f}), 2) AS min, ROUND(quantile_cont({f}, 0.25), 2) AS p25, ROUND(quantile_cont({f}, 0.5), 2) AS p50, "
            f"ROUND(quantile_cont({f}, 0.75), 2) AS p75, ROUND(MAX({f}), 2) AS max FROM clean")


@register("describe", f"WITH {sql_clean_cte()} {' UNION ALL '.join(_describe_sql(f) for f in FEATS)}")
def describe(spark, sf):
    d = ST.describe(X.clean_features(spark, sf), FEATS)
    return d.select("feature", "count", *[F.round(c, 2).alias(c) for c in ("mean", "std", "min", "p25", "p50", "p75", "max")])


@register("ranges", f"WITH {sql_clean_cte()} " + " UNION ALL ".join(
    f"SELECT '{f}' AS feature, ROUND(MIN({f}), 2) AS min, ROUND(MAX({f}), 2) AS max FROM clean" for f in FEATS))
def ranges(spark, sf):
    r = ST.ranges(X.clean_features(spark, sf), FEATS)
    return r.select("feature", F.round("min", 2).alias("min"), F.round("max", 2).alias("max"))


@register("kpis", f"WITH {sql_clean_cte()} SELECT COUNT(*) AS n_rows, "
                  + ", ".join(f"ROUND(AVG({f}), 2) AS mean_{f}" for f in FEATS) + " FROM clean")
def kpis(spark, sf):
    k = ST.kpis(X.clean_features(spark, sf), FEATS)
    return k.select("n_rows", *[F.round(f"mean_{f}", 2).alias(f"mean_{f}") for f in FEATS])


@register("category_shares", f"""WITH {sql_clean_cte()}
SELECT {CAT} AS value, COUNT(*) AS count, ROUND(COUNT(*) * 100.0 / SUM(COUNT(*)) OVER (), 6) AS share
FROM clean WHERE {CAT} IS NOT NULL GROUP BY {CAT}""")
def category_shares(spark, sf):
    """AG4 / CH6: category frequencies with percent (pie data)."""
    v = ST.value_counts(X.clean_features(spark, sf), CAT)
    return v.select("value", "count", F.round("share", 6).alias("share"))


def _corr_sql(digits):
    cells = []
    for a in FEATS:
        for b in FEATS:
            v = f"CORR({a}, {b})"
            cells.append(f"SELECT '{a}' AS feature_x, '{b}' AS feature_y, ROUND({v}, {digits}) AS corr FROM clean")
    return f"WITH {sql_clean_cte()} " + " UNION ALL ".join(cells)


@register("correlations", _corr_sql(6))
def correlations(spark, sf):
    c = ST.correlations(X.clean_features(spark, sf), FEATS)
    return c.select("feature_x", "feature_y", F.round("corr", 6).alias("corr"))


@register("corr_cells", _corr_sql(3))
def corr_cells(spark, sf):
    """CH7: the heat-map cells, rounded to 3 places."""
    c = ST.correlations(X.clean_features(spark, sf), FEATS)
    return c.select("feature_x", "feature_y", F.round("corr", 3).alias("corr"))


def _hist_sql(f, bins=30):
    return (f"SELECT '{f}' AS feature, CAST(b.bin AS INTEGER) AS bin, ROUND(m.lo + b.bin * (m.hi - m.lo) / {bins}.0, 4) AS bin_start, "
            f"ROUND(m.lo + (b.bin + 1) * (m.hi - m.lo) / {bins}.0, 4) AS bin_end, "
            f"CAST((SELECT COUNT(*) FROM clean WHERE {f} IS NOT NULL AND CASE WHEN m.hi = m.lo THEN 0 ELSE "
            f"LEAST(FLOOR(({f} - m.lo) / ((m.hi - m.lo) / {bins}.0)), {bins - 1}) END = b.bin) AS BIGINT) AS count "
            f"FROM (SELECT MIN({f}) AS lo, MAX({f}) AS hi FROM clean) m, range(0, {bins}) b(bin)")


@register("histogram30", f"WITH {sql_clean_cte()} " + " UNION ALL ".join(_hist_sql(f) for f in FEATS))
def histogram30(spark, sf):
    """AG6: 30 equal-width bins per feature, empty bins included."""
    clean = X.clean_features(spark, sf)
    parts = [ST.histogram(clean, f, X.CFG.histogram_bins).select(
        F.lit(f).alias("feature"), "bin", F.round("bin_start", 4).alias("bin_start"), F.round("bin_end", 4).alias("bin_end"), "count")
        for f in FEATS]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register("quantiles", """SELECT event_type, ROUND(quantile_cont(value, 0.1), 6) AS p10, ROUND(quantile_cont(value, 0.5), 6) AS p50,
       ROUND(quantile_cont(value, 0.9), 6) AS p90 FROM events GROUP BY event_type""")
def quantiles(spark, sf):
    """AG7: linear-interpolation quantiles of event values per event type."""
    q = ST.quantiles(T.table(spark, sf, "events"), "value", [0.1, 0.5, 0.9], by="event_type")
    return q.select("event_type", *[F.round(c, 6).alias(c) for c in ("p10", "p50", "p90")])


@register("category_mode", """SELECT c_nationkey, mode_value FROM (
  SELECT c_nationkey, c_mktsegment AS mode_value,
         row_number() OVER (PARTITION BY c_nationkey ORDER BY COUNT(*) DESC, c_mktsegment) AS rn
  FROM customer WHERE c_mktsegment IS NOT NULL GROUP BY c_nationkey, c_mktsegment) t WHERE rn = 1""")
def category_mode(spark, sf):
    """AG8: modal market segment per nation (ties -> smallest value)."""
    return ST.mode_by(T.table(spark, sf, "customer"), "c_mktsegment", "c_nationkey")


@register("feature_vectors", f"""WITH {sql_clean_cte()}
SELECT {ID}, {len(FEATS)} AS n_dims, {', '.join(f'ROUND({f}, 2) AS x{i}' for i, f in enumerate(FEATS))} FROM clean""")
def feature_vectors(spark, sf):
    """CL7: the features, in order, as one vector column (shown by its elements)."""
    v = SC.feature_vector(X.clean_features(spark, sf), FEATS)
    return v.select(ID, F.size("features").alias("n_dims"), *[F.round(F.col("features")[i], 2).alias(f"x{i}") for i in range(len(FEATS))])
