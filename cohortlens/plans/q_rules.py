"""Catalogue part 2: bands, rule tables, profiles, action tables and exports
(EX1-EX15, PR1-PR5, AG9, AG11, IO7, IO8, IO10)."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortlens import config as C
from cohortlens.functions import rules as R
from cohortlens.operators import profile as P
from cohortlens.plans import context as X
from cohortlens.sources.sinks import labelled_export
from cohortlens.plans.catalog import (BAND_SQL_COLS, CAT, FEATS, ID, ROUND_PROFILE_SQL, _round_profile, register,
                                      sql_lloyd_cte, sql_profile_agg)
from cohortlens.sources import tables as T

AGE_N, INC_N, SP_N = C.AGE_NAMES, C.INCOME_NAMES, C.SPENDING_NAMES


def nation_labelled(spark, sf):
    """Customers grouped by nation (the nation key plays the cluster label)."""
    f = T.customer_features(spark, sf, with_nation=True).na.drop(subset=FEATS)
    return f.withColumn("cluster", F.col("c_nationkey").cast("int")).drop("c_nationkey")


NATION_SQL = (f"nfeat AS ({T.customer_features_sql(with_nation=True)}),\n"
              f"nlab AS (SELECT CAST(c_nationkey AS INTEGER) AS cluster, * EXCLUDE (c_nationkey) FROM nfeat "
              f"WHERE c_acctbal IS NOT NULL AND order_count IS NOT NULL AND total_spend IS NOT NULL)")

_cat_batch = R.catalogue_rows_sql(C.PRODUCT_RULES_BATCH, R.BATCH_FIELDS)
_cat_inter = R.catalogue_rows_sql(C.PRODUCT_RULES_INTERACTIVE, R.INTERACTIVE_FIELDS)
_rec_sql, _prio_sql = R.recommendation_sql({"income": "income_band", "spending": "spending_band"})
_inter_rule = R.rule_index_sql(C.PRODUCT_RULES_INTERACTIVE, {"income": "income_band", "spending": "spending_band"})
_batch_rule = R.rule_index_sql(C.PRODUCT_RULES_BATCH, BAND_SQL_COLS)


# --- EX1-EX3: bands per row ------------------------------------------------------------------

@register("bands", f"""WITH {NATION_SQL}
SELECT {ID}, {R.band_sql('c_acctbal', X.BANDS.age, AGE_N)} AS age_band,
       {R.band_sql('total_spend', X.BANDS.income, INC_N)} AS income_band,
       {R.band_sql('order_count', X.BANDS.spending, SP_N)} AS spending_band FROM nlab""")
def bands(spark, sf):
    df = nation_labelled(spark, sf)
    b = R.band_columns(F.col("c_acctbal"), F.col("total_spend"), F.col("order_count"), X.BANDS)
    return df.select(ID, b["age"].alias("age_band"), b["income"].alias("income_band"), b["spending"].alias("spending_band"))


# --- PR1 over nations: EX4 strategy + EX6/EX14 products ---------------------------------------

@register("nation_profiles", f"""WITH {NATION_SQL},
{sql_profile_agg('nlab', 'Mixed')},
cat AS (SELECT * FROM {_cat_batch}),
ruled AS (SELECT p.*, {R.strategy_sql(BAND_SQL_COLS)} AS strategy, {_batch_rule} AS prod_rule FROM prof p)
SELECT {ROUND_PROFILE_SQL}, dominant_category, age_band, income_band, spending_band, strategy,
       (SELECT string_agg(c.product, ', ' ORDER BY c.rnk) FROM cat c WHERE c.rule = ruled.prod_rule AND c.rnk < 3) AS top_products
FROM ruled""")
def nation_profiles(spark, sf):
    prof = P.cluster_profiles(nation_labelled(spark, sf), X.ROLES, X.BANDS)
    top3 = F.concat_ws(", ", F.slice(F.transform("products", lambda p: p["product"]), 1, 3))
    return prof.select(*_round_profile(prof), "dominant_category", "age_band", "income_band", "spending_band",
                       "strategy", top3.alias("top_products"))


@register("products_batch", f"""WITH {NATION_SQL},
{sql_profile_agg('nlab', 'Mixed')},
ruled AS (SELECT p.cluster, {_batch_rule} AS prod_rule FROM prof p)
SELECT r.cluster, CAST(c.rnk AS INTEGER) AS rank, c.product, c.priority, c.reason, c.conversion
FROM ruled r JOIN {R.catalogue_rows_sql(C.PRODUCT_RULES_BATCH, R.BATCH_FIELDS, "c")} ON c.rule = r.prod_rule""")
def products_batch(spark, sf):
    """EX6 + EX15: one row per (group, recommended product) of the batch rule set."""
    prof = P.cluster_profiles(nation_labelled(spark, sf), X.ROLES, X.BANDS)
    return prof.select("cluster", F.posexplode("products").alias("rank", "p")).select(
        "cluster", F.col("rank").cast("int").alias("rank"), *[F.col(f"p.{f}").alias(f) for f in R.BATCH_FIELDS])


# --- PR2 / EX5 ---------------------------------------------------------------------------------

def _insights_sql(labelled: str) -> str:
    return f"""{sql_profile_agg(labelled, 'Unknown')},
ins AS (SELECT p.*, {_rec_sql} AS recommendation, {_prio_sql} AS priority FROM prof p)"""


@register("priority_rules", f"""WITH {NATION_SQL},
{_insights_sql('nlab')}
SELECT {ROUND_PROFILE_SQL}, age_band, income_band, spending_band, recommendation, priority FROM ins""")
def priority_rules(spark, sf):
    ins = P.cluster_insights(nation_labelled(spark, sf), X.ROLES, X.BANDS)
    return ins.select(*_round_profile(ins), "age_band", "income_band", "spending_band", "recommendation", "priority")


@register("cluster_insights", f"""WITH {sql_lloyd_cte()},
{_insights_sql('labelled')}
SELECT {ROUND_PROFILE_SQL}, dominant_category, age_band, income_band, spending_band, recommendation, priority FROM ins""")
def cluster_insights(spark, sf):
    """PR2 over the Lloyd labels."""
    ins = P.cluster_insights(X.lloyd_labelled(spark, sf), X.ROLES, X.BANDS)
    return ins.select(*_round_profile(ins), "dominant_category", "age_band", "income_band", "spending_band",
                      "recommendation", "priority")


# --- PR3 + EX7 + EX8 + EX13 + EX15 ------------------------------------------------------------

def _recs_sql(labelled: str) -> str:
    inter_cols = ", ".join(f"c.{f}" if f != "priority" else "c.priority AS product_priority" for f in R.INTERACTIVE_FIELDS)
    return f"""{_insights_sql(labelled)}
SELECT i.cluster, i.age_band, i.income_band, i.spending_band,
       COALESCE(d.demographic, dd.demographic) AS demographic, COALESCE(d.behavior, dd.behavior) AS behavior,
       COALESCE(d.approach, dd.approach) AS approach, CAST(c.rnk AS INTEGER) AS rank, {inter_cols},
       contains(c.priority, 'Primary') AS is_primary
FROM ins i
JOIN {R.catalogue_rows_sql(C.PRODUCT_RULES_INTERACTIVE, R.INTERACTIVE_FIELDS, "c")}
  ON c.rule = {_inter_rule.replace('income_band', 'i.income_band').replace('spending_band', 'i.spending_band')}
LEFT JOIN {R.demographics_rows_sql("d")} ON d.age_band = i.age_band
CROSS JOIN (SELECT * FROM {R.demographics_rows_sql("dd0")} WHERE age_band = {R.quote(C.DEFAULT_DEMOGRAPHIC)}) dd"""


@register("recommendation_rows", f"WITH {sql_lloyd_cte()},\n{_recs_sql('labelled')}")
def recommendation_rows(spark, sf):
    return P.recommendation_rows(P.cluster_insights(X.lloyd_labelled(spark, sf), X.ROLES, X.BANDS))


@register("nation_recommendations", f"WITH {NATION_SQL},\n{_recs_sql('nlab')}")
def nation_recommendations(spark, sf):
    return P.recommendation_rows(P.cluster_insights(nation_labelled(spark, sf), X.ROLES, X.BANDS))


# --- PR4 / PR5 ---------------------------------------------------------------------------------

_levels_sql = "(VALUES " + ", ".join(f"({i}, {R.quote(a)}, {R.quote(b)}, {R.quote(c)}, {R.quote(d)})"
                                     for i, (a, b, c, d) in enumerate(C.ACTION_PLAN)) + \
    ") AS lv(level_order, level, expected_impact, timeline, revenue_potential)"


@register("action_plan", f"""WITH {sql_lloyd_cte()},
{_insights_sql('labelled')}
SELECT CAST(lv.level_order AS INTEGER) AS level_order, lv.level, CAST(i.cluster AS INTEGER) AS cluster, CAST(i.size AS BIGINT) AS size,
       ROUND(i.share, 6) AS share, i.age_band, i.income_band, i.spending_band, i.recommendation,
       lv.expected_impact, lv.timeline, lv.revenue_potential
FROM ins i JOIN {_levels_sql} ON contains(i.priority, lv.level)""")
def action_plan(spark, sf):
    plan = P.action_plan(spark, P.cluster_insights(X.lloyd_labelled(spark, sf), X.ROLES, X.BANDS))
    return plan.withColumn("share", F.round("share", 6)).withColumn("size", F.col("size").cast("long"))


_budget_sql = "(VALUES " + ", ".join(f"({R.quote(a)}, {b}, {R.quote(c)}, {R.quote(a.split(' ')[0])})" for a, b, c in C.BUDGET) + \
    ") AS b(priority, budget_pct, reason, level)"


@register("budget", f"""WITH {sql_lloyd_cte()},
{_insights_sql('labelled')},
cnt AS (SELECT regexp_extract(priority, '(High|Medium|Low)', 1) AS level, COUNT(*) AS n_clusters, SUM(size) AS n_customers
        FROM ins GROUP BY 1)
SELECT b.priority, CAST(b.budget_pct AS INTEGER) AS budget_pct, b.reason,
       CAST(COALESCE(cnt.n_clusters, 0) AS BIGINT) AS n_clusters, CAST(COALESCE(cnt.n_customers, 0) AS BIGINT) AS n_customers
FROM {_budget_sql} LEFT JOIN cnt ON b.level = cnt.level""")
def budget(spark, sf):
    return P.budget_allocation(spark, P.cluster_insights(X.lloyd_labelled(spark, sf), X.ROLES, X.BANDS))


# --- EX9-EX12, IO8, IO10, IO7 -----------------------------------------------------------------

@register("segment_text", f"""WITH {sql_lloyd_cte()},
{sql_profile_agg('labelled', 'Mixed')}
SELECT CAST(cluster AS INTEGER) AS cluster, CASE WHEN cluster = -1 THEN 'Noise' ELSE 'Cluster ' || cluster END AS cluster_name,
       age_band || ', ' || income_band || ' income, ' || spending_band || ' spending' AS description FROM prof""")
def segment_text(spark, sf):
    prof = P.cluster_profiles(X.lloyd_labelled(spark, sf), X.ROLES, X.BANDS)
    return prof.select("cluster", R.cluster_name(F.col("cluster")).alias("cluster_name"),
                       R.segment_text(F.col("age_band"), F.col("income_band"), F.col("spending_band")).alias("description"))


@register("formatted_insights", f"""WITH {sql_lloyd_cte()},
{_insights_sql('labelled')}
SELECT CAST(cluster AS INTEGER) AS "Cluster", CAST(size AS BIGINT) AS "Size",
       printf('%.1f%%', share) AS "Market %", printf('%.1f', avg_age) AS "Avg Age",
       'BDT ' || format('{{:,.0f}}', avg_income) AS "Avg Income", printf('%.1f', avg_spending) AS "Avg Spending",
       priority AS "Priority", recommendation AS "Strategy" FROM ins""")
def formatted_insights(spark, sf):
    """IO8 + EX11: the insight export with display formatting (ties to even, as Python formats)."""
    ins = P.cluster_insights(X.lloyd_labelled(spark, sf), X.ROLES, X.BANDS)
    return ins.select(
        F.col("cluster").alias("Cluster"), F.col("size").alias("Size"),
        F.concat(R.fixed_text(F.col("share"), 1), F.lit("%")).alias("Market %"),
        R.fixed_text(F.col("avg_age"), 1).alias("Avg Age"),
        F.concat(F.lit("BDT "), R.grouped_thousands(F.col("avg_income"))).alias("Avg Income"),
        R.fixed_text(F.col("avg_spending"), 1).alias("Avg Spending"),
        F.col("priority").alias("Priority"), F.col("recommendation").alias("Strategy"))


@register("cluster_sizes", f"""WITH {sql_lloyd_cte()}
SELECT 'Cluster ' || cluster AS "Cluster", COUNT(*) AS "Customer_Count",
       printf('%.2f%%', COUNT(*) * 100.0 / (SELECT COUNT(*) FROM labelled)) AS "Percentage"
FROM labelled GROUP BY cluster""")
def cluster_sizes(spark, sf):
    """IO10 + AG9 + AG11: the cluster-size table."""
    s = P.cluster_sizes(X.lloyd_labelled(spark, sf))
    return s.select(F.format_string("Cluster %d", "cluster").alias("Cluster"), F.col("size").alias("Customer_Count"),
                    F.concat(R.fixed_text(F.col("share"), 2), F.lit("%")).alias("Percentage"))


@register("labelled_rows", f"""WITH {sql_lloyd_cte()}
SELECT {ID}, {CAT}, c_acctbal, order_count, ROUND(total_spend, 2) AS total_spend, CAST(cluster AS INTEGER) AS "Cluster" FROM labelled""")
def labelled_rows(spark, sf):
    """IO7: customers with the chosen algorithm's label as ``Cluster``."""
    lab = X.lloyd_labelled(spark, sf)
    out = labelled_export(X.clean_features(spark, sf), lab, ID)
    return out.select(ID, CAT, "c_acctbal", "order_count", F.round("total_spend", 2).alias("total_spend"), "Cluster")
