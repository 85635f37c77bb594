"""Cluster profiles and action tables: AG9-AG14, CL11, CL12, PR1-PR5.

Every per-cluster loop of the original job becomes one ``groupBy(cluster)`` (one scan, partial
aggregation map-side, k groups after the shuffle). Percent-of-total uses a scalar subquery
(evaluated once, no single-partition window).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens import config as C
from cohortlens.functions import rules as R


def cluster_sizes(labelled: DataFrame, cluster: str = "cluster") -> DataFrame:
    """AG9 / AG11 / IO10: size and share per label (noise included, shares of all rows)."""
    total = labelled.select(F.count(F.lit(1))).scalar()
    return (labelled.groupBy(F.col(cluster).alias("cluster")).agg(F.count(F.lit(1)).alias("size"))
            .select("cluster", "size", (F.col("size") * 100.0 / total).alias("share")))


def noise_summary(labelled: DataFrame, cluster: str = "cluster") -> DataFrame:
    """AG12 + AG13 + ML12: noise count/share, clusters found, outcome warning — one aggregate."""
    c = F.col(cluster)
    agg = labelled.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(c == -1).alias("n_noise"),
        F.count_distinct(F.when(c != -1, c)).alias("n_clusters"),
    )
    return agg.select(
        "n_rows", "n_noise", (F.col("n_noise") * 100.0 / F.col("n_rows")).alias("noise_share"), "n_clusters",
        F.when(F.col("n_clusters") == 0, F.lit("no clusters found: every row is noise"))
         .when(F.col("n_clusters") == 1, F.lit("only one cluster found: scores are undefined"))
         .otherwise(F.lit(None).cast("string")).alias("warning"),
    )


def mean_of(col: str, roles: C.Roles):
    """Mean of a feature; money features (2 decimals) are averaged over exact integer cents."""
    if col in roles.money:
        cents = F.sum(F.round(F.col(col).cast("double") * 100.0).cast("long")).cast("double")
        return cents / F.count(F.col(col)).cast("double") / F.lit(100.0)
    return F.avg(F.col(col).cast("double"))


def profile_aggregate(labelled: DataFrame, roles: C.Roles, cluster: str = "cluster", empty_mode: str = "Mixed", by: str | None = None) -> DataFrame:
    """AG9 + AG10 + AG8 + CL12: size, share, raw-feature means and modal category per non-noise cluster, of each
    labelling named in column ``by`` if there are several."""
    feats = {"avg_age": roles.age_feature, "avg_income": roles.income_feature, "avg_spending": roles.spending_feature}
    # First by (cluster, category), one row per value, so that no task holds a cluster's values for the mode.
    keys = ([F.col(by)] if by else []) + [F.col(cluster).alias("cluster")]
    rows = labelled if by else labelled.where(F.col(cluster) != -1)
    per = rows.groupBy(*keys, F.col(roles.category).alias("_cat")).agg(
        F.count(F.lit(1)).alias("_n"), *[x for name, f in feats.items() for x in (_total_of(f, roles).alias(f"_s_{name}"), F.count(f).alias(f"_c_{name}"))])
    by_count = F.when(F.col("_cat").isNotNull(), F.struct(-F.col("_n"), F.col("_cat")))
    means = [(F.sum(f"_s_{name}").cast("double") / F.sum(f"_c_{name}").cast("double") / F.lit(100.0 if f in roles.money else 1.0)).alias(name)
             for name, f in feats.items()]
    out = per.groupBy(*([by] if by else []), "cluster").agg(
        F.sum("_n").alias("size"), *means, F.coalesce(F.min_by("_cat", by_count), F.lit(empty_mode)).alias("dominant_category"))
    if not by:
        return out.withColumn("share", F.col("size") * 100.0 / labelled.select(F.count(F.lit(1))).scalar())
    totals = out.groupBy(by).agg(F.sum("size").alias("_total"))  # noise included
    return out.where("cluster <> -1").join(totals, by).withColumn("share", F.col("size") * 100.0 / F.col("_total")).drop("_total")


def _total_of(col: str, roles: C.Roles):
    """Sum of a feature; money features (2 decimals) in exact integer cents."""
    x = F.col(col).cast("double")
    return F.sum(F.round(x * 100.0).cast("long")) if col in roles.money else F.sum(x)


def _band_cols(bands: C.Bands) -> dict:
    cols = R.band_columns(F.col("avg_age"), F.col("avg_income"), F.col("avg_spending"), bands)
    cols["share"] = F.col("share")
    return cols


def cluster_profiles_many(labelled: DataFrame, roles: C.Roles, bands: C.Bands, by: str = "algorithm") -> DataFrame:
    """PR1 for several labellings of the same rows (one row per row and labelling, named in ``by``) in one aggregate."""
    return cluster_profiles(labelled, roles, bands, by=by)


def cluster_profiles(labelled: DataFrame, roles: C.Roles, bands: C.Bands, cluster: str = "cluster", by: str | None = None) -> DataFrame:
    """PR1 (batch): bands of the cluster means, strategy (EX4) and product list (EX6)."""
    agg = profile_aggregate(labelled, roles, cluster, "Mixed", by)
    b = _band_cols(bands)
    return agg.select(
        *([by] if by else []), "cluster", "size", "share", "avg_age", "avg_income", "avg_spending", "dominant_category",
        b["age"].alias("age_band"), b["income"].alias("income_band"), b["spending"].alias("spending_band"),
    ).select("*", *_rules_batch())


def _rules_batch():
    cols = {"income": F.col("income_band"), "spending": F.col("spending_band"), "share": F.col("share")}
    return [R.strategy(cols).alias("strategy"), R.products_batch(cols).alias("products")]


def cluster_insights(labelled: DataFrame, roles: C.Roles, bands: C.Bands, cluster: str = "cluster") -> DataFrame:
    """PR2 (interactive): as PR1 with the recommendation text and priority of EX5."""
    agg = profile_aggregate(labelled, roles, cluster, "Unknown")
    b = _band_cols(bands)
    base = agg.select(
        "cluster", "size", "share", "avg_age", "avg_income", "avg_spending", "dominant_category",
        b["age"].alias("age_band"), b["income"].alias("income_band"), b["spending"].alias("spending_band"))
    rec, prio = R.recommendation_and_priority({"income": F.col("income_band"), "spending": F.col("spending_band")})
    return base.select("*", rec.alias("recommendation"), prio.alias("priority"))


def recommendation_rows(insights: DataFrame) -> DataFrame:
    """PR3 + EX7 + EX8 + EX13 + EX15: one row per cluster x recommended product."""
    cols = {"income": F.col("income_band"), "spending": F.col("spending_band")}
    with_recs = insights.select(
        "cluster", "age_band", "income_band", "spending_band", "priority",
        R.demographic(F.col("age_band")).alias("demo"), R.products_interactive(cols).alias("recs"))
    return with_recs.select(
        "cluster", "age_band", "income_band", "spending_band",
        F.col("demo.demographic").alias("demographic"), F.col("demo.behavior").alias("behavior"),
        F.col("demo.approach").alias("approach"), F.posexplode("recs").alias("rank", "rec"),
    ).select(
        "cluster", "age_band", "income_band", "spending_band", "demographic", "behavior", "approach",
        F.col("rank").cast("int").alias("rank"),
        *[F.col(f"rec.{f}").alias(f if f != "priority" else "product_priority") for f in R.INTERACTIVE_FIELDS],
        R.is_primary(F.col("rec.priority")).alias("is_primary"),
    )


def action_plan(spark: SparkSession, insights: DataFrame) -> DataFrame:
    """PR4: clusters grouped by priority level with impact, timeline and revenue potential.

    The 3-row level table is a fixed config constant (size known), so it is broadcast.
    """
    levels = spark.createDataFrame(
        [(i, lvl, impact, timeline, revenue) for i, (lvl, impact, timeline, revenue) in enumerate(C.ACTION_PLAN)],
        "level_order INT, level STRING, expected_impact STRING, timeline STRING, revenue_potential STRING")
    return (insights.join(F.broadcast(levels), insights.priority.contains(levels.level), "inner")
            .select("level_order", "level", "cluster", "size", "share", "age_band", "income_band", "spending_band",
                    "recommendation", "expected_impact", "timeline", "revenue_potential"))


def budget_allocation(spark: SparkSession, insights: DataFrame) -> DataFrame:
    """PR5: 50/35/15 % budget rows with the number of clusters and customers at each level."""
    rows = [(name, pct, reason, name.split(" ")[0]) for name, pct, reason in C.BUDGET]
    budget = spark.createDataFrame(rows, "priority STRING, budget_pct INT, reason STRING, level STRING")
    counts = insights.groupBy(F.regexp_extract("priority", r"(High|Medium|Low)", 1).alias("level")).agg(
        F.count(F.lit(1)).alias("n_clusters"), F.sum("size").alias("n_customers"))
    return (F.broadcast(budget).join(counts, "level", "left")
            .select("priority", "budget_pct", "reason",
                    F.coalesce("n_clusters", F.lit(0)).cast("long").alias("n_clusters"),
                    F.coalesce("n_customers", F.lit(0)).cast("long").alias("n_customers")))


def label_codes(df: DataFrame, id_col: str, label: str) -> DataFrame:
    """AG14: labels numbered 0.. by first appearance (smallest id), by the distributed numbering."""
    from cohortlens.operators.clean import dense_index
    firsts = df.groupBy(label).agg(F.min(id_col).alias("first_id"))
    return dense_index(firsts, ["first_id"], name="code").select(label, "first_id", F.col("code").cast("int"))
