"""The query catalogue: one Spark query per operator id of the inventory, each with its SQL twin.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLES[name] -> str`` (DuckDB SQL over the
bundled tables). Floats are rounded identically on both sides (6 places for unit-scale values,
2-4 for money-scale means) so that summation order cannot change the compared value.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens import config as C
from cohortlens.functions import rules as R
from cohortlens.operators import kmeans as KM
from cohortlens.operators import profile as P
from cohortlens.operators.scale import scaled_sql
from cohortlens.plans import context as X
from cohortlens.sources.tables import customer_features_sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


# --- shared SQL fragments --------------------------------------------------------------------

FEATS = X.FEATURES
ID = X.ROLES.id
CAT = X.ROLES.category


def sql_clean_cte() -> str:
    nn = " AND ".join(f"{f} IS NOT NULL AND NOT isnan({f})" for f in FEATS)
    return f"feat AS ({customer_features_sql()}),\nclean AS (SELECT * FROM feat WHERE {nn})"


def sql_scaled_cte() -> str:
    return f"{sql_clean_cte()},\nscaled AS (SELECT s.*, c.{CAT}, {', '.join('c.' + f for f in FEATS)} FROM {scaled_sql('clean', ID, FEATS)} s JOIN clean c USING ({ID}))"


def sql_lloyd_cte(k: int = X.LLOYD_K, iters: int = X.LLOYD_ITERS) -> str:
    return (f"{sql_scaled_cte()},\n{KM.lloyd_sql('scaled', ID, X.ZCOLS, k, iters)},\n"
            f"labelled AS (SELECT s.*, a.cluster FROM scaled s JOIN assign_final a USING ({ID}))")


def sql_profile_agg(labelled: str, empty_mode: str, p: str = "") -> str:
    """CTEs ``{p}tot``, ``{p}agg``, ``{p}modes``, ``{p}prof`` over a relation with cluster + raw features."""
    r = X.ROLES

    def mean(c):
        if c in r.money:
            return f"CAST(SUM(CAST(ROUND({c} * 100.0) AS BIGINT)) AS DOUBLE) / CAST(COUNT({c}) AS DOUBLE) / 100.0"
        return f"AVG({c})"
    return f"""{p}tot AS (SELECT COUNT(*) AS n FROM {labelled}),
{p}agg AS (SELECT cluster, COUNT(*) AS size, {mean(r.age_feature)} AS avg_age, {mean(r.income_feature)} AS avg_income,
               {mean(r.spending_feature)} AS avg_spending
        FROM {labelled} WHERE cluster <> -1 GROUP BY cluster),
{p}modes AS (SELECT cluster, {CAT} AS mode_value FROM (
            SELECT cluster, {CAT}, row_number() OVER (PARTITION BY cluster ORDER BY COUNT(*) DESC, {CAT}) AS rn
            FROM {labelled} WHERE cluster <> -1 AND {CAT} IS NOT NULL GROUP BY cluster, {CAT}) m WHERE rn = 1),
{p}prof AS (SELECT a.cluster, a.size, a.size * 100.0 / t.n AS share, a.avg_age, a.avg_income, a.avg_spending,
                COALESCE(m.mode_value, '{empty_mode}') AS dominant_category,
                {R.band_sql('a.avg_age', X.BANDS.age, ('Young', 'Middle-aged', 'Senior'))} AS age_band,
                {R.band_sql('a.avg_income', X.BANDS.income, ('Low', 'Medium', 'High'))} AS income_band,
                {R.band_sql('a.avg_spending', X.BANDS.spending, ('Low', 'Medium', 'High'))} AS spending_band
         FROM {p}agg a CROSS JOIN {p}tot t LEFT JOIN {p}modes m ON a.cluster = m.cluster)"""


BAND_SQL_COLS = {"income": "income_band", "spending": "spending_band", "share": "share"}


def fixed(col, digits: int):
    """Round half up as floor(x * 10^d + 0.5) / 10^d — the same IEEE steps in Spark and in SQL,
    so exact ties (means of few 2-decimal values) round alike on both sides."""
    c = F.col(col) if isinstance(col, str) else col
    return (F.floor(c * F.lit(10.0 ** digits) + F.lit(0.5)) / F.lit(10.0 ** digits)).cast("double")


def fixed_sql(expr: str, digits: int) -> str:
    return f"CAST(floor(({expr}) * {10.0 ** digits!r} + 0.5) / {10.0 ** digits!r} AS DOUBLE)"


def _round_profile(df: DataFrame) -> list:
    return [F.col("cluster").cast("int").alias("cluster"), F.col("size").cast("long").alias("size"),
            fixed("share", 6).alias("share"), fixed("avg_age", 4).alias("avg_age"),
            fixed("avg_income", 2).alias("avg_income"), fixed("avg_spending", 6).alias("avg_spending")]


ROUND_PROFILE_SQL = ("CAST(cluster AS INTEGER) AS cluster, CAST(size AS BIGINT) AS size, "
                     f"{fixed_sql('share', 6)} AS share, {fixed_sql('avg_age', 4)} AS avg_age, "
                     f"{fixed_sql('avg_income', 2)} AS avg_income, {fixed_sql('avg_spending', 6)} AS avg_spending")


# --- flagship: PR1 over ML1b -----------------------------------------------------------------

def profile_kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer ⟕ orders -> clean -> scale -> Lloyd (5 given centers, 3 updates) -> batch profiles."""
    labelled = X.lloyd_labelled(spark, sf_dir)
    prof = P.cluster_profiles(labelled, X.ROLES, X.BANDS)
    top3 = F.concat_ws(", ", F.slice(F.transform("products", lambda p: p["product"]), 1, 3))
    return prof.select(*_round_profile(prof), "dominant_category", "age_band", "income_band", "spending_band",
                       "strategy", top3.alias("top_products"))


register("profile_kmeans", f"""
WITH {sql_lloyd_cte()},
{sql_profile_agg('labelled', 'Mixed')},
cat AS (SELECT * FROM {R.catalogue_rows_sql(C.PRODUCT_RULES_BATCH, R.BATCH_FIELDS)}),
ruled AS (SELECT p.*, {R.strategy_sql(BAND_SQL_COLS)} AS strategy,
                 {R.rule_index_sql(C.PRODUCT_RULES_BATCH, BAND_SQL_COLS)} AS prod_rule
          FROM prof p)
SELECT {ROUND_PROFILE_SQL}, dominant_category, age_band, income_band, spending_band, strategy,
       (SELECT string_agg(c.product, ', ' ORDER BY c.rnk) FROM cat c WHERE c.rule = ruled.prod_rule AND c.rnk < 3) AS top_products
FROM ruled
""")(profile_kmeans)


# The rest of the catalogue registers itself on import.
from cohortlens.plans import q_tables  # noqa: E402,F401
from cohortlens.plans import q_rules  # noqa: E402,F401
from cohortlens.plans import q_metrics  # noqa: E402,F401
from cohortlens.plans import q_density  # noqa: E402,F401
from cohortlens.plans import q_models  # noqa: E402,F401
from cohortlens.plans import q_io  # noqa: E402,F401
from cohortlens.plans import q_checks  # noqa: E402,F401
