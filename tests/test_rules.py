"""Band and rule tables: edge values, the full rule grid, golden profile values."""

import itertools

from pyspark.sql import functions as F

from cohortlens import config as C
from cohortlens.functions import rules as R


def test_band_edges(spark):
    df = spark.createDataFrame([(29.99,), (30.0,), (50.0,), (49.99,)], "x double")
    got = [r[0] for r in df.select(R.band(F.col("x"), (30.0, 50.0), C.AGE_NAMES)).collect()]
    assert got == ["Young", "Middle-aged", "Senior", "Middle-aged"]


def test_rule_grid_first_match(spark):
    grid = list(itertools.product(C.INCOME_NAMES, C.SPENDING_NAMES, [20.0, 20.01]))
    df = spark.createDataFrame(grid, "income string, spending string, share double")
    cols = {"income": F.col("income"), "spending": F.col("spending"), "share": F.col("share")}
    rec, prio = R.recommendation_and_priority(cols)
    out = df.select("income", "spending", "share", R.strategy(cols).alias("s"), prio.alias("p"),
                    F.size(R.products_interactive(cols)).alias("n_inter"),
                    R.products_batch(cols)[0]["product"].alias("first_batch")).collect()
    for r in out:
        inc, sp, share = r["income"], r["spending"], r["share"]
        if sp == "High" and inc == "High":
            want = C.STRATEGY_RULES[0][1]
        elif sp == "High":
            want = C.STRATEGY_RULES[1][1]
        elif sp == "Low" and inc == "High":
            want = C.STRATEGY_RULES[2][1]
        elif sp == "Medium" and share > 20:
            want = C.STRATEGY_RULES[3][1]
        else:
            want = C.STRATEGY_RULES[4][1]
        assert r["s"] == want
        if sp == "High" and inc == "High":
            assert r["p"].endswith("High")
        elif (sp == "High" and inc in ("Medium", "Low")) or (sp == "Low" and inc == "High"):
            assert r["p"].endswith("Medium")
        else:
            assert r["p"].endswith("Low")
        # interactive: high income with low/medium spending gets a single product
        assert r["n_inter"] == (1 if inc == "High" and sp in ("Low", "Medium") else 2)
        # batch: low income + high spending falls to the default rule
        if inc == "Low" and sp == "High":
            assert r["first_batch"] == "Headphones"


def test_golden_profile_rule(spark):
    """A cluster with mean age 41.4, income 513,036, spending 46.9 and 21.6 % share is
    Middle-aged / Medium / Medium and gets the mass-market strategy."""
    df = spark.createDataFrame([(41.4, 513036.0, 46.9, 21.6)], "a double, i double, s double, share double")
    b = R.band_columns(F.col("a"), F.col("i"), F.col("s"), C.Bands())
    cols = {"income": b["income"], "spending": b["spending"], "share": F.col("share")}
    r = df.select(b["age"].alias("age"), b["income"].alias("inc"), b["spending"].alias("sp"), R.strategy(cols).alias("st")).first()
    assert (r["age"], r["inc"], r["sp"]) == ("Middle-aged", "Medium", "Medium")
    assert r["st"].startswith("Mass market")


def test_demographic_default(spark):
    df = spark.createDataFrame([("Young",), ("Unknown",)], "b string")
    got = [r[0] for r in df.select(R.demographic(F.col("b"))["demographic"]).collect()]
    assert got[0].startswith("Young") and got[1].startswith("Middle-aged")


def test_formatting(spark):
    df = spark.createDataFrame([(1234567.4, -1), (5.0, 3)], "x double, c int")
    r = df.select(R.grouped_thousands(F.col("x")).alias("g"), R.cluster_name(F.col("c")).alias("n")).collect()
    assert r[0]["g"] == "1,234,567" and r[0]["n"] == "Noise" and r[1]["n"] == "Cluster 3"
