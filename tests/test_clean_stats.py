"""Cleaning and statistics semantics (nulls, Inf, IQR, scaling, histogram, mode, numbering)."""

import math

import numpy as np
from pyspark.sql import functions as F

from cohortlens.operators import clean as CL
from cohortlens.operators import stats as ST
from cohortlens.operators.scale import scale_features

INF = float("inf")


def test_nulls_and_nan_dropped_only_for_features(spark):
    df = spark.createDataFrame([(1, 1.0, None), (2, None, "a"), (3, float("nan"), "b"), (4, 2.0, "c")], "id long, f double, c string")
    rep = {r["feature"]: r["null_count"] for r in CL.null_report(df, ["f"]).collect()}
    assert rep == {"f": 2}
    assert sorted(r["id"] for r in CL.drop_missing(df, ["f"]).collect()) == [1, 4]


def test_inf_rule_both_branches(spark):
    with_feature_inf = spark.createDataFrame([(1, INF, 5.0), (2, 1.0, INF), (3, 2.0, 1.0)], "id long, f double, other double")
    out = {r["id"]: r["other"] for r in CL.drop_inf(with_feature_inf, ["f"]).collect()}
    assert out == {2: None, 3: 1.0}  # other's Inf nulled because a feature held Inf
    only_other = spark.createDataFrame([(1, 1.0, INF), (2, 2.0, 1.0)], "id long, f double, other double")
    out2 = {r["id"]: r["other"] for r in CL.drop_inf(only_other, ["f"]).collect()}
    assert out2 == {1: INF, 2: 1.0}  # untouched: no feature holds Inf


def test_outlier_fence_strict(spark):
    vals = [float(v) for v in range(1, 20)] + [200.0]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    r = CL.outlier_report(df, ["x"], 3.0).first()
    q1, q3 = np.percentile(vals, 25), np.percentile(vals, 75)
    assert math.isclose(r["q1"], q1) and math.isclose(r["q3"], q3)
    expected = sum(1 for v in vals if v < q1 - 3 * (q3 - q1) or v > q3 + 3 * (q3 - q1))
    assert r["n_outliers"] == expected == 1


def test_scaling_population_and_constant(spark):
    df = spark.createDataFrame([(1, 1.0, 7.0), (2, 2.0, 7.0), (3, 4.0, 7.0)], "id long, a double, b double")
    out, cols = scale_features(df, ["a", "b"], keep=["id"])
    rows = out.orderBy("id").collect()
    a = np.array([1.0, 2.0, 4.0])
    want = (a - a.mean()) / a.std()
    assert np.allclose([r["z_a"] for r in rows], want)
    assert all(r["z_b"] == 0.0 for r in rows)


def test_histogram_keeps_empty_bins(spark):
    df = spark.createDataFrame([(0.0,), (10.0,), (10.0,)], "x double")
    h = ST.histogram(df, "x", 5).orderBy("bin").collect()
    assert [r["count"] for r in h] == [1, 0, 0, 0, 2]  # max lands in the last (closed) bin


def test_mode_ties_smallest_nulls_ignored(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, None), (1, None), (2, None)], "g int, c string")
    got = {r["g"]: r["mode_value"] for r in ST.mode_by(df, "c", "g").collect()}
    assert got == {1: "a", 2: "Mixed"}


def test_dense_index_is_a_permutation(spark):
    df = spark.range(0, 1000).withColumn("k", F.pmod(F.col("id") * 7919, F.lit(1000)))
    out = CL.dense_index(df, [F.col("k")], name="ix", start=1).collect()
    ix = sorted(r["ix"] for r in out)
    assert ix == list(range(1, 1001))
    assert all(r["ix"] == r["k"] + 1 for r in out)  # k is a permutation of 0..999, so order = k


def test_correlation_matrix(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=200)
    y = 2 * x + rng.normal(size=200)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "x double, y double")
    got = {(r["feature_x"], r["feature_y"]): r["corr"] for r in ST.correlations(df, ["x", "y"]).collect()}
    assert math.isclose(got[("x", "y")], np.corrcoef(x, y)[0, 1], rel_tol=1e-9)
    assert got[("x", "x")] == 1.0


def test_exact_quantiles_equal_percentile_with_heavy_ties_and_groups(spark):
    from cohortlens.operators.quantile import exact_quantiles

    rng = np.random.default_rng(7)
    rows = []
    for i in range(3000):
        g = "hot" if i % 3 == 0 else ("a" if i % 3 == 1 else "b")
        v = 5.0 if (g == "hot" and i % 2 == 0) else float(np.round(rng.normal(0, 10), 3))  # one value holds 1/6 of rows
        rows.append((g, None if i % 97 == 0 else v, float(i % 11)))
    rows.append(("empty", None, None))
    rows += [(None, float(v), 1.0) for v in (3.0, 1.0, 2.0, 8.0)]  # a null group is a group
    df = spark.createDataFrame(rows, "g string, x double, y double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 0.999, 1.0]
    want = {r["g"]: (r["qx"], r["qy"]) for r in df.groupBy("g").agg(
        F.percentile("x", probs).alias("qx"), F.percentile("y", probs).alias("qy")).collect()}
    out = exact_quantiles(df, ["x", "y"], probs, by="g")
    assert "Window" not in out._jdf.queryExecution().toString()
    got = {(r["g"], r["feature"]): r["q"] for r in out.collect()}
    for g, (qx, qy) in want.items():
        if qx is None:
            assert got[(g, "x")] == [None] * len(probs)
            continue
        assert got[(g, "x")] == list(qx) and got[(g, "y")] == list(qy)
    whole = {r["feature"]: r["q"] for r in exact_quantiles(df, ["x"], probs).collect()}
    assert whole["x"] == list(df.agg(F.percentile("x", probs)).first()[0])
    assert ST.quantiles(df, "x", [0.5], by="g").where("g = 'empty'").first()["p50"] is None


def test_images_have_the_order_and_bits_of_doubles(spark):
    import struct

    from cohortlens.operators.quantile import image, value

    rng = np.random.default_rng(1)
    xs = [0.0, 5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.7976931348623157e308, math.inf, 1.0, *rng.lognormal(0, 200, 200)]
    xs += [y for e in range(-1074, 1024, 7) for y in (2.0 ** e, float(np.nextafter(2.0 ** e, 0)), float(np.nextafter(2.0 ** e, math.inf)))]
    xs = [float(s * x) for x in xs for s in (1, -1)]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    for r in df.select("x", image(F.col("x")).alias("v"), value(image(F.col("x"))).alias("y")).collect():
        bits = struct.unpack("<q", struct.pack("<d", abs(r["x"])))[0]
        assert r["v"] == (-bits if r["x"] < 0 else bits) and r["y"] == r["x"]
