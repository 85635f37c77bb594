"""Clustering operators: density clustering vs a sequential scan, components, Ward vs a naive
Lance-Williams Ward, Lloyd monotonicity, recovery of five separated groups, mixtures."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlens.operators import dbscan as DB
from cohortlens.operators import gmm as G
from cohortlens.operators import kmeans as KM
from cohortlens.operators import metrics as M
from cohortlens.operators import ward as W
from cohortlens.operators.components import connected_components


def _naive_dbscan(x, eps, min_samples):
    """Sequential scan in row order (what the original job's library does)."""
    n = len(x)
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    nb = [np.nonzero(d[i] <= eps)[0] for i in range(n)]
    core = np.array([len(v) >= min_samples for v in nb])
    lab = -np.ones(n, dtype=int)
    c = 0
    for i in range(n):
        if lab[i] != -1 or not core[i]:
            continue
        stack = [i]
        while stack:
            j = stack.pop()
            if lab[j] != -1:
                continue
            lab[j] = c
            if core[j]:
                stack.extend(v for v in nb[j] if lab[v] == -1)
        c += 1
    return lab


@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.default_rng(3)
    x = np.vstack([rng.normal([0, 0, 0], 0.3, (120, 3)), rng.normal([2, 2, 0], 0.3, (100, 3)),
                   rng.uniform(-2, 4, (60, 3)), np.repeat([[5.0, 5.0, 5.0]], 20, axis=0)])  # 20 exact copies
    rows = [(i, *map(float, p)) for i, p in enumerate(x)]
    return x, spark.createDataFrame(rows, "id long, a double, b double, c double")


@pytest.mark.parametrize("eps,ms", [(0.35, 6), (0.5, 10)])
def test_dbscan_equals_sequential_scan(blobs, eps, ms):
    x, df = blobs
    got = {r["id"]: r["cluster"] for r in DB.dbscan(df, "id", ["a", "b", "c"], eps, ms).collect()}
    want = _naive_dbscan(x, eps, ms)
    assert [got[i] for i in range(len(x))] == want.tolist()


def test_dbscan_partition_and_chunk_independent(blobs):
    x, df = blobs
    a = DB.dbscan(df, "id", ["a", "b", "c"], 0.35, 6).orderBy("id").collect()
    b = DB.dbscan(df.repartition(3), "id", ["a", "b", "c"], 0.35, 6, chunk_rows=7).orderBy("id").collect()
    assert a == b  # chunking a dense cell (the 20 copies) changes nothing


def test_dbscan_rejects_eps_zero(blobs):
    _, df = blobs
    with pytest.raises(DB.DensityParameterError):
        DB.dbscan(df, "id", ["a", "b", "c"], 0.0, 5)


def test_k_distance_matches_brute_force(blobs):
    x, df = blobs
    k = 4
    got = {r["id"]: r["kdist"] for r in DB.k_distance(df, "id", ["a", "b", "c"], k, block_rows=64).collect()}
    d = np.sort(np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1)), axis=1)[:, k - 1]  # self counted first
    assert np.allclose([got[i] for i in range(len(x))], d)


def test_components_chain_and_isolated(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(0, 40)] + [(100, 101)], "a long, b long")
    nodes = spark.createDataFrame([(i,) for i in list(range(41)) + [100, 101, 200]], "node long")
    comp = {r["node"]: r["component"] for r in connected_components(nodes, edges).collect()}
    assert all(comp[i] == 0 for i in range(41)) and comp[101] == 100 and comp[200] == 200


def _naive_ward_heights(x):
    clusters = {i: [i] for i in range(len(x))}
    size = {i: 1 for i in range(len(x))}
    d = {(i, j): float(np.linalg.norm(x[i] - x[j])) for i in range(len(x)) for j in range(i + 1, len(x))}
    nxt, heights = len(x), []
    while len(clusters) > 1:
        (i, j), h = min(d.items(), key=lambda kv: (kv[1], kv[0]))
        heights.append(h)
        t = size[i] + size[j]
        new = {}
        for k in clusters:
            if k in (i, j):
                continue
            dik = d[(min(i, k), max(i, k))]
            djk = d[(min(j, k), max(j, k))]
            T = t + size[k]
            new[k] = math.sqrt(((size[i] + size[k]) * dik ** 2 + (size[j] + size[k]) * djk ** 2 - size[k] * h ** 2) / T)
        clusters[nxt] = clusters.pop(i) + clusters.pop(j)
        size[nxt] = t
        d = {kk: v for kk, v in d.items() if i not in kk and j not in kk}
        for k, v in new.items():
            d[(min(k, nxt), max(k, nxt))] = v
        nxt += 1
    return heights


def test_ward_exact_equals_naive(spark):
    rng = np.random.default_rng(11)
    x = np.vstack([rng.normal(0, 0.3, (20, 2)), rng.normal(5, 0.3, (20, 2)), rng.normal([0, 6], 0.3, (20, 2))])
    merges = W.ward_merges(x, np.ones(len(x)))
    assert np.allclose(sorted(m[2] for m in merges), sorted(_naive_ward_heights(x)))
    df = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(x)], "id long, a double, b double")
    labels, _, mode = W.ward(df, "id", ["a", "b"], 3, exact=True)
    assert mode == "exact"
    truth = spark.createDataFrame([(i, str(i // 20)) for i in range(60)], "id long, truth string")
    assert M.adjusted_rand(labels, truth, "id").first()["ari"] == 1.0


def test_ward_cuts_nested():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(30, 2))
    merges = W.ward_merges(x, np.ones(30))
    for k in range(2, 8):
        fine, coarse = W.cut(merges, 30, k + 1), W.cut(merges, 30, k)
        for g in set(fine):
            assert len(set(coarse[fine == g])) == 1


def test_lloyd_wcss_non_increasing(five_groups):
    from cohortlens.operators.scale import scale_features
    df, z = scale_features(five_groups, ["age", "income", "spending"], keep=["id"])
    df = df.persist()
    centers = KM.first_rows_as_centers(df, "id", z, 5)
    last = float("inf")
    for _ in range(4):
        w = M.wcss(KM.assign(df, z, centers), z).first()["wcss"]
        assert w <= last + 1e-9
        last = w
        centers, _ = KM.lloyd(df, z, centers, 1)


def test_kmeans_and_gmm_recover_five_groups(five_groups):
    from cohortlens.operators.scale import scale_features
    df, z = scale_features(five_groups, ["age", "income", "spending"], keep=["id"])
    df = df.persist()
    truth = five_groups.select("id", "truth")
    fit = KM.fit_kmeans(df, z, 5, restarts=3)
    lab = KM.assign(df, z, fit["centers"]).select("id", "cluster")
    assert M.adjusted_rand(lab, truth, "id").first()["ari"] >= 0.95
    g = G.fit_gmm(df, z, 5, restarts=2)
    e = G.e_step(df, z, g["weights"], g["means"], g["covs"]).select("id", "cluster")
    assert M.adjusted_rand(e, truth, "id").first()["ari"] >= 0.95


def test_sweep_picks_five(five_groups):
    from cohortlens.operators.scale import scale_features
    df, z = scale_features(five_groups, ["age", "income", "spending"], keep=["id"])
    df = df.persist()
    sw = KM.sweep(df, "id", z, [3, 4, 5, 6], fit="library", restarts=3)
    assert KM.best_k(sw).first()["selected_k"] == 5


def test_estep_matches_numpy(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(50, 2))
    w = [0.3, 0.7]
    mu = [[0.0, 0.0], [1.0, -1.0]]
    cov = [[[1.0, 0.3], [0.3, 2.0]], [[0.5, 0.0], [0.0, 0.5]]]
    df = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(x)], "id long, a double, b double")
    got = {r["id"]: (r["log_likelihood"], r["cluster"]) for r in G.e_step(df, ["a", "b"], w, mu, cov).collect()}

    def logpdf(p, m, c):
        c = np.array(c)
        diff = p - np.array(m)
        return -0.5 * (2 * math.log(2 * math.pi) + math.log(np.linalg.det(c)) + diff @ np.linalg.inv(c) @ diff)
    for i, p in enumerate(x):
        l = np.array([math.log(w[k]) + logpdf(p, mu[k], cov[k]) for k in range(2)])
        lse = l.max() + math.log(np.exp(l - l.max()).sum())
        assert math.isclose(got[i][0], lse, rel_tol=1e-9) and got[i][1] == int(np.argmax(l))


def test_k_distance_grid_matches_brute_force(spark, blobs):
    x0, _ = blobs
    # one far outlier (many width doublings) and a point holding a third of all rows
    x = np.vstack([x0, [[40.0, -30.0, 12.0]], np.repeat([[0.1, 0.1, 0.1]], len(x0) // 2, axis=0)])
    df = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(x)], "id long, a double, b double, c double")
    full = np.sort(np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1)), axis=1)
    for k in (1, 4, 10):
        got = {r["id"]: r["kdist"] for r in DB.k_distance_grid(df, "id", ["a", "b", "c"], k, chunk_rows=50).collect()}
        assert len(got) == len(x)
        assert np.allclose([got[i] for i in range(len(x))], full[:, k - 1])  # self counted first


def test_lloyd_many_equals_lloyd_per_k(five_groups):
    cols = ["age", "income", "spending"]
    df = five_groups.select("id", *[(F.col(c) / 1000.0).alias(c) for c in cols])
    seeds = KM.first_rows_as_centers(df, "id", cols, 6)
    many = KM.lloyd_many(df, cols, {k: seeds[:k] for k in (2, 4, 6)}, 4)
    for k in (2, 4, 6):
        one, _ = KM.lloyd(df, cols, seeds[:k], 4)
        assert np.allclose(np.array(many[k]), np.array(one), rtol=1e-12, atol=1e-12)


def test_assign_many_centers_batch_form_equals_expression(five_groups, monkeypatch):
    cols = ["age", "income", "spending"]
    df = five_groups.select("id", *[(F.col(c) / F.lit(1000.0)).alias(c) for c in cols])
    rng = np.random.default_rng(2)
    centers = [list(map(float, r)) for r in rng.normal([0.04, 700, 0.05], [0.01, 300, 0.02], (40, 3))]
    centers[7] = list(centers[3])  # a tie: the lower id wins in both forms
    batch = {r["id"]: (r["cluster"], r["d2"]) for r in KM.assign(df, cols, centers, dist="d2").collect()}
    monkeypatch.setattr(KM, "EXPR_CENTERS", 10_000)
    expr = {r["id"]: (r["cluster"], r["d2"]) for r in KM.assign(df, cols, centers, dist="d2").collect()}
    assert batch.keys() == expr.keys()
    assert all(batch[i][0] == expr[i][0] and math.isclose(batch[i][1], expr[i][1], rel_tol=1e-12) for i in batch)
    assert 7 not in {v[0] for v in batch.values()}


def _cloud(spark, x):
    return spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(x)], "id long, x0 double, x1 double")


def test_adaptive_cells_visits_grow_linearly(spark):
    """One far row and one dense spot: the pairs (row, foreign cell) stay in proportion to the rows, and so do the cells."""
    from cohortlens.operators import kdtree as KD

    rng = np.random.default_rng(8)
    per_row = []
    for n in (1000, 4000):
        x = np.vstack([rng.uniform(0, 1, size=(n, 2)), rng.normal(0.5, 1e-6, size=(n, 2)), np.full((n, 2), 0.25), [[1e7, -1e7]]])
        found, visits = KD.k_distances(_cloud(spark, x), 2, 5, leaf_rows=64)
        got = {r["id"]: r["kdist"] for r in found.collect()}
        step = max(1, len(x) // 300)
        for i in [*range(0, len(x), step), len(x) - 1]:
            assert got[i] == pytest.approx(np.sort(np.sqrt(((x - x[i]) ** 2).sum(1)))[4], rel=1e-9, abs=1e-15)
        per_row.append(visits.count() / len(x))
    assert per_row[1] < 1.5 * per_row[0] and per_row[1] < 3


def test_star_of_100000_leaves_is_dealt_to_many_tasks(spark):
    from cohortlens.operators import components as CC

    n = 100_000
    ids = spark.range(n).select((F.col("id") * 7919 % 1_000_003).alias("a")).where("a <> 500000")
    edges = ids.select("a", F.lit(500_000).cast("long").alias("b"))
    both = CC._undirected(edges)
    total = both.count()
    spark.conf.set("spark.sql.shuffle.partitions", "400")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        dealt = CC.with_minimum(both, total).groupBy(F.spark_partition_id()).count()
        assert dealt.agg(F.max("count")).first()[0] <= total / 50
    finally:
        for key, v in (("spark.sql.shuffle.partitions", "8"), ("spark.sql.adaptive.enabled", "true"), ("spark.sql.autoBroadcastJoinThreshold", str(10 << 20))):
            spark.conf.set(key, v)
    comp = CC.connected_components(ids.select(F.col("a").alias("node")).unionByName(spark.range(1).select(F.lit(500_000).cast("long").alias("node"))), edges)
    assert [tuple(r) for r in comp.groupBy("component").count().collect()] == [(0, comp.count())]


def test_boxes_settle_two_dense_cells(spark):
    """Chunk pairs whose rows are compared do not grow with the square of the chunks; the labels are those of a scan."""
    rng = np.random.default_rng(9)
    for n in (500, 2000):
        x = np.vstack([rng.uniform([0, 0], [0.6, 0.6], size=(n, 2)), rng.uniform([0.75, 0], [1.3, 0.6], size=(n, 2)), np.full((n, 2), 0.3), [[9.0, 9.0]]])
        df = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(x)], "id long, x double, y double")
        pts, cells = DB._cells(df, "id", ["x", "y"], 1.0, 50)
        boxes = DB.chunk_boxes(pts, 2)
        assert boxes.count() > n / 25 and pts.groupBy("cell", "chunk").count().agg(F.max("count")).first()[0] < 120
        pairs = DB._cell_pairs(cells, 2, 1.0)
        dense = pairs.where("n_a >= 5 and n_b >= 5")
        proven = DB.certified_links(dense, boxes, 2, 1.0)
        assert dense.count() > 0
        open_pairs = pairs.join(proven, ["cell_a", "cell_b"], "left_anti")
        assert DB._chunk_pairs(open_pairs, boxes, 2, 1.0).count() <= 2 * boxes.count()
    got = {r["id"]: r["cluster"] for r in DB.dbscan(df, "id", ["x", "y"], 1.0, 5, chunk_rows=50).collect()}
    assert [got[i] for i in range(len(x))] == list(_naive_dbscan(x, 1.0, 5))


@pytest.mark.parametrize("d,chunk_rows", [(12, 1024), (64, 40), (6, 25)])
def test_density_clusters_in_many_dimensions(spark, monkeypatch, d, chunk_rows):
    from cohortlens.operators import dbscan_metric as DM

    monkeypatch.setattr(DM, "ROWS_PER_PIVOT", 60)
    rng = np.random.default_rng(d)
    centers = rng.normal(size=(6, d)) * 2
    x = np.vstack([*[c + 0.25 * rng.normal(size=(80, d)) for c in centers], rng.normal(size=(60, d)) * 3, np.repeat(centers[:1], 150, axis=0)])
    x = x[rng.permutation(len(x))]
    df = spark.createDataFrame([(i, [float(v) for v in p]) for i, p in enumerate(x)], "id long, v array<double>").repartition(5)
    eps = 0.25 * float(np.sqrt(2 * d)) * 0.9
    out = {r["id"]: r["cluster"] for r in DB.dbscan_vectors(df, "id", "v", eps, 6, chunk_rows).collect()}
    expected = _naive_dbscan(x, eps, 6)
    assert len(set(expected)) > 3
    assert [out[i] for i in range(len(x))] == list(expected)
    if d == 6:  # as columns, through the same entry as the grid
        cols = [f"c{i}" for i in range(d)]
        wide = df.select("id", *[F.col("v")[i].alias(c) for i, c in enumerate(cols)])
        assert {r["id"]: r["cluster"] for r in DB.dbscan(wide, "id", cols, eps, 6).collect()} == out
        _, visits = DM.dbscan_metric(df.select("id", F.col("v").alias("x")), eps, 6)
        assert visits.select("id", "cell").distinct().count() < 0.6 * len(x) * 11


def test_ward_rounds_equal_naive(spark):
    from cohortlens.operators import ward_rounds as WR

    rng = np.random.default_rng(12)
    x = np.vstack([*[c + 0.3 * rng.normal(size=(60, 2)) for c in ([0, 0], [3, 1], [-2, 4])], rng.uniform(-20, 20, size=(20, 2))])
    merges = W.ward_merges(x, np.ones(len(x)))
    df = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(x)], "id long, a double, b double").repartition(3)
    labels, table = WR.ward_labels(df, "id", ["a", "b"], 5, local_rows=10, leaf_rows=16)
    got = sorted((r["height"], r["size"]) for r in table.collect())
    assert len(got) == len(x) - 1 and np.allclose(got, sorted((m[2], m[3]) for m in merges))
    same = {}
    for r in labels.collect():
        same.setdefault(r["cluster"], set()).add(r["id"])
    groups = W.cut(merges, len(x), 5)
    assert {frozenset(v) for v in same.values()} == {frozenset(np.flatnonzero(groups == g).tolist()) for g in set(groups)}


def test_ward_rounds_with_equal_rows(spark):
    """Rows that are equal, or nearest to rows of other cells, merge as the sequential algorithm merges them; ids of any type."""
    rng = np.random.default_rng(5)
    x = np.vstack([rng.uniform(0, 4, size=(120, 2)), rng.uniform(9, 12, size=(60, 2)), [[1.0, 1.0]] * 30, [[-0.0, 20.0], [0.0, 20.0]]])
    merges = W.ward_merges(x, np.ones(len(x)))
    rows = [(f"r{i:04d}", *map(float, p)) for i, p in enumerate(x)]
    labels, table, mode = W.ward(spark.createDataFrame(rows, "id string, a double, b double").repartition(4), "id", ["a", "b"], 4, exact="rounds")
    got = sorted((r["height"], r["size"]) for r in table.collect())
    assert mode == "exact rounds" and len(got) == len(x) - 1 and np.allclose(got, sorted((m[2], m[3]) for m in merges))
    same, groups = {}, W.cut(merges, len(x), 4)
    for r in labels.collect():
        same.setdefault(r["cluster"], set()).add(int(r["id"][1:]))
    assert {frozenset(v) for v in same.values()} == {frozenset(np.flatnonzero(groups == g).tolist()) for g in set(groups)}


def test_ward_cells_merge_what_no_outside_cluster_can_join():
    """A cell leaves the pairs open that a visitor, or a cluster in another cell's box, could come into."""
    from cohortlens.operators import ward_rounds as WR

    x, n, none = np.array([[0.0], [1.0], [10.0], [10.5]]), np.ones(4), np.zeros((0, 1))
    merged = lambda lo, hi, least, y, m, reach: [m[:2] for m in WR._merged_within(np.arange(4), x, n, lo, hi, least, y, m, reach)[0]]
    assert merged(none, none, np.zeros(0), none, np.zeros(0), 1.0) == [(0, 1), (2, 3), (0, 2)]
    assert merged(none, none, np.zeros(0), np.array([[11.2]]), np.ones(1), 1.0) == [(0, 1), (2, 3)]  # the visitor is nearer than 0 and 1
    box = np.array([[10.9]]), np.array([[99.0]]), np.ones(1)
    assert merged(*box, none, np.zeros(0), 0.1) == [(0, 1)]  # 10.5 may have its nearest at 10.9
    assert merged(*box, none, np.zeros(0), 5.0) == [(0, 1), (2, 3)]  # whoever is within 5 would be a visitor


def test_cells_that_are_joined_are_not_compared(spark):
    """Cells joined through their central rows need no comparison of rows; the labels are those of a scan."""
    rng = np.random.default_rng(3)
    x = np.vstack([rng.uniform(0, 2, size=(900, 2)), rng.uniform(5, 6, size=(300, 2)), [[2.4, 1.0], [9.0, 9.0]]])
    df = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(x)], "id long, x double, y double")
    pts, cells = DB._cells(df, "id", ["x", "y"], 0.5, 64)
    pairs = DB._cell_pairs(cells, 2, 0.5).where("n_a >= 4 and n_b >= 4").persist()
    links = DB.central_links(pairs, pts.withColumn("core", F.lit(True)), 2, 0.5).collect()
    names = {tuple(r["cell"]): i for i, r in enumerate(cells.orderBy("cell").collect())}
    root = {i: i for i in names.values()}
    for r in links:
        a, b = root[names[tuple(r["cell_a"])]], root[names[tuple(r["cell_b"])]]
        root = {i: min(a, b) if v in (a, b) else v for i, v in root.items()}
    parts = spark.createDataFrame([(list(c), root[i]) for c, i in names.items()], "cell array<bigint>, part long")
    assert pairs.count() > 100 and DB.open_cell_pairs(pairs, parts, 4).count() < 0.1 * pairs.count()
    got = {r["id"]: r["cluster"] for r in DB.dbscan(df, "id", ["x", "y"], 0.5, 4, chunk_rows=64).collect()}
    assert [got[i] for i in range(len(x))] == list(_naive_dbscan(x, 0.5, 4))


def test_dense_vectors_visit_a_few_cells(spark, monkeypatch):
    """In one dense place most rows meet NEAR_CELLS cells only; the labels are those of a scan."""
    from cohortlens.operators import dbscan_metric as DM

    monkeypatch.setattr(DM, "ROWS_PER_PIVOT", 40)
    rng = np.random.default_rng(5)
    x = np.vstack([rng.normal(size=(800, 8)), 3 + 0.3 * rng.normal(size=(30, 8)) + 20, np.full((1, 8), 9.0)])
    df = spark.createDataFrame([(i, [float(v) for v in p]) for i, p in enumerate(x)], "id long, x array<double>").repartition(4)
    _, visits = DM.dbscan_metric(df, 2.6, 4, 64)
    assert visits.select("id", "cell").distinct().count() < 0.6 * len(x) * 20
    out = {r["id"]: r["cluster"] for r in DB.dbscan_vectors(df, "id", "x", 2.6, 4, 64).collect()}
    assert [out[i] for i in range(len(x))] == list(_naive_dbscan(x, 2.6, 4))


def test_fits_scan_a_few_parts_a_core(spark):
    cores = spark.sparkContext.defaultParallelism
    wide = spark.range(40_000).selectExpr("id", "CAST(id AS DOUBLE) AS x").repartition(150)
    for df in (wide, wide.coalesce(1)):
        got = KM.dealt(df, "id")
        assert min(2, 2 * cores) <= got.rdd.getNumPartitions() <= 2 * cores and got.count() == 40_000
    assert KM.dealt(wide.limit(0), None).count() == 0
