"""Scores against brute-force NumPy on small frames; ARI properties; sentinels."""

import math
import time

import numpy as np
import pandas as pd
import pytest

from cohortlens.operators import metrics as M


def _brute_silhouette(x, lab):
    n = len(x)
    d = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(-1))
    s = np.zeros(n)
    for i in range(n):
        own = lab == lab[i]
        if own.sum() <= 1:
            continue
        a = d[i, own].sum() / (own.sum() - 1)
        b = min(d[i, lab == c].mean() for c in set(lab) if c != lab[i])
        s[i] = (b - a) / max(a, b) if max(a, b) > 0 else 0.0
    return s.mean()


def _brute_db_ch(x, lab):
    ks = sorted(set(lab))
    cent = np.array([x[lab == k].mean(0) for k in ks])
    s = np.array([np.sqrt(((x[lab == k] - cent[i]) ** 2).sum(1)).mean() for i, k in enumerate(ks)])
    cd = np.sqrt(((cent[:, None] - cent[None]) ** 2).sum(-1))
    r = np.where(cd > 0, (s[:, None] + s[None]) / np.where(cd > 0, cd, 1), 0)
    np.fill_diagonal(r, 0)
    db = r.max(1).mean()
    g = x.mean(0)
    n = len(x)
    wcss = sum(((x[lab == k] - cent[i]) ** 2).sum() for i, k in enumerate(ks))
    between = sum((lab == k).sum() * ((cent[i] - g) ** 2).sum() for i, k in enumerate(ks))
    ch = between * (n - len(ks)) / (wcss * (len(ks) - 1))
    return db, ch, wcss


@pytest.fixture(scope="module")
def small(spark):
    rng = np.random.default_rng(7)
    x = np.vstack([rng.normal(0, 1, (40, 3)), rng.normal(4, 1, (35, 3)), rng.normal([0, 5, 0], 1, (25, 3)), [[9, 9, 9]]])
    lab = np.array([0] * 40 + [1] * 35 + [-1] * 25 + [2])  # includes a noise group and a singleton
    rows = [(i, int(l), *map(float, p)) for i, (p, l) in enumerate(zip(x, lab))]
    return x, lab, spark.createDataFrame(rows, "id long, cluster int, a double, b double, c double")


def test_silhouette_exact_matches_brute_force(small):
    x, lab, df = small
    for block in (16, 4096):  # many blocks and one block give the same number
        got = M.silhouette_exact(df, "id", ["a", "b", "c"], block_rows=block).first()["silhouette"]
        assert math.isclose(got, _brute_silhouette(x, lab), rel_tol=1e-9, abs_tol=1e-12)


def test_centroid_scores_match_brute_force(small):
    x, lab, df = small
    r = M.centroid_scores(df, ["a", "b", "c"]).first()
    db, ch, wcss = _brute_db_ch(x, lab)
    assert math.isclose(r["davies_bouldin"], db, rel_tol=1e-9)
    assert math.isclose(r["calinski_harabasz"], ch, rel_tol=1e-9)
    assert math.isclose(r["wcss"], wcss, rel_tol=1e-9)


def test_db_coincident_centroids_is_zero(spark):
    df = spark.createDataFrame([(1, 0, 0.0), (2, 0, 2.0), (3, 1, 0.0), (4, 1, 2.0)], "id long, cluster int, a double")
    assert M.centroid_scores(df, ["a"]).first()["davies_bouldin"] == 0.0


def test_ari_renaming_and_symmetry(spark):
    labels = spark.createDataFrame([(i, i % 3) for i in range(30)], "id long, cluster int")
    renamed = spark.createDataFrame([(i, f"x{(i % 3) * 7}") for i in range(30)], "id long, truth string")
    assert M.adjusted_rand(labels, renamed, "id").first()["ari"] == 1.0
    other = spark.createDataFrame([(i, str(i % 2)) for i in range(30)], "id long, truth string")
    a = M.adjusted_rand(labels, other, "id").first()["ari"]
    swapped = M.adjusted_rand(other.withColumnRenamed("truth", "cluster"),
                              labels.withColumnRenamed("cluster", "truth"), "id").first()["ari"]
    assert math.isclose(a, swapped, abs_tol=1e-12)


def test_ari_matches_by_id_not_position(spark):
    """A truth table with extra, shuffled rows still scores 1 against the same partition."""
    labels = spark.createDataFrame([(i, i // 4) for i in range(8)], "id long, cluster int")
    truth = spark.createDataFrame([(i, f"g{i // 4}") for i in [7, 3, 100, 5, 0, 1, 2, 4, 6, 101]], "id long, truth string")
    r = M.adjusted_rand(labels, truth, "id").first()
    assert r["n_matched"] == 8 and r["ari"] == 1.0


def test_sentinels(spark):
    df = spark.createDataFrame([(1, 0, 1.0), (2, 0, 2.0)], "id long, cluster int, a double")
    from pyspark.sql import functions as F
    sc = M.centroid_scores(df, ["a"]).withColumn("silhouette", F.lit(0.1))
    r = M.with_sentinels(sc).first()
    assert r["silhouette"] == -1.0 and r["davies_bouldin"] == float("inf") and r["calinski_harabasz"] == 0.0
    assert r["is_valid"] is False


def test_noise_filtered_fallback_mt7(spark):
    from cohortlens.plans import workflow as WF

    rng = np.random.default_rng(5)
    pts = np.vstack([rng.normal(0, 0.1, (30, 2)), rng.normal(3, 0.1, (30, 2)), [[10.0, 10.0], [-9.0, 4.0]]])
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(pts)], "id long, a double, b double")
    labels = spark.createDataFrame([(i, 0 if i < 30 else (1 if i < 60 else -1)) for i in range(len(pts))], "id long, cluster int")

    def fails_with_noise(lab, id_col, cols):
        if lab.where("cluster = -1").count():
            raise RuntimeError("metric failed")
        return WF._scores(lab, id_col, cols)

    out = WF.score(df, labels, "id", ["a", "b"], scorer=fails_with_noise)
    clean = WF.score(df.where("id < 60"), labels, "id", ["a", "b"])
    assert out["warning"].startswith("scores without noise rows") and clean["warning"] is None
    assert out["silhouette"] == clean["silhouette"] and out["is_valid"]
    # every row its own label (noise counted as a label) -> the label-count rule fails twice -> sentinels
    own = spark.createDataFrame([(i, i if i < 61 else -1) for i in range(len(pts))], "id long, cluster int")
    s = WF.score(df, own, "id", ["a", "b"])
    assert s["silhouette"] == -1.0 and s["warning"].startswith("scores failed") and not s["is_valid"]


def test_pruned_silhouette_skips_far_clusters(spark):
    """200 clusters: the same value as all pairs, from a small part of the (row, cluster) pairs."""
    rng = np.random.default_rng(3)
    rows = [(c * 15 + i, c if (c + i) % 50 else -1, float(c % 20 * 10 + rng.normal()), float(c // 20 * 10 + rng.normal())) for c in range(200) for i in range(15)]
    df = spark.createDataFrame(rows, "id long, cluster int, x double, y double")
    every = M.silhouettes_exact(df, "id", ["x", "y"], ["cluster"]).first()["silhouette"]
    for block in (4096, 64):
        assert M.silhouette_exact(df, "id", ["x", "y"], block_rows=block).first()["silhouette"] == pytest.approx(every, abs=1e-9)
    met, sizes = M.silhouette_pairs(M._labelled_vectors(df, "id", ["x", "y"], "cluster", None))
    assert sizes.count() == 201 and met.count() < 0.05 * 201 * len(rows)


def test_sampled_silhouette_is_within_its_error(spark):
    rng = np.random.default_rng(4)
    rows = [(i, int(i % 3), float(i % 3 * 2 + rng.normal()), float(rng.normal())) for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, cluster int, x double, y double")
    exact = M.silhouette_exact(df, "id", ["x", "y"]).first()["silhouette"]
    for seed in range(3):
        r = M.silhouette_sampled(df, "id", ["x", "y"], per_cluster=150, seed=seed).first()
        assert r["mode"] == "sampled" and r["n_sampled"] == 450 and r["n_rows"] == 3000
        assert 0 < r["standard_error"] < 0.05 and abs(r["silhouette"] - exact) < 3 * r["standard_error"]


def test_ari_of_a_billion_rows(spark):
    """Pair counts beyond the integers of a double: equal to Python's."""
    table = {("a", 0): 400_000_003, ("a", 1): 7, ("b", 0): 11, ("b", 1): 300_000_019, ("c", 1): 299_999_960}
    cont = spark.createDataFrame([(t, c, n) for (t, c), n in table.items()], "truth string, cluster int, nij long")
    n, s2 = sum(table.values()), sum(v * v for v in table.values())
    a2 = sum(sum(v for (t, _), v in table.items() if t == x) ** 2 for x in "abc")
    b2 = sum(sum(v for (_, c), v in table.items() if c == x) ** 2 for x in (0, 1))
    tp, fp, fn = s2 - n, b2 - s2, a2 - s2
    tn = n * n - fp - fn - s2
    from fractions import Fraction
    expected = Fraction(2 * (tp * tn - fn * fp), (tp + fn) * (fn + tn) + (tp + fp) * (fp + tn))
    got = M.ari_of_contingency(cont).first()
    assert got["n_matched"] == n and got["ari"] == pytest.approx(float(expected), rel=1e-15)


def test_silhouettes_emit_one_row_a_block_pair(spark, monkeypatch):
    """Several labellings, repeated rows and a label column with 300 clusters: brute force, whichever path they take, and few rows leave the tiles."""
    rng = np.random.default_rng(5)
    x = rng.normal(0, 2, (300, 2))
    labs = np.column_stack([rng.integers(0, 3, 300), (x[:, 0] > 0) * 2 - 1, np.arange(300) // 2])
    df = spark.createDataFrame([(i, *map(float, p), *map(int, c)) for i, (p, c) in enumerate(zip(x, labs))], "id long, x double, y double, a int, b int, c int")
    emitted = []
    made = M._block_pair_sums([np.unique(c) for c in labs[:, :2].T])
    for blk in (np.arange(300) % 2, np.zeros(300, int)):
        sides = [pd.DataFrame({"id": np.flatnonzero(blk == s), "c": list(labs[blk == s][:, :2]), "x": list(x[blk == s])}) for s in range(blk.max() + 1)]
        emitted.append(sum(len(made((i, j), sides[i], sides[j])) for i in range(len(sides)) for j in range(i, len(sides))))
    assert emitted == [600, 300]  # rows x blocks, not rows x blocks x clusters
    for most, block in ((256, None), (256, 70), (4, 70)):
        monkeypatch.setattr(M, "MOST_CLUSTERS", most)
        got = {r["labelling"]: (r["silhouette"], r["n_rows"]) for r in M.silhouettes_exact(df, "id", ["x", "y"], ["a", "b", "c"], block_rows=block).collect()}
        for j, name in enumerate("abc"):
            assert got[name][0] == pytest.approx(_brute_silhouette(x, labs[:, j]), abs=1e-9) and got[name][1] == 300


def test_runs_of_equal_labels_are_summed_first():
    rng = np.random.default_rng(6)
    dist = rng.random((128, 256))
    for rows, axis in ((256, 1), (128, 0)):
        of = np.zeros((rows, 40))
        of[np.arange(rows), np.sort(rng.integers(0, 9, rows))] = 1.0
        for one_hot in (of, of[rng.permutation(rows)], of[:, :9]):
            assert np.allclose(M._grouped(dist, one_hot, axis), (dist if axis else dist.T) @ one_hot, rtol=1e-13)


def test_many_clusters_stream_rows_through_blocks(spark, monkeypatch):
    """More than FEW_COLUMNS clusters: brute force with null labels, null and repeated ids and equal rows; a row's sums leave the tasks once,
    not once a block, and no row is paired with another."""
    rng = np.random.default_rng(8)
    x = np.round(rng.normal(0, 2, (400, 3)), 1)
    x[200:220] = x[:20]  # equal rows of other ids
    labs = np.column_stack([rng.integers(0, 12, 400), (x[:, 0] > 0) * 2 - 1, rng.integers(-1, 20, 400)])
    rows = [(None if i == 7 else i, *map(float, p), None if c[0] == 11 else int(c[0]), *map(int, c[1:])) for i, (p, c) in enumerate(zip(x, labs))]
    df = spark.createDataFrame(rows, "id long, x double, y double, z double, a int, b int, c int").repartition(5)
    monkeypatch.setattr(M, "_block_pair_sums", lambda labels: pytest.fail("blocks met in pairs"))
    for block in (None, 37):
        got = {r["labelling"]: (r["silhouette"], r["n_rows"]) for r in M.silhouettes_exact(df, "id", ["x", "y", "z"], ["a", "b", "c"], block_rows=block).collect()}
        for j, name in enumerate("abc"):
            assert got[name][0] == pytest.approx(_brute_silhouette(x, labs[:, j]), abs=1e-12) and got[name][1] == 400
    base = df.selectExpr("id", "array(cast(b as bigint), cast(c as bigint)) as c", "array(x, y, z) as x")
    labels = [np.unique(c) for c in labs[:, 1:].T]
    sums = M._streamed_sums(base, 400, 3, labels, "bigint", 37)
    assert sums.count() == 400 and sums.where("size(s) = 23 and n = 1").count() == 400
    again = base.unionByName(base.where("id = 9"))  # rows of one id and the same labels count as one, with the sums of both
    twice = M._streamed_sums(again, 401, 3, labels, "bigint", 37).where("id = 9").collect()
    assert [r["n"] for r in twice] == [2]
    d = np.sqrt(((x[9] - np.vstack([x, x[9:10]])) ** 2).sum(1))
    lab = np.append(labs[:, 1], labs[9, 1])
    assert twice[0]["s"][:2] == pytest.approx([2 * d[lab == k].sum() for k in (-1, 1)])


def test_a_labelling_of_many_clusters_does_not_part_the_others():
    assert M._shared([5, 300, 4]) == ([[0, 2]], [1])
    assert M._shared([200, 50, 10]) == ([[0, 1], [2]], [])
    groups, alone = M._shared([16] * 16)  # one number holds all labels of a row
    assert alone == [] and groups == [list(range(15)), [15]]


def _sums_by_differences(a, b, codes, width):
    """What one tile of 8 rows after the other costs without a product of matrices."""
    out, starts = np.zeros((a.shape[1], width)), np.flatnonzero(np.diff(codes, prepend=-1))
    for lo in range(0, a.shape[1], 8):
        dist = np.zeros((a[:, lo:lo + 8].shape[1], b.shape[1]))
        for x, y in zip(a[:, lo:lo + 8, None], b[:, None, :]):
            diff = x - y
            np.multiply(diff, diff, out=diff)
            dist += diff
        np.sqrt(dist, out=dist)
        out[lo:lo + 8, codes[starts]] += np.add.reduceat(dist, starts, axis=1)
    return out


def test_streamed_distances_are_exact_on_odd_rows():
    """Offsets, outliers, equal rows, few values: the sums of differences, and 0 for equal rows, whichever way a tile is computed."""
    rng = np.random.default_rng(12)
    forms = {"plain": lambda x: x, "offset": lambda x: x + 1e7, "equal": lambda x: 0 * x + 0.1, "few values": np.round,
             "outliers": lambda x: np.where(rng.random(x.shape) < 0.002, x * 1e7, x), "close": lambda x: 3.0 + x * 1e-9}
    for name, form in forms.items():
        a = form(rng.normal(size=(3, 37)))
        b = np.hstack([a[:, :20], form(rng.normal(size=(3, 2 * M.STREAM_TILE_COLUMNS)))])
        for codes in (np.sort(rng.integers(0, 5, b.shape[1])), rng.integers(0, 5, b.shape[1]), np.zeros(b.shape[1], np.int64)):
            got = np.zeros((37, 5))
            M._stream_distance_sums(a, b, codes, lambda c: np.eye(5)[c], got)
            want = np.sqrt(((a[:, :, None] - b[:, None, :]) ** 2).sum(axis=0)) @ np.eye(5)[codes]
            assert np.allclose(got, want, rtol=1e-10, atol=0), name
    a = np.full((3, 4), 0.3)
    a[0, 1] = np.inf
    got = np.zeros((4, 1))
    with np.errstate(invalid="ignore"):
        M._stream_distance_sums(a, np.full((3, 6), 0.3), np.zeros(6, np.int64), lambda c: np.ones((len(c), 1)), got)
    assert got[:, 0].tolist() == [0.0, np.inf, 0.0, 0.0]


def test_streamed_distances_cost_less_than_differences():
    """Every pair of rows is one distance, so a distance's cost is the silhouette's: the least times of five runs."""
    rng = np.random.default_rng(13)
    a, b, codes = rng.normal(size=(3, 512)), rng.normal(size=(3, 10_000)), np.sort(rng.integers(0, 4, 10_000))
    times = {"differences": [], "streamed": []}
    for _ in range(5):
        start = time.perf_counter()
        want = np.zeros((512, 4))
        for lo in range(0, 10_000, 4096):
            want += _sums_by_differences(a, b[:, lo:lo + 4096], codes[lo:lo + 4096], 4)
        times["differences"].append(time.perf_counter() - start)
        start, got = time.perf_counter(), np.zeros((512, 4))
        M._stream_distance_sums(a, b, codes, lambda c: np.eye(4)[c], got)
        times["streamed"].append(time.perf_counter() - start)
        assert np.allclose(got, want, rtol=1e-12)
    assert min(times["streamed"]) < 0.85 * min(times["differences"])


def test_rows_that_stream_leave_their_task_as_silhouettes(spark):
    """One number a labelling, however many clusters it has: single rows, repeated ids and rows, a labelling of one cluster."""
    rng = np.random.default_rng(14)
    x = np.round(rng.normal(0, 1, (90, 2)), 1)
    labs = np.column_stack([rng.integers(0, 18, 90), np.zeros(90, int), np.where(np.arange(90) == 5, 1, 0)])
    df = spark.createDataFrame([(i, *map(float, p), *map(int, c)) for i, (p, c) in enumerate(zip(x, labs))], "id long, x double, y double, a int, b int, c int")
    base = df.selectExpr("id", "array(cast(a as bigint), cast(b as bigint), cast(c as bigint)) as c", "array(x, y) as x")
    labels, sizes = zip(*[np.unique(c, return_counts=True) for c in labs.T])
    rows = M._streamed_sums(base, 90, 2, list(labels), "bigint", 40, list(sizes)).collect()
    assert len(rows) == 90 and all(len(r["s"]) == 3 for r in rows)
    for j in (0, 2):
        assert np.mean([r["s"][j] for r in rows]) == pytest.approx(_brute_silhouette(x, labs[:, j]), abs=1e-12)
    assert all(r["s"][1] == 0 for r in rows)
    got = {r["labelling"]: r["silhouette"] for r in M.silhouettes_exact(df, "id", ["x", "y"], ["a", "b", "c"]).collect()}
    assert got["a"] == pytest.approx(_brute_silhouette(x, labs[:, 0]), abs=1e-12) and got["b"] == 0
    own = np.array([[0], [0]])
    assert M._row_silhouettes(own, np.array([2, 1]), np.array([[0.0, 8.0], [0.0, 0.0]]), [np.array([1, 2])]).tolist() == [[1.0], [0.0]]
