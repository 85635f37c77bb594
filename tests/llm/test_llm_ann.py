"""Collision counting against brute force."""

import numpy as np
import pytest

ann = pytest.importorskip("cohortlens.llm.ann")

SCHEMA = "vec_id long, embedding array<float>, rank int, query_id string"


def brute(rows, own, query, k):
    out = [(float(np.sqrt(((np.asarray(v) - query) ** 2).sum())), i) for i, v in rows if i != own and len(v) == len(query)]
    return sorted(out)[:k]


@pytest.mark.parametrize("block_rows", [16384, 150])
def test_recall_and_scores(spark, block_rows):
    rng = np.random.default_rng(1)
    centers = rng.normal(size=(6, 32))
    data = np.concatenate([rng.normal(size=(400, 32)), *[c + 0.05 * rng.normal(size=(60, 32)) for c in centers]]).astype(np.float32)
    data[700:] = data[700]  # one very common vector
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(data)]
    rows += [(5000, rows[3][1][:8]), (5001, rows[4][1][:8]), (5100, rows[5][1][:8])]  # another length
    good = [r for r in rows]
    odd = [(6000, None), (6001, []), (6002, [0.0] * 32), (6003, [float("nan")] * 32), (6004, [float("inf")] + [1.0] * 31), (6005, [None] + [1.0] * 31), (None, rows[0][1])]
    df = spark.createDataFrame([(i, v, 0, "own") for i, v in rows + odd], SCHEMA).repartition(4)
    out = ann.search(df, df.where("vec_id % 20 = 0"), block_rows=block_rows).toPandas()
    found = wanted = 0
    for i, v in good:
        if i % 20 == 0:
            got = out[out.query_id == i].sort_values("rank")
            best = brute(good, i, np.asarray(v), 10)
            assert len(got) == len(best) and list(got["rank"]) == list(range(1, len(best) + 1))
            dist = {j: d for d, j in brute(good, i, np.asarray(v), len(good))}
            assert all(abs(dist[j] - s) < 1e-12 for j, s in zip(got.vec_id, got.score))
            pairs = list(zip(got.score, got.vec_id))
            assert pairs == sorted(pairs)
            found += len(set(got.vec_id) & {j for _, j in best})
            wanted += len(best)
    assert found >= 0.95 * wanted
    assert set(out.query_id) == {i for i, _ in good if i % 20 == 0}


def test_recall_on_the_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    out = ann.search(df, df.where("vec_id % 10 = 0")).toPandas()
    hit = [len(set(out[out.query_id == i].vec_id) & {j for _, j in brute(rows, i, np.asarray(v), 10)}) for i, v in rows if i % 10 == 0]
    assert np.mean(hit) >= 9


def test_few_rows_and_empty(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0], 0, ""), (1, [1.0, 2.0], 0, ""), (2, [1.0, 2.0], 0, "")], SCHEMA)
    got = ann.search(df, df.where("vec_id = 0")).collect()
    assert [(r["rank"], r["vec_id"], r["score"]) for r in got] == [(1, 1, 0.0), (2, 2, 0.0)]
    none = df.where("vec_id < 0")
    assert ann.search(none, none).count() == 0 and ann.search(df.where("vec_id = 0"), df.where("vec_id = 0")).count() == 0


def share_verified(x, queries, k=10):
    block = ann.Block(np.arange(len(x)), x)
    hit = 0
    for q in queries:
        dist = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
        best = [i for i in np.lexsort((np.arange(len(x)), dist)) if i != q][:k]
        hit += len(set(block.search(q, x[q], k)[0].tolist()) & set(best))
    return block.n_verified / len(queries) / len(x), hit / len(queries) / k


def test_few_rows_are_verified():
    rng = np.random.default_rng(3)
    centers = rng.normal(size=(50, 64))
    share, recall = share_verified(np.concatenate([c + 0.1 * rng.normal(size=(40, 64)) for c in centers]), range(0, 2000, 40))
    assert share < 0.05 and recall >= 0.95
    share, recall = share_verified(rng.normal(size=(6000, 64)), range(0, 6000, 300))  # nothing is near anything
    assert share < 0.3 and recall >= 0.9


def test_few_rows_are_verified_on_the_table():
    import pandas as pd

    x = np.stack(pd.read_parquet("/root/testdata/sf0.1/embeddings.parquet").sort_values("vec_id")["embedding"].to_numpy()).astype(np.float64)
    share, recall = share_verified(x, range(0, len(x), 50))
    assert share < 0.3 and recall >= 0.9
