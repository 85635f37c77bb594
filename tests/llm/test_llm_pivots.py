"""Pivot-table elimination against all inner products."""

import math

import numpy as np
import pytest

pivots = pytest.importorskip("cohortlens.llm.pivots")

SCHEMA = "vec_id long, embedding array<float>, rank int, query_id string, block int"


def scaled(v):
    return [math.floor(1024 * float(x)) for x in v]


def brute(rows, asked, k=10):
    out = set()
    for q, v in asked:
        got = sorted((-sum(a * b for a, b in zip(scaled(v), scaled(w))), i) for i, w in rows if i != q and len(w) == len(v))[:k]
        out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(got)}
    return out


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, "own", 1) for i, v in rows], SCHEMA).repartition(4)


@pytest.mark.parametrize("block_rows,n_pivots", [(4096, 64), (40, 5), (1000, 1)])
def test_equals_brute_force(spark, block_rows, n_pivots):
    rng = np.random.default_rng(2)
    centers = 3 * rng.normal(size=(8, 16))
    data = np.concatenate([rng.normal(size=(150, 16)), *[c + 0.02 * rng.normal(size=(40, 16)) for c in centers]]).astype(np.float32)
    data[300:420] = data[300]  # a vector that holds a quarter of the rows: ties
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(data)]
    rows += [(5000, rows[3][1][:8]), (5001, rows[4][1][:8]), (5020, rows[5][1][:8]), (6000, [0.0] * 16), (6001, [0.5] * 16), (6001, [0.5] * 16)]
    odd = [(7000, None), (7020, []), (7040, [float("nan")] * 16), (7060, [float("-inf")] + [1.0] * 15), (7080, [None] + [1.0] * 15), (None, rows[0][1]), (7100, [1e30] * 16)]
    df = frame(spark, rows + odd)
    got = pivots.search(df, df.where("vec_id % 20 = 0"), block_rows=block_rows, n_pivots=n_pivots)
    assert {tuple(r) for r in got.collect()} == brute(rows, [r for r in rows if r[0] % 20 == 0])


def test_components_beyond_doubles(spark):
    """Sums over 2^53 are taken in integers."""
    rng = np.random.default_rng(5)
    rows = [(i, [float(np.float32(x)) for x in rng.uniform(9000, 16000, size=64)]) for i in range(60)]
    df = frame(spark, rows)
    assert {tuple(r) for r in pivots.search(df, df.where("vec_id % 20 = 0")).collect()} == brute(rows, rows[::20])


def test_elimination(spark):
    """On clustered vectors most rows are never evaluated, and what is left out is proven worse."""
    rng = np.random.default_rng(6)
    centers = rng.normal(size=(20, 32))
    x = np.floor(1024 * np.concatenate([c + 0.05 * rng.normal(size=(100, 32)) for c in centers]))
    p = pivots.choose(x[::7])
    d = np.sqrt(((x[:, None] - p) ** 2).sum(axis=2)).astype("<f4")
    block = pivots.Block(list(range(len(x))), [v.tobytes() for v in x.astype("<i4")], [v.tobytes() for v in d])
    for q in range(0, 2000, 100):
        ids, scores = block.search(q, x[q], d[q], None, 10)
        every = sorted((-int(s), i) for i, s in enumerate(x @ x[q]) if i != q)[:10]
        assert [(-s, i) for i, s in zip(ids.tolist(), scores.tolist())] == every
    assert block.n_scored < 0.3 * 20 * len(x)


def test_few_rows_and_empty(spark):
    df = frame(spark, [(0, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [1.0, 2.0])])
    got = pivots.search(df, df.where("vec_id = 0")).collect()
    assert [tuple(r) for r in got] == [(0, 1, 1, 5 * 1024 ** 2), (0, 2, 2, 5 * 1024 ** 2)]
    none = df.where("vec_id < 0")
    assert pivots.search(none, none).count() == 0
    assert pivots.search(df.where("vec_id = 0"), df.where("vec_id = 0")).count() == 0
    assert pivots.search(none, df).count() == 0
