"""Mixing against the contract's own procedure."""

import hashlib
import re

import pytest

mixing = pytest.importorskip("cohortlens.llm.mixing")


def brute_targets(sizes: dict, weights=(5, 2, 1)):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    out, open_, left = {}, set(order), 1.5 * sum(sizes.values())
    while open_:
        total = sum(weight[s] for s in open_)
        over = [s for s in open_ if left * weight[s] / total >= 2 * sizes[s]]
        if not over:
            return out | {s: left * weight[s] / total for s in open_}
        for s in over:
            out[s] = 2.0 * sizes[s]
            left -= out[s]
            open_.discard(s)
    return out


def rows():
    out = [(i, "w " * (i % 50), ["b", "a", None, "é", "𐀀", "z"][min(i % 9, 5)], "own", 0.5) for i in range(900)]
    return out + [(1, None, "a", "own", 0.5), (2, "", "empty source", "own", 0.5), (7, "w w", "a", "own", 0.5), (7, "w w", "a", "own", 0.5), (None, "null id", "b", "own", 0.5)]


@pytest.mark.parametrize("bucket_rows", [50_000, 20])
def test_mix(spark, monkeypatch, bucket_rows):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", bucket_rows)
    data = rows()
    df = spark.createDataFrame(data, "doc_id long, text string, source string, __sum string, position double").repartition(5)
    out = mixing.mix(df).toPandas()
    assert len(out) == len(data) and set(out["__sum"]) == {"own"} and set(out.position) == {0.5}
    n = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert sorted(out["size"]) == sorted(n(t) for _, t, *_ in data)
    sizes: dict = {}
    for _, t, s, *_ in data:
        sizes[s] = sizes.get(s, 0) + n(t)
    wanted = brute_targets(sizes)
    for s, g in out.groupby(out.source.fillna("<null>")):
        s = None if s == "<null>" else s
        assert g.source_size.iloc[0] == sizes[s] and abs(g.target.iloc[0] - wanted[s]) < 1e-6
        assert abs(g.taken.sum() - wanted[s]) <= max(1, g["size"].max())
    assert (out.taken <= 2 * out["size"]).all() and (out.positions.str.len() * out["size"] == out.taken).all()
    again = mixing.mix(df.repartition(2), keep_text=False).toPandas()
    key = ["doc_id", "source", "size", "taken"]
    assert sorted(map(str, again[key].values.tolist())) == sorted(map(str, out[key].values.tolist()))


def test_curriculum_order_and_schedule(spark):
    data = [(i, "w " * 10, "abc"[i % 3]) for i in range(3000)]
    order = mixing.curriculum(mixing.mix(spark.createDataFrame(data, "doc_id long, text string, source string"))).toPandas()
    assert order.position.is_monotonic_increasing and order.position.between(0, 1).all()
    first = order[order.position < 0.5].source.value_counts() / order.source.value_counts()
    assert first["a"] > 0.55 and abs(first["b"] - 0.5) < 0.02 and first["c"] < 0.45  # fades out, even, comes in


def test_registered_order_has_every_position(spark, tmp_path):
    """curriculum_order against the schedule, integrated and inverted by bisection."""
    from cohortlens.llm.queries import QUERIES

    data = [(i, "w " * (1 + i % 13), "abc"[min(i % 5, 2)]) for i in range(600)]
    spark.createDataFrame(data, "doc_id long, text string, source string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in QUERIES["curriculum_order"](spark, str(tmp_path)).select("position", "doc_id", "size").collect()]
    assert [p for p, *_ in got] == sorted(p for p, *_ in got)
    sizes = {s: sum(1 + i % 13 for i, _, t in data if t == s) for s in "abc"}
    goals, wanted = brute_targets(sizes), []
    for s, slope in zip("abc", (-0.5, 0.0, 0.5), strict=True):
        stream = sorted((hashlib.md5(str(i).encode()).hexdigest(), i, 1 + i % 13) for i, _, t in data if t == s)
        at = 0
        for _, i, n in stream * 2:
            if at + n / 2 < goals[s]:
                low, high = 0.0, 1.0
                for _ in range(60):
                    u = (low + high) / 2
                    low, high = (u, high) if goals[s] * (slope * u * u + (1 - slope) * u) < at else (low, u)
                wanted.append((i, n, low))
            at += n
    mine, theirs = sorted((i, p, n) for p, i, n in got), sorted((i, p, n) for i, n, p in wanted)
    assert [(i, n) for i, _, n in mine] == [(i, n) for i, _, n in theirs]
    assert all(abs(a[1] - b[1]) < 1e-5 for a, b in zip(mine, theirs, strict=True))


def test_op6_follows_the_training_order(spark, tmp_path):
    """op6's rows come from the curriculum: sorted by first position, documents left out last, each taken as often as it is placed."""
    from cohortlens.llm.queries import QUERIES

    data = [(i, "w " * (i % 13), "abc"[min(i % 5, 2)]) for i in range(600)]
    spark.createDataFrame(data, "doc_id long, text string, source string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = [(r["doc_id"], r["taken"]) for r in QUERIES["op6_mixing"](spark, str(tmp_path)).collect()]
    mixed = {r["doc_id"]: r for r in mixing.mix(spark.read.parquet(f"{tmp_path}/documents.parquet")).collect()}
    first = [(mixed[i]["positions"] or [2.0])[0] for i, _ in got]
    assert len(got) == 600 and first == sorted(first) and 2.0 in first
    assert all(taken == mixed[i]["taken"] for i, taken in got)


def test_empty_table(spark):
    assert mixing.mix(spark.createDataFrame([], "doc_id long, text string, source string")).count() == 0
