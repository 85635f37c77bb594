"""Near-duplicate groups against brute force over all pairs."""

import random
import re

import numpy as np
import pytest

smh = pytest.importorskip("cohortlens.llm.superminhash")

AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(AZ))
    return frozenset(tuple(w[i:i + 4]) for i in range(len(w) - 3)) if len(w) >= 4 else frozenset([tuple(w)] if w else [])


def brute(rows):
    """id -> least reachable id; ids with several texts are one document."""
    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    parent = {i: i for i, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                x, y = sorted((find(i), find(j)))
                parent[y] = x
    return {i: find(i) for i in parent}


def corpus():
    rng = random.Random(17)
    vocabulary = [f"w{i}" for i in range(3000)] + ["ÄÖ", "é", "I", "i"]
    rows, n = [], 0

    def add(text):
        nonlocal n
        rows.append((n, text))
        n += 1
    for _ in range(25):
        base = rng.choices(vocabulary, k=rng.choice([5, 12, 40, 120, 400]))
        for rate in (0, 0.01, 0.02, 0.03, 0.05, 0.08, 0.12):
            add(" ".join(rng.choice(vocabulary) if rng.random() < rate else w for w in base))
    chain = rng.choices(vocabulary, k=100)  # neighbours are linked, the ends are not
    for k in range(30):
        add(" ".join(chain))
        chain[k * 3] = f"new{k}"
    family = rng.choices(vocabulary, k=200)  # a large group of near copies, and a large group of exact ones
    for _ in range(60):
        own = list(family)
        own[rng.randrange(200)] = "x"
        add(" ".join(own))
    for _ in range(40):
        add("Exact COPY of a text that stands here often")
    for t in (None, "", "  \n", "one", "ONE", "one two three", "One\ttwo three", "x " * 30_000, "x " * 20_000):
        add(t)
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("group_rows", [256, 7])
def test_groups_equal_brute_force(spark, monkeypatch, group_rows):
    monkeypatch.setattr(smh, "GROUP_ROWS", group_rows)
    rows = corpus()
    rows += [rows[0], rows[0], (None, "null id"), (None, rows[3][1]), (rows[5][0], rows[9][1])]  # repeated, null ids, one id with two texts
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, n int, rep int").repartition(5)
    out = smh.groups(df).collect()
    assert len(out) == len(rows)
    wanted, size = brute(rows), {}
    for i, t in rows:
        size.setdefault(i, set()).add(len(shingles(t)))
    for r in out:
        assert r["n_shingles"] in size[r["id"]]
        if r["id"] is not None and r["n_shingles"]:
            assert r["component_id"] == wanted[r["id"]]
    kept = smh.keep_one(df).collect()
    own = [r["doc_id"] for r in kept if r["doc_id"] is not None]
    assert sorted(own) == sorted(set(wanted.values())) and sum(r["doc_id"] is None for r in kept) == 2
    assert set(kept[0].asDict()) == {"doc_id", "text", "n", "rep"}


def test_blocks_find_what_stars_miss(spark):
    """Members of one bucket that are linked with each other but not with its least member."""
    import pandas as pd

    near = [f"w{i}" for i in range(60)]
    texts = ["other words " * 30, " ".join(near), " ".join([*near[:-1], "x"])]
    sets = smh.shingle_sets([t.encode() for t in texts])
    sig = smh.signatures(sets)
    band = int((sig[1][:96].reshape(24, 4) == sig[2][:96].reshape(24, 4)).all(axis=1).argmax())
    rows = [(1, 0, 0, b, 0, i, i, 57, sig[i].tobytes(), texts[i]) for b in (band, band + 1) for i in range(3)]
    frame = pd.DataFrame(rows, columns=["key", "x", "y", "band", "block", "id", "comp", "n", "sig", "text"])
    frame["key"] = frame["band"]
    got = pd.concat(list(smh._close(iter([frame[:2], frame[2:]]))))  # a group goes on in the next batch
    assert got.values.tolist() == [[1, 2]]
    rest = pd.concat(list(smh._involved(iter([frame[:2].drop(columns="text"), frame[2:].drop(columns="text")]))))
    assert rest[["key", "id"]].values.tolist() == [[band, 1], [band, 2]]  # only their texts are moved


def test_long_texts_are_hashed_in_pieces(monkeypatch):
    rng = random.Random(2)
    texts = [" ".join(rng.choices(["a", "Bc", "def\t", "é", "x" * 900], k=k)).encode() for k in (1, 50, 4000)] + [b"", b" " * 5000, b"y" * 9000]
    whole = smh.shingle_sets(texts)
    monkeypatch.setattr(smh, "BLOCK_BYTES", 300)
    monkeypatch.setattr(smh, "_powers", [np.ones(1, np.uint64), np.ones(1, np.uint64)])
    assert all((a == b).all() and len(a) == len(b) for a, b in zip(whole, smh.shingle_sets(texts), strict=True))
    assert len(smh._powers[0]) <= 600  # a huge word's powers are not kept


def test_signature_estimates_similarity():
    rng = np.random.default_rng(0)
    errors = []
    for share in (0.2, 0.5, 0.8, 0.95):
        for n in (20, 100, 1000):
            for _ in range(20):
                e = rng.integers(1, 1 << 63, size=2 * n, dtype=np.uint64)
                common = round(share * 2 * n / (1 + share))
                a, b = np.sort(e[:n]), np.sort(np.concatenate((e[:common], e[n:2 * n - common])))
                s = smh.signatures([a, b])
                errors.append((s[0] == s[1]).mean() - common / (2 * n - common))
    assert abs(np.mean(errors)) < 0.01 and np.std(errors) < 0.05


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert smh.groups(df).count() == 0 and smh.keep_one(df).count() == 0
