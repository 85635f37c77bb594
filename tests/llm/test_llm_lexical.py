"""Piped term owners against a plain ranking."""

import math
import re
from collections import Counter

import numpy as np
import pytest

lexical = pytest.importorskip("cohortlens.llm.lexical")

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
DOCS = "doc_id long, text string, item_id long, term string, shard int"
ITEMS = "item_id long, text string, doc_id long"


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, k=10):
    own = [(i, Counter(terms(t)), len(terms(t))) for i, t in docs]
    n_docs, n_terms = sum(n > 0 for *_, n in own), sum(n for *_, n in own)
    df = Counter(w for _, c, _ in own for w in c)
    asked = {}
    for i, t in items:
        if i is not None:
            asked.setdefault(i, set()).update(terms(t))
    out = set()
    for item, ws in asked.items():
        got = []
        for i, c, n in own:
            if n and i is not None:
                m = 100 - 90 + 90 * n * n_docs // n_terms
                s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * (1_000_000_000 * c[w] // (1000 * c[w] + 8 * m)) for w in ws if w in c)
                if s > 0:
                    got.append((-s, i))
        out |= {(item, r + 1, i, -s) for r, (s, i) in enumerate(sorted(got)[:k])}
    return out


def run(spark, docs, items, **kw):
    d = spark.createDataFrame([(i, t, 1, "x", 2) for i, t in docs], DOCS).repartition(5)
    q = spark.createDataFrame([(i, t, 9) for i, t in items], ITEMS)
    return {tuple(r) for r in lexical.search(d, q, **kw).collect()}


def corpus(n, seed=3):
    rng = np.random.default_rng(seed)
    vocab = ["the", "La", "año", "Été", "x1", "日本"] + [f"w{i}" for i in range(300)]
    p = 1 / np.arange(1, len(vocab) + 1)
    return [(i, " ,-".join(rng.choice(vocab, size=int(rng.integers(1, 60)), p=p / p.sum()))) for i in range(n)]


@pytest.mark.parametrize("rows", [4096, 37])
def test_equals_a_plain_ranking(spark, monkeypatch, rows):
    docs = corpus(700)
    docs += [(1000 + i, docs[5][1]) for i in range(60)]  # copies: ties by id
    docs += [(3, "w7 w8"), (3, "w7 w8"), (None, "w7 w8 w9 rare"), (2000, None), (2001, ""), (2002, "--- ,"), (2003, "Straße ÀB_c 12a")]
    docs += [(2004, "the " * 40_000 + "needle"), (2005, "rare the"), (2006, "the rare İx"), (2 ** 62 + 1, "rare")]
    items = [(i, docs[7 * i][1]) for i in range(20)] + [(20, "rare"), (20, "needle"), (None, "rare"), (21, None), (22, "no-such"), (23, "the la"), (24, "STRASSE straße İx àb Àb"), (25, docs[5][1])]
    monkeypatch.setattr(lexical, "SHARD_ROWS", rows)
    assert run(spark, docs, items) == brute(docs, items)


def test_blocks_of_items_and_shuffled_vocabulary(spark, monkeypatch):
    docs = corpus(200, 4)
    items = [(i, docs[i][1]) for i in range(60)]
    monkeypatch.setattr(lexical, "BLOCK_ITEMS", 7)
    monkeypatch.setattr(lexical, "BROADCAST_TERMS", 3)
    assert run(spark, docs, items, k=4) == brute(docs, items, 4)


def test_accumulators_thin_out(spark):
    """An owner drops documents that can no longer be among the best, and only those."""
    rng = np.random.default_rng(1)
    ids, n = np.arange(400, dtype="<i8"), np.full(400, 50, "<u4")
    head = {"term": None, "w": None, "items": None, "rests": None, "docs": ids.tobytes(), "counts": n.tobytes()}
    pd = pytest.importorskip("pandas")
    row = lambda docs, w, rest: {"term": "t", "w": w, "items": np.array([7]), "rests": np.array([rest]), "docs": np.asarray(docs, "<u2").tobytes(),
                                 "counts": np.full(len(docs), 1, "<u4").tobytes()}
    none = pd.DataFrame([], columns=[c.split()[0] for c in lexical.BUNDLE.split(", ")])
    rare = sorted(rng.choice(400, 12, replace=False).tolist())
    own = pd.DataFrame([head, row(rare, 9000, 0), row(range(400), 100, 0)])
    out = lexical._add((0, 1), own, none, 10, 400, 20_000, False)
    assert np.frombuffer(out["docs"][0], "<u2").tolist() == rare
    own = pd.DataFrame([head, row(rare, 9000, 10 ** 12), row(range(400), 100, 10 ** 12)])
    out = lexical._add((0, 1), own, none, 10, 400, 20_000, False)
    assert len(np.frombuffer(out["docs"][0], "<u2")) == 400


def test_empty_tables(spark):
    assert run(spark, [], [(1, "a")]) == set()
    assert run(spark, [(1, "a")], []) == set()
    assert run(spark, [(1, None), (2, "-")], [(1, "a")]) == set()
