"""The pipeline's stages on planted documents, and the registered names."""

import hashlib
import os
import random
import re
import struct
import sys
import zlib

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
corpus_pipeline = pytest.importorskip("corpus_pipeline")

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size int"


def prose(k, n=60):
    return " ".join(f"word{k}x{i}" for i in range(n))


def test_stages_in_order(spark, tmp_path):
    rows = [(i, prose(i) + f" mail me{i}@example.com", "en", f"s{i % 3}", 5, i) for i in range(30)]
    rows += [(100 + i, prose(0) + f" mail me0@example.com end{i}", "en", "s0", 5, 0) for i in range(5)]  # near copies of 0
    rows += [(200, "### *** %%% " * 30, "en", "s0", 5, 0), (201, None, "en", None, None, 0), (202, "", "en", None, 0, 0), rows[3], (None, prose(999), "en", "s1", 1, 0)]
    docs = spark.createDataFrame(rows, SCHEMA)
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "near_dedup", "pii", "mixing", "packing"]
    kept = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, "").write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        kept[name] = docs.collect()
        assert name == "packing" or docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "size"]
    ids = lambda name: sorted(-1 if r["doc_id"] is None else r["doc_id"] for r in kept[name])
    assert ids("quality_rules") == sorted([-1, *range(30), 3, *range(100, 105)])
    assert ids("near_dedup") == [-1, *range(30)]
    assert ids("pii") == [-1, *range(30)]
    for r in kept["pii"]:
        assert "@" not in r["text"] and (r["doc_id"] is None or (r["text"].endswith("mail [EMAIL]") and r["n_chars"] == len(r["text"])))
    assert {r["doc_id"] for r in kept["mixing"]} <= set(range(30)) | {None} and set(r["text"] for r in kept["mixing"]) <= {r["text"] for r in kept["pii"]}
    assert sorted(set(ids("packing"))) == sorted(set(ids("mixing"))) and len({(r["sequence_id"], r["offset"]) for r in kept["packing"]}) == len(kept["packing"])


def five_words(text):
    w = (text or "").lower().split()
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def test_near_dedup_stage_links_at_five_words(spark):
    rng = random.Random(5)
    rows = []
    for g in range(30):
        base = [f"g{g}w{i}" for i in range(180)]
        for changes in range(7):  # 4 scattered changes: linked at four words, not at five
            own = list(base)
            for i in range(changes):
                own[20 + 40 * (i % 4) + 10 * (i // 4)] = f"n{g}x{changes}x{rng.random()}"
            rows.append((len(rows), " ".join(own)))
    rows += [(1000, "a b c d"), (1001, "a b c d"), (1002, "a b c e"), (1003, None), (1004, "")]
    sets = {i: five_words(t) for i, t in rows}
    least = {i: i for i in sets}

    def find(x):
        while least[x] != x:
            x = least[x]
        return x
    for i, a in sets.items():
        for j, b in sets.items():
            if j < i and a and b and 100 * len(a & b) >= 80 * len(a | b):
                x, y = sorted((find(i), find(j)))
                least[y] = x
    kept = corpus_pipeline.near_dedup_stage(spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(3), "").collect()
    assert sorted(r["doc_id"] for r in kept) == sorted(i for i in sets if find(i) == i)
    assert len(kept) > 30 + 4  # a group's documents with many changes stay


def test_run_equals_brute_force(spark, tmp_path):
    """All five stages by hand: what passes, groups, redaction, takes of each document, pieces of each take, whole sequences."""
    from cohortlens.llm import tokens

    rows, n = [], 0
    for g in range(12):
        for changes in range(6):  # near copies, some beyond 80 % at five words
            words = prose(g, 1500 if g == 0 else 180).split()
            for i in range(changes if g else 100 * changes):
                words[20 + 40 * (i % 4) + 10 * (i // 4) if g else 3 + 13 * (i % 110)] = f"n{g}x{changes}x{i}"
            rows.append((n, " ".join(words) + f" mail me{g}@example.com", "en", f"s{g % 3}", 5, n))
            n += 1
    rows += [(200, "### *** %%% " * 30, "en", "s0", 5, 0), (201, None, "en", None, None, 0), (202, "", "en", None, 0, 0), rows[9], (None, prose(999), "en", "s1", 1, 0)]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    good = {r[0]: r for r in rows if r[0] is not None and r[0] < 200}
    least = {i: i for i in good}

    def find(x):
        while least[x] != x:
            x = least[x]
        return x
    sets = {i: five_words(r[1]) for i, r in good.items()}
    for i, a in sets.items():
        for j, b in sets.items():
            if j < i and 100 * len(a & b) >= 80 * len(a | b):
                x, y = sorted((find(i), find(j)))
                least[y] = x
    kept = [r for i, r in good.items() if find(i) == i] + [rows[-1]]
    assert 12 < len(kept) < len(good)
    streams = {}
    for i, t, _, s, *_ in kept:
        t = re.sub(r"\S+@\S+", "[EMAIL]", t)
        streams.setdefault(s, []).append((hashlib.md5(b"" if i is None else str(i).encode()).hexdigest(), i, t, len(t.split())))
    sizes = {s: sum(x[3] for x in v) for s, v in streams.items()}
    left, goals, todo = 1.5 * sum(sizes.values()), {}, dict(zip(sorted(sizes), (5, 2, 1), strict=True))
    while todo:
        full = [s for s in todo if left * todo[s] / sum(todo.values()) >= 2 * sizes[s]]
        for s in full:
            goals[s] = 2.0 * sizes[s]
        if not full:
            goals |= {s: left * w / sum(todo.values()) for s, w in todo.items()}
            break
        left -= sum(goals[s] for s in full)
        todo = {s: w for s, w in todo.items() if s not in full}
    encoder, wanted = tokens.encoder(tokens.default_tokenizer()), []
    for s, stream in streams.items():
        at = 0
        for _, i, t, size in sorted(stream) * 2:
            if at + size / 2 < goals[s]:
                ids = [*map(int, encoder.ids(t)), 0]
                edges = [0, *range(len(ids) % 2048 or 2048, len(ids) + 1, 2048)]
                wanted += [(-1 if i is None else i, k, a, b - a, zlib.crc32(struct.pack(f"<{b - a}I", *ids[a:b]))) for k, (a, b) in enumerate(zip(edges, edges[1:], strict=False))]
            at += size
    assert max(w[1] for w in wanted) > 0
    assert sorted((-1 if r["doc_id"] is None else r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == sorted(wanted)
    ends = {}
    for r in sorted(got, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == ends.get(r["sequence_id"], 0)
        ends[r["sequence_id"]] = r["offset"] + r["length"]
    assert sorted(ends) == list(range(len(ends))) and max(ends.values()) <= 2048


def test_empty_documents(spark):
    docs = spark.createDataFrame([], SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "")
    assert docs.count() == 0


def test_registered():
    import __spark_entry__

    names = __spark_entry__.queries()
    assert "pipeline" in names and all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 11))
