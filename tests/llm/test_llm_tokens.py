"""Token counts and packing against the tokenizers library."""

import random
import zlib

import numpy as np
import pytest

tokens = pytest.importorskip("cohortlens.llm.tokens")
packing = pytest.importorskip("cohortlens.llm.packing")
queries = pytest.importorskip("cohortlens.llm.queries")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokens.default_tokenizer())


def texts():
    rng = random.Random(5)
    bits = ["word", " the", "  ", "\n\n", "don't", "12345", "é", "　", "日本語", "<|endoftext|>", "x1y2", " ", "🙂", "a" * 40, "="]
    made = ["".join(rng.choices(bits, k=rng.randint(1, 60))) for _ in range(40)]
    return [None, "", " ", "<|endoftext|>", *made, "".join(rng.choices(bits, k=3000)), "nospace" * 400, "日本語" * 500, " ".join(f"w{i}" for i in range(2500))]


def count(library, text):
    return len(library.encode(text or "", add_special_tokens=False).ids)


def test_counts_equal_the_library(spark, library):
    rows = [(i, t, 1, "k") for i, t in enumerate(texts())]
    rows += [rows[-1], rows[-2], (None, "null id", 1, "k")]  # repeated huge rows, a null id
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int, seam string").repartition(3)
    # Small sizes, so that most texts are cut and seams without a stable place occur.
    out = tokens.count_tokens(df, huge=200, step=64, overlap=8).collect()
    expected = sorted((i is None, i or 0, len((t or "").encode()), count(library, t)) for i, t, _, _ in rows)
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_bytes"], r["n_tokens"]) for r in out) == expected
    assert all(r["over_limit"] == (r["n_tokens"] > 1024) and r["seam"] == "k" for r in out)


def test_counts_on_the_corpus(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    got = {r["doc_id"]: r["n_tokens"] for r in tokens.count_tokens(docs, huge=2000, step=1000, overlap=64).collect()}
    assert got == {r["doc_id"]: count(library, r["text"]) for r in docs.collect()}


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "piece_bpe_32k.model"])
def test_other_tokenizers(spark, name):
    import public_tokenizers

    path = public_tokenizers.path(name)
    rows = [(1, "Some plain text, twice. " * 3), (2, None)]
    got = {r["doc_id"]: r["n_tokens"] for r in tokens.count_tokens(spark.createDataFrame(rows, "doc_id long, text string"), tokenizer=path).collect()}
    if name.endswith(".json"):
        from tokenizers import Tokenizer

        wanted = len(Tokenizer.from_file(path).encode(rows[0][1], add_special_tokens=False).ids)
    else:
        import sentencepiece

        wanted = len(sentencepiece.SentencePieceProcessor(model_file=path).encode(rows[0][1]))
    assert got == {1: wanted, 2: 0}


def test_empty_tables(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert tokens.count_tokens(df).count() == 0
    assert packing.pack(packing.pieces(df)).count() == 0


def test_plan_holds_every_rank_once():
    rng = random.Random(1)
    for cap in (1, 7, 64, 2048):
        counts = {rng.randint(1, cap): rng.randint(1, 500) for _ in range(40)}
        used: dict[int, int] = {}
        for length, first, n, per, seq, offset in packing.plan(counts, cap):
            for i in range(n):
                at = (seq + i // per, offset + (i % per) * length)
                for place in range(at[1], at[1] + length):
                    assert place < cap and not used.get(at[0], 0) >> place & 1
                    used[at[0]] = used.get(at[0], 0) | 1 << place
            counts[length] -= n
        assert not any(counts.values())
        assert all(u & (u + 1) == 0 for u in used.values())  # gapless from 0


def test_pack(spark, library):
    rows = [(i, t) for i, t in enumerate(texts())]
    rows += [rows[5], rows[5], (None, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    out = packing.pack(packing.pieces(df, max_len=64), max_len=64).toPandas()
    ids = {i: [*library.encode(t or "", add_special_tokens=False).ids, 0] for i, t in rows}
    for r in out[out.doc_id.notna()].itertuples():
        own = ids[int(r.doc_id)][r.start:r.start + r.length]
        assert own == list(r.ids) and zlib.crc32(np.array(own, "<u4").tobytes()) == r.ids_crc32
        assert r.length <= 64 and (r.piece == 0 or r.length == 64)
    wanted = sum(len(ids[i]) for i, _ in rows)
    assert out.length.sum() == wanted
    out = out.sort_values(["sequence_id", "offset"])
    assert (out.offset == (out.offset + out.length).groupby(out.sequence_id).shift(1).fillna(0)).all()
    assert out.sequence_id.nunique() <= 1.1 * -(-wanted // 64) + 1


@pytest.mark.parametrize("white", [" ", "\n", "\t", " \n", " ", "　"])
def test_very_long_white_space(white):
    """The fast core's matcher has a bounded stack; such texts equal the library's ids too."""
    enc, own = tokens.encoder(tokens.default_tokenizer()), tokens.library(tokens.default_tokenizer())
    for text in (white * (1_000_000 // len(white)), "a" + white * (500_000 // len(white)) + "b c", "word " * 10 + white * 300_000):
        assert enc.ids(text).tolist() == own.encode(text, add_special_tokens=False).ids


def test_white_space_through_the_queries(spark, tmp_path):
    texts = {1: " " * 2_000_000, 2: "\n" * 2_000_000, 3: "\t" * 2_000_000, 4: "word " * 100 + " " * 1_000_000 + "\n" * 1_000_000 + " end of it", 5: "short"}
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    own = tokens.library(tokens.default_tokenizer())
    n = {i: len(own.encode(t, add_special_tokens=False).ids) for i, t in texts.items()}
    assert {r["doc_id"]: r["n_tokens"] for r in queries.op3_token_counts(spark, str(tmp_path)).collect()} == n
    packed = queries.op2_best_fit_packing(spark, str(tmp_path)).groupBy("doc_id").sum("length").collect()
    assert {r[0]: r[1] for r in packed} == {i: k + 1 for i, k in n.items()}
