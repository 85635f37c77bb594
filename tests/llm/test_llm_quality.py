"""Quality ledger against brute force, and its edge cases."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

quality = pytest.importorskip("cohortlens.llm.quality")

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    w = WORD.findall(text or "")
    counts = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    covered = {k for i in range(len(w) - 7) if counts[tuple(w[i:i + 8])] > 1 for k in range(i, i + 8)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered))


def texts():
    rng = random.Random(3)
    words = ["a", "bb", "Ünïcode", "x|y", "#", "dé jà", "\x1c", "ok!"]
    made = [" ".join(rng.choices(words[: rng.randint(1, 8)], k=rng.randint(0, 80))) + "\n" * rng.randint(0, 2) for _ in range(60)]
    made += ["\n".join(rng.choices(["same line", "other", " ", ""], k=9)) for _ in range(10)]
    return [None, "", " \n\t\x0b\x0c\r", "one", "w " * 8, "w " * 16, "a b c d e f g h " * 2, "x" * 300_000, *made]


def test_measures_equal_brute_force(spark):
    rows = [(i, t, "keep", 7) for i, t in enumerate(texts())] + [(3, "one", "keep", 7)]  # a repeated row
    df = spark.createDataFrame(rows, "doc_id long, text string, n_words string, kept int")  # clashing names
    out = quality.ledger(df.repartition(3)).collect()
    assert len(out) == len(rows)
    for r in out:
        got = tuple(r["ledger"][m] for m in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))
        assert got == brute(r["text"]), r["text"]
        assert (r["n_words"], r["kept"]) == ("keep", 7)
        base = got[0] < 20 or 100 * got[4] > 30 * got[0]
        assert bool(r["ledger"]["fail_bits"] & quality.mask(quality.BASE)) == base


def test_policies_and_ablations(spark):
    prose = " ".join(f"word{i}" for i in range(40))
    rows = [(1, prose), (2, prose + " $$$$ %%%% ####" * 20), (3, prose.upper() + " MORE"), (4, "short"), (5, None)]
    led = quality.ledger(spark.createDataFrame(rows, "doc_id long, text string")).cache()
    kept = {p: {r["doc_id"] for r in led.where(quality.passes("ledger.fail_bits", p)).collect()} for p in quality.POLICIES}
    assert kept == {"base": {1, 3} | kept["base"] & {2}, "v1": {1}, "v2": {1}}
    table = {r["rule"]: (r["n_failed"], r["n_only"]) for r in quality.ablations(led, "v2").collect()}
    bits = {r["doc_id"]: r["ledger"]["fail_bits"] for r in led.collect()}
    for rule, bit in quality.BIT.items():
        assert table[rule] == (sum(bool(b & bit) for b in bits.values()), sum(b == bit for b in bits.values()))


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert quality.ledger(df).count() == 0
    assert quality.ablations(quality.ledger(df)).count() == 0


def test_clean_documents_of_the_corpus_stay(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    led = quality.ledger(docs).join(labels, "doc_id").where("quality = 1 and ledger.n_words >= 20")
    lost = led.where(~quality.passes("ledger.fail_bits", "v2")).select(F.col("ledger.fail_bits")).collect()
    assert not [r for r in lost if not r[0] & quality.mask(quality.BASE)]
