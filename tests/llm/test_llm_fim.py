"""Fill-in-the-middle against plain slicing, and the way back."""

import hashlib

import pytest
from pyspark.sql import functions as F

fim = pytest.importorskip("cohortlens.llm.fim")
queries = pytest.importorskip("cohortlens.llm.queries")

SCHEMA = "doc_id long, text string, fim string, n int, output string"
TEXTS = ["", None, "a", "é", "\U0001F600́\r\n x", "has <P> in it", "<S>", "<M", "<P", "a<", "P>", "\n" * 50, " \t " * 9, "x" * 700_000 + "é", "word " * 3000, "a b\x0bc\x00d"]


def expected(doc, text):
    t = text or ""
    h = hashlib.sha256(f"1:{'' if doc is None else doc}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i:8 * i + 8], 16) for i in range(4))
    a, b = sorted((h1 % (len(t) + 1), h2 % (len(t) + 1)))
    if not t or any(s in t for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return (doc, len(t), "plain", None, None, t)
    if h4 % 100 < 20:
        return (doc, len(t), "spm", a, b - a, f"<S>{t[b:]}<P>{t[:a]}<M>{t[a:b]}")
    return (doc, len(t), "psm", a, b - a, f"<P>{t[:a]}<S>{t[b:]}<M>{t[a:b]}")


def test_equals_slicing_and_comes_back(spark):
    rows = [(i, TEXTS[i % len(TEXTS)]) for i in range(20 * len(TEXTS)) if i < 60 or i % len(TEXTS) != 13] + [(5, "again"), (5, "again"), (None, "no id")]
    df = spark.createDataFrame([(*r, "own", 1, "o") for r in rows], SCHEMA).repartition(3)
    out = fim.transform(df, to="cut").withColumn("back", fim.restore(F.col("cut.output"), F.col("cut.form")))
    assert out.columns == ["doc_id", "text", "fim", "n", "output", "cut", "back"]
    got = out.collect()
    key = lambda r: tuple(map(str, r))
    assert sorted([(r["doc_id"], r["cut"]["n"], r["cut"]["form"], r["cut"]["prefix_chars"], r["cut"]["middle_chars"], r["cut"]["output"]) for r in got], key=key) == sorted([expected(*r) for r in rows], key=key)
    assert all(r["back"] == (r["text"] or "") for r in got)
    assert {r["cut"]["form"] for r in got} == {"plain", "psm", "spm"}


@pytest.mark.parametrize("unit", ["char", "word", "line"])
def test_units_cover_any_text(unit, monkeypatch):
    for t in [*TEXTS, "a b\n\nc  d\n", "\n", " lead", "trail  "]:
        t = t or ""
        whole = list(fim.ends(t, fim.UNITS[unit]))
        assert whole == sorted(set(whole)) and (whole[-1] if whole else 0) == len(t)
        with monkeypatch.context() as m:
            m.setattr(fim, "WINDOW", 5)  # in runs
            assert list(fim.ends(t[:4000], fim.UNITS[unit])) == (whole if len(t) <= 4000 else list(fim.ends(t[:4000], fim.UNITS[unit])))
    assert list(fim.ends(" a b \nc", fim.UNITS["word"])) == [3, 6, 7]
    assert list(fim.ends("x\n\ny", fim.UNITS["line"])) == [2, 3, 4]


def test_words_and_lines_come_back(spark):
    df = spark.createDataFrame([(i, " one two\nthree  \n\n four" * (i % 5)) for i in range(200)], "doc_id long, text string")
    for unit in ("word", "line"):
        out = fim.transform(df, unit=unit, seed=7).withColumn("back", fim.restore(F.col("fim.output"), F.col("fim.form")))
        assert out.where("back != text").count() == 0 and out.where("fim.form != 'plain'").count() > 50
        if unit == "line":  # cuts stand at line starts
            part = F.substring(F.col("text"), F.lit(1), F.col("fim.prefix_chars").cast("int"))
            assert out.where("fim.form != 'plain' and fim.prefix_chars > 0 and fim.prefix_chars < length(text)").where(~part.endswith("\n")).count() == 0


def test_query_columns_and_empty(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    out = queries.op13_fill_in_middle(spark, str(tmp_path))
    assert out.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"] and out.count() == 0
