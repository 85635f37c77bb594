"""Base spans against Python's regex, added spans on planted cases, redaction."""

import random
import re

import pytest
from pyspark.sql import functions as F

pii = pytest.importorskip("cohortlens.llm.pii")

PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(ds):
    total = 0
    for i, c in enumerate(reversed(ds)):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def valid(kind, s):
    ds = re.sub("[^0-9]", "", s)
    return {"email": lambda: True, "ip": lambda: all(int(x) <= 255 for x in s.split(".")), "card": lambda: 12 <= len(ds) <= 19 and luhn(ds),
            "phone": lambda: 9 <= len(ds) <= 15}[kind]()


def brute(text):
    out = [(m.start(), k, m.end()) for k, kind in enumerate(PLAIN) for m in re.finditer(PLAIN[kind], text or "") if valid(kind, m[0])]
    return sorted(out)


@pytest.fixture(scope="module")
def model(spark):
    return pii.fit(spark)


def texts():
    rng = random.Random(11)
    bits = list("0123456789") * 3 + [" ", "-", ".", "+", "@", "(", ")", "a", "b.c", "@x.y", "é", "𐀀", "  ", "1.2.3.4", "4111 1111 1111 1111", "+1 (555) 123-4567", "a@b.co", "00255.0.0.1", "256.1.1.1"]
    made = ["".join(rng.choices(bits, k=rng.randint(1, 80))) for _ in range(400)]
    return [None, "", *made, "a@b.c+d@e.f@g.h", "x" * 50_000 + "@y.z", "1 " * 20_000, "1.2.3.4.5.6.7.8", "𐀀 a@b.c", "+1((((" * 2000, "." * 5000, "5 -4111111111111111", "a@b..c a@b.c."]


def test_base_spans_equal_plain_patterns(spark, model):
    rows = [(i, t, "own") for i, t in enumerate(texts())] + [(1, "a@b.co", "own")] * 2
    out = pii.find(spark.createDataFrame(rows, "doc_id long, text string, pii string"), model).collect()
    assert len(out) == len(rows)
    for r in out:
        assert [(x["start"], x["k"], x["end"]) for x in r["pii"] if x["base"]] == brute(r["text"]), r["text"]


def test_compressed_addresses_and_national_phones(spark, model):
    planted = {"host 2001:db8::1 is": ("ip", "2001:db8::1"), "address fe80::a1b2:c3d4:12:9, and": ("ip", "fe80::a1b2:c3d4:12:9"),
               "tel 020 7946 0958.": ("phone", "020 7946 0958"), "call 01 23 45 67 89 now": ("phone", "01 23 45 67 89"), "phone: 0171-1234567, or": ("phone", "0171-1234567")}
    clean = ["call a::b(c)", "use std::abs and foo::bad here", "a :: b", "1::2::3", "on 01.02.2024 10:30"]
    df = spark.createDataFrame([(t,) for t in [*planted, *clean]], "text string")
    got = {r["text"]: [(pii.KINDS[x["k"]], r["text"][x["start"]:x["end"]]) for x in r["pii"]] for r in pii.find(df, model).collect()}
    assert got == {t: [p] for t, p in planted.items()} | {t: [] for t in clean}


def test_added_spans(spark, model):
    planted = {"call me on (123) 456-7890 now": "phone", "write to jo.doe[at]example.com thanks": "email", "her ssn 123-45-6789.": "ssn",
               "my iban DE44 5001 0517 5407 3249 31.": "iban"}
    clean = ["the sum 123 456 7890 999 units", "part 123-45-6789/12", "number 1234567890123456 of", "just words", "x = v1[at]f.g(y)"]
    df = spark.createDataFrame([(t,) for t in [*planted, *clean]], "text string")
    got = {r["text"]: [pii.KINDS[x["k"]] for x in r["pii"]] for r in pii.find(df, model).collect()}
    assert {t: got[t] for t in planted} == {t: [k] for t, k in planted.items()}
    assert not any(got[t] for t in clean)


def test_redaction_and_digest_string(spark, model):
    rows = [("mail a@b.co or +1 (555) 123-4567!",), ("𐀀 1.2.3.4 end",), ("nothing",), (None,), ("",)]
    out = pii.find(spark.createDataFrame(rows, "text string"), model)
    got = {r["text"]: (r["red"], r["s"]) for r in out.withColumn("red", pii.redact(F.col("text"), F.col("pii"))).withColumn("s", pii.as_string(F.col("pii"))).collect()}
    assert got[rows[0][0]] == ("mail [EMAIL] or [PHONE]!", "email:5:11,phone:15:32")
    assert got[rows[1][0]] == ("𐀀 [IP] end", "ip:2:9")
    assert got["nothing"] == ("nothing", "") and got[None] == (None, "") and got[""] == ("", "")


def test_empty_table_and_plan(spark, model):
    df = spark.createDataFrame([], "doc_id long, text string")
    out = pii.find(df, model)
    assert out.count() == 0
    assert not re.search("Python|Pandas|Arrow", out._jdf.queryExecution().executedPlan().toString())


def test_precision_on_templates_that_were_held_out(spark):
    got = {r["kind"]: r for r in pii.held_out(spark, n=2400).collect()}
    assert set(got) == set(pii.KINDS)
    assert all(r["precision"] is None or r["precision"] >= 0.9 for r in got.values())
    assert sum(r["recall"] * r["n_personal"] for r in got.values()) >= 0.6 * sum(r["n_personal"] for r in got.values())
