"""URL rules against brute force, reputation on planted hosts."""

import re

import pytest
from pyspark.sql import functions as F

urls = pytest.importorskip("cohortlens.llm.urls")

AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(url):
    if not url or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = host.translate(AZ)
    fit = [(len(r), r, v) for r, v in urls.RULES if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith(r[r.index("/"):])]
    return (host, path, *(max(fit)[1:] if fit else (None, None)))


URLS = [None, "", "no scheme", "http://", "http://NET/", "http://net", "https://a.net/x", "https://anet/x", "https://example.net/en/", "https://www.Example.NET/en/a?b#c",
        "https://example.net/en", "http://example.com/de/x", "http://badexample.com/de/x", "http://x.org/fr/#", "http://x.org?/fr/", "http://É.org/fr/é", "a://b://c/d",
        "http://x.com\n/y\nz", "x" * 5000 + "://h.com/p", "http://u:p@h.com:80/q"]


def test_rules_equal_brute_force(spark):
    rows = [(i, u, "own", 3) for i, u in enumerate(URLS)] + [(6, URLS[6], "own", 3), (None, "http://x.org/fr/a", "own", 3)]
    df = spark.createDataFrame(rows, "page_id long, url string, n string, bad int")
    none = spark.createDataFrame([], "page_id long, bad boolean")
    out = urls.judge(df, none).collect()
    assert len(out) == len(rows)
    for r in out:
        host, path, rule, verdict = brute(r["url"])
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == (host, path, rule, verdict or "allow"), r["url"]
        assert r["n"] == "own" and r["bad"] == 3


def test_reputation_blocks_bad_hosts_and_shrinks(spark):
    pages, bad = [], []
    for h, n, wrong in (("spam.evil.com", 80, 78), ("fine.evil.com", 80, 3), ("new.evil.com", 1, 1), *[(f"h{i}.good{i % 7}.com", 40, 2) for i in range(30)]):
        for k in range(n):
            pages.append((len(pages), f"http://{h}/{k}"))
            bad.append((len(pages) - 1, k < wrong))
    pages.append((len(pages), "http://unseen.good1.com/"))
    df = spark.createDataFrame(pages, "page_id long, url string")
    outcomes = spark.createDataFrame(bad + bad[:5] + [(0, None), (10**6, True)], "page_id long, bad boolean")
    got = {r["host"]: r for r in urls.judge(df, outcomes).collect()}
    assert {h for h, r in got.items() if r["verdict"] == "block"} == {"spam.evil.com"}
    assert got["new.evil.com"]["bad_rate"] < 0.9 and got["unseen.good1.com"]["bad_rate"] < 0.2
    assert all(r["bad_bound"] < r["bad_rate"] for r in got.values())


def test_empty_table(spark):
    df = spark.createDataFrame([], "page_id long, url string")
    assert urls.judge(df, spark.createDataFrame([], "page_id long, bad boolean")).count() == 0


def test_domains_without_port_and_user_info(spark):
    hosts = {"h.com:8080": ("h.com", "com"), "a.b.h.com": ("h.com", "com"), "me:pw@x.h.co.uk:1": ("h.co.uk", "co.uk"), "192.168.0.1": ("192.168.0.1", "192.168.0.1"),
             "192.168.0.1:80": ("192.168.0.1", "192.168.0.1"), "[::1]:80": ("[::1]", "[::1]"), "localhost": ("localhost", "localhost"), "1.2.3.example.org": ("example.org", "org")}
    df = spark.createDataFrame([(h,) for h in hosts], "host string")
    domain, suffix = urls.registered(F.col("host"))
    assert {r["host"]: (r["d"], r["s"]) for r in df.select("host", domain.alias("d"), suffix.alias("s")).collect()} == hosts
