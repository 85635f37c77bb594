"""Archives: an exact round trip, both ARC versions, and hand-written records."""

import base64
import gzip
import hashlib

import pytest

warc = pytest.importorskip("cohortlens.llm.warc")


def sha(b):
    return base64.b32encode(hashlib.sha1(b).digest()).decode()


def test_round_trip(spark):
    bodies = [None, "", "<p>a</p>", "<p>a</p>", "é𐀀\r\n\r\nWARC/1.1\r\n\r\n", "\n\nhttp://x 0.0.0.0 2 t 5\n", "x" * 3_000_000, "", "<p>a</p>"]
    rows = [(i, "http://h/%d a\nb" % i if i % 2 else None, b, "own") for i, b in enumerate(bodies)] + [(8, "u", "<p>a</p>", "own"), (None, "u", "null id", "own"), (None, "u", "<p>a</p>", "own")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, rec string").repartition(3)
    out = warc.round_trip(df).collect()
    assert len(out) == len(rows)
    groups = {}
    for i, _, b, _ in rows:
        groups.setdefault((b or "").encode(), []).append(i)
    for r in out:
        body = next(b for b in groups if sha(b) == r["payload_digest"])
        assert r["payload_bytes"] == len(body)
        best = max((i for i in groups[body] if i is not None), default=None)
        if r["record_type"] == "response":
            assert r["page_id"] == best and r["refers_to"] is None
        else:
            assert r["refers_to"] == best
    for body, ids in groups.items():
        assert sum(r["record_type"] == "response" for r in out if r["payload_digest"] == sha(body)) == 1
        assert sorted(str(r["page_id"]) for r in out if r["payload_digest"] == sha(body)) == sorted(map(str, ids))


def test_least_bytes(spark):
    df = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcdef"), (4, "u", "abcdef")], "page_id long, url string, html string")
    got = {r["page_id"]: (r["record_type"], r["refers_to"]) for r in warc.round_trip(df, least_bytes=3).collect()}
    assert got == {1: ("response", None), 2: ("response", None), 3: ("revisit", 4), 4: ("response", None)}


@pytest.mark.parametrize("version", [1, 2])
def test_versions_and_converted_text(spark, tmp_path, version):
    df = spark.createDataFrame([(7, "http://h/a b", "body")], "page_id long, url string, html string").coalesce(1)
    warc.write_arc(df, f"{tmp_path}/arc", version)
    content = next((tmp_path / "arc").glob("part-*.gz")).read_bytes()
    assert gzip.decompress(content).split(b"\n")[1] == f"{version} 0 crawl".encode()
    ((rec, url, date, head, payload),) = warc.arc_records(content, "x.arc")
    assert (url, date, payload) == ("http://h/a%20b", warc.DATE, b"body") and head.startswith(b"HTTP/1.1 200")
    warc.convert(spark, f"{tmp_path}/arc", f"{tmp_path}/warc")
    (info, about), (fields, block) = sorted((x for p in (tmp_path / "warc").glob("part-*.gz") for x in warc.warc_records(p.read_bytes(), p.name)), key=lambda x: x[0]["WARC-Type"] == "response")
    assert info["WARC-Type"] == "warcinfo" and f"ARC version {version}".encode() in about and info["WARC-Filename"].endswith(".arc")
    assert block == head + payload and fields["WARC-Date"] == "2024-01-01T00:00:00Z" and fields["WARC-Type"] == "response"
    assert fields["WARC-Payload-Digest"] == "sha1:" + sha(b"body") and fields["WARC-Block-Digest"] == "sha1:" + sha(block)


def test_hand_written_arc_and_damage():
    body = b"HTTP/1.0 200 OK\r\nA: b\r\n\r\nhello\n"
    about = b"1 0 Me\n" + warc.FIELDS[1].encode() + b"\n"
    good = b"filedesc://x.arc 0.0.0.0 19990101000000 text/plain %d\n" % len(about) + about + b"\n" + b"http://a/ 1.2.3.4 19990102030405 text/html %d\n" % len(body) + body + b"\n"
    ((_, url, date, head, payload),) = warc.arc_records(gzip.compress(good), "x")
    assert (url, date, head + payload, payload) == ("http://a/", "19990102030405", body, b"hello\n")
    for bad in (good[:-4], good.replace(b"1 0 Me", b"9 0 Me")):
        with pytest.raises(ValueError):
            list(warc.arc_records(gzip.compress(bad), "x"))


def _arc(version, records, packed):
    """A foreign archive: records are (url, address, date, type, body)."""
    about = b"%d 0 Elsewhere\n" % version + warc.FIELDS[version].encode() + b"\n<meta>more about it</meta>\n"
    middle = b"" if version == 1 else b"200 - - 0 x.arc "
    rows = [(b"filedesc://x.arc", b"0.0.0.0", b"19980203040506", b"text/plain", about), *records]
    parts = [b"%s %s %s %s %s%d\n" % (u, a, d, t, middle, len(b)) + b + b"\n" for u, a, d, t, b in rows]
    return b"".join(map(gzip.compress, parts)) if packed else b"".join(parts)


@pytest.mark.parametrize("version,packed", [(1, True), (2, False)])
def test_foreign_archives(spark, tmp_path, version, packed):
    latin, binary = "caf\xe9 \xa3".encode("latin-1"), bytes(range(256)) * 40
    records = [
        (b"http://a.example/x", b"10.1.2.3", b"19990102030405", b"text/html", b"HTTP/1.0 200 OK\r\nContent-Type: text/html; charset=iso-8859-1\r\n\r\n" + latin),
        (b"http://a.example/image", b"10.1.2.4", b"19990102030406", b"image/gif", b"HTTP/1.1 200 OK\nA: b\n\n" + binary),
        (b"http://a.example/with some spaces", b"10.1.2.5", b"19990102030407", b"text/plain", b"HTTP/1.0 200 OK\n\n"),
        (b"http://a.example/caf\xe9", b"10.1.2.6", b"19990102030408", b"text/html", b"HTTP/1.0 204 No\r\nB: c\r\n\r\n\n\nhttp://x 1.1.1.1 2 t 5\n\x00"),
        (b"dns:a.example", b"10.9.9.9", b"19990102030409", b"text/dns", b"19990102030409\na.example. 3600 IN A 10.1.2.3\n"),
        (b"http://b.example/copy", b"10.1.2.7", b"19990102030410", b"image/gif", b"HTTP/1.0 200 OK\r\n\r\n" + binary),
        (b"http://b.example/no-head", b"10.1.2.8", b"19990102030411", b"application/x-thing", b"no head at all \xff"),
    ]
    (tmp_path / "arc").mkdir()
    (tmp_path / "arc" / ("x.arc.gz" if packed else "x.arc")).write_bytes(_arc(version, records, packed))
    warc.convert(spark, f"{tmp_path}/arc", f"{tmp_path}/warc")
    got = {f.get("WARC-Target-URI", "info"): (f, b) for p in (tmp_path / "warc").glob("part-*") for f, b in warc.warc_records(p.read_bytes(), p.name)}
    assert len(got) == len(records) + 1 and got["info"][0]["WARC-Type"] == "warcinfo" and got["info"][0]["WARC-Date"] == "1998-02-03T04:05:06Z"
    uris = {"http://a.example/with%20some%20spaces": 2, "http://a.example/caf%E9": 3, "dns:a.example": 4, "http://a.example/x": 0, "http://b.example/no-head": 6}
    for uri, k in uris.items():
        fields, block = got[uri]
        assert block == records[k][4] and fields["WARC-IP-Address"] == records[k][1].decode()
        assert fields["WARC-Date"].replace("-", "").replace(":", "").replace("T", "").rstrip("Z") == records[k][2].decode()
        assert fields["WARC-Block-Digest"] == "sha1:" + sha(block)
        plain = k in (4, 6)
        assert fields["WARC-Type"] == ("resource" if plain else "response") and fields["Content-Type"] == (records[k][3].decode() if plain else warc.HTTP)
    pair = [got["http://a.example/image"], got["http://b.example/copy"]]
    assert sorted(f["WARC-Type"] for f, _ in pair) == ["response", "revisit"] and {f["WARC-Payload-Digest"] for f, _ in pair} == {"sha1:" + sha(binary)}
    whole = next((f, b) for f, b in pair if f["WARC-Type"] == "response")
    assert whole[1].endswith(binary) and next(f for f, _ in pair if f["WARC-Type"] == "revisit")["WARC-Refers-To"] == whole[0]["WARC-Record-ID"]
    types = {r["record_type"] for r in warc.read_warc(spark, f"{tmp_path}/warc").collect()}
    assert types == {"response", "resource", "revisit"}


def test_empty_table(spark):
    assert warc.round_trip(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
