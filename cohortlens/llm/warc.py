"""Legacy archive converter: ARC (versions 1 and 2) to WARC, and both formats' writers and readers.

Archives are files that Spark's text writer makes, one per task: a record is one value and the
writer's line separator is the format's record end ("\\n" in ARC, a blank line pair in WARC), gzip-compressed.
Readers go by declared lengths alone, since payloads may hold any separator: they stream a file through
a buffered gzip reader, so a task holds one compressed file and one record.

Conversion: an ARC file, compressed or not, starts with a version block whose definition line names the fields of all header
lines that follow; it becomes a ``warcinfo`` record. Each record's header line, read from its right end (a url may hold
spaces), and declared length give url, address, 14-digit date, type and body; from these come the WARC record id (from
archive and number), ISO date, type, block and payload digests (base32 SHA-1). A body with an HTTP head (its lines may end in
bare line feeds) is a ``response``, any other (``dns:`` records, say) a ``resource`` of the type that the line tells. Of records with
equal payloads the one with the largest page id stays, the others are ``revisit`` records that refer to it. Bodies are bytes
from end to end, in any encoding or none.

Defined results: null html is an empty payload; a null url is written as ``-``; white space in a url is percent-encoded
in header lines; a null page id stays null and counts as smallest; repeated rows are records of their own (ties go to one
of them); an empty table gives archives without records. Only the id, url and html columns are used.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import os
import re
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.session import materialize, scratch_folder

DATE, ADDRESS = "20240101000000", "0.0.0.0"
BATCH_BYTES = 4 << 20
#: The field names of ARC header lines by version. Fixed values of the format.
FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
RECORD_END = "\r\n\r\n"
HEAD_END = re.compile(rb"\n\r?\n")
INFO, HTTP = "filedesc://", "application/http; msgtype=response"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _arc_line(version: int, url: str, kind: str, length: int, name: str) -> str:
    middle = [] if version == 1 else ["200", "-", "-", "0", name]
    return " ".join([url, ADDRESS, DATE, kind, *middle, str(length)])


def _arc_records(version: int | None):
    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part = TaskContext.get().partitionId()
        v, name = version or 1 + part % 2, f"part-{part:05d}.arc"
        about = f"{v} 0 crawl\n{FIELDS[v]}\n"
        yield pd.DataFrame({"value": [f"{_arc_line(v, 'filedesc://' + name, 'text/plain', len(about), name)}\n{about}"]})
        for batch in batches:
            out, size = [], 0
            for page, url, html in zip(batch["page_id"], batch["url"], batch["html"], strict=True):
                line = re.sub(r"[\s\x00-\x20]", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), url) if isinstance(url, str) and url else "-"
                own = "" if pd.isna(page) else f"X-Page-Id: {int(page)}\r\n"
                head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{own}\r\n"
                body = html if isinstance(html, str) else ""
                length = len(head) + len(body.encode("utf-8", "surrogatepass"))
                out.append(f"{_arc_line(v, line, 'text/html', length, name)}\n{head}{body}")
                size += length
                if size >= BATCH_BYTES:
                    yield pd.DataFrame({"value": out})
                    out, size = [], 0
            yield pd.DataFrame({"value": out}, dtype=object)
    return write


def write_arc(pages: DataFrame, path: str, version: int | None = None, id_col: str = "page_id", url: str = "url", html: str = "html") -> None:
    """One ARC file per task at ``path``; version 1 or 2, or (None) both in turn."""
    rows = pages.select(F.col(id_col).cast("string").alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"))
    rows.mapInPandas(_arc_records(version), "value string").write.option("lineSep", "\n").option("compression", "gzip").text(path)


def _opened(content: bytes) -> io.BufferedReader:
    """A buffered stream of an archive, compressed (as a whole or record by record) or plain."""
    raw = io.BytesIO(content)
    return io.BufferedReader(gzip.GzipFile(fileobj=raw) if content[:2] == b"\x1f\x8b" else raw, 1 << 20)


def _text(field: bytes) -> str:
    """A header field as text; bytes that are no UTF-8, and white space and controls, are percent-encoded."""
    try:
        out = field.decode("utf-8")
    except UnicodeDecodeError:
        out = "".join(chr(b) if b < 128 else f"%{b:02X}" for b in field)
    return re.sub(r"[\s\x00-\x20\x7f]", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), out)


def head_end(block: bytes) -> int:
    """Where the HTTP head of a block ends; 0 if it has none."""
    if not block.startswith(b"HTTP/"):
        return 0
    found = HEAD_END.search(block)
    return found.end() if found else len(block)


def record_id(name: str, k: int | str) -> str:
    return str(uuid.UUID(bytes=hashlib.md5(f"{name}#{k}".encode()).digest()))


def arc_entries(content: bytes, name: str) -> Iterator[tuple[str, dict[str, str], bytes, bytes]]:
    """(record id, header fields, HTTP head, payload) of every record of an ARC file. The version block comes first, with
    its version and definition line as payload."""
    with _opened(content) as f:
        line = f.readline().split()
        body = f.read(int(line[-1])).split(b"\n")
        version, names = int(body[0].split()[0]), body[1].decode("ascii", "replace").split()
        if version not in FIELDS or names != FIELDS[version].split():
            raise ValueError(f"{name}: unknown ARC version block {body[:2]}")
        yield record_id(name, "info"), {"URL": _text(line[0]), "IP-address": _text(line[1]), "Archive-date": _text(line[2]), "Content-type": "application/warc-fields"}, b"", (
            f"format: WARC File Format 1.1\r\nconverted-from: ARC version {version}\r\narc-fields: {' '.join(names)}\r\n".encode())
        k = 0
        while header := f.readline():
            if not header.strip():  # the end of a record
                continue
            fields = dict(zip(names, map(_text, header.rstrip(b"\r\n").rsplit(b" ", len(names) - 1)), strict=True))
            block = f.read(int(fields["Archive-length"]))
            if len(block) != int(fields["Archive-length"]):
                raise ValueError(f"{name}: record {k} does not have its declared length")
            end = head_end(block)
            yield record_id(name, k), fields, block[:end], block[end:]
            k += 1


def arc_records(content: bytes, name: str) -> Iterator[tuple[str, str, str, bytes, bytes]]:
    """(record id, url, 14-digit date, HTTP head, payload) of every record after the version block."""
    for rec, fields, head, payload in arc_entries(content, name):
        if not fields["URL"].startswith(INFO):
            yield rec, fields["URL"], fields["Archive-date"], head, payload


def _page_id(head: bytes) -> int | None:
    found = re.search(rb"\nX-Page-Id: (-?\d+)\r?\n", head)
    return int(found[1]) if found else None


def _read(records, columns: list[str]):
    """A reader of binary files: batches of the tuples that ``records(content, name)`` makes."""
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"], strict=True):
                out, size = [], 0
                for row in records(content, os.path.basename(path)):
                    out.append(row)
                    size += sum(len(x) for x in row if isinstance(x, (str, bytes)))
                    if size >= BATCH_BYTES or len(out) >= 8192:
                        yield _frame(out, columns)
                        out, size = [], 0
                yield _frame(out, columns)
    return read


def _frame(rows: list, columns: list[str]) -> pd.DataFrame:
    df = pd.DataFrame(rows, columns=columns)
    return df.astype({c: "Int64" for c in columns if c in ("page_id", "payload_bytes")})


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", "content")


def _arc_index(content: bytes, name: str):
    for rec, _, _, head, payload in arc_records(content, name):
        yield rec, _page_id(head), digest(payload), len(payload)


def _arc_full(content: bytes, name: str):
    for rec, fields, head, payload in arc_entries(content, name):
        d, info = fields["Archive-date"], fields["URL"].startswith(INFO)
        iso = f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"
        kind, mime = ("warcinfo", fields["Content-type"]) if info else ("response", HTTP) if head else ("resource", fields["Content-type"])
        about = [f"WARC-Record-ID: <urn:uuid:{rec}>", f"WARC-Date: {iso}"]
        about += [f"WARC-Filename: {fields['URL'].removeprefix(INFO)}"] if info else [
            f"WARC-Target-URI: {fields['URL']}", f"WARC-IP-Address: {fields['IP-address']}", f"WARC-Payload-Digest: sha1:{digest(payload)}"]
        yield rec, kind, "\r\n".join([*about, f"Content-Type: {mime}"]), head, payload, digest(head + payload), digest(head)


def convert(spark: SparkSession, arc: str, warc: str, least_bytes: int = 0) -> None:
    """The ARC files at ``arc`` as WARC files at ``warc``. Payloads of under ``least_bytes`` are never revisits."""
    index = materialize(_files(spark, arc).mapInPandas(_read(_arc_index, ["rec", "page_id", "digest", "payload_bytes"]),
                                                       "rec string, page_id long, digest string, payload_bytes long"), "arc-index")
    first = index.where(F.col("payload_bytes") >= least_bytes).groupBy("digest").agg(
        F.max(F.struct(F.coalesce("page_id", F.lit(-(1 << 63))), "rec")).alias("first")).select("digest", F.col("first.rec").alias("refers_to"))
    revisits = index.where(F.col("payload_bytes") >= least_bytes).join(first, "digest").where("rec != refers_to").select("rec", "refers_to")
    full = _files(spark, arc).mapInPandas(_read(_arc_full, ["rec", "kind", "about", "head", "payload", "full_digest", "head_digest"]),
                                          "rec string, kind string, about string, head binary, payload binary, full_digest string, head_digest string")
    rows = full.join(revisits, "rec", "left")
    again = F.col("refers_to").isNotNull()
    block = F.when(again, F.col("head")).otherwise(F.concat("head", "payload"))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    header = F.concat(
        F.lit("WARC/1.1\r\n"), line("WARC-Type", F.when(again, "revisit").otherwise(F.col("kind"))), "about", F.lit("\r\n"),
        line("WARC-Block-Digest", F.concat(F.lit("sha1:"), F.when(again, F.col("head_digest")).otherwise(F.col("full_digest")))),
        F.when(again, F.concat(line("WARC-Profile", F.lit(PROFILE)), line("WARC-Refers-To", F.concat(F.lit("<urn:uuid:"), "refers_to", F.lit(">"))))).otherwise(""),
        line("Content-Length", F.octet_length(block).cast("string")), F.lit("\r\n"))
    # The cast keeps the bytes as they are, and the text writer writes them so.
    record = F.concat(header.cast("binary"), block).cast("string")
    rows.select(record.alias("value")).write.option("lineSep", RECORD_END).option("compression", "gzip").text(warc)


def warc_records(content: bytes, name: str) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, block) of every record of a WARC file."""
    with _opened(content) as f:
        while version := f.readline():
            if not version.startswith(b"WARC/"):
                raise ValueError(f"{name}: no WARC record at {version[:40]!r}")
            fields = {}
            while (line := f.readline()) not in (b"\r\n", b""):
                key, _, value = line.decode().rstrip("\r\n").partition(": ")
                fields[key] = value
            block = f.read(int(fields["Content-Length"]))
            if len(block) != int(fields["Content-Length"]) or f.read(4) != b"\r\n\r\n":
                raise ValueError(f"{name}: a record does not have its declared length")
            yield fields, block


def _warc_index(content: bytes, name: str):
    for fields, block in warc_records(content, name):
        if fields["WARC-Type"] == "warcinfo":
            continue
        end = head_end(block)
        told = fields["WARC-Payload-Digest"].removeprefix("sha1:")
        again = fields["WARC-Type"] == "revisit"
        if not again and digest(block[end:]) != told:
            raise ValueError(f"{name}: payload digest of {fields['WARC-Record-ID']} does not fit")
        yield (fields["WARC-Record-ID"][10:-1], _page_id(block[:end]), told, None if again else len(block) - end, fields["WARC-Type"],
               fields["WARC-Refers-To"][10:-1] if again else None)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to (page id) of every record but ``warcinfo``; digests are checked."""
    columns = ["rec", "page_id", "payload_digest", "payload_bytes", "record_type", "refers_rec"]
    index = materialize(_files(spark, path).mapInPandas(_read(_warc_index, columns),
                                                        "rec string, page_id long, payload_digest string, payload_bytes long, record_type string, refers_rec string"), "warc-index")
    own = index.where("record_type != 'revisit'").select("page_id", "payload_bytes", "payload_digest", "record_type", F.lit(None).cast("long").alias("refers_to"))
    target = index.where("record_type != 'revisit'").select(F.col("rec").alias("refers_rec"), F.col("page_id").alias("refers_to"), F.col("payload_bytes").alias("n"))
    again = index.where("record_type = 'revisit'").join(target, "refers_rec", "left").select(
        "page_id", F.col("n").alias("payload_bytes"), "payload_digest", "record_type", "refers_to")
    return own.unionByName(again)


def round_trip(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Pages as ARC files, these as WARC files, and what these hold. Both folders lie in the application's scratch folder."""
    spark = pages.sparkSession
    base = f"{scratch_folder(spark)}/archives-{uuid.uuid4().hex}"
    write_arc(pages, f"{base}/arc")
    convert(spark, f"{base}/arc", f"{base}/warc", least_bytes)
    return read_warc(spark, f"{base}/warc")
