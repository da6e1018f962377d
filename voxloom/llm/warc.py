"""Legacy archive converter: ARC files in, WARC files out, and readers for both.

An ARC file starts with a ``filedesc`` record whose body names the version and so the
fields of every later header line: version 1 has URL, IP, date, type and length; version 2
has result code, checksum, location, offset and file name between type and length. The
reader takes each record by the declared length. The converter gives it a
deterministic WARC-Record-ID (a name-based UUID of URL, date, place and payload digest), an
ISO timestamp, a type, and SHA-1 digests of block and payload. Of records with equal
payloads, the preferred one is a ``response``; the others become ``revisit`` records that
refer to it and keep only the HTTP header, as the identical-payload-digest profile says.

Files are written by Spark's own writer into the shared folder; a record's
closing blank lines are the writer's line separator. They are gzipped as whole files, and read whole, so their bytes are bounded: records are written by
classes of size (``CLASSES``), the larger the fewer to a file. Bodies are bytes throughout,
whatever their encoding. The converter reads the archives twice: for digests and header lines, of which it decides who refers
to whom, and for the records, which it writes where it reads them. Who refers to whom is broadcast to the files, in groups of files whose lists have a measured size within
``LISTS_BYTES``, so that payloads aren't shuffled; only beyond ``GROUPS`` such groups are lists and files joined by a shuffle.

Defined results: null payloads are empty; a null URL is written as ``-`` and white space and control
characters in URLs as percent escapes; an empty table writes no record; repeated rows are
records of their own, of which one (the first by file and place) is the response.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voxloom.llm.common import RESULT_ROWS, compact, discard, materialise, remove, table, work_dir

#: Header fields of the two ARC versions, as the filedesc body lists them.
ARC_FIELDS = {
    1: ("URL", "IP-address", "Archive-date", "Content-type", "Archive-length"),
    2: ("URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset", "Filename", "Archive-length"),
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Rows of a file, which is read as a whole.
RECORDS = 5000
#: (bytes of a record at most, records of a file) by class of size: 256 MB a file, or one record.
CLASSES = ((52_000, RECORDS), (1 << 20, 256), (16 << 20, 16), (None, 1))
#: Bytes of the lists of revisits that are broadcast at a time, and how many times at most.
LISTS_BYTES, GROUPS = 64 << 20, 16
_UNSAFE = re.compile(r"[\x00-\x20\x7f]")


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data, usedforsecurity=False).digest()).decode()


def arc_header(version: int, url: str, ip: str, date: str, mime: str, length: int, code: int = 200, checksum: str = "-", name: str = "-") -> str:
    url = _UNSAFE.sub(lambda m: f"%{ord(m[0]):02X}", url) or "-"
    rest = (str(code), checksum, "-", "0", name) if version == 2 else ()
    return " ".join((url, ip, date, mime, *rest, str(length)))


def arc_filedesc(version: int, name: str, date: str) -> str:
    """The first record of an ARC file, without the line break behind it."""
    body = f"{version} 0 voxloom\n{' '.join(ARC_FIELDS[version])}\n"
    return f"{arc_header(version, 'filedesc://' + name, '0.0.0.0', date, 'text/plain', len(body.encode()), name=name)}\n{body}"


def parse_arc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, body) of each record but the filedesc; fields by the version that it declares."""
    at, fields = 0, None
    while at < len(data):
        if data[at : at + 1] in b"\r\n":
            at += 1
            continue
        end = data.index(b"\n", at)
        line = data[at:end].decode("utf-8", "replace").rstrip("\r")
        parts = line.split(" ")
        length = int(parts[-1])
        body = data[end + 1 : end + 1 + length]
        if len(body) < length:
            raise ValueError(f"the record at byte {at} declares {length} bytes; {len(body)} are there")
        at = end + 1 + length
        if fields is None:
            if not line.startswith("filedesc://"):
                raise ValueError("an ARC file starts with a filedesc record")
            version = int(body.split(b" ", 1)[0])
            if version not in ARC_FIELDS:
                raise ValueError(f"unknown ARC version {version}")
            fields = ARC_FIELDS[version]
            continue
        if len(parts) != len(fields):
            raise ValueError(f"the header at byte {end - len(line)} has {len(parts)} fields; its version has {len(fields)}")
        yield dict(zip(fields, parts, strict=True)), body


def split_http(body: bytes) -> tuple[bytes, bytes]:
    """HTTP header with its blank line, payload; a body without such a header is all payload."""
    if body.startswith(b"HTTP/") and (at := body.find(b"\r\n\r\n")) >= 0:
        return body[: at + 4], body[at + 4 :]
    return b"", body


def iso(date: str) -> str:
    d = (date + "00000101000000"[len(date) :])[:14]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def record_id(*parts: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, chr(10).join(parts))}>"


def warc_record(kind: str, rid: str, uri: str, date: str, http: bytes, payload: bytes, payload_digest: str, refers_to: str | None, ip: str) -> bytes:
    """A record up to, without, its two closing line breaks."""
    block = http if kind == "revisit" else http + payload
    head = {
        "WARC-Type": kind,
        "WARC-Record-ID": rid,
        "WARC-Date": date,
        "WARC-Target-URI": uri,
        "WARC-IP-Address": ip,
        "WARC-Payload-Digest": f"sha1:{payload_digest}",
        "WARC-Block-Digest": f"sha1:{sha1_base32(block)}",
    }
    if kind == "revisit":
        head |= {"WARC-Refers-To": refers_to or "", "WARC-Profile": REVISIT_PROFILE}
    head |= {"Content-Type": "application/http; msgtype=response", "Content-Length": str(len(block))}
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head.items()) + "\r\n").encode("utf-8", "surrogateescape") + block


def parse_warc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, block) of each record, by the declared lengths; block digests are verified."""
    at = 0
    while at < len(data):
        if data[at : at + 1] in b"\r\n":
            at += 1
            continue
        end = data.index(b"\r\n\r\n", at)
        first, *lines = data[at:end].decode("utf-8", "surrogateescape").split("\r\n")
        if not first.startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        head = dict(x.split(": ", 1) for x in lines)
        block = data[end + 4 : end + 4 + int(head["Content-Length"])]
        at = end + 4 + len(block)
        if head.get("WARC-Block-Digest", "").removeprefix("sha1:") != sha1_base32(block):
            raise ValueError(f"the block of {head['WARC-Record-ID']} doesn't have its digest")
        yield head, block


def _class_of(size: Column) -> Column:
    """Number of the class of a record of so many bytes."""
    out = F.lit(len(CLASSES) - 1)
    for i in reversed(range(len(CLASSES) - 1)):
        out = F.when(size <= CLASSES[i][0], i).otherwise(out)
    return out


def write_arc(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", payload: str = "html", version: int = 2, date: str = "20200101000000") -> None:
    """Writes pages as gzipped ARC files; the key goes into the HTTP header. A file of small records also takes up to RECORDS of them; larger ones have files of their own."""

    def lines(batches: Iterator[pd.DataFrame], most: int) -> Iterator[pd.DataFrame]:
        n_rows = 0
        for pdf in batches:
            out = []
            for k, u, p in zip(pdf["k"], pdf["u"], pdf["p"], strict=True):
                if n_rows % most == 0:  # a new file
                    out.append(arc_filedesc(version, "pages.arc", date).encode())
                    n_rows += 1
                body = bytes(p) if p is not None else b""
                http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nX-Page-Key: {k or ''}\r\nContent-Length: {len(body)}\r\n\r\n".encode()
                out.append(f"{arc_header(version, u or '', '0.0.0.0', date, 'text/html', len(http) + len(body), name='pages.arc')}\n".encode() + http + body)
                n_rows += 1
            yield pd.DataFrame({"value": out}, dtype=object)

    cols = compact(pages).select(F.col(f"`{key}`").cast("string").alias("k"), F.col(f"`{url}`").cast("string").alias("u"), F.col(f"`{payload}`").cast("binary").alias("p"))
    size = _class_of(F.coalesce(F.octet_length("p"), F.lit(0)))
    for i in sorted(r["i"] for r in cols.select(size.alias("i")).distinct().collect()) or [0]:
        most = max(2, CLASSES[i][1]) if i else RECORDS  # a filedesc and a record at least
        _write(cols.where(size == i).mapInPandas(lambda b, most=most: lines(b, most), "value binary"), path, "\n", most)


def _write(rows: DataFrame, path: str, end: str, most: int) -> None:
    """More gzipped files of the bytes in ``value``; the cast to text leaves them as they are."""
    rows.select(F.col("value").cast("string")).write.mode("append").option("lineSep", end).option("compression", "gzip").option("maxRecordsPerFile", most).text(path)


def _files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("path", "content")


def _literal(path: str) -> str:
    """A path that isn't taken for a pattern."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


ARC_ROW = "file string, place int, key string, url string, ip string, date string, payload_bytes long, digest string, http binary, payload binary"


def _names(row: str) -> list[str]:
    return [x.split()[0] for x in row.split(", ")]


def _key_of(http: bytes) -> str | None:
    found = re.search(rb"\r\nX-Page-Key: ([^\r]+)\r\n", http)
    return found and found[1].decode()


def read_arc(spark: SparkSession, path: str, with_body: bool = True) -> DataFrame:
    """One row per record of the gzipped ARC files under a path."""
    schema = ARC_ROW if with_body else ARC_ROW.removesuffix(", http binary, payload binary")

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for name, content in zip(pdf["path"], pdf["content"], strict=True):
                rows = []
                for place, (head, body) in enumerate(parse_arc(gzip.decompress(content))):
                    http, payload = split_http(body)
                    row = (name, place, _key_of(http), head["URL"], head["IP-address"], head["Archive-date"], len(payload), sha1_base32(payload))
                    rows.append((*row, http, payload) if with_body else row)
                    if len(rows) >= 500:
                        yield pd.DataFrame(rows, columns=_names(schema))
                        rows = []
                yield pd.DataFrame(rows, columns=_names(schema))

    return _files(spark, path).mapInPandas(parse, schema)


def convert(spark: SparkSession, arc: str, warc: str, prefer: str = "cast(key as bigint)", least_bytes: int = 0) -> None:
    """Writes the records of ARC files as WARC files.

    Of equal payloads of at least ``least_bytes``, the record with the largest ``prefer``
    is the response.
    """
    heads = materialise(read_arc(spark, arc, with_body=False), "arc-heads")
    order = F.struct(F.expr(prefer).alias("prefer"), F.hash("file", "place").alias("h"), "file", "place", "key", "url", "date")
    best = heads.where(F.col("payload_bytes") >= least_bytes).groupBy("digest").agg(F.max(order).alias("best"))
    same = (F.col("best.file") == F.col("file")) & (F.col("best.place") == F.col("place"))
    others = heads.where(F.col("payload_bytes") >= least_bytes).join(best, "digest").where(~same)
    # One row a file, of its own records.
    listed = F.collect_list(F.struct("place", *[F.col(f"best.{c}").alias(c) for c in ("key", "url", "date")]))
    taken = F.sum(F.lit(40) + F.coalesce(F.octet_length("best.url"), F.lit(0)) + F.coalesce(F.octet_length("best.key"), F.lit(0)))
    refers = materialise(others.groupBy(F.col("file").alias("path")).agg(listed.alias("refers"), taken.alias("bytes")), "arc-lists")

    def records(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for name, content, refers in zip(pdf["path"], pdf["content"], pdf["refers"], strict=True):
                to = {r["place"]: r for r in refers} if refers is not None else {}
                out = []
                for place, (head, body) in enumerate(parse_arc(gzip.decompress(content))):
                    http, payload = split_http(body)
                    digest, own = sha1_base32(payload), (head["URL"], head["Archive-date"], str(_key_of(http)))
                    if (r := to.get(place)) is None:
                        kind, rid, target = "response", record_id(*own, digest), None
                    else:
                        kind, rid, target = "revisit", record_id(*own, digest, "revisit", name, str(place)), record_id(r["url"], r["date"], str(r["key"]), digest)
                    out.append(warc_record(kind, rid, head["URL"], iso(head["Archive-date"]), http, payload, digest, target, head["IP-address"]))
                    if len(out) >= 500:
                        yield pd.DataFrame({"value": out}, dtype=object)
                        out = []
                yield pd.DataFrame({"value": out}, dtype=object)

    groups = -(-(refers.agg(F.sum("bytes")).first()[0] or 0) // LISTS_BYTES)
    group = F.pmod(F.xxhash64("file"), F.lit(max(1, groups))) if groups <= GROUPS else F.lit(0)
    sizes = heads.groupBy("file").agg(F.max(_class_of(F.col("payload_bytes"))).alias("i"), F.any_value(group).alias("g"))
    jobs: dict[tuple[int, int], list[str]] = {}
    for r in sizes.collect():  # names of files, which a listing holds as well
        jobs.setdefault((r["i"], r["g"]), []).append(r["file"])
    for (i, g), names in sorted(jobs.items()):
        mine = refers.select("path", "refers")
        if groups <= GROUPS:
            mine = F.broadcast(mine.where(F.pmod(F.xxhash64("path"), F.lit(max(1, groups))) == g))
        files = _files(spark, [_literal(n) for n in names]).join(mine, "path", "left")
        _write(files.mapInPandas(records, "value binary"), warc, "\r\n\r\n", CLASSES[i][1] if i else RECORDS)
    if not jobs:
        _write(spark.createDataFrame([], "value binary"), warc, "\r\n\r\n", RECORDS)
    discard(heads, refers)


WARC_ROW = "record_id string, record_type string, uri string, date string, key string, payload_bytes long, payload_digest string, refers_to string, payload binary"


def read_warc(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """One row per record of gzipped WARC files; a revisit's length is the one of its HTTP header."""
    schema = WARC_ROW if with_payload else WARC_ROW.removesuffix(", payload binary")

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = _names(schema)
        for pdf in batches:
            for content in pdf["content"]:
                rows = []
                for head, block in parse_warc(gzip.decompress(content)):
                    http, payload = split_http(block)
                    said = head["WARC-Payload-Digest"].removeprefix("sha1:")
                    if head["WARC-Type"] == "response":
                        if sha1_base32(payload) != said:
                            raise ValueError(f"the payload of {head['WARC-Record-ID']} doesn't have its digest")
                        n = len(payload)
                    else:
                        length = re.search(rb"\r\nContent-Length: ([0-9]+)\r\n", http)
                        n, payload = int(length[1]) if length else None, None
                    row = (head["WARC-Record-ID"], head["WARC-Type"], head["WARC-Target-URI"], head["WARC-Date"], _key_of(http), n, said, head.get("WARC-Refers-To"))
                    rows.append((*row, payload) if with_payload else row)
                    if len(rows) >= 500:
                        yield pd.DataFrame(rows, columns=names)
                        rows = []
                yield pd.DataFrame(rows, columns=names)

    return _files(spark, path).mapInPandas(parse, schema)


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as ARC, converted to WARC and read back: size, digest, type and reference of each."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    arc, warc = work_dir(spark, "arc"), work_dir(spark, "warc")
    write_arc(pages, arc)
    convert(spark, arc, warc)
    remove(spark, arc)
    back = materialise(read_warc(spark, warc, with_payload=False), "warc-rows")
    remove(spark, warc)
    target = back.where("record_type = 'response'").select(F.col("record_id").alias("refers_to"), F.col("key").alias("to_key")).distinct()
    return compact(back.join(target, "refers_to", "left"), back.count(), RESULT_ROWS).select(
        F.col("key").cast("long").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.when(F.col("record_type") == "revisit", F.col("to_key").cast("long")).alias("refers_to"),
    )


#: DuckDB has SHA-1 as hex only; base32 of its 160 bits is spelled by fives.
ORACLE_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS body FROM pages
), h AS (
  SELECT page_id, octet_length(encode(body)) AS payload_bytes, sha1(body) AS x FROM p
), d AS (
  SELECT page_id, payload_bytes,
         array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(
           ((CAST('0x' || substr(x || '0', 1 + CAST(floor(i * 5 / 4) AS INTEGER), 2) AS INTEGER) >> CAST(3 - (i * 5) % 4 AS INTEGER)) & 31) AS INTEGER), 1)), '') AS payload_digest
  FROM h
), m AS (
  SELECT payload_digest, max(page_id) AS best FROM d GROUP BY payload_digest
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN page_id = best THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = best THEN NULL ELSE best END AS refers_to
FROM d JOIN m USING (payload_digest)
"""
