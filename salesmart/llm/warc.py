"""Legacy web archives (ARC, versions 1 and 2) to WARC, and WARC files written and read by Spark.

An ARC file begins with a version block whose last line names the fields of all record headers; a
record is a header line, as many bytes as it declares, and a line feed.  Version 1 has five fields,
version 2 ten.  Each ARC record becomes the WARC record that says the same: identifier (from what
the record is, so that a second run gives the same one), timestamp, type and digests.

Files are written by Spark's text writer: a WARC record ends with two line ends, which is the line
separator it is given, and a string column holds any bytes.

Cases: a payload is any bytes, an empty one included; a null URL or one with white space is written
percent-encoded; a declared length that runs past the end raises an error with the offset.
"""

from __future__ import annotations

import base64
import hashlib
import re
import urllib.parse
import uuid
import zlib
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import cut, pieces, shared_folder

# The field lines of the two versions.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
END = b"\r\n\r\n"
#: Payloads below this are never stored as a reference to another record.
LEAST_SHARED = 100
#: Bytes of payload that a written file is meant to hold.
FILE_BYTES = 16 << 20
#: The crawl time of pages that come without one.
DATE = "20200101000000"


class ArcRecord(NamedTuple):
    version: int
    offset: int
    fields: dict[str, str]
    content: bytes


class WarcRecord(NamedTuple):
    headers: dict[str, str]
    block: bytes


# --- ARC -------------------------------------------------------------------------------------


def arc_file(version: int, records: Iterable[tuple[str, str, str, bytes]], name: str = "pages.arc", date: str = DATE) -> bytes:
    """An ARC file of (url, address, content type, content)."""
    block = f"{version} 0 pages\n{ARC_FIELDS[version]}\n".encode()
    more = " 200 - - 0 pages.arc" if version == 2 else ""
    out = [f"filedesc://{name} 0.0.0.0 {date} text/plain{more} {len(block)}\n".encode(), block, b"\n"]
    at = sum(map(len, out))
    for url, address, kind, content in records:
        if version == 2:
            more = f" 200 {hashlib.md5(content).hexdigest()} - {at} {name}"
        head = f"{url} {address} {date} {kind}{more} {len(content)}\n".encode()
        out += [head, content, b"\n"]
        at += len(head) + len(content) + 1
    return b"".join(out)


def read_arc(data: bytes) -> Iterator[ArcRecord]:
    """The records of an ARC file; the first is its version block."""
    names: list[str] = []
    version = at = 0
    while at < len(data):
        if data[at : at + 1] in b"\r\n":
            at += 1
            continue
        stop = data.find(b"\n", at)
        if stop < 0:
            raise ValueError(f"record header at {at} has no end")
        line = data[at:stop].decode("utf-8", "replace").rstrip("\r")
        length = line.rpartition(" ")[2]
        if not length.isdigit() or stop + 1 + int(length) > len(data):
            raise ValueError(f"record at {at} declares a wrong length")
        content = data[stop + 1 : stop + 1 + int(length)]
        if not names:
            first, _, rest = content.decode("utf-8", "replace").partition("\n")
            version, names = int(first.split(" ")[0]), rest.partition("\n")[0].strip().split(" ")
            if version not in ARC_FIELDS or names != ARC_FIELDS[version].split(" "):
                raise ValueError(f"unknown ARC version block {first!r}")
        # In a header line only the URL may hold spaces.  The version block's may have five fields.
        own = names if line.count(" ") >= len(names) - 1 else ARC_FIELDS[1].split(" ")
        values = line.rsplit(" ", len(own) - 1)
        if len(values) != len(own):
            raise ValueError(f"record header at {at} has too few fields")
        yield ArcRecord(version, at, dict(zip(own, values, strict=True)), content)
        at = stop + 1 + int(length)


# --- conversion ------------------------------------------------------------------------------


def record_id(kind: str, uri: str, date: str, digest: str, mark: str = "") -> str:
    """The identifier of a record, from what it is."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, ' '.join((kind, uri, date, digest, mark)))}>"


def warc_date(arc_date: str) -> str:
    """2020-01-02T03:04:05Z for 20200102030405; missing trailing parts are their least values."""
    d = arc_date if len(arc_date) >= 14 else arc_date + "00000101000000"[len(arc_date) :]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def http_parts(block: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """Header fields in lower case, head and body of an HTTP response."""
    head, end, body = block.partition(END)
    fields = {}
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        fields[name.strip().lower()] = value.strip()
    return fields, head + end, body


def convert(record: ArcRecord) -> WarcRecord:
    """The equivalent WARC record: warcinfo, response for HTTP, else resource."""
    uri, date = record.fields["URL"], warc_date(record.fields["Archive-date"])
    payload, mark = record.content, ""
    if uri.startswith("filedesc://"):
        kind, media = "warcinfo", "application/warc-fields"
    elif record.content.startswith(b"HTTP/"):
        kind, media = "response", "application/http; msgtype=response"
        fields, _, payload = http_parts(record.content)
        mark = fields.get("x-page-id", "")
    else:
        kind, media = "resource", record.fields["Content-type"]
    digest = hashlib.sha256(payload).hexdigest()
    headers = {
        "WARC-Type": kind,
        "WARC-Record-ID": record_id(kind, uri, date, digest, mark),
        "WARC-Date": date,
        "WARC-Target-URI": uri,
        "WARC-IP-Address": record.fields["IP-address"],
        "WARC-Payload-Digest": f"sha256:{digest}",
        "WARC-Block-Digest": "sha1:" + base64.b32encode(hashlib.sha1(record.content).digest()).decode(),
        "Content-Type": media,
        "Content-Length": str(len(record.content)),
    }
    if kind == "warcinfo":
        headers["WARC-Filename"] = uri.removeprefix("filedesc://")
        del headers["WARC-Target-URI"]
    return WarcRecord(headers, record.content)


def revisit(record: WarcRecord, first_uri: str, first_mark: str) -> WarcRecord:
    """A response as a reference to the one that holds the same payload; its HTTP head stays."""
    fields, head, _ = http_parts(record.block)
    digest = record.headers["WARC-Payload-Digest"]
    date = record.headers["WARC-Date"]
    uri = record.headers["WARC-Target-URI"]
    bare = digest.partition(":")[2]
    return WarcRecord(
        record.headers
        | {
            "WARC-Type": "revisit",
            "WARC-Record-ID": record_id("revisit", uri, date, bare, fields.get("x-page-id", "")),
            "WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            "WARC-Refers-To": record_id("response", first_uri, date, bare, first_mark),
            "WARC-Refers-To-Target-URI": first_uri,
            "WARC-Block-Digest": "sha1:" + base64.b32encode(hashlib.sha1(head).digest()).decode(),
            "Content-Length": str(len(head)),
        },
        head,
    )


# --- WARC ------------------------------------------------------------------------------------


def warc_bytes(record: WarcRecord) -> bytes:
    """The record without the two line ends that follow it."""
    head = "".join(f"{k}: {v}\r\n" for k, v in record.headers.items())
    return f"WARC/1.1\r\n{head}\r\n".encode() + record.block


def read_warc(data: bytes) -> Iterator[WarcRecord]:
    """The records of a WARC file, by their declared lengths; digests are verified."""
    at = 0
    while at < len(data):
        stop = data.find(END, at)
        head = data[at:stop].decode("utf-8", "replace").split("\r\n")
        if stop < 0 or not head[0].startswith("WARC/"):
            raise ValueError(f"no record header at {at}")
        headers = dict(line.split(": ", 1) for line in head[1:])
        begin = stop + len(END)
        end = begin + int(headers["Content-Length"])
        if data[end : end + len(END)] != END:
            raise ValueError(f"record at {at} declares a wrong length")
        block = data[begin:end]
        if "WARC-Block-Digest" in headers:
            found = "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()
            if found != headers["WARC-Block-Digest"]:
                raise ValueError(f"record at {at} is not what its digest says")
        yield WarcRecord(headers, block)
        at = end + len(END)


def inflated(data: bytes) -> bytes:
    """The content of gzip members one after the other, or the data if it is not compressed."""
    out = []
    while data[:2] == b"\x1f\x8b":
        unzip = zlib.decompressobj(wbits=31)
        out += [unzip.decompress(data), unzip.flush()]
        data = unzip.unused_data
    return b"".join(out) if out else data


# --- pages -----------------------------------------------------------------------------------

_UNSAFE = re.compile(r"[\x00-\x20\x7f-\x9f    ]")


def _url(url: str | None, page_id: int | None) -> str:
    if not url:
        return f"urn:page:{page_id}"
    return _UNSAFE.sub(lambda m: urllib.parse.quote(m[0]), url)


def _http(page_id: int | None, payload: bytes) -> bytes:
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nX-Page-Id: {page_id}\r\nContent-Length: {len(payload)}"
    return head.encode() + END + payload


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pages to ARC files of either version, and these, record by record, to WARC."""
    for batch in batches:
        for piece in pieces(batch, "html"):
            pages = [
                (i, _url(u, i), (h or "").encode(), {x["digest"]: x for x in held or []})
                for i, u, h, held in zip(*(c.to_pylist() for c in piece.columns), strict=True)
            ]
            for version in ARC_FIELDS:
                own = [p for p in pages if (p[0] or 0) % len(ARC_FIELDS) == version - 1]
                archive = arc_file(version, ((u, "0.0.0.0", "text/html", _http(i, payload)) for i, u, payload, _ in own))
                records = [convert(r) for r in read_arc(archive)]
                out = [records[0]] if own else []
                for record, (_, _, _, held) in zip(records[1:], own, strict=True):
                    first = held.get(record.headers["WARC-Payload-Digest"].partition(":")[2])
                    out.append(revisit(record, _url(first["url"], first["page_id"]), str(first["page_id"])) if first else record)
                column = pa.array([warc_bytes(r) for r in out], pa.binary())
                yield pa.RecordBatch.from_arrays([column], names=["record"])


def write_pages(pages: DataFrame, path: str) -> None:
    """Pages (page_id, url, html) as WARC files; equal payloads are held by the page of least id."""
    pages = pages.select("page_id", "url", "html")
    named = pages.select(
        "page_id", "url", F.sha2(F.coalesce("html", F.lit("")), 256).alias("digest"),
        F.coalesce(F.octet_length("html"), F.lit(0)).alias("size"),
    )
    total = named.agg(F.sum("size")).first()[0] or 0
    large = named.where(F.col("size") >= LEAST_SHARED)
    first = large.groupBy("digest").agg(
        F.min(F.struct("page_id", "url")).alias("first"), F.count("*").alias("n")
    ).where("n > 1 and first.page_id is not null")
    # One row matches each page, so that adaptive execution can split the join where a digest is frequent.
    held = large.select("page_id", "digest").join(first, "digest").where("page_id <> first.page_id")
    held = held.groupBy("page_id").agg(F.collect_set(F.struct("digest", "first.page_id", "first.url")).alias("held"))
    files = max(1, -(-total // FILE_BYTES))
    joined = pages.repartition(files, "page_id").join(held, "page_id", "left")
    joined = joined.select("page_id", "url", "html", "held")
    records = joined.mapInArrow(_records, "record binary")
    records.select(F.col("record").cast("string").alias("record")).write.option(
        "lineSep", END.decode()
    ).option("compression", "gzip").text(path)


def read_pages(frame: DataFrame) -> DataFrame:
    """Of WARC files (content): one row for each page's record."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                rows = []
                for record in read_warc(inflated(content.as_py())):
                    if record.headers["WARC-Type"] not in ("response", "revisit"):
                        continue
                    fields, _, body = http_parts(record.block)
                    digest, size = record.headers["WARC-Payload-Digest"].partition(":")[2], int(fields["content-length"])
                    whole = record.headers["WARC-Type"] == "response"
                    if whole and (len(body) != size or hashlib.sha256(body).hexdigest() != digest):
                        raise ValueError(f"payload of {record.headers['WARC-Record-ID']} is not what its digest says")
                    page = fields["x-page-id"]
                    rows.append(
                        (None if page == "None" else int(page), size, digest, record.headers["WARC-Type"],
                         record.headers["WARC-Record-ID"], record.headers.get("WARC-Refers-To"))
                    )
                columns = list(zip(*rows, strict=True)) if rows else [[]] * 6
                kinds = [pa.int64(), pa.int64(), *[pa.string()] * 4]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                    names=["page_id", "payload_bytes", "payload_digest", "record_type", "record_id", "refers_to_id"],
                )

    return frame.select("content").mapInArrow(
        run,
        "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, record_id string, refers_to_id string",
    )


def archive_pages(pages: DataFrame) -> DataFrame:
    """Write pages as WARC files into the shared folder, read these back: a row for each page.

    refers_to is the page whose response a revisit names.  Repeated rows give repeated rows; rows
    that repeat the least page_id of a payload are all responses; an empty table gives an empty one.
    """
    spark = pages.sparkSession
    path = shared_folder(spark)
    write_pages(pages, path)
    read = cut(read_pages(spark.read.format("binaryFile").load(path)))
    whole = read.where("record_type = 'response'")
    # many revisits name one response: pair each response once with its identifier
    named = whole.groupBy(F.col("record_id").alias("refers_to_id")).agg(F.min("page_id").alias("refers_to"))
    again = read.where("record_type = 'revisit'").join(named, "refers_to_id", "left")
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return whole.withColumn("refers_to", F.lit(None).cast("bigint")).select(columns).union(again.select(columns))
