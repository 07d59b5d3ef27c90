"""Legacy ARC archives to WARC, with records of equal payload turned into revisits.

An ARC file begins with a version block whose second line names its version; version 1
headers hold five fields (URL, IP, date, type, length), version 2 headers ten (result
code, checksum, location, offset and file name before the length). Records are cut by
their declared length. WARC files are written by Spark's text sink, which writes the bytes
it is given and ends each record with two line ends, and are gzipped; they are read back
by declared lengths too.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastegraph.llm.common import stage

FIELDS = {
    b"1": ("url", "ip", "date", "type", "length"),
    b"2": ("url", "ip", "date", "type", "result", "checksum", "location", "offset", "file", "length"),
}
LINE = {v: b" ".join(n.title().encode() for n in names) for v, names in FIELDS.items()}
END = b"\r\n\r\n"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def arc_file(name: str, version: bytes, records: list[tuple[str, str, bytes]]) -> bytes:
    """An ARC file of (url, 14-digit date, document) records."""
    note = version + b" 0 archive\n" + LINE[version] + b"\n"
    head = f"filedesc://{name} 0.0.0.0 20200101000000 text/plain"
    head += " 200 - - 0 " + name if version == b"2" else ""
    parts = [f"{head} {len(note)}\n".encode(), note, b"\n"]
    at = sum(map(len, parts))
    for url, date, document in records:
        more = f" 200 - - {at} {name}" if version == b"2" else ""
        line = f"{url} 0.0.0.0 {date} text/html{more} {len(document)}\n".encode()
        parts += [line, document, b"\n"]
        at += len(line) + len(document) + 1
    return b"".join(parts)


def parse_arc(data: bytes) -> Iterator[dict]:
    """Records of an ARC file after its version block, each with file, offset and document."""
    at, names, name = 0, None, ""
    while at < len(data):
        end = data.index(b"\n", at)
        line = data[at:end]
        if not line:  # blank lines may stand between records
            at = end + 1
            continue
        length = int(line.rsplit(b" ", 1)[1])
        document = data[end + 1 : end + 1 + length]
        if len(document) != length:
            raise ValueError(f"the record at byte {at} is cut off")
        if names is None:
            if not line.startswith(b"filedesc://"):
                raise ValueError("no version block")
            version = document.split(b" ", 1)[0]
            names, name = FIELDS[version], line[11:].split(b" ", 1)[0].decode()
        else:
            # A URL may hold blanks; the other fields may not.
            values = [v.decode() for v in line.rsplit(b" ", len(names) - 1)]
            yield dict(zip(names, values, strict=True)) | {"document": document, "archive": name, "at": at}
        at = end + 1 + length


def http_parts(document: bytes) -> tuple[bytes, bytes]:
    """(header lines with the blank one, body) of an HTTP message; no header if there is none."""
    if not document.startswith(b"HTTP/"):
        return b"", document
    head, mark, body = document.partition(END)
    return head + mark, body


def warc_record(kind: str, fields: list[tuple[str, str]], block: bytes) -> bytes:
    """A WARC record without the two line ends behind it."""
    lines = ["WARC/1.1", f"WARC-Type: {kind}", *[f"{k}: {v}" for k, v in fields], f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + END + block


def parse_warc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, block) of each record."""
    at = 0
    while at < len(data):
        end = data.index(END, at)
        lines = data[at:end].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        fields = dict(line.split(": ", 1) for line in lines[1:])
        size = int(fields["Content-Length"])
        yield fields, data[end + 4 : end + 4 + size]
        at = end + 4 + size + len(END)


def pages_to_arc(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", body_col: str = "html") -> DataFrame:
    """ARC files (content) of pages, versions in turn; the page id is an HTTP header.

    Null bodies are empty; a null URL is ``unknown:``. White space in URLs is escaped.
    """

    def work(batches):
        part = TaskContext.get().partitionId()
        for number, batch in enumerate(batches):
            records = []
            for page, url, body in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                body = (body or "").encode()
                own = b"" if page is None else b"X-Page-Id: %d\r\n" % page
                document = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n%sContent-Length: %d\r\n\r\n" % (own, len(body))
                url = "".join(f"%{ord(c):02X}" if c.isspace() and ord(c) < 256 else c for c in url or "unknown:")
                url = "".join("%20" if c.isspace() else c for c in url)
                seconds = (page or 0) % (86400 * 365)
                day = np.datetime64("2020-01-01T00:00:00") + np.timedelta64(seconds, "s")
                records.append((url, "".join(c for c in str(day) if c.isdigit()), document + body))
            version = b"12"[(part + number) % 2 :][:1]
            data = arc_file(f"pages-{part:05d}-{number:05d}.arc", version, records)
            yield pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], ["content"])

    chosen = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"), F.col(body_col).cast("string").alias("body"))
    return chosen.mapInArrow(work, "content binary")


_FIELDS = "record_id string, page_id long, digest string, size long, url string, date string, http binary"


def convert(archives: DataFrame, with_payload: bool = True) -> DataFrame:
    """One row per ARC record with what its WARC record needs.

    The identifier is made from the archive's name, the place in it and the payload, so
    it is the same in every run.
    """

    def work(batches):
        names = ["record_id", "page_id", "digest", "size", "url", "date", "http"] + ["payload"] * with_payload
        for batch in batches:
            for content in batch.column(0):
                rows, held = [], 0
                for record in parse_arc(content.as_py()):
                    http, payload = http_parts(record["document"])
                    digest = payload_digest(payload)
                    own = uuid.uuid5(uuid.NAMESPACE_URL, f"{record['archive']} {record['at']} {digest}")
                    page = next((int(h[11:]) for h in http.split(b"\r\n") if h.startswith(b"X-Page-Id: ")), None)
                    d = record["date"]
                    date = f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"
                    rows.append((str(own), page, digest, len(payload), record["url"], date, http, payload)[: len(names)])
                    held += len(payload) if with_payload else 100
                    if held > 1 << 22:
                        yield _batch(rows, names)
                        rows, held = [], 0
                if rows:
                    yield _batch(rows, names)

    return archives.mapInArrow(work, _FIELDS + ", payload binary" * with_payload)


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = {"page_id": pa.int64(), "size": pa.int64(), "http": pa.binary(), "payload": pa.binary()}
    columns = [pa.array(c, kinds.get(n, pa.string())) for n, c in zip(names, zip(*rows, strict=True), strict=True)]
    return pa.RecordBatch.from_arrays(columns, names)


def revisits(records: DataFrame, least_bytes: int = 0) -> DataFrame:
    """(record_id, refers_id, refers_url, refers_date) of records whose payload another one holds.

    Of equal payloads of at least ``least_bytes`` the record with the smallest page id is
    the original; records without a page id come last, ties go to the smaller record id.
    """
    large = records.where(F.col("size") >= least_bytes)
    first = F.struct(F.col("page_id").isNull().alias("none"), "page_id", "record_id", "url", "date")
    best = large.groupBy("digest").agg(F.min(first).alias("best"), F.count("*").alias("n")).where("n > 1")
    found = large.join(best, "digest").where("record_id <> best.record_id")
    return found.select(
        "record_id", F.col("best.record_id").alias("refers_id"), F.col("best.url").alias("refers_url"), F.col("best.date").alias("refers_date")
    )


def write_warc(archives: DataFrame, path: str, least_bytes: int = 0) -> None:
    """Convert ARC files (column content) to gzipped WARC files below ``path``.

    Which records are revisits is found from digests alone.
    """
    light = stage(convert(archives, with_payload=False).drop("http"), "records")
    again = stage(revisits(light, least_bytes), "revisits")

    def work(batches):
        part, first = TaskContext.get().partitionId(), True
        for batch in batches:
            out = []
            if first:
                own = uuid.uuid5(uuid.NAMESPACE_URL, f"warcinfo {part}")
                fields = [("WARC-Record-ID", f"<urn:uuid:{own}>"), ("WARC-Date", "2020-01-01T00:00:00Z"), ("Content-Type", "application/warc-fields")]
                out.append(warc_record("warcinfo", fields, b"format: WARC File Format 1.1\r\n"))
                first = False
            for r in batch.to_pylist():
                fields = [
                    ("WARC-Record-ID", f"<urn:uuid:{r['record_id']}>"),
                    ("WARC-Target-URI", r["url"]),
                    ("WARC-Date", r["date"]),
                    ("WARC-Payload-Digest", f"sha1:{r['digest']}"),
                ]
                block, kind = r["http"], "revisit"
                if r["refers_id"] is None:
                    block, kind = block + r["payload"], "response"
                else:
                    fields += [
                        ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                        ("WARC-Refers-To", f"<urn:uuid:{r['refers_id']}>"),
                        ("WARC-Refers-To-Target-URI", r["refers_url"]),
                        ("WARC-Refers-To-Date", r["refers_date"]),
                    ]
                fields += [("WARC-Block-Digest", f"sha1:{payload_digest(block)}"), ("Content-Type", "application/http; msgtype=response")]
                out.append(warc_record(kind, fields, block))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])

    # Record ids are all different, so a hot payload does not gather anywhere.
    rows = convert(archives).join(again, "record_id", "left")
    blocks = rows.mapInArrow(work, "value binary")
    blocks.select(F.col("value").cast("string").alias("value")).write.option("lineSep", "\r\n\r\n").option("compression", "gzip").text(path)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) from WARC files.

    The digest of a response is taken anew from its payload and must be the declared one.
    """

    def work(batches):
        for batch in batches:
            for content in batch.column(0):
                rows = []
                for fields, block in parse_warc(gzip.decompress(content.as_py())):
                    if fields["WARC-Type"] == "warcinfo":
                        continue
                    http, payload = http_parts(block)
                    headers = dict(h.split(": ", 1) for h in http.decode().split("\r\n")[1:] if h)
                    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                    if fields["WARC-Type"] == "response" and payload_digest(payload) != digest:
                        raise ValueError(f"the payload of {fields['WARC-Record-ID']} has another digest")
                    page, refers = headers.get("X-Page-Id"), fields.get("WARC-Refers-To")
                    rows.append((fields["WARC-Record-ID"], page and int(page), int(headers["Content-Length"]), digest, fields["WARC-Type"], refers))
                if rows:
                    columns = list(zip(*rows, strict=True))
                    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
                    names = ["record", "page_id", "payload_bytes", "payload_digest", "record_type", "refers"]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    kind = "record string, page_id long, payload_bytes long, payload_digest string, record_type string, refers string"
    rows = stage(files.mapInArrow(work, kind), "warc-rows")
    target = rows.where("record_type = 'response'").select(F.col("record").alias("refers"), F.col("page_id").alias("refers_to"))
    return rows.join(target, "refers", "left").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "record")
