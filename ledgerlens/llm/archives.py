"""Legacy ARC archives converted to WARC (operator 3).

``write_arc`` stores pages as ARC files of both versions, ``arc_to_warc``
converts any ARC files, ``read_warc`` reads WARC files back.

*Parsing.*  An ARC file opens with a ``filedesc://`` record whose body names the
version; a record's header line has five fields in version 1 (URL, IP address,
date, type, length) and ten in version 2 (status, checksum, location, offset and
file name before the length).  Bodies are taken by their declared length, never by
searching for a separator.

*Synthesis.*  Each record becomes a WARC/1.1 record: an identifier derived from
its place (file and record number), the 14-digit date as ISO 8601, a type (warcinfo
for the file description, response for HTTP, resource for the rest) and SHA-1
digests of payload and block.  Of records with equal payloads of at least
``min_bytes`` the one with the largest page number is the response; the others
become revisits that keep the HTTP header and refer to it.

*At scale.*  Files are written by Spark's text sink, whose line end is the record
separator, so a lost task leaves no half file.  A file is one read split of the
input and is parsed as a stream in one task.  Payloads are never shuffled: one pass
over the files gathers digests, the choice of responses is an aggregate by digest
(combined map-side) and an equi-join of narrow rows, and the revisits are written as
one small table per file.  The task that converts a file reads that file's table by its path,
so archives take part in no join; the shared folder must be on a file system that
``pyarrow.fs`` knows.

Defined cases: a null html is an empty payload; a null URL is written as "-" and
left out of the WARC header; a null page id is left out too and orders first;
of rows equal in page id and payload one is the response; no rows give no rows.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
import pyarrow.dataset as ds
from pyarrow.fs import FileSelector, FileSystem
from pyspark.sql import DataFrame, SparkSession, functions as F

from .storage import new_path, save
from .text import whole

V1_FIELDS = "URL IP-address Archive-date Content-type Archive-length"
V2_FIELDS = ("URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename "
             "Archive-length")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_ROW_MASK = (1 << 33) - 1  # monotonically_increasing_id numbers rows within a partition from 0


class ArcRecord(NamedTuple):
    url: str
    ip: str
    date: str
    kind: str
    body: bytes


def write_arc(pages: DataFrame, path: str, *, date: str = "20240101000000", origin: str = "ledgerlens") -> None:
    """Pages (page_id, url, html) as gzipped ARC files, one per input partition, of version 1 and 2 in turn."""
    number = F.monotonically_increasing_id()
    version = F.shiftright(number, 33) % 2 + 1
    payload = whole(F.col("html"))
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: "),
                    F.octet_length(payload).cast("string"),
                    F.coalesce(F.concat(F.lit("\r\nX-Page-Id: "), F.col("page_id").cast("string")), F.lit("")),
                    F.lit("\r\n\r\n"))
    url = F.coalesce(F.nullif(F.regexp_replace("url", r"[\x00-\x20\x7F]", "%20"), F.lit("")), F.lit("-"))
    size = (F.octet_length(head) + F.octet_length(payload)).cast("string")
    line1 = F.concat(url, F.lit(f" 0.0.0.0 {date} text/html "), size)
    line2 = F.concat(url, F.lit(f" 0.0.0.0 {date} text/html 200 - - 0 pages.arc "), size)
    opens = {}
    for v, fields, extra in ((1, V1_FIELDS, ""), (2, V2_FIELDS, "200 - - 0 pages.arc ")):
        body = f"{v} 0 {origin}\n{fields}\n"
        opens[v] = f"filedesc://pages.arc 0.0.0.0 {date} text/plain {extra}{len(body)}\n{body}\n"
    first = F.when(number.bitwiseAND(F.lit(_ROW_MASK)) == 0,
                   F.when(version == 1, opens[1]).otherwise(opens[2])).otherwise("")
    (pages.select(F.concat(first, F.when(version == 1, line1).otherwise(line2), F.lit("\n"), head, payload)
                  .alias("value"))
     .write.option("lineSep", "\n").option("compression", "gzip").text(path))


def _stream(raw: bytes) -> io.BufferedReader:
    buf = io.BytesIO(raw)
    return io.BufferedReader(gzip.GzipFile(fileobj=buf) if raw[:2] == b"\x1f\x8b" else buf, 1 << 20)


def parse_arc(raw: bytes) -> Iterator[ArcRecord]:
    """The records of an ARC file, its file description included."""
    stream, version = _stream(raw), 1
    while line := stream.readline():
        if not line.strip():
            continue
        fields = line.decode("utf-8", "replace").rstrip("\r\n").split(" ")
        opening = fields[0].startswith("filedesc:")
        if len(fields) != (10 if (version == 2 and not opening) or (opening and len(fields) > 5) else 5):
            raise ValueError(f"not an ARC header of version {version}: {line[:200]!r}")
        body = stream.read(int(fields[-1]))
        if len(body) != int(fields[-1]):
            raise ValueError(f"the record of {fields[0]} is cut short")
        if opening:
            version = int(body.split(b" ", 1)[0])
        yield ArcRecord(fields[0], fields[1], fields[2], fields[3], body)


def _http(body: bytes) -> tuple[bytes, bytes]:
    """Header (with its empty line) and payload; no header unless there is a status line."""
    end = body.find(b"\r\n\r\n") if body.startswith(b"HTTP/") else -1
    return (body[:end + 4], body[end + 4:]) if end >= 0 else (b"", body)


def _field(head: bytes, name: bytes) -> str | None:
    for line in head.split(b"\r\n"):
        key, _, value = line.partition(b":")
        if key.strip().lower() == name:
            return value.strip().decode("utf-8", "replace")
    return None


def _sha1(raw: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(raw).digest()).decode()


def record_id(file: int, record: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'arc:{file}/{record}')}>"


def _files(spark: SparkSession, path: str) -> DataFrame:
    return (spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
            .select(F.regexp_extract("path", r"part-(\d+)", 1).cast("long").alias("file"), "content"))


def _arrow(columns: list, rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [[]] * len(columns)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(cols, columns)], [n for n, _ in columns])


_INDEX = [("file", pa.int64()), ("record", pa.int64()), ("page_id", pa.int64()), ("url", pa.string()),
          ("date", pa.string()), ("size", pa.int64()), ("digest", pa.binary())]


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for file, raw in zip(b.column(0).to_pylist(), b.column(1)):
            rows = []
            for k, r in enumerate(parse_arc(raw.as_py())):
                head, payload = _http(r.body)
                if head:
                    page = _field(head, b"x-page-id")
                    rows.append((file, k, None if page is None else int(page), r.url, r.date, len(payload),
                                 hashlib.sha1(payload).digest()))
            yield _arrow(_INDEX, rows)


def _iso(date: str) -> str:
    d = date.ljust(14, "0")
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def _warc(file: int, number: int, r: ArcRecord, same: dict | None) -> bytes:
    """A WARC record without the empty lines that end it; ``same``: the response of equal payload."""
    head, payload = _http(r.body)
    block, fields = r.body, []
    if r.url.startswith("filedesc:"):
        kind, content = "warcinfo", "text/plain"
        fields.append(("WARC-Filename", r.url.removeprefix("filedesc://")))
    elif head:
        kind, content = "revisit" if same else "response", "application/http; msgtype=response"
    else:
        kind, content = "resource", r.kind
    if same:
        block = head
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(same["file"], same["record"])),
                   ("WARC-Refers-To-Date", _iso(same["date"]))]
        if same["url"] != "-":
            fields.append(("WARC-Refers-To-Target-URI", same["url"]))
    if kind != "warcinfo":
        fields += [("WARC-Target-URI", r.url)] * (r.url != "-") + [("WARC-IP-Address", r.ip)] * (r.ip != "0.0.0.0")
        fields.append(("WARC-Payload-Digest", _sha1(payload)))
    fields = [("WARC-Type", kind), ("WARC-Record-ID", record_id(file, number)), ("WARC-Date", _iso(r.date)), *fields,
              ("WARC-Block-Digest", _sha1(block)), ("Content-Type", content), ("Content-Length", str(len(block)))]
    return "\r\n".join(["WARC/1.1", *(f"{k}: {v}" for k, v in fields), "", ""]).encode() + block


def _revisits(folder: str, file: int) -> dict[int, dict]:
    """The responses that records of a file repeat, by record number."""
    fs, path = FileSystem.from_uri(folder)
    found = fs.get_file_info(FileSelector(f"{path}/file={file}", allow_not_found=True))
    parts = [f.path for f in found if f.base_name.startswith("part-")]
    rows = ds.dataset(parts, format="parquet", filesystem=fs).to_table().to_pylist() if parts else []
    return {r["at"]: {"file": r["to_file"], "record": r["to_record"], "url": r["url"], "date": r["date"]} for r in rows}


def _convert(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for file, raw in zip(b.column(0).to_pylist(), b.column(1)):
                same = _revisits(folder, file)
                out, size = [], 0
                for k, r in enumerate(parse_arc(raw.as_py())):
                    out.append(_warc(file, k, r, same.get(k)))
                    size += len(out[-1])
                    if size > 4 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])
                        out, size = [], 0
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])

    return run


def arc_to_warc(spark: SparkSession, arc_path: str, warc_path: str, *, min_bytes: int = 1000) -> None:
    """Convert ARC files to WARC files, equal payloads of at least ``min_bytes`` stored once."""
    index = save(_files(spark, arc_path).mapInArrow(
        _index, "file long, record long, page_id long, url string, date string, size long, digest binary"), "arc-index")
    large = index.where(F.col("size") >= min_bytes)
    responses = (large.groupBy("digest", "size")
                 .agg(F.count("*").alias("n"), F.max(F.struct("page_id", "file", "record", "url", "date")).alias("r"))
                 .where("n > 1").drop("n"))
    lists = new_path(spark, "arc-revisits")
    (large.select("digest", "size", "file", F.col("record").alias("at")).join(responses, ["digest", "size"])
     .where((F.col("file") != F.col("r.file")) | (F.col("at") != F.col("r.record")))
     .select("file", "at", F.col("r.file").alias("to_file"), F.col("r.record").alias("to_record"), "r.url", "r.date")
     .repartition("file")  # the records of one file: bounded by the file
     .write.partitionBy("file").parquet(lists))
    (_files(spark, arc_path).mapInArrow(_convert(lists), "record binary")
     .select(F.col("record").cast("string").alias("value"))
     .write.option("lineSep", "\r\n\r\n").option("compression", "gzip").text(warc_path))


_WARC_ROW = [("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
             ("record_type", pa.string()), ("record_id", pa.string()), ("refers_to_id", pa.string()),
             ("target_uri", pa.string()), ("warc_date", pa.string())]


def parse_warc(raw: bytes) -> Iterator[tuple[dict, bytes]]:
    """(header fields by lower-case name, block) of each record."""
    stream = _stream(raw)
    while line := stream.readline():
        if line in (b"\r\n", b"\n"):
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:200]!r}")
        fields = {}
        while (line := stream.readline().rstrip(b"\r\n")):
            key, _, value = line.partition(b":")
            fields[key.decode().strip().lower()] = value.decode("utf-8", "replace").strip()
        block = stream.read(int(fields["content-length"]))
        if len(block) != int(fields["content-length"]):
            raise ValueError(f"the record {fields.get('warc-record-id')} is cut short")
        yield fields, block


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for raw in b.column(1):
            rows = []
            for f, block in parse_warc(raw.as_py()):
                if f["warc-type"] not in ("response", "revisit"):
                    continue
                head, payload = _http(block)
                page = _field(head, b"x-page-id")
                digest = f["warc-payload-digest"]
                if f["warc-type"] == "response":
                    size = len(payload)
                    if _sha1(payload) != digest:
                        raise ValueError(f"the payload of {f['warc-record-id']} does not match its digest")
                else:
                    size = int(_field(head, b"content-length"))
                rows.append((None if page is None else int(page), size,
                             base64.b32decode(digest.removeprefix("sha1:")).hex(), f["warc-type"],
                             f["warc-record-id"], f.get("warc-refers-to"), f.get("warc-target-uri"), f["warc-date"]))
            yield _arrow(_WARC_ROW, rows)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """One row per response and revisit, with the page that a revisit refers to."""
    rows = save(_files(spark, path).mapInArrow(
        _read, "page_id long, payload_bytes long, payload_digest string, record_type string, record_id string, "
               "refers_to_id string, target_uri string, warc_date string"), "warc-rows")
    responses = rows.where("record_type = 'response'")
    pages = responses.select(F.col("record_id").alias("refers_to_id"), F.col("page_id").alias("refers_to"))
    # a response may have very many revisits; Spark splits such a key on the left side of this join
    revisits = rows.where("record_type = 'revisit'").join(pages, "refers_to_id", "left")
    return revisits.unionByName(responses.withColumn("refers_to", F.lit(None).cast("long")))


def archive_round_trip(pages: DataFrame, folder: str | None = None, *, min_bytes: int = 1000) -> DataFrame:
    """Pages to ARC, ARC to WARC, and the WARC files read back."""
    spark = pages.sparkSession
    folder = folder or new_path(spark, "archives")
    write_arc(pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html"), f"{folder}/arc")
    arc_to_warc(spark, f"{folder}/arc", f"{folder}/warc", min_bytes=min_bytes)
    return read_warc(spark, f"{folder}/warc")
