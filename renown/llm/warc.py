"""WARC writer and sequential reader.

``write_archives`` gives every page one record in its own gzip member;
``read_archives`` walks the files member by member with incremental
decompression, frames blocks by Content-Length and checks both digests.
Archives are files below a folder that the driver and all executors
share; a task that is run again writes a new file, and only files named
in the written manifest are read.

Defined results: null html is an empty payload; a null page id is written
as ``null`` and never is a response for others; of equal payloads the row
with the largest page id is the response, and repeated rows of that id are
responses too; a null url becomes ``urn:page:<id>``; an empty table gives
an empty manifest and no records.  Extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import zlib

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from renown.session import materialize, scratch_path

MANIFEST = "path string, records long"
RECORDS = ("page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, "
           "uri string, payload binary")
_CRLF = b"\r\n"


def plan_records(pages: DataFrame, min_bytes: int = 1000) -> DataFrame:
    """page_id, url, html, digest, n_bytes and ``response_id`` (largest page id among equal payloads)."""
    payload = F.coalesce(F.col("html"), F.lit(""))
    base = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url"), payload.alias("html"),
                        F.sha1(F.encode(payload, "UTF-8")).alias("digest"), F.octet_length(payload).alias("n_bytes"))
    groups = materialize(base.filter(F.col("n_bytes") >= min_bytes).groupBy("digest")
                         .agg(F.max("page_id").alias("response_id"), F.count("*").alias("n"))
                         .filter("n > 1 AND response_id IS NOT NULL").drop("n"), "warc-groups")
    return base.join(groups, "digest", "left")


def _sha1_label(raw: bytes) -> str:
    return "sha1:" + base64.b32encode(raw).decode()


def _member(kind: str, record_id: str, fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = [("WARC-Type", kind), ("WARC-Record-ID", f"<urn:{record_id}>"), *fields,
            ("WARC-Block-Digest", _sha1_label(hashlib.sha1(block).digest())), ("Content-Length", str(len(block)))]
    lines = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head) + "\r\n"
    gz = zlib.compressobj(6, zlib.DEFLATED, 31)
    return gz.compress(lines.encode() + block + _CRLF + _CRLF) + gz.flush()


def record_bytes(page_id, url, html: str, digest: str, response_id) -> bytes:
    """One gzip member: a response with its payload, or a revisit without it."""
    payload = html.encode()
    pid = "null" if page_id is None else str(page_id)
    uri = "".join(c for c in (url or f"urn:page:{pid}") if c > " " and c != "\x7f") or f"urn:page:{pid}"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    fields = [("WARC-Date", "1970-01-01T00:00:00Z"), ("WARC-Target-URI", uri),
              ("WARC-Payload-Digest", _sha1_label(bytes.fromhex(digest))),
              ("Content-Type", "application/http; msgtype=response")]
    if response_id is None or response_id == page_id:
        return _member("response", f"page:{pid}", fields, http.encode() + payload)
    fields += [("WARC-Refers-To", f"<urn:page:{response_id}>"),
               ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
    return _member("revisit", f"page:{pid}", fields, http.encode())


def write_archives(planned: DataFrame, folder: str, roll_bytes: int = 256 << 20) -> DataFrame:
    """Write the records of ``plan_records`` as .warc.gz files in ``folder``; returns the written manifest."""
    def write(batches):
        from pyarrow import fs as pafs
        ctx = TaskContext.get()
        fs, base = pafs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:")
                                            else f"file://{folder}")
        fs.create_dir(base, recursive=True)
        out, size, n, path, part, done = None, 0, 0, "", 0, []
        for pdf in batches:
            ids = [None if pd.isna(x) else int(x) for x in pdf["page_id"]]
            refs = [None if pd.isna(x) else int(x) for x in pdf["response_id"]]
            for row in zip(ids, pdf["url"], pdf["html"], pdf["digest"], refs):
                if out is None:
                    path = f"{base}/part-{ctx.partitionId():06d}-{ctx.taskAttemptId()}-{part:04d}.warc.gz"
                    out, size, n, part = fs.open_output_stream(path, compression=None), 0, 0, part + 1
                    out.write(_member("warcinfo", f"info:{ctx.taskAttemptId()}-{part}",
                                      [("Content-Type", "application/warc-fields")], b"format: WARC/1.1\r\n"))
                data = record_bytes(*row)
                out.write(data)
                size, n = size + len(data), n + 1
                if size >= roll_bytes:
                    out.close()
                    done.append((path, n))
                    out = None
        if out is not None:
            out.close()
            done.append((path, n))
        yield pd.DataFrame(done, columns=["path", "records"])

    rows = planned.select("page_id", "url", "html", "digest", "response_id").mapInPandas(write, MANIFEST)
    return materialize(rows, "warc-manifest").withColumn("folder", F.lit(folder))


class _Members:
    """Bytes of one gzip member after another, decompressed as they are asked for."""

    def __init__(self, stream, chunk: int = 1 << 16):
        self.stream, self.chunk, self.raw = stream, chunk, b""
        self.z, self.buf = None, bytearray()

    def next(self) -> bool:
        """Go to the next member; False at the end of the file."""
        self.raw = self.raw or self.stream.read(self.chunk)
        self.z, self.buf = zlib.decompressobj(31), bytearray()
        return bool(self.raw)

    def fill(self) -> bool:
        while not self.z.eof:
            data = self.z.decompress(self.z.unconsumed_tail or self.raw, self.chunk)
            if self.z.eof:
                self.raw = self.z.unused_data
            elif not self.z.unconsumed_tail:
                self.raw = self.stream.read(self.chunk)
                if not self.raw and not data:
                    raise ValueError("archive ends inside a gzip member")
            if data:
                self.buf += data
                return True
        return False

    def until(self, mark: bytes) -> bytes:
        at, seen = self.buf.find(mark), 0
        while at < 0:
            seen = max(0, len(self.buf) - len(mark))
            if not self.fill():
                raise ValueError("record header has no end")
            at = self.buf.find(mark, seen)
        head = bytes(self.buf[:at])
        del self.buf[:at + len(mark)]
        return head

    def take(self, n: int):
        """``n`` bytes, in pieces."""
        while n:
            if not self.buf and not self.fill():
                raise ValueError("block is shorter than its Content-Length")
            piece = bytes(self.buf[:n])
            del self.buf[:len(piece)]
            n -= len(piece)
            yield piece


def _headers(head: bytes) -> tuple[str, dict[str, str]]:
    first, *rest = head.decode().split("\r\n")
    return first, {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in rest)}


def _page_of(urn: str):
    value = urn.strip("<>").rpartition(":")[2]
    return None if value == "null" else int(value)


def iter_records(stream, with_payload: bool = False):
    """Page records of one archive, in order; raises ValueError on damaged framing or digests."""
    members = _Members(stream)
    while members.next():
        version, h = _headers(members.until(_CRLF + _CRLF))
        if not version.startswith("WARC/"):
            raise ValueError(f"not a WARC record: {version[:40]!r}")
        left, block = int(h["content-length"]), hashlib.sha1()
        pages = h["warc-type"] in ("response", "revisit")
        http, payload, kept, n = {}, hashlib.sha1(), [], 0
        head, in_head = b"", pages
        for piece in members.take(left):
            block.update(piece)
            if in_head:
                head += piece
                at = head.find(_CRLF + _CRLF)
                if at < 0:
                    continue
                http, piece, in_head = _headers(head[:at])[1], head[at + 4:], False
            payload.update(piece)
            n += len(piece)
            if with_payload:
                kept.append(piece)
        if b"".join(members.take(4)) != _CRLF + _CRLF or members.buf or members.fill():
            raise ValueError("record does not end where its Content-Length says")
        if _sha1_label(block.digest()) != h["warc-block-digest"]:
            raise ValueError(f"block digest differs in {h['warc-record-id']}")
        if not pages:
            continue
        stated = base64.b32decode(h["warc-payload-digest"].removeprefix("sha1:")).hex()
        if h["warc-type"] == "response" and (payload.hexdigest() != stated or n != int(http["content-length"])):
            raise ValueError(f"payload differs in {h['warc-record-id']}")
        yield (_page_of(h["warc-record-id"]), int(http["content-length"]), stated, h["warc-type"],
               _page_of(h["warc-refers-to"]) if "warc-refers-to" in h else None, h["warc-target-uri"],
               b"".join(kept) if with_payload and h["warc-type"] == "response" else None)


def read_archives(spark: SparkSession, manifest: DataFrame, with_payload: bool = False,
                  batch_rows: int = 2000) -> DataFrame:
    """Records of the archives in ``manifest``: a file is one task's work, read in order."""
    def read(batches):
        from pyarrow import fs as pafs
        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "uri", "payload"]

        def frame(rows):
            out = pd.DataFrame(rows, columns=names)
            return out.astype({"page_id": "Int64", "refers_to": "Int64"})

        for pdf in batches:
            for path, folder, n in zip(pdf["path"], pdf["folder"], pdf["records"]):
                fs, _ = pafs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:")
                                                 else f"file://{folder}")
                rows, seen = [], 0
                with fs.open_input_stream(path, compression=None) as stream:
                    for rec in iter_records(stream, with_payload):
                        rows.append(rec)
                        seen += 1
                        if len(rows) >= batch_rows:
                            yield frame(rows)
                            rows = []
                if seen != n:
                    raise ValueError(f"{path}: {seen} records, the manifest has {n}")
                if rows:
                    yield frame(rows)

    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return manifest.select("path", "folder", "records").repartition(parts).mapInPandas(read, RECORDS)


def page_records(pages: DataFrame) -> DataFrame:
    """Write ``pages`` as archives in the shared folder and read them back."""
    spark = pages.sparkSession
    folder = scratch_path(spark, "warc")
    manifest = write_archives(plan_records(pages), folder)
    return read_archives(spark, manifest).drop("uri", "payload")


SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS d FROM pages),
g AS (SELECT d, max(page_id) AS response_id FROM p WHERE strlen(html) >= 1000 GROUP BY d)
SELECT p.page_id, CAST(strlen(p.html) AS BIGINT) AS payload_bytes, p.d AS payload_digest,
       CASE WHEN g.response_id IS NULL OR g.response_id = p.page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN g.response_id <> p.page_id THEN g.response_id END AS refers_to
FROM p LEFT JOIN g ON p.d = g.d AND strlen(p.html) >= 1000
"""
