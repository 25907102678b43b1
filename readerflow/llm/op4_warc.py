"""WARC archives: writer with revisit records, and a splittable reader.

Writing: equal payloads of at least ``min_revisit`` bytes are found by their
SHA-1 (the shuffle before the aggregation carries digests and ids, not pages);
the largest page id of such a group is stored whole, the others become revisit
records that refer to it. Each record is a gzip member of its own. A task writes
its file under a name of its own and moves it into place; only the files of
tasks that committed are in the manifest, so lost or repeated tasks leave
nothing that is read.

Reading: files are cut into byte ranges. A task scans its range for the gzip
magic, takes a candidate as a member only if it inflates, its first line is a
WARC version, its headers are complete and its checksum holds, and owns the
records that start inside its range, reading on beyond the end for the last one.

Defined results: null html is an empty payload; a null id is written and read
back as null (equal payloads without any id stay responses); rows that repeat
the largest id of a group are all responses; empty tables give no archive and no
rows. Only id, url and html are read, so further columns never clash.
"""

from __future__ import annotations

import hashlib
import re
import urllib.parse
import uuid
import zlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from readerflow.session import scratch_path

from .common import table

MIN_REVISIT = 1000
MAGIC = b"\x1f\x8b\x08"
DATE = "2024-01-01T00:00:00Z"
MAX_HEADER = 1 << 16
PAGE, NO_PAGE = "<urn:x-page:", "<urn:x-no-page>"


def _filesystem(path: str):
    from pyarrow import fs

    path = re.sub(r"^file:/+", "/", path)
    return fs.FileSystem.from_uri(path)


def plan_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_revisit: int = MIN_REVISIT) -> DataFrame:
    """(page_id, url, html, digest, refers_to): refers_to is null for responses."""
    payload = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"),
                        F.sha1(payload).alias("digest"), F.octet_length(payload).alias("n"))
    groups = (rows.where(F.col("n") >= min_revisit).groupBy("digest").agg(F.max("page_id").alias("whole"), F.count("*").alias("copies"))
              .where("copies > 1 AND whole IS NOT NULL").drop("copies"))
    # short payloads have no group; they are dealt by page, so that many equal ones are not one key
    found = F.when(F.col("n") >= min_revisit, F.col("digest")).otherwise(F.concat(F.lit("-"), F.hex(F.xxhash64("page_id", "url"))))
    joined = rows.withColumn("found", found).join(groups.withColumnRenamed("digest", "found"), "found", "left")
    return joined.select("page_id", "url", "html", "digest", F.when(~F.col("page_id").eqNullSafe(F.col("whole")), F.col("whole")).alias("refers_to"))


def _urn(page_id) -> str:
    return NO_PAGE if page_id is None else f"{PAGE}{urllib.parse.quote(str(page_id), safe='')}>"


def _page_id(urn: str | None) -> str | None:
    return urllib.parse.unquote(urn[len(PAGE):-1]) if urn and urn.startswith(PAGE) else None


def _member(page_id, url, html, digest, refers_to, level: int) -> bytes:
    payload = (html or "").encode()
    uri = urllib.parse.quote(url or "about:blank", safe="!#$%&'()*+,/:;=?@[]~-._")
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = [
        "WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {_urn(page_id)}", f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {uri}", f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
    ]
    if refers_to is not None:
        head += [f"WARC-Refers-To: {_urn(refers_to)}", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    return zlib.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", level, wbits=31)


def write_archives(records: DataFrame, root: str, level: int = 4, roll_bytes: int = 256 << 20) -> DataFrame:
    """Write the planned records below ``root``; returns the manifest (path, bytes, records) as a committed table."""
    spark = records.sparkSession

    def run(batches):
        files, base = _filesystem(root)
        files.create_dir(base, recursive=True)
        out, done = None, []

        def close():
            out[0].close()
            files.move(out[1] + ".part", out[1])
            done.append((out[1], out[2], out[3]))

        for b in batches:
            for row in zip(*(b.column(k).to_pylist() for k in range(5))):
                if out is None:
                    name = f"{base}/{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.gz"
                    out = [files.open_output_stream(name + ".part", compression=None), name, 0, 0]
                data = _member(*row, level)
                out[0].write(data)
                out[2] += len(data)
                out[3] += 1
                if out[2] >= roll_bytes:
                    close()
                    out = None
        if out is not None:
            close()
        yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done], pa.int64()), pa.array([d[2] for d in done], pa.int64())],
                                         names=["path", "bytes", "records"])

    manifest = f"{root}-manifest"
    records.mapInArrow(run, "path string, bytes long, records long").write.parquet(manifest)
    return spark.read.schema("path string, bytes long, records long").parquet(manifest)


class _Window:
    """Buffered forward reads of a file."""

    def __init__(self, f, size: int, block: int) -> None:
        self.f, self.size, self.block, self.base, self.buf = f, size, block, 0, b""

    def get(self, at: int, n: int) -> bytes:
        n = min(n, self.size - at)
        if n <= 0:
            return b""
        if not (self.base <= at and at + n <= self.base + len(self.buf)):
            self.f.seek(at)
            self.base, self.buf = at, self.f.read(max(n, self.block))
        return self.buf[at - self.base:at - self.base + n]


def _inflate(win: _Window, at: int) -> tuple[bytes, int] | None:
    """The member at ``at`` and where it ends; None if it is not a whole gzip member with a WARC header."""
    d, parts, got, pos, step = zlib.decompressobj(31), [], 0, at, 4096
    checked = False
    try:
        while not d.eof:
            piece = win.get(pos, step)
            if not piece:
                return None
            pos += len(piece)
            parts.append(d.decompress(piece))
            got += len(parts[-1])
            step = min(step * 2, 1 << 20)
            if not checked and got >= 8:
                if not b"".join(parts)[:8].startswith(b"WARC/1."):
                    return None
                checked = True
    except zlib.error:
        return None
    return b"".join(parts), pos - len(d.unused_data)


def _parse(record: bytes) -> dict[str, str] | None:
    cut = record.find(b"\r\n\r\n", 0, MAX_HEADER)
    if cut < 0 or not record.startswith(b"WARC/1."):
        return None
    head = {}
    for line in record[:cut].decode("utf-8", "replace").split("\r\n")[1:]:
        k, sep, v = line.partition(":")
        if not sep:
            return None
        head[k.strip().lower()] = v.strip()
    n = head.get("content-length", "")
    if not n.isdigit() or len(record) < cut + 4 + int(n) or "warc-type" not in head:
        return None
    head["__block"] = record[cut + 4:cut + 4 + int(n)]
    return head


def read_range(path: str, start: int, end: int, block: int = 1 << 20):
    """Headers and blocks of the records that start in [start, end)."""
    files, name = _filesystem(path)
    with files.open_input_file(name) as f:
        win, pos = _Window(f, f.size(), block), start
        while pos < end:
            here = win.get(pos, 4096)
            hit = here.find(MAGIC)
            if hit < 0:
                if pos + len(here) >= win.size:
                    break
                pos += max(1, len(here) - len(MAGIC) + 1)
                continue
            pos += hit
            if pos >= end:
                break
            member = _inflate(win, pos)
            head = _parse(member[0]) if member else None
            if head is None:
                pos += 1
                continue
            yield head
            pos = member[1]


def _record(head: dict) -> tuple:
    http, _, payload = head["__block"].partition(b"\r\n\r\n")
    digest = head.get("warc-payload-digest", "").partition(":")[2]
    if head["warc-type"] == "revisit":
        m = re.search(rb"(?i)content-length:\s*(\d+)", http)
        size = int(m[1]) if m else None
    else:
        size, own = len(payload), hashlib.sha1(payload).hexdigest()
        if digest and digest != own:
            raise ValueError(f"payload of {head.get('warc-record-id')} does not match its digest")
        digest = own
    return _page_id(head.get("warc-record-id")), head.get("warc-target-uri"), size, digest, head["warc-type"], _page_id(head.get("warc-refers-to")), payload


def read_archives(manifest: DataFrame, split_bytes: int = 64 << 20, with_payload: bool = False) -> DataFrame:
    """Records of the files of a manifest (path, bytes), cut into ranges of ``split_bytes``."""
    n = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = manifest.where("bytes > 0").select("path", F.explode(F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(split_bytes).cast("long"))).alias("start"))
    ranges = ranges.repartition(n, "path", "start")
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", *(["payload"] if with_payload else [])]

    def run(batches):
        for b in batches:
            for path, start in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                rows = []
                for head in read_range(path, start, start + split_bytes):
                    rows.append(_record(head)[: len(names)])
                    if len(rows) >= 1000:
                        yield _batch(rows, names)
                        rows = []
                if rows:
                    yield _batch(rows, names)

    schema = "page_id string, url string, payload_bytes long, payload_digest string, record_type string, refers_to string" + (", payload binary" if with_payload else "")
    return ranges.mapInArrow(run, schema)


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    kind = pages.schema["page_id"].dataType
    manifest = write_archives(plan_records(pages), scratch_path(spark, "warc"))
    back = read_archives(manifest, split_bytes=1 << 20)
    return back.select(F.col("page_id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to"))


ORACLE = f"""
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS d FROM pages),
g AS (SELECT d, max(page_id) AS whole FROM p WHERE n >= {MIN_REVISIT} GROUP BY d)
SELECT p.page_id, p.n AS payload_bytes, p.d AS payload_digest,
       CASE WHEN g.whole IS NOT NULL AND p.page_id IS DISTINCT FROM g.whole THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN g.whole IS NOT NULL AND p.page_id IS DISTINCT FROM g.whole THEN g.whole END AS refers_to
FROM p LEFT JOIN g ON p.d = g.d
"""
