"""WARC records in ZIP packages: a deduplicating writer and a range reader.

A package is a ZIP archive (stored, not deflated) with two members:
``archive/data.warc.gz``, one gzip member a record, and ``indexes/index.cdxj``,
one JSON line a record with its place inside the first member. The reader finds
the central directory from the end of the file (ZIP64 included), locates the
stored members, and fetches single records with range reads; nothing is
extracted. Records with an equal payload of some length are stored once: the
others are ``revisit`` records that name it.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import json
import struct
import uuid
import zipfile
import zlib

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airdata.llm.common import shared_path, ship, staged, utf8

#: Payloads shorter than this are always stored.
LEAST = 1000
#: Records a reading task fetches in one go.
READ = 512
#: Fixed values of the ZIP and WARC formats.
EOCD, EOCD64, EOCD64_AT, CENTRAL, LOCAL = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07", b"PK\x01\x02", b"PK\x03\x04"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"


# ------------------------------------------------------------------ ZIP

def members(f, size: int) -> dict[str, tuple[int, int]]:
    """Name -> (offset of the data, length) of the stored members of a ZIP archive.

    ``f`` has ``read_at(n, offset)``-like access through ``_at``. Reads the end
    of the file, the central directory and the local headers, nothing else.
    Deflated or encrypted members are an error: they allow no range reads.
    """
    tail_at = max(0, size - 65_557 - 20)  # the longest comment, the record itself, the ZIP64 locator
    tail = _at(f, tail_at, size - tail_at)
    end = tail.rfind(EOCD)
    if end < 0:
        raise ValueError("no end of central directory: not a ZIP archive")
    count, length, start = struct.unpack("<HII", tail[end + 10:end + 20])
    if count == 0xFFFF or length == 0xFFFFFFFF or start == 0xFFFFFFFF:
        if tail[end - 20:end - 16] != EOCD64_AT:
            raise ValueError("no ZIP64 locator")
        (at,) = struct.unpack("<Q", tail[end - 12:end - 4])
        head = _at(f, at, 56)
        if head[:4] != EOCD64:
            raise ValueError("no ZIP64 end of central directory")
        count, length, start = struct.unpack("<QQQ", head[32:56])
    directory, out, p = _at(f, start, length), {}, 0
    for _ in range(count):
        if directory[p:p + 4] != CENTRAL:
            raise ValueError("central directory is damaged")
        flags, method = struct.unpack("<HH", directory[p + 8:p + 12])
        packed, whole, n, m, k = struct.unpack("<IIHHH", directory[p + 20:p + 34])
        (at,) = struct.unpack("<I", directory[p + 42:p + 46])
        name = directory[p + 46:p + 46 + n].decode("utf-8" if flags & 0x800 else "cp437")
        extra = directory[p + 46 + n:p + 46 + n + m]
        while len(extra) >= 4:
            kind, size_ = struct.unpack("<HH", extra[:4])
            if kind == 1:  # ZIP64: only the fields that overflowed, in this order
                wide = io.BytesIO(extra[4:4 + size_])
                if whole == 0xFFFFFFFF:
                    (whole,) = struct.unpack("<Q", wide.read(8))
                if packed == 0xFFFFFFFF:
                    (packed,) = struct.unpack("<Q", wide.read(8))
                if at == 0xFFFFFFFF:
                    (at,) = struct.unpack("<Q", wide.read(8))
            extra = extra[4 + size_:]
        if method != 0 or flags & 1:
            raise ValueError(f"member {name} is compressed or encrypted, not stored")
        local = _at(f, at, 30)
        if local[:4] != LOCAL:
            raise ValueError(f"local header of {name} is damaged")
        a, b = struct.unpack("<HH", local[26:30])
        out[name] = (at + 30 + a + b, packed)
        p += 46 + n + m + k
    return out


def _at(f, offset: int, n: int) -> bytes:
    f.seek(offset)
    return f.read(n)


# ----------------------------------------------------------------- WARC

def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC record. A revisit keeps the HTTP header, with the length of the full payload, and no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    name = uuid.UUID(hashlib.md5(f"{page_id}|{url}|{digest}".encode()).hexdigest())
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:uuid:{name}>", f"WARC-Date: {DATE}",
            f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if url is not None:
        head.append("WARC-Target-URI: " + "".join(c if c.isprintable() and c != " " else "".join(f"%{b:02X}" for b in c.encode()) for c in url))
    if revisit:
        head += [f"WARC-Profile: {PROFILE}"] + ([f"X-Refers-To-Page-ID: {refers_to}"] if refers_to is not None else [])
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> dict:
    """A record read back: its headers, the payload and the payload's full length."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    h = {k.strip(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    block = rest[:int(h["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    return {"type": h["WARC-Type"], "page_id": int(h["X-Page-ID"]) if "X-Page-ID" in h else None, "url": h.get("WARC-Target-URI"),
            "digest": h["WARC-Payload-Digest"].partition(":")[2], "payload": payload, "length": length,
            "refers_to": int(h["X-Refers-To-Page-ID"]) if "X-Refers-To-Page-ID" in h else None}


def _runs(index: list[dict], read: int, most: int = 1 << 22):
    """The index in runs of up to ``read`` neighbouring records and ``most`` bytes (a longer record is a run of its own)."""
    part, size = [], 0
    for x in index:
        if part and (len(part) == read or size + x["length"] > most):
            yield part
            part, size = [], 0
        part.append(x)
        size += x["length"]
    if part:
        yield part


# ------------------------------------------------------------ operators

def with_originals(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """Add payload_digest, payload_bytes, record_type and refers_to to (page_id, url, html).

    Of the pages with an equal payload of at least ``least`` bytes, the one
    with the largest page_id is the response; null ids come after all others.
    Only digests that occur twice are joined back, and they are counted before
    the shuffle, so that a page copied a million times is a row a task there.
    Rows that repeat a page in full, its id included, are responses all.
    """
    body = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    p = (pages.select("page_id", "url", "html").withColumn("payload_digest", F.sha1(body)).withColumn("payload_bytes", F.octet_length(body).cast("long")))
    same = (p.filter(F.col("payload_bytes") >= least).groupBy(F.col("payload_digest").alias("_digest"))
            .agg(F.max("page_id").alias("_original"), F.count(F.lit(1)).alias("_n")).filter("_n > 1").drop("_n"))
    p = p.join(same, (F.col("payload_digest") == F.col("_digest")) & (F.col("payload_bytes") >= least), "left")
    again = F.col("_original").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_original"))
    return (p.withColumn("record_type", F.when(again, "revisit").otherwise("response"))
            .withColumn("refers_to", F.when(again, F.col("_original"))).drop("_original", "_digest"))


def write_packages(pages: DataFrame, path: str | None = None, least: int = LEAST, level: int = 1) -> DataFrame:
    """Write the records of (page_id, url, html) as packages under ``path``; a row a package: path, records, bytes.

    Each task writes one package under a name of its own, so a task that runs
    again leaves an unused file and no half one; the returned table, itself in
    the shared folder, lists the packages that count. Records go to the package
    as they come, so memory holds one record and the index. Null html is an
    empty payload; an empty table gives no packages.
    """
    spark = pages.sparkSession
    ship(spark)
    path = path or shared_path(spark, "packages")

    def write(batches):
        pack = None
        for b in batches:
            if not b.num_rows:
                continue
            if pack is None:
                pack = _Package(path, level)
            for row in zip(b.column("page_id").to_pylist(), b.column("url").to_pylist(), utf8(b.column("html")), b.column("payload_digest").to_pylist(),
                           b.column("record_type").to_pylist(), b.column("refers_to").to_pylist()):
                pack.add(*row)
        if pack is not None:
            yield pa.RecordBatch.from_pylist([pack.close()], schema=pa.schema([("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())]))

    return staged(with_originals(pages, least).mapInArrow(write, "path string, records long, bytes long"), "packages-list")


class _Package:
    """A package being written: records stream into the stored member, the index follows as the second."""

    def __init__(self, path: str, level: int):
        fs, base = pafs.FileSystem.from_uri(path)
        fs.create_dir(base, recursive=True)
        name = f"pages-{uuid.uuid4().hex}.wacz"
        self.path, self.level = f"{path.rstrip('/')}/{name}", level
        self.out = fs.open_output_stream(f"{base}/{name}")
        # the stream isn't seekable: sizes follow the data, and the index names exact places
        self.zip = zipfile.ZipFile(self.out, "w", zipfile.ZIP_STORED, allowZip64=True)
        self.member = self.zip.open(zipfile.ZipInfo("archive/data.warc.gz", (2024, 1, 1, 0, 0, 0)), "w", force_zip64=True)
        self.index, self.offset = [], 0

    def add(self, page_id, url, payload, digest, kind, refers_to):
        raw = gzip.compress(record(page_id, url, payload or b"", digest, refers_to, kind == "revisit"), self.level, mtime=0)
        self.member.write(raw)
        self.index.append((self.offset, len(raw)))
        self.offset += len(raw)

    def close(self) -> dict:
        self.member.close()
        lines = "".join(json.dumps({"offset": o, "length": n}) + "\n" for o, n in self.index)
        self.zip.writestr(zipfile.ZipInfo("indexes/index.cdxj", (2024, 1, 1, 0, 0, 0)), lines)
        self.zip.close()
        size = self.out.tell()
        self.out.close()
        return {"path": self.path, "records": len(self.index), "bytes": size}


def read_packages(spark: SparkSession, packages: DataFrame, read: int = READ) -> DataFrame:
    """The records of the packages listed in ``packages`` (path): page_id, url, record_type, payload_digest, refers_to, payload_bytes, payload (binary, empty for a revisit).

    One pass reads directories and indexes and deals the places out in runs of
    ``read`` records; a second one fetches each run with one range read.
    """
    ship(spark)

    def places(batches):
        for b in batches:
            for path in b.column("path").to_pylist():
                fs, at = pafs.FileSystem.from_uri(path)
                with fs.open_input_file(at) as f:
                    found = members(f, f.size())
                    start, n = found["indexes/index.cdxj"]
                    index = [json.loads(x) for x in _at(f, start, n).decode().splitlines()]
                base = found["archive/data.warc.gz"][0]
                for part in _runs(index, read):
                    yield pa.RecordBatch.from_pylist([{"path": path, "start": base + part[0]["offset"], "lengths": [x["length"] for x in part]}],
                                                     schema=pa.schema([("path", pa.string()), ("start", pa.int64()), ("lengths", pa.list_(pa.int64()))]))

    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_digest", pa.string()),
                        ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload", pa.binary())])

    def fetch(batches):
        for b in batches:
            for path, start, lengths in zip(*(b.column(c).to_pylist() for c in ("path", "start", "lengths"))):
                fs, at = pafs.FileSystem.from_uri(path)
                with fs.open_input_file(at) as f:
                    raw = _at(f, start, sum(lengths))
                rows, p = [], 0
                for n in lengths:
                    r = parse(zlib.decompress(raw[p:p + n], 31))
                    if r["type"] == "response" and hashlib.sha1(r["payload"]).hexdigest() != r["digest"]:
                        raise ValueError(f"{path}: the payload at {start + p} doesn't have its digest")
                    rows.append({"page_id": r["page_id"], "url": r["url"], "record_type": r["type"], "payload_digest": r["digest"],
                                 "refers_to": r["refers_to"], "payload_bytes": r["length"], "payload": r["payload"]})
                    p += n
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    runs = packages.select("path").repartition(packages.sparkSession.sparkContext.defaultParallelism).mapInArrow(places, "path string, start long, lengths array<long>")
    runs = runs.repartition(spark.sparkContext.defaultParallelism * 4, "path", "start")
    return runs.mapInArrow(fetch, "page_id long, url string, record_type string, payload_digest string, refers_to long, payload_bytes long, payload binary")
