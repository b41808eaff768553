"""Operator 10 - WARC records in ZIP packages, read without extraction.

Writing: every task packs its rows into archives in the shared folder.  An
archive is a ZIP file with two stored members, ``archive/data.warc.gz`` (one
gzip member per WARC record, so any record can be read alone) and
``indexes/index.cdxj`` (one JSON line per record: where it is).  Both members
have ZIP64 headers, so no size limit is met.  A task names its files by its
attempt and returns them as rows; the manifest of those rows, written once,
names the archives of the tasks that counted, so a lost executor or a second
attempt leaves no half or double archive in the result.

Reading: the end record, the ZIP64 locator and end record and the central
directory are parsed from range reads at the file's end; the stored index
member gives the records' places, and each record is one range read.  Nothing
is unpacked to disk and a task holds one index and one record.

Repeated payloads: of equal payloads of at least ``MIN_REVISIT`` bytes the one
with the smallest id is a ``response``, the others are ``revisit`` records
without a payload that name it.

Defined cases: NULL html is an empty payload; a NULL id is always a response
and never referred to; rows that repeat the responding id are responses too;
NULL url is written as ``urn:none``; an empty table gives no archive; other
columns are ignored.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import os
import re
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenderlake.session import scratch_path

from .common import local_path, read, written

MIN_REVISIT = 100
ARCHIVE_RECORDS = 20_000
ARCHIVE_BYTES = 256 << 20
DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
MANIFEST = "archive string, records long, bytes long"
RECORD = ("archive string, page_id long, url string, record_type string, refers_to long, payload_bytes long, "
          "payload_digest string, payload binary")


# -------------------------------------------------------------------- storage
def _store(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder or file, for a worker of any executor."""
    path = local_path(uri)
    return (pafs.LocalFileSystem(), path) if path is not None else pafs.FileSystem.from_uri(uri)


# ------------------------------------------------------------------------ zip
class ZipReader:
    """Members of a ZIP file on a random-access file, from its central directory."""

    TAIL = 22 + 65535 + 20

    def __init__(self, f, size: int):
        self.f, self.size = f, size
        tail_at = max(0, size - self.TAIL)
        tail = self.at(tail_at, size - tail_at)
        end = self._end(tail)
        entries, length, offset = struct.unpack_from("<HII", tail, end + 10)
        if entries == 0xFFFF or length == 0xFFFFFFFF or offset == 0xFFFFFFFF:
            if end < 20 or tail[end - 20:end - 16] != b"PK\x06\x07":
                raise ValueError("ZIP64 locator is missing")
            (at,) = struct.unpack_from("<Q", tail, end - 12)
            head = self.at(at, 56)
            if head[:4] != b"PK\x06\x06":
                raise ValueError("ZIP64 end record is missing")
            entries, length, offset = struct.unpack_from("<QQQ", head, 32)
        self.members = dict(self._directory(self.at(offset, length), entries))

    def at(self, offset: int, length: int) -> bytes:
        self.f.seek(offset)
        data = self.f.read(length)
        if len(data) != length:
            raise ValueError(f"file ends at {offset + len(data)}, {offset + length} expected")
        return data

    @staticmethod
    def _end(tail: bytes) -> int:
        """Place of the end record: the last one whose comment reaches the file's end."""
        at = tail.rfind(b"PK\x05\x06")
        while at >= 0:
            if at + 22 <= len(tail) and at + 22 + struct.unpack_from("<H", tail, at + 20)[0] == len(tail):
                return at
            at = tail.rfind(b"PK\x05\x06", 0, at)
        raise ValueError("not a ZIP file")

    @staticmethod
    def _directory(data: bytes, entries: int) -> Iterator[tuple[str, dict]]:
        at = 0
        for _ in range(entries):
            if data[at:at + 4] != b"PK\x01\x02":
                raise ValueError("central directory is broken")
            flags, method = struct.unpack_from("<HH", data, at + 8)
            packed, full, n_name, n_extra, n_note = struct.unpack_from("<IIHHH", data, at + 20)
            (header,) = struct.unpack_from("<I", data, at + 42)
            name = data[at + 46:at + 46 + n_name]
            wide = ZipReader._wide(data[at + 46 + n_name:at + 46 + n_name + n_extra])
            if full == 0xFFFFFFFF:
                full = next(wide)
            if packed == 0xFFFFFFFF:
                packed = next(wide)
            if header == 0xFFFFFFFF:
                header = next(wide)
            yield name.decode("utf-8" if flags & 0x800 else "cp437"), {"method": method, "size": packed, "full": full, "header": header}
            at += 46 + n_name + n_extra + n_note

    @staticmethod
    def _wide(extra: bytes) -> Iterator[int]:
        """The 64-bit values of the ZIP64 extra field, in order."""
        at = 0
        while at + 4 <= len(extra):
            kind, n = struct.unpack_from("<HH", extra, at)
            if kind == 1:
                yield from struct.unpack_from(f"<{n // 8}Q", extra, at + 4)
            at += 4 + n

    def start(self, name: str) -> int:
        """Where the bytes of a stored member begin."""
        m = self.members[name]
        if m["method"]:
            raise ValueError(f"{name} is compressed; only stored members can be range-read")
        head = self.at(m["header"], 30)
        if head[:4] != b"PK\x03\x04":
            raise ValueError(f"{name} has no local header")
        n_name, n_extra = struct.unpack_from("<HH", head, 26)
        return m["header"] + 30 + n_name + n_extra


# ----------------------------------------------------------------------- warc
def warc_record(page_id, url, kind: str, refers_to, size: int, digest: str, payload: bytes) -> bytes:
    """One WARC/1.1 record; a revisit has no block and names the response's digest and id."""
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
             f"WARC-Target-URI: {re.sub(r'[\x00-\x20\x7f]', lambda m: f'%{ord(m[0]):02X}', url or 'urn:none')}", "Content-Type: text/html",
             f"WARC-Payload-Digest: sha256:{digest}", f"X-Payload-Length: {size}"]
    if kind == "revisit":
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    lines.append(f"Content-Length: {len(payload)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + payload + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict, bytes]:
    """Headers (lower-case names) and block of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
    n = int(headers["content-length"])
    if rest[n:] != b"\r\n\r\n":
        raise ValueError("record length is wrong")
    return headers, rest[:n]


class Package:
    """An archive being written: records go to the data member as they come."""

    def __init__(self, folder: str):
        self.uri = f"{folder}/part-{uuid.uuid4().hex}.wacz"
        self.fs, path = _store(self.uri)
        self.fs.create_dir(os.path.dirname(path), recursive=True)
        self.out = self.fs.open_output_stream(path)
        self.zip = zipfile.ZipFile(self.out, "w", zipfile.ZIP_STORED)
        self.data = self.zip.open(zipfile.ZipInfo(DATA), "w", force_zip64=True)
        self.index, self.bytes = [], 0

    def add(self, key, record: bytes) -> None:
        packed = gzip.compress(record, 6, mtime=0)
        self.index.append(json.dumps({"id": key, "offset": self.bytes, "length": len(packed)}))
        self.data.write(packed)
        self.bytes += len(packed)

    def full(self) -> bool:
        return len(self.index) >= ARCHIVE_RECORDS or self.bytes >= ARCHIVE_BYTES

    def close(self) -> tuple[str, int, int]:
        self.data.close()
        with self.zip.open(zipfile.ZipInfo(INDEX), "w", force_zip64=True) as f:
            f.write("\n".join(self.index).encode())
        self.zip.close()
        self.out.close()
        return self.uri, len(self.index), self.bytes


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Archives of (page_id, url, payload, digest, first_id) rows; one row per archive."""

    def run(batches):
        package, made = None, []
        for batch in batches:
            for i in range(batch.num_rows):
                page_id, url, payload, digest, first = (c[i].as_py() for c in batch.columns)
                package = package or Package(folder)
                revisit = first is not None and page_id is not None and first != page_id
                package.add(page_id, warc_record(page_id, url, "revisit" if revisit else "response", first, len(payload), digest, b"" if revisit else payload))
                if package.full():
                    made.append(package.close())
                    package = None
        if package:
            made.append(package.close())
        if made:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*made)], names=["archive", "records", "bytes"])

    return pages.select("page_id", "url", "payload", "digest", "first_id").mapInArrow(run, MANIFEST)


def read_archives(archives: DataFrame) -> DataFrame:
    """The records (see RECORD) of all archives of (archive); payload is NULL for a revisit."""

    def records(uri: str):
        fs, path = _store(uri)
        with fs.open_input_file(path) as f:
            package = ZipReader(f, f.size())
            data, index = package.start(DATA), package.at(package.start(INDEX), package.members[INDEX]["size"])
            for line in index.decode().split("\n") if index else []:
                at = json.loads(line)
                headers, block = parse_record(zlib.decompress(package.at(data + at["offset"], at["length"]), 31))
                kind = headers["warc-type"]
                own, refers = (re.search(r"urn:page:(-?\d+)", headers.get(h, "")) for h in ("warc-record-id", "warc-refers-to"))
                digest, size = headers["warc-payload-digest"].removeprefix("sha256:"), int(headers["x-payload-length"])
                if kind == "response":
                    if digest != hashlib.sha256(block).hexdigest() or size != len(block):
                        raise ValueError(f"{uri}: payload of record {at['id']} does not match its digest")
                yield (uri, own and int(own[1]), headers["warc-target-uri"], kind, refers and int(refers[1]), size, digest,
                       block if kind == "response" else None)

    def run(batches):
        kinds = (pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary())
        names = [x.split()[0] for x in RECORD.split(", ")]

        def packed(rows):
            return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), kinds)], names=names)

        for batch in batches:
            for uri in batch.column(0).to_pylist():
                held, size = [], 0
                for r in records(uri):
                    held.append(r)
                    size += len(r[-1] or b"")
                    if size >= 1 << 20 or len(held) >= 1000:
                        yield packed(held)
                        held, size = [], 0
                if held:
                    yield packed(held)

    return archives.select("archive").mapInArrow(run, RECORD)


def with_first(pages: DataFrame, min_bytes: int = MIN_REVISIT) -> DataFrame:
    """(page_id, url, payload, digest, first_id): first_id is the smallest id with the
    payload where several rows share one of at least ``min_bytes`` bytes, else NULL.

    Only payloads that occur more than once are on the right of the join; ids
    and digests are combined before the shuffle, so a payload that holds a
    third of all rows is one row per task there, and Spark may split it here.
    """
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    firsts = (rows.filter(F.octet_length("payload") >= min_bytes).groupBy(F.col("digest").alias("_d"))
              .agg(F.min("page_id").alias("first_id"), F.count("*").alias("_n")).filter("_n > 1").drop("_n"))
    return rows.join(firsts, F.col("digest") == F.col("_d"), "left").drop("_d")


def packed(pages: DataFrame) -> DataFrame:
    """Write the archives of ``pages`` and return the records read back from them."""
    spark = pages.sparkSession
    folder = scratch_path(spark, "warc")
    manifest = written(spark, write_archives(with_first(pages), folder), "warc-manifest")
    n = manifest.count()  # archives, spread over the tasks that read them
    return read_archives(manifest.repartition(max(1, n), "archive"))


def query(spark, sf_dir: str) -> DataFrame:
    return packed(read(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, octet_length(encode(html)) AS n, sha256(html) AS digest FROM p),
f AS (SELECT digest, min(page_id) AS first_id FROM d WHERE n >= 100 GROUP BY digest)
SELECT d.page_id, CAST(d.n AS BIGINT) AS payload_bytes, d.digest AS payload_digest,
       CASE WHEN f.first_id <> d.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN f.first_id <> d.page_id THEN f.first_id END AS refers_to
FROM d LEFT JOIN f ON d.digest = f.digest
"""
