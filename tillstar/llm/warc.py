"""WARC records in ZIP-packaged archives: writer and range reader.

An archive is a ZIP file with two stored (never deflated) members:
``archive/data.warc.gz``, WARC records each in a gzip member of its own, and
``indexes/index.cdx``, one JSON line per record with its offset and length in
the first member.  The reader parses the end record, the ZIP64 locator and end
record and the central directory, finds where stored members begin from their
local headers, reads the index by range and then each record by range; nothing
is extracted.

Each task writes its own archives (rolled over at ``ARCHIVE_BYTES``) into the
shared folder under fresh names; only archives of tasks that ended well are in
the table of archives, so a lost or repeated task leaves at most a file that
nobody reads.

Nulls: a null html is an empty payload, a null page_id is kept as null and is
never referred to; repeated page_ids with equal payloads are all responses;
an empty table writes no archive and reads no record.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstar.llm.common import map_arrow, written
from tillstar.session import make_dirs, work_dir

ARCHIVE_BYTES = 256 << 20  # an archive is closed once its records reach this size
READ_BYTES = 4 << 20  # neighbouring records are read together up to this size
DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdx"
RECORDS = (
    "page_id bigint, url string, record_type string, payload_digest string, payload_bytes bigint, "
    "refers_to bigint, payload string, intact boolean"
)


def file_system(path: str) -> tuple[pa.fs.FileSystem, str]:
    """The file system of a folder or file named by URI or by absolute path."""
    if "://" not in path and path.startswith("file:"):
        path = "file://" + path[len("file:") :]
    return pa.fs.FileSystem.from_uri(path)


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _clean(value: str) -> str:
    """A header value on one line: control characters are percent-encoded."""
    return "".join(f"%{ord(c):02X}" if ord(c) < 32 or ord(c) == 127 else c for c in value)


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """A WARC 1.1 record: a response, or a revisit (no payload) that refers to one."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    block = http if refers_to is not None else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha1:{payload_digest(payload)}",
        f"WARC-Payload-Length: {len(payload)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.insert(3, f"WARC-Target-URI: {_clean(url)}")
    if refers_to is not None:
        head.insert(3, "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.insert(4, f"WARC-Refers-To: <urn:page:{refers_to}>")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> dict:
    """Fields of one record; ``intact`` says that lengths and digest agree with the payload."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    named = {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
    block = rest[: int(named["content-length"])]
    page = lambda v: int(v[len("<urn:page:") : -1]) if v and v != "<urn:page:>" else None
    kind = named["warc-type"]
    payload = block.partition(b"\r\n\r\n")[2] if kind == "response" else None
    digest = named["warc-payload-digest"].removeprefix("sha1:")
    n = int(named["warc-payload-length"])
    return {
        "page_id": page(named.get("warc-record-id")),
        "url": named.get("warc-target-uri"),
        "record_type": kind,
        "payload_digest": digest,
        "payload_bytes": n,
        "refers_to": page(named.get("warc-refers-to")),
        "payload": None if payload is None else payload.decode("utf-8", "replace"),
        "intact": payload is None or (payload_digest(payload) == digest and len(payload) == n),
    }


class ArchiveWriter:
    """One archive: records are appended, the index and directory follow at the end."""

    def __init__(self, folder: str):
        fs, base = file_system(folder)
        self.path = f"{folder}/{uuid.uuid4().hex}.wacz"
        self.file = fs.open_output_stream(f"{base}/{self.path.rpartition('/')[2]}")
        self.zip = zipfile.ZipFile(self.file, "w", zipfile.ZIP_STORED)
        self.data = self.zip.open(zipfile.ZipInfo(DATA), "w", force_zip64=True)
        self.index: list[str] = []
        self.size = 0

    def add(self, raw: bytes, page_id: int | None) -> None:
        packed = gzip.compress(raw, compresslevel=1, mtime=0)
        self.data.write(packed)
        self.index.append(json.dumps({"page": page_id, "offset": self.size, "length": len(packed)}))
        self.size += len(packed)

    def close(self) -> tuple[str, int]:
        self.data.close()
        with self.zip.open(zipfile.ZipInfo(INDEX), "w", force_zip64=True) as f:
            f.write("\n".join(self.index).encode())
        self.zip.close()
        self.file.close()
        return self.path, len(self.index)


class ArchiveReader:
    """Range reads of a ZIP-packaged archive through its central directory."""

    def __init__(self, path: str):
        fs, at = file_system(path)
        self.file = fs.open_input_file(at)
        self.members = self._directory()

    def read(self, start: int, length: int) -> bytes:
        self.file.seek(start)
        return self.file.read(length)

    def _directory(self) -> dict[str, tuple[int, int]]:
        """Name -> (local header offset, stored size) of every stored member."""
        size = self.file.size()
        tail_at = max(0, size - 65557)  # the end record, and the longest comment after it
        tail = self.read(tail_at, size - tail_at)
        end = tail.rfind(b"PK\x05\x06", 0, max(0, len(tail) - 18))
        while end >= 0 and end + 22 + struct.unpack_from("<H", tail, end + 20)[0] != len(tail):
            end = tail.rfind(b"PK\x05\x06", 0, end)
        if end < 0:
            raise ValueError("no end-of-directory record: not a ZIP archive, or cut short")
        count, length, start = struct.unpack_from("<HII", tail, end + 10)
        if count == 0xFFFF or length == 0xFFFFFFFF or start == 0xFFFFFFFF:
            sig, _, end64_at, _ = struct.unpack("<4sIQI", self.read(tail_at + end - 20, 20))
            if sig != b"PK\x06\x07":
                raise ValueError("ZIP64 locator missing")
            end64 = self.read(end64_at, 56)
            if end64[:4] != b"PK\x06\x06":
                raise ValueError("ZIP64 end record missing")
            count, length, start = struct.unpack_from("<QQQ", end64, 32)
        raw, at, found = self.read(start, length), 0, {}
        for _ in range(count):
            if raw[at : at + 4] != b"PK\x01\x02":
                raise ValueError("central directory is damaged")
            method = struct.unpack_from("<H", raw, at + 10)[0]
            packed, plain, n_name, n_extra, n_note = struct.unpack_from("<IIHHH", raw, at + 20)
            header = struct.unpack_from("<I", raw, at + 42)[0]
            name = raw[at + 46 : at + 46 + n_name].decode()
            extra, at = raw[at + 46 + n_name : at + 46 + n_name + n_extra], at + 46 + n_name + n_extra + n_note
            while len(extra) >= 4:
                kind, n = struct.unpack_from("<HH", extra)
                if kind == 1:  # ZIP64: only the fields whose 32-bit form is all ones, in this order
                    values = iter(struct.unpack_from(f"<{n // 8}Q", extra, 4))
                    plain = next(values) if plain == 0xFFFFFFFF else plain
                    packed = next(values) if packed == 0xFFFFFFFF else packed
                    header = next(values) if header == 0xFFFFFFFF else header
                extra = extra[4 + n :]
            if method == 0:
                found[name] = (header, packed)
        return found

    def where(self, name: str) -> tuple[int, int]:
        """(start, size) of a stored member's bytes in the archive."""
        header, size = self.members[name]
        n_name, n_extra = struct.unpack_from("<HH", self.read(header, 30), 26)
        return header + 30 + n_name + n_extra, size

    def index(self) -> list[dict]:
        return [json.loads(line) for line in self.read(*self.where(INDEX)).decode().split("\n") if line]

    def records(self, entries: list[dict]) -> Iterator[dict]:
        """Records of the index ``entries``; neighbours share a read."""
        base, _ = self.where(DATA)
        run: list[dict] = []
        for entry in [*sorted(entries, key=lambda e: e["offset"]), None]:
            if run and (
                entry is None
                or entry["offset"] != run[-1]["offset"] + run[-1]["length"]
                or entry["offset"] + entry["length"] - run[0]["offset"] > READ_BYTES
            ):
                first = run[0]["offset"]
                raw = self.read(base + first, run[-1]["offset"] + run[-1]["length"] - first)
                for e in run:
                    at = e["offset"] - first
                    yield parse_record(zlib.decompress(raw[at : at + e["length"]], wbits=31))
                run = []
            if entry is not None:
                run.append(entry)

    def close(self) -> None:
        self.file.close()


def with_references(pages: DataFrame) -> DataFrame:
    """``pages (page_id, url, html)`` with ``refers_to``: the response's page_id for revisits.

    Digests are grouped with partial sums; the join back is by digest, whose
    hot values (large groups of copies) AQE splits on the pages' side.
    """
    keyed = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html")).withColumn(
        "digest", F.sha1(F.col("html").cast("binary"))
    )
    first = (
        pages.select("page_id", F.sha1(F.coalesce("html", F.lit("")).cast("binary")).alias("digest"))
        .groupBy("digest")
        .agg(F.max("page_id").alias("response_id"), F.count("*").alias("n"))
        .filter("n > 1")
        .drop("n")
    )
    other = ~F.col("page_id").eqNullSafe(F.col("response_id"))
    return keyed.join(first, "digest", "left").select(
        "page_id", "url", "html", F.when(other, F.col("response_id")).alias("refers_to")
    )


def write_archives(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write a record per row of ``pages``; returns the archives (path, n_records)."""
    make_dirs(pages.sparkSession, folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        out, done = None, []
        for batch in batches:
            for page, url, html, ref in zip(
                batch.column(0).to_pylist(), batch.column(1), batch.column(2), batch.column(3).to_pylist()
            ):
                out = out or ArchiveWriter(folder)
                out.add(record(page, url.as_py(), html.as_py().encode("utf-8", "surrogatepass"), ref), page)
                if out.size >= archive_bytes:
                    done.append(out.close())
                    out = None
        if out:
            done.append(out.close())
        yield {"path": [d[0] for d in done], "n_records": [d[1] for d in done]}

    return written(map_arrow(with_references(pages), run, "path string, n_records bigint"), "archives")


def read_archives(archives: DataFrame, payloads: bool = True) -> DataFrame:
    """All records of the archives in column ``path``, a task's share of archives at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        names = [c.split()[0] for c in RECORDS.split(", ")]
        for batch in batches:
            for path in batch.column(0).to_pylist():
                reader = ArchiveReader(path)
                rows, size = [], 0
                for r in reader.records(reader.index()):
                    if not payloads:
                        r["payload"] = None
                    rows.append(r)
                    size += r["payload_bytes"]
                    if size >= 16 << 20 or len(rows) >= 4096:
                        yield {n: [x[n] for x in rows] for n in names}
                        rows, size = [], 0
                reader.close()
                yield {n: [x[n] for x in rows] for n in names}

    # the table of archives is small; deal the archives out evenly
    spark: SparkSession = archives.sparkSession
    n = spark.sparkContext.defaultParallelism
    return map_arrow(archives.select("path").repartition(max(n, archives.count())), run, RECORDS)


def roundtrip(pages: DataFrame, archive_bytes: int = ARCHIVE_BYTES, payloads: bool = True) -> DataFrame:
    """Write ``pages`` into archives in the shared folder and read them back."""
    folder = work_dir(pages.sparkSession, "wacz")
    return read_archives(write_archives(pages, folder, archive_bytes), payloads)
