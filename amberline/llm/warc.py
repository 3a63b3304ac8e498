"""WARC records in ZIP packages: a writer, and a reader that takes records by range without extraction.

A package holds two stored members: ``archive/data.warc.gz``, whose records are gzip members of
their own, and ``indexes/index.cdx``, with a line ``offset length`` for each record. The reader
takes a package's end record (and its ZIP64 form), its central directory and the index, turns
record offsets into offsets of the package file, and reads only those ranges.
"""

from __future__ import annotations

import base64
import hashlib
import io
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from amberline.llm.common import open_store, saved
from amberline.session import scratch_path

ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.cdx"
PACKAGE_BYTES = 32 << 20
RANGE_BYTES = 4 << 20
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
URN = "urn:amberline:page:"
# Signatures and fixed lengths of ZIP structures.
END, END64, LOCATOR64, CENTRAL, LOCAL = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07", b"PK\x01\x02", b"PK\x03\x04"
END_BYTES, LOCATOR_BYTES, END64_BYTES, CENTRAL_BYTES, LOCAL_BYTES = 22, 20, 56, 46, 30
FULL16, FULL32 = 0xFFFF, 0xFFFFFFFF


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """A WARC 1.1 record; a revisit holds the HTTP headers of the payload and not the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    revisit = refers_to is not None
    block = http if revisit else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <{URN}{'' if page_id is None else page_id}>",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{digest(payload)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url:
        lines.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{URN}{refers_to}>"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _headers(text: bytes) -> dict[str, str]:
    lines = text.decode().split("\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}


def parse_record(raw: bytes) -> tuple:
    """``page_id, url, payload_bytes, payload_digest, record_type, refers_to, html`` of a record.

    The digest of a response is computed from what was read; a revisit's length and digest stand in its headers.
    """
    head, _, rest = raw.partition(b"\r\n\r\n")
    warc = _headers(head)
    http, _, payload = rest[: int(warc["content-length"])].partition(b"\r\n\r\n")
    own = warc["warc-record-id"][1:-1].removeprefix(URN)
    page_id, url = int(own) if own else None, warc.get("warc-target-uri")
    if warc["warc-type"] == "revisit":
        first = int(warc["warc-refers-to"][1:-1].removeprefix(URN))
        return page_id, url, int(_headers(http)["content-length"]), warc["warc-payload-digest"].removeprefix("sha1:"), "revisit", first, None
    return page_id, url, len(payload), digest(payload), "response", None, payload


class Package:
    """Builds one package in memory, of about ``PACKAGE_BYTES``."""

    def __init__(self) -> None:
        self.data, self.lines = io.BytesIO(), []

    def add(self, raw: bytes) -> None:
        packer = zlib.compressobj(6, zlib.DEFLATED, 31)
        member = packer.compress(raw) + packer.flush()
        self.lines.append(f"{self.data.tell()} {len(member)}")
        self.data.write(member)

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as package:
            for name, data in ((ARCHIVE, self.data.getbuffer()), (INDEX, "\n".join(self.lines).encode())):
                with package.open(zipfile.ZipInfo(name), "w", force_zip64=True) as member:
                    member.write(data)
        return out.getvalue()


class Member(NamedTuple):
    name: str
    method: int
    size: int
    header_at: int


def directory(file: pa.NativeFile) -> list[Member]:
    """The members of a package by its central directory, of the plain or the ZIP64 form."""
    size = file.size()
    tail_at = max(0, size - END_BYTES - FULL16)
    tail = file.read_at(size - tail_at, tail_at)
    at = tail.rfind(END)
    if at < 0:
        raise ValueError("no end of central directory")
    count, length, start = struct.unpack_from("<H2I", tail, at + 10)
    end_at = tail_at + at
    if (count == FULL16 or FULL32 in (length, start)) and end_at >= LOCATOR_BYTES:
        locator = file.read_at(LOCATOR_BYTES, end_at - LOCATOR_BYTES)
        if locator[:4] == LOCATOR64:
            end64 = file.read_at(END64_BYTES, struct.unpack_from("<Q", locator, 8)[0])
            if end64[:4] != END64:
                raise ValueError("no ZIP64 end of central directory")
            count, length, start = struct.unpack_from("<3Q", end64, 32)
    data, at, out = file.read_at(length, start), 0, []
    for _ in range(count):
        if data[at : at + 4] != CENTRAL:
            raise ValueError("broken central directory")
        method = struct.unpack_from("<H", data, at + 10)[0]
        packed, plain, names, extras, comments = struct.unpack_from("<2I3H", data, at + 20)
        header_at = struct.unpack_from("<I", data, at + 42)[0]
        name = data[at + CENTRAL_BYTES : at + CENTRAL_BYTES + names].decode()
        extra, wide = data[at + CENTRAL_BYTES + names : at + CENTRAL_BYTES + names + extras], b""
        while len(extra) >= 4:  # fields: id, length, data; id 1 holds the numbers that do not fit
            kind, n = struct.unpack_from("<2H", extra)
            if kind == 1:
                wide = extra[4 : 4 + n]
            extra = extra[4 + n :]
        for value in (plain, packed, header_at):
            if value == FULL32 and len(wide) >= 8:
                number, wide = struct.unpack_from("<Q", wide)[0], wide[8:]
                if value is header_at:
                    header_at = number
                if value is packed:
                    packed = number
        out.append(Member(name, method, packed, header_at))
        at += CENTRAL_BYTES + names + extras + comments
    return out


def data_at(file: pa.NativeFile, member: Member) -> int:
    """Where the bytes of a stored member begin in the package."""
    if member.method != zipfile.ZIP_STORED:
        raise ValueError(f"{member.name} is not stored")
    header = file.read_at(LOCAL_BYTES, member.header_at)
    if header[:4] != LOCAL:
        raise ValueError("broken local header")
    names, extras = struct.unpack_from("<2H", header, 26)
    return member.header_at + LOCAL_BYTES + names + extras


def locate(path: str) -> Iterator[tuple[list[int], list[int]]]:
    """Offsets and lengths of a package's records in the package file, in ranges of about ``RANGE_BYTES``."""
    store, name = open_store(path)
    with store.open_input_file(name) as file:
        members = {m.name: m for m in directory(file)}
        start = data_at(file, members[ARCHIVE])
        index = file.read_at(members[INDEX].size, data_at(file, members[INDEX])).decode()
    at, lengths, total = [], [], 0
    for line in index.splitlines():
        offset, length = map(int, line.split())
        if at and total + length > RANGE_BYTES:
            yield at, lengths
            at, lengths, total = [], [], 0
        at.append(start + offset)
        lengths.append(length)
        total += length
    if at:
        yield at, lengths


def first_pages(pages: DataFrame, least: int) -> DataFrame:
    """``page_id, digest, first``: rows whose payload of ``least`` bytes or more a smaller page_id has too."""
    html = F.coalesce("html", F.lit(""))
    keys = pages.where(F.octet_length(html) >= least).select("page_id", F.sha1(html.cast("binary")).alias("digest"))
    first = keys.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1 AND first IS NOT NULL")
    later = keys.join(first.drop("n"), "digest").where("page_id IS NULL OR page_id > first")
    return later.distinct()


def write_packages(pages: DataFrame, folder: str, least: int = 0) -> DataFrame:
    """Write a record for each row of ``pages`` (``page_id, url, html``) and return the written ``path, n_records``.

    Of rows with equal payloads of ``least`` bytes or more, that with the smallest ``page_id`` is a
    response and the others revisit it. A null ``html`` is an empty payload. Rows with a null
    ``page_id`` never are the first of equal payloads unless all are such; then all are responses,
    as are rows that repeat the smallest ``page_id``.

    A task that runs again writes files of other names; only those that its last run lists count.
    """
    later = first_pages(pages, least).withColumnRenamed("page_id", "_id")
    html = F.coalesce("html", F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", html.alias("payload"), F.sha1(html).alias("digest"))
    same = F.col("page_id").eqNullSafe(F.col("_id")) & (rows["digest"] == later["digest"])
    rows = rows.join(later, same, "left").select("page_id", "url", "payload", "first")

    def run(batches):
        store, base = open_store(folder)
        store.create_dir(base, recursive=True)

        def put(package):
            name = f"{uuid.uuid4().hex}.wacz"
            with store.open_output_stream(f"{base}/{name}") as out:
                out.write(package.to_bytes())
            return pa.RecordBatch.from_pydict({"path": [f"{folder}/{name}"], "n_records": [len(package.lines)]})

        package = Package()
        for batch in batches:
            for row in zip(*(column for column in batch.columns), strict=True):
                package.add(record(*(value.as_py() for value in row)))
                if package.data.tell() >= PACKAGE_BYTES:
                    yield put(package)
                    package = Package()
        if package.lines:
            yield put(package)

    return saved(rows.mapInArrow(run, "path string, n_records long"), "packages")


def read_packages(packages: DataFrame) -> DataFrame:
    """All records of the packages named in ``path``: ``page_id, url, payload_bytes, payload_digest, record_type, refers_to, html``.

    Packages are divided into ranges, which are dealt out to tasks whatever package they are of. No packages
    give no records.
    """

    def ranges(batches):
        for batch in batches:
            for path in batch.column(0).to_pylist():
                for at, lengths in locate(path):
                    yield pa.RecordBatch.from_pydict({"path": [path], "at": [at], "lengths": [lengths]})

    def records(batches):
        shape = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("html", pa.binary())])
        for batch in batches:
            for path, at, lengths in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                store, name = open_store(path)
                with store.open_input_file(name) as file:
                    data = file.read_at(at[-1] + lengths[-1] - at[0], at[0])
                rows = [parse_record(zlib.decompress(data[a - at[0] : a - at[0] + n], 31)) for a, n in zip(at, lengths, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), shape, strict=True)], schema=shape)

    found = packages.select("path").mapInArrow(ranges, "path string, at array<long>, lengths array<long>")
    # With a number given, adaptive execution does not join the few bytes of many ranges into one task.
    parts = int(packages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = found.repartition(parts, F.xxhash64("path", F.col("at")[0]))
    return found.mapInArrow(records, "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, html binary")


def archive_round_trip(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Write ``pages`` to packages in the shared folder and read the records' figures back."""
    return read_packages(write_packages(pages, scratch_path(spark, "warc"))).drop("html", "url")
