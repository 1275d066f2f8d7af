"""WARC in ZIP packages (operator 11): web archives written as packages of stored members, and read back by ranges.

A package is a ZIP file with `archive/data.warc.gz` (a gzip member per record), `indexes/index.cdxj` (url, offset and length of each record) and
`datapackage.json`, all stored and not deflated, so that any record is a range of bytes of the package.

Writing. Payloads are told equal by SHA-256, counted by Spark; of those that occur more than once the record with the least id is a
response and the others are revisits. Only rows whose digest may be among the repeated ones (a bitmap of fixed size tells) are shuffled.
Each task then streams its rows into packages of about PACKAGE bytes. A package has a random name and is listed only by
the task that ended well, so what a lost executor leaves behind is never read.

Reading. A package is opened at its end: the end record, its ZIP64 form where there is one, and the central directory give the members; the local
header of a member tells where its bytes begin. The index is read as a range and cut into ranges of about RANGE bytes of consecutive records, a
row each, which Spark deals to tasks; a task reads its range only and parses the records in it. An archive that no index covers is one
range. Nothing is extracted, and no task holds more than a record and a piece of READ bytes.

Files are reached by pyarrow's file systems, by the URI of the folder that the cluster shares.

Defined cases: a null html is an empty payload; equal empty payloads are equal. Rows without an id are revisits of the least id of their payload, or responses
where no row of it has an id. Rows that repeat the least id of a payload are all responses. A null or empty url is written as `about:blank`; bytes that headers
can't hold are percent-encoded. An empty table gives no packages and no records. Compressed archive members and broken packages are errors that name the file. Extra columns stay out.
"""

from __future__ import annotations

import base64
import hashlib
import json
import math
import re
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratiform.llm.common import columns_of, marked, scratch, written

PACKAGE, RECORDS = 256 << 20, 100_000  # bytes and records of a package
RANGE, READ = 8 << 20, 1 << 20
#: Tasks of one job; beyond it a task has several packages or ranges, one after the other.
MOST_TASKS = 20_000
ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"


# ---------------------------------------------------------------- records


def _digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record(kind: str, record_id: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [("WARC-Type", kind), ("WARC-Record-ID", f"<urn:uuid:{record_id}>"), *headers, ("Content-Length", str(len(block)))]
    plain = ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines) + "\r\n").encode() + block + b"\r\n\r\n"
    packer = zlib.compressobj(1, wbits=31)
    return packer.compress(plain) + packer.flush()


def _uri(url: bytes | None) -> str:
    return re.sub(rb"[^\x21-\x7e]", lambda m: b"%%%02X" % m[0][0], url or b"about:blank").decode()


def page_record(page_id: int | None, url: bytes | None, payload: bytes, first: int | None, date: str) -> bytes:
    """The gzip member of a page: a response with its payload, or a revisit that names the page (first) with the same payload."""
    digest, uri = _digest(payload), _uri(url)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    headers = [("WARC-Date", date), ("WARC-Target-URI", uri), ("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", f"sha1:{digest}")]
    headers += [("Page-Id", str(page_id))] if page_id is not None else []
    name = lambda of: str(uuid.uuid5(uuid.NAMESPACE_URL, f"{of}/{digest}"))
    if first is None:
        return _record("response", name(page_id), headers, http + payload)
    headers += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", f"<urn:uuid:{name(first)}>"), ("Refers-To-Page-Id", str(first))]
    return _record("revisit", name(page_id), headers, http)


def _fields(lines: list[bytes]) -> dict[str, str]:
    pairs = (line.decode("utf-8", "replace").partition(":") for line in lines if line)
    return {k.strip().lower(): v.strip() for k, _, v in pairs}


def parse_record(data: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """Headers, HTTP headers (none for other blocks) and payload of a record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    first, *lines = head.split(b"\r\n")
    if not first.startswith(b"WARC/"):
        raise ValueError(f"not a WARC record: {first[:40]!r}")
    headers = _fields(lines)
    block = rest[: int(headers.get("content-length", 0))]
    if not headers.get("content-type", "").startswith("application/http"):
        return headers, {}, block
    http, _, payload = block.partition(b"\r\n\r\n")
    return headers, _fields(http.split(b"\r\n")[1:]), payload


# ---------------------------------------------------------------- writing


class _Package:
    """A package that is being written."""

    def __init__(self, folder: str, date: str) -> None:
        self.path = f"{folder}/{uuid.uuid4().hex}.wacz"
        fs, place = FileSystem.from_uri(self.path)
        fs.create_dir(place.rsplit("/", 1)[0], recursive=True)
        self.out = fs.open_output_stream(place)
        self.zip = zipfile.ZipFile(self.out, "w", zipfile.ZIP_STORED)
        self.data = self.zip.open(zipfile.ZipInfo(ARCHIVE), "w", force_zip64=True)
        self.size, self.lines, self.date = 0, [], date
        self.add(_record("warcinfo", str(uuid.uuid4()), [("WARC-Date", date), ("Content-Type", "application/warc-fields")], b"format: WARC file version 1.1\r\n"), None)

    def add(self, record: bytes, uri: str | None) -> None:
        if uri is not None:
            self.lines.append(f"{uri} {re.sub('[^0-9]', '', self.date)} {json.dumps({'offset': self.size, 'length': len(record), 'filename': 'data.warc.gz'})}\n".encode())
        self.data.write(record)
        self.size += len(record)

    def close(self) -> tuple[str, int, int]:
        """Path, bytes of records, number of pages."""
        self.data.close()
        self.zip.writestr(zipfile.ZipInfo(INDEX), b"".join(sorted(self.lines)))
        self.zip.writestr(zipfile.ZipInfo("datapackage.json"), json.dumps({"profile": "data-package", "wacz_version": "1.1.1", "resources": [{"path": p} for p in (ARCHIVE, INDEX)]}))
        self.zip.close()
        self.out.close()
        return self.path, self.size, len(self.lines)


def write_archives(pages: DataFrame, folder: str | None = None, least: int = 0, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Writes pages (page_id, url, html) as packages in a shared folder; gives a written table (path, bytes, pages) of them.

    Of pages with equal payloads of at least `least` bytes, that with the least id is a response and the others are revisits.
    """
    folder = folder or scratch(pages.sparkSession, "warc")
    rows = columns_of(pages, page_id="long", url="binary", html="binary").withColumn("html", F.coalesce("html", F.lit("").cast("binary")))
    rows = rows.withColumn("digest", F.sha2("html", 256))
    again = rows.filter(F.octet_length("html") >= least).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1").select("digest", "first")
    again = written(again, "warc-repeated")
    named = marked(rows, again, "digest")
    once = named.filter("not maybe").withColumn("first", F.lit(None).cast("long"))
    many = named.filter("maybe").join(again, "digest", "left").withColumn("first", F.when(F.col("page_id").eqNullSafe(F.col("first")), None).otherwise(F.col("first")))
    fields = ["page_id", "url", "html", "first"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        package: _Package | None = None
        done: list[tuple[str, int, int]] = []
        for batch in batches:
            for row in zip(*(batch.column(i) for i in range(len(fields)))):
                page_id, url, html, first = (v.as_py() for v in row)
                package = package or _Package(folder, date)
                package.add(page_record(page_id, url, html, first, date), _uri(url))
                if package.size >= PACKAGE or len(package.lines) >= RECORDS:
                    done.append(package.close())
                    package = None
        if package:
            done.append(package.close())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*done)], names=["path", "bytes", "pages"])

    return written(once.select(fields).union(many.select(fields)).mapInArrow(run, "path string, bytes long, pages long"), "warc-packages")


# ---------------------------------------------------------------- the directory of a package


@dataclass
class Member:
    """A member of a package: where its bytes begin, how many there are, and whether they are stored as they are."""

    name: str
    start: int
    size: int
    method: int


def _at(file: pa.NativeFile, start: int, size: int) -> bytes:
    file.seek(start)
    data = file.read(size)
    if start < 0 or len(data) < size:
        raise ValueError("the package is cut short")
    return data


def directory(file: pa.NativeFile) -> list[Member]:
    """The members of a ZIP file, from its central directory alone and the local header of each."""
    length = file.size()
    tail = _at(file, max(0, length - 65_557), min(length, 65_557))
    at = tail.rfind(b"PK\5\6")
    while at >= 0 and at + 22 + struct.unpack_from("<H", tail, at + 20)[0] != len(tail) if at + 22 <= len(tail) else at >= 0:
        at = tail.rfind(b"PK\5\6", 0, at)  # the mark may stand in the comment
    if at < 0:
        raise ValueError("no end of a central directory")
    entries, size, start = struct.unpack_from("<HII", tail, at + 10)
    end = length - len(tail) + at
    if end >= 20 and (mark := _at(file, end - 20, 20))[:4] == b"PK\6\7":
        place = struct.unpack_from("<Q", mark, 8)[0]
        wide = _at(file, place, 56)
        if wide[:4] != b"PK\6\6":
            raise ValueError("no ZIP64 end of the central directory")
        entries, size, start = struct.unpack_from("<QQQ", wide, 32)
    data, found, at = _at(file, start, size), [], 0
    for _ in range(entries):
        if data[at : at + 4] != b"PK\1\2":
            raise ValueError("a broken central directory")
        method, packed, plain, n, extra, comment, header = struct.unpack_from("<10xH8xIIHHH8xI", data, at)
        name = data[at + 46 : at + 46 + n].decode("utf-8", "replace")
        more, k = data[at + 46 + n : at + 46 + n + extra], 0
        while k + 4 <= len(more):
            tag, m = struct.unpack_from("<HH", more, k)
            if tag == 1:  # ZIP64: only the fields that didn't fit, in this order
                wide_fields = iter(struct.unpack_from(f"<{m // 8}Q", more, k + 4))
                plain = next(wide_fields) if plain == 0xFFFFFFFF else plain
                packed = next(wide_fields) if packed == 0xFFFFFFFF else packed
                header = next(wide_fields) if header == 0xFFFFFFFF else header
            k += 4 + m
        local = _at(file, header, 30)
        if local[:4] != b"PK\3\4":
            raise ValueError(f"no local header for {name}")
        found.append(Member(name, header + 30 + sum(struct.unpack_from("<HH", local, 26)), packed, method))
        at += 46 + n + extra + comment
    return found


# ---------------------------------------------------------------- reading


def _bytes(file: pa.NativeFile, member: Member) -> Iterator[bytes]:
    """The plain bytes of a member, piece by piece."""
    unpack = zlib.decompressobj(-15) if member.method == 8 else None
    if member.method not in (0, 8):
        raise ValueError(f"{member.name}: method {member.method} is not known")
    for k in range(0, member.size, READ):
        piece = _at(file, member.start + k, min(READ, member.size - k))
        yield unpack.decompress(piece) if unpack else piece


def _lines(pieces: Iterator[bytes], packed: bool) -> Iterator[bytes]:
    unpack, rest = zlib.decompressobj(31) if packed else None, b""
    for piece in pieces:
        while piece:
            plain = unpack.decompress(piece) if unpack else piece
            piece = unpack.unused_data if unpack and unpack.eof else b""
            if unpack and unpack.eof:
                unpack = zlib.decompressobj(31)
            *lines, rest = (rest + plain).split(b"\n")
            yield from lines
    yield rest


def ranges_of(file: pa.NativeFile) -> list[tuple[str, int, int]]:
    """(archive, start, stop) in bytes of the package: consecutive records of about RANGE bytes by the index, or an archive that no index covers."""
    members = directory(file)
    archives = {m.name.rsplit("/", 1)[1]: m for m in members if re.search(r"(^|/)archive/[^/]+\.warc(\.gz)?$", m.name)}
    places: dict[str, list[tuple[int, int]]] = {name: [] for name in archives}
    for m in members:
        if re.search(r"(^|/)indexes/[^/]+\.cdxj?(\.gz)?$", m.name):
            for line in _lines(_bytes(file, m), m.name.endswith(".gz")):
                if (brace := line.find(b"{")) >= 0:
                    entry = json.loads(line[brace:])
                    if entry.get("filename") in places:
                        places[entry["filename"]].append((int(entry["offset"]), int(entry["length"])))
    found = []
    for name, m in archives.items():
        if m.method != 0:
            raise ValueError(f"{m.name} is compressed within the package")
        if not places[name]:
            found.append((m.name, m.start, m.start + m.size))
            continue
        starts, sizes = np.array(sorted(set(places[name]))).T
        cut = np.flatnonzero(np.diff(starts // RANGE) | (starts[1:] != starts[:-1] + sizes[:-1])) + 1
        for a, b in zip([0, *cut], [*cut, len(starts)]):
            found.append((m.name, m.start + int(starts[a]), m.start + int(starts[b - 1] + sizes[b - 1])))
    return found


def _plain_records(file: pa.NativeFile, start: int, stop: int) -> Iterator[tuple[int, bytes]]:
    """(offset, bytes) of the plain records in a range."""
    data, at = b"", start
    for k in range(start, stop, READ):
        data += _at(file, k, min(READ, stop - k))
        while (head := data.find(b"\r\n\r\n")) >= 0:
            size = head + 8 + int(_fields(data[:head].split(b"\r\n")[1:]).get("content-length", 0))
            if len(data) < size:
                break
            yield at, data[:size]
            data, at = data[size:], at + size
    if data.strip():
        raise ValueError("a record is cut short")


def _packed_records(file: pa.NativeFile, start: int, stop: int) -> Iterator[tuple[int, bytes]]:
    """(offset, bytes) of the records in a range of gzip members, one each."""
    unpack, parts, at = zlib.decompressobj(31), [], start
    for k in range(start, stop, READ):
        piece = _at(file, k, min(READ, stop - k))
        end = k + len(piece)
        while piece:
            parts.append(unpack.decompress(piece))
            piece = unpack.unused_data
            if unpack.eof:
                yield at, b"".join(parts)
                unpack, parts, at = zlib.decompressobj(31), [], end - len(piece)
    if at != stop:
        raise ValueError("a record is cut short")


_RECORD = "path string, start long, record_type string, headers map<string,string>, http map<string,string>, payload binary"
_RECORD_ARROW = [pa.string(), pa.int64(), pa.string(), pa.map_(pa.string(), pa.string()), pa.map_(pa.string(), pa.string()), pa.binary()]


def read_archives(packages: DataFrame) -> DataFrame:
    """The records in packages (path): path, start (byte in the package), record_type, headers, http (header names are lower-case) and payload."""

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                fs, place = FileSystem.from_uri(path)
                with fs.open_input_file(place) as file:
                    found = ranges_of(file)
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array([path] * len(found)), *(pa.array(x) for x in zip(*found))], names=["path", "archive", "start", "stop"])

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, archive, start, stop in zip(*(c.to_pylist() for c in batch.columns)):
                fs, place = FileSystem.from_uri(path)
                with fs.open_input_file(place) as file:
                    rows, size = [], 0
                    for at, data in (_packed_records if archive.endswith(".gz") else _plain_records)(file, start, stop):
                        headers, http, payload = parse_record(data)
                        rows.append((path, at, headers.get("warc-type"), list(headers.items()), list(http.items()), payload))
                        size += len(payload)
                        if size >= RANGE or len(rows) >= 4096:
                            yield _batch(rows)
                            rows, size = [], 0
                    if rows:
                        yield _batch(rows)

    paths = packages.select("path")
    n = max(1, min(MOST_TASKS, paths.count()))
    ranges = written(paths.repartition(n).mapInArrow(listed, "path string, archive string, start long, stop long"), "warc-ranges")
    return ranges.repartition(max(1, min(MOST_TASKS, math.ceil(ranges.count() / 2)))).mapInArrow(records, _RECORD)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), _RECORD_ARROW)], names=["path", "start", "record_type", "headers", "http", "payload"])
