"""WARC archives in ZIP packages: written by tasks, read back by byte ranges without extraction.

A package is a ZIP file of stored (uncompressed) members: ``archive/data.warc.gz``, WARC records
that are one gzip member each, and ``indexes/index.cdxj``, one line with offset and length for
each record.  The reader takes the end of the file, the ZIP64 records where there are any, and
the central directory; finds each stored archive member's first byte from its local header, and
its index; and deals the records out as byte ranges, so that one large package is read by many
tasks and each task reads only its ranges.  An archive member that no index lists is read from
front to back in bounded blocks.

Writing: a record whose payload is at least ``min_payload`` bytes long and equal to that of a
row with a larger id becomes a ``revisit`` of it (equal by SHA-256).  Which payloads occur more
than once is found from digests alone; payloads are not shuffled as long as the repeated ones are
few enough to broadcast (``BROADCAST_DIGESTS``, counted first; beyond that one join by digest,
whose hot keys Spark splits).  Every attempt of a task writes packages of its own name, and only
those are read that committed tasks list; so a lost executor leaves no half-written package
behind in the list.

Defined results: a null payload is empty; rows without an id are records with an empty id and
the smallest in order; rows that share the largest id of their payload are all responses; a
null URL leaves its field out, and control characters in one are percent-encoded.  Reading
raises on a damaged directory, a member that is compressed or encrypted, a record of another
length than its index says, and a payload unlike its digest.
"""

from __future__ import annotations

import base64
import datetime
import hashlib
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Callable, Iterator
from typing import NamedTuple
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from baton.llm.wire import stored
from baton.session import new_snapshot_path
from baton.storage import delete_file, open_input, open_output

MIN_PAYLOAD = 1000
#: A task closes a package once it holds so many bytes.
PACKAGE_BYTES = 256 << 20
#: Bytes of neighbouring records that are read at once, and of a task.
RANGE_BYTES, TASK_BYTES = 8 << 20, 128 << 20
BROADCAST_DIGESTS = 100_000
BLOCK = 1 << 20
PACKAGES = "path string, records bigint, bytes bigint"
RANGES = "path string, member string, begin bigint, stop bigint, offsets array<bigint>"
RECORDS = ("archive string, offset bigint, record_type string, record_id string, target_uri string, refers_to string, "
           "payload_digest string, payload_bytes bigint, payload binary")

# Fixed values of the formats.
ID_PREFIX = "urn:record:"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"


# --- ZIP ----------------------------------------------------------------------------

class Member(NamedTuple):
    name: str
    method: int
    flags: int
    packed: int
    size: int
    header: int


def _end_of_directory(read: Callable[[int, int], bytes], size: int) -> tuple[int, int, int, int]:
    """(entries, bytes of the directory, its offset, bytes before the ZIP's own start)."""
    low = max(0, size - 22 - 0xFFFF)
    tail = read(low, size - low)
    at = tail.rfind(b"PK\x05\x06")
    while at >= 0 and (len(tail) < at + 22 or low + at + 22 + struct.unpack_from("<H", tail, at + 20)[0] != size):
        at = tail.rfind(b"PK\x05\x06", 0, at)
    if at < 0:
        raise ValueError("not a ZIP file: no end of central directory")
    disk, first_disk, _, entries, length, offset = struct.unpack_from("<4H2L", tail, at + 4)
    end = low + at
    locator = read(end - 20, 20) if end >= 20 else b""
    if locator[:4] == b"PK\x06\x07":  # also where the short fields would have done
        _, where, _ = struct.unpack("<LQL", locator[4:])
        record = read(where, 56)
        if record[:4] != b"PK\x06\x06":  # data stands before the ZIP: the record ends at its locator
            where = end - 20 - 56
            record = read(where, 56)
        if record[:4] != b"PK\x06\x06":
            raise ValueError("damaged ZIP64 end of central directory")
        disk, first_disk, _, entries, length, offset = struct.unpack_from("<2L4Q", record, 16)
        end = where
    if disk or first_disk:
        raise ValueError("a ZIP file in several volumes")
    before = end - length - offset
    if before < 0:
        raise ValueError("damaged ZIP file: its central directory lies outside of it")
    return entries, length, offset, before


def members(read: Callable[[int, int], bytes], size: int) -> Iterator[Member]:
    """The entries of a ZIP file's central directory, read in bounded blocks."""
    entries, length, offset, before = _end_of_directory(read, size)
    at, end, buffer, p = before + offset, before + offset + length, b"", 0
    for _ in range(entries):
        need = 46
        while True:
            while len(buffer) < p + need and at < end:
                block = read(at, min(BLOCK, end - at))
                buffer, p, at = buffer[p:] + block, 0, at + len(block)
            if len(buffer) < p + need or buffer[p:p + 4] != b"PK\x01\x02":
                raise ValueError("damaged central directory")
            name, extra, comment = struct.unpack_from("<3H", buffer, p + 28)
            if need == 46 + name + extra + comment:
                break
            need = 46 + name + extra + comment
        flags, method = struct.unpack_from("<2H", buffer, p + 8)
        packed, full = struct.unpack_from("<2L", buffer, p + 20)
        header, = struct.unpack_from("<L", buffer, p + 42)
        fields = buffer[p + 46 + name:p + 46 + name + extra]
        wide = [0xFFFFFFFF == full, 0xFFFFFFFF == packed, 0xFFFFFFFF == header]
        while any(wide) and len(fields) >= 4:
            kind, n = struct.unpack_from("<2H", fields)
            if kind == 1:
                values = list(struct.unpack_from(f"<{min(n, 8 * sum(wide)) // 8}Q", fields, 4))
                if len(values) < sum(wide):
                    raise ValueError("damaged ZIP64 field")
                full, packed, header = (values.pop(0) if w else v for w, v in zip(wide, (full, packed, header)))
                break
            fields = fields[4 + n:]
        text = buffer[p + 46:p + 46 + name].decode("utf-8" if flags & 0x800 else "cp437")
        yield Member(text, method, flags, packed, full, header + before)
        p += need


def data_offset(read: Callable[[int, int], bytes], member: Member) -> int:
    """The first byte of a member's data, behind its local header."""
    head = read(member.header, 30)
    if len(head) < 30 or head[:4] != b"PK\x03\x04":
        raise ValueError(f"no local header of {member.name}")
    if member.flags & 1:
        raise ValueError(f"{member.name} is encrypted")
    if member.method:
        raise ValueError(f"{member.name} is compressed: only stored members can be read by ranges")
    name, extra = struct.unpack_from("<2H", head, 26)
    return member.header + 30 + name + extra


def _reader(file: pa.NativeFile) -> Callable[[int, int], bytes]:
    def read(at: int, n: int) -> bytes:
        file.seek(at)
        return file.read(n)

    return read


# --- records --------------------------------------------------------------------------

def _field(value: str) -> str:
    return "".join(quote(c) if c <= " " or c == "\x7f" else c for c in value)


def record_id(ident) -> str:
    """The id of a row's record: a URN of the row's id as text, empty for null."""
    return f"<{ID_PREFIX}{'' if ident is None else quote(str(ident), safe='')}>"


def _digest(text: str) -> str:
    return "sha1:" + base64.b32encode(bytes.fromhex(text)).decode()


def _hex(text: str | None) -> str | None:
    """The digest of a record's field in hex; None if it is of another kind."""
    kind, _, value = (text or "").partition(":")
    if kind.lower() != "sha1":
        return None
    return value.lower() if len(value) == 40 else base64.b32decode(value.upper()).hex()


def record(ident, url: str | None, payload: bytes | None, sha1: str, size: int, refers_to, date: str) -> bytes:
    """One WARC record: a response with its payload, or a revisit of ``refers_to`` without."""
    revisit = payload is None
    block = HTTP_HEAD + f"Content-Length: {size}\r\n\r\n".encode() + (payload or b"")
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(ident)}", f"WARC-Date: {date}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_field(url)}")
    head.append(f"WARC-Payload-Digest: {_digest(sha1)}")
    if revisit:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {record_id(refers_to)}", f"X-Payload-Length: {size}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """The fields (names in lower case) and the block of one record."""
    head, mark, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not mark or not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields: dict[str, str] = {}
    for line in lines[1:]:
        name, _, value = line.partition(":")
        fields[name.strip().lower()] = value.strip()
    length = int(fields.get("content-length", "-1"))
    if not 0 <= length <= len(rest):
        raise ValueError("a WARC record is cut off")
    return fields, rest[:length]


def _row(archive: str, offset: int, data: bytes) -> tuple:
    fields, block = parse_record(data)
    kind = fields.get("warc-type", "")
    payload = None
    if kind in ("response", "resource"):
        payload = block
        if fields.get("content-type", "").startswith("application/http"):
            _, mark, payload = block.partition(b"\r\n\r\n")
            if not mark:
                raise ValueError("an HTTP block without the end of its head")
    digest = _hex(fields.get("warc-payload-digest"))
    if payload is not None:
        found = hashlib.sha1(payload).hexdigest()
        if digest not in (None, found):
            raise ValueError(f"the payload of {fields.get('warc-record-id')} has not its digest")
        digest = found
    size = len(payload) if payload is not None else fields.get("x-payload-length")
    ids = [v and v.strip("<>") for v in (fields.get("warc-record-id"), fields.get("warc-refers-to"))]
    return archive, offset, kind, ids[0], fields.get("warc-target-uri"), ids[1], digest, None if size is None else int(size), payload


# --- writing ----------------------------------------------------------------------------

class Package:
    """One ZIP package that a task writes; the index stands behind the archive."""

    def __init__(self, path: str):
        self.path, self.lines, self.at = path, [], 0
        self.stream = open_output(path)
        self.zip = zipfile.ZipFile(self.stream, "w", zipfile.ZIP_STORED, allowZip64=True)
        self.member = self.zip.open(ARCHIVE, "w", force_zip64=True)

    def add(self, data: bytes, url: str | None, date: str, fields: dict) -> None:
        self.member.write(data)
        key = _field(url).lower() if url else "-"
        self.lines.append(f"{key} {''.join(c for c in date if c.isdigit())} {json.dumps(fields | {'filename': ARCHIVE, 'offset': self.at, 'length': len(data)})}\n")
        self.at += len(data)

    def close(self) -> pa.RecordBatch:
        self.member.close()
        with self.zip.open(INDEX, "w", force_zip64=True) as index:
            for line in self.lines:
                index.write(line.encode())
        self.zip.close()
        self.stream.close()
        return pa.RecordBatch.from_pylist([{"path": self.path, "records": len(self.lines), "bytes": self.at}],
                                          pa.schema([("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())]))

    def abandon(self) -> None:
        self.stream.close()
        delete_file(self.path)


def write_archives(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", folder: str | None = None,
                   min_payload: int = MIN_PAYLOAD, package_bytes: int = PACKAGE_BYTES, level: int = 3, date: str | None = None) -> DataFrame:
    """Write every row as a WARC record; (path, records, bytes) of the packages, as a stored table.

    ``folder`` (default: a new one in the session's checkpoint folder) must be one that
    :mod:`baton.storage` reaches from the tasks.  ``date`` is that of all records.
    """
    folder = folder or new_snapshot_path(pages.sparkSession)
    date = date or datetime.datetime.now(datetime.timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    payload = F.coalesce(F.col(f"`{payload_col}`").cast("binary"), F.lit(b""))
    rows = pages.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{url_col}`").cast("string").alias("url"), payload.alias("payload"),
                        F.octet_length(payload).cast("long").alias("size"))
    rows = rows.withColumn("key", F.when(F.col("size") >= min_payload, F.sha2("payload", 256)))
    groups = rows.where(F.col("key").isNotNull()).groupBy("key").agg(F.max("id").alias("leader"), F.count("*").alias("n"))
    repeated = stored(groups.where("n > 1").select("key", "leader"))
    few = repeated.count() <= BROADCAST_DIGESTS
    typed = rows.join(F.broadcast(repeated) if few else repeated.hint("merge"), "key", "left")
    refers_to = F.when(F.col("leader").isNotNull() & ~F.col("id").eqNullSafe(F.col("leader")), F.col("leader"))
    typed = typed.select("id", "url", F.when(refers_to.isNull(), F.col("payload")).alias("payload"), F.sha1("payload").alias("sha1"), "size", refers_to.alias("refers_to"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        package = None
        try:
            for batch in batches:
                for ident, url, data, sha1, size, leader in zip(*(c.to_pylist() for c in batch.columns)):
                    package = package or Package(f"{folder.rstrip('/')}/{uuid.uuid4().hex}.wacz")
                    gz = zlib.compressobj(level, zlib.DEFLATED, 31)
                    whole = gz.compress(record(ident, url, data, sha1, size, leader, date)) + gz.flush()
                    package.add(whole, url, date, {"digest": _digest(sha1), "mime": "warc/revisit" if data is None else "text/html"})
                    if package.at >= package_bytes:
                        done, package = package.close(), None
                        yield done
            if package:
                done, package = package.close(), None
                yield done
        finally:
            if package:
                package.abandon()

    return stored(typed.mapInArrow(write, PACKAGES))


# --- reading ----------------------------------------------------------------------------

def _index_lines(read: Callable[[int, int], bytes], at: int, size: int) -> Iterator[dict]:
    rest, end = b"", at + size
    while at < end or rest:
        block = read(at, min(BLOCK, end - at)) if at < end else b""
        at += len(block)
        *lines, rest = (rest + block).split(b"\n") if block else [rest, b""]
        for line in lines:
            brace = line.find(b"{")
            if brace >= 0:
                yield json.loads(line[brace:])


def package_ranges(path: str, range_bytes: int = RANGE_BYTES) -> Iterator[dict]:
    """The byte ranges of one package's records: ``begin`` to ``stop`` in the package, with the
    offsets of the records in the range; without offsets it is a whole member to read in order."""
    with open_input(path) as file:
        read = _reader(file)
        found = list(members(read, file.size()))
        archives = {m.name: (data_offset(read, m), m.size) for m in found if m.name.startswith("archive/") and not m.name.endswith("/")}
        for name in list(archives):  # an index names its archives with or without the folder
            archives.setdefault(name.removeprefix("archive/"), archives[name])
        listed: set[tuple] = set()
        run: dict | None = None
        for m in found:
            if not (m.name.startswith("indexes/") and m.name.endswith((".cdx", ".cdxj"))):
                continue
            for line in _index_lines(read, data_offset(read, m), m.size):
                base, size = archives[line["filename"]]
                offset, length = int(line["offset"]), int(line["length"])
                if offset + length > size:
                    raise ValueError(f"{path}: a record beyond the end of {line['filename']}")
                listed.add((base, size))
                if run and (run["base"] != base or run["stop"] != base + offset or run["stop"] - run["begin"] >= range_bytes):
                    yield run
                    run = None
                run = run or {"path": path, "member": line["filename"], "base": base, "begin": base + offset, "offsets": []}
                run["offsets"].append(base + offset)
                run["stop"] = base + offset + length
        if run:
            yield run
        for name, (base, size) in archives.items():
            if (base, size) not in listed and "archive/" + name not in archives and size:
                yield {"path": path, "member": name, "begin": base, "stop": base + size, "offsets": []}


def _in_order(read: Callable[[int, int], bytes], begin: int, stop: int) -> Iterator[tuple[int, bytes]]:
    """The records of a member that no index lists, gzipped one by one or plain."""
    gzipped = read(begin, 2) == b"\x1f\x8b"
    at, rest = begin, b""
    while at < stop or rest:
        start = at - len(rest)
        if gzipped:
            gz, out = zlib.decompressobj(31), []
            while not gz.eof:
                if not rest:
                    if at >= stop:
                        raise ValueError("a gzip member is cut off")
                    rest = read(at, min(BLOCK, stop - at))
                    at += len(rest)
                out.append(gz.decompress(rest))
                rest = gz.unused_data
            yield start, b"".join(out)
            continue
        need = 1
        while True:
            while len(rest) < need and at < stop:
                block = read(at, min(BLOCK, stop - at))
                rest, at = rest + block, at + len(block)
            head, mark, _ = rest.partition(b"\r\n\r\n")
            if not mark:
                if at >= stop:
                    raise ValueError("a WARC record is cut off")
                need = len(rest) + 1
                continue
            size = next((int(x.split(b":")[1]) for x in head.split(b"\r\n") if x.lower().startswith(b"content-length:")), 0)
            total = len(head) + 4 + size + 4
            if len(rest) >= total:
                break
            if at >= stop:
                raise ValueError("a WARC record is cut off")
            need = total
        yield start, rest[:total]
        rest = rest[total:]


def _records(path: str, begin: int, stop: int, offsets: list[int]) -> Iterator[tuple]:
    with open_input(path) as file:
        read = _reader(file)
        if not offsets:
            for at, data in _in_order(read, begin, stop):
                yield _row(path, at, data)
            return
        data = memoryview(read(begin, stop - begin))
        if len(data) != stop - begin:
            raise ValueError(f"{path} is cut off")
        for at, end in zip(offsets, [*offsets[1:], stop]):
            piece = data[at - begin:end - begin]
            if bytes(piece[:2]) == b"\x1f\x8b":
                gz = zlib.decompressobj(31)
                whole = gz.decompress(piece)
                if not gz.eof or gz.unused_data:
                    raise ValueError(f"{path}: the record at {at} is not as long as its index says")
                yield _row(path, at, whole)
            else:
                yield _row(path, at, bytes(piece))


def read_archives(spark: SparkSession, packages: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """All records of the packages of a (path, ...) table: see ``RECORDS``.

    ``offset`` is the record's place in its package; ids are without brackets; revisits have no
    payload, and a ``payload_bytes`` only if their writer noted it.
    """
    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.schema([("path", pa.string()), ("member", pa.string()), ("begin", pa.int64()), ("stop", pa.int64()), ("offsets", pa.list_(pa.int64()))])
        for batch in batches:
            for path in batch.column(0).to_pylist():
                for r in package_ranges(path, range_bytes):
                    yield pa.RecordBatch.from_pylist([{n: r[n] for n in kind.names}], kind)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.schema([(n, pa.int64() if n in ("offset", "payload_bytes") else pa.binary() if n == "payload" else pa.string())
                          for n in (c.split()[0] for c in RECORDS.split(", "))])
        rows, size = [], 0

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kind.types)], schema=kind)

        for batch in batches:
            for r in batch.to_pylist():
                for row in _records(r["path"], r["begin"], r["stop"], r["offsets"]):
                    rows.append(row)
                    size += len(row[-1] or b"") + 500
                    if size >= range_bytes:
                        yield batch_of(rows)
                        rows, size = [], 0
        if rows:
            yield batch_of(rows)

    paths = packages.select("path")
    n = paths.count()
    ranges = stored(paths.repartition(min(max(n, 1), 10_000)).mapInArrow(locate, RANGES))
    total = ranges.agg(F.sum(F.col("stop") - F.col("begin"))).first()[0] or 0
    tasks = max(spark.sparkContext.defaultParallelism, -(-total // TASK_BYTES))
    return ranges.repartition(tasks).mapInArrow(read, RECORDS)


def row_id(name: str) -> F.Column:
    """The id, as text, of the row that a record of this column of ids was written for."""
    text = F.substring(F.col(name), len(ID_PREFIX) + 1, 1 << 30)
    return F.when(F.col(name).startswith(ID_PREFIX) & (text != ""), F.url_decode(F.replace(text, F.lit("+"), F.lit("%2B"))))
