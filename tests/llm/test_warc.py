"""WARC records in ZIP packages (11): exact round trips, the ZIP directory, and archives of others."""

from __future__ import annotations

import gzip
import hashlib
import io
import json
import os
import zipfile
import zlib

import pytest

from baton.llm import queries, warc

HTML = "<p>漢é text</p>" * 100
PAGES = [(1, "http://a/1", HTML), (2, "http://a/2", HTML), (9, None, HTML), (5, "http://a/5?q= x\r\nEvil: 1", HTML), (9, "http://a/9", HTML),
         (None, "u", HTML), (None, "v", "alone without an id " * 80), (3, "http://b", "short"), (4, "http://b", "short"), (6, "http://c", None),
         (7, "http://d", ""), (8, "", "x" * 999), (10, "h", "x" * 999), (11, "h", "x" * 1000), (12, "h", "x" * 1000), (13, "h", "\r\n\r\nWARC/1.1\r\n" * 90),
         (-5, "h", "y" * 2000), (-7, "h", "y" * 2000), (14, "h", "\x00" * 300_000)]


def expected(pages):
    out = []
    for ident, _, html in pages:
        data = (html or "").encode()
        same = [i for i, _, h in pages if (h or "").encode() == data and i is not None]
        top = max(same, default=None) if len(data) >= 1000 else None
        refers = top if top is not None and ident != top else None
        out.append((ident, len(data), hashlib.sha1(data).hexdigest(), "response" if refers is None else "revisit", refers))
    return sorted(out, key=repr)


def frame(spark, pages):
    return spark.createDataFrame([(i, u, h, "c", 1) for i, u, h in pages], "page_id bigint, url string, html string, id string, key int").repartition(3)


def paths(spark, *names):
    return spark.createDataFrame([(str(n),) for n in names], "path string")


@pytest.mark.parametrize("few", [True, False])
def test_query_equals_the_pages(spark, tmp_dir, monkeypatch, few):
    if not few:
        monkeypatch.setattr(warc, "BROADCAST_DIGESTS", 0)
    frame(spark, PAGES).write.parquet(f"{tmp_dir}/pages.parquet")
    got = queries.op11_warc_archives(spark, tmp_dir)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == expected(PAGES)


def test_query_equals_sql(spark):
    from tests.conftest import SF001
    from tools.check_oracle import canon, duck

    got = queries.op11_warc_archives(spark, SF001)
    cur = duck(SF001).execute(queries.oracle_sql()["op11_warc_archives"])
    assert canon(got.columns, got.collect()) == canon([d[0] for d in cur.description], cur.fetchall())


def test_packages_hold_whole_records(spark, tmp_dir):
    written = warc.write_archives(frame(spark, PAGES), folder=tmp_dir + "/sub", package_bytes=700, date="2024-05-06T07:08:09Z")
    made = written.collect()
    assert len(made) > 4 and sum(p.records for p in made) == len(PAGES)
    assert sorted(os.listdir(tmp_dir + "/sub")) == sorted(os.path.basename(p.path) for p in made)
    payloads = {}
    for p in made:
        with zipfile.ZipFile(p.path) as z:  # another reader
            assert z.testzip() is None and all(i.compress_type == zipfile.ZIP_STORED for i in z.infolist())
            lines = [json.loads(x[x.index("{"):]) for x in z.read(warc.INDEX).decode().splitlines()]
            data = z.read(warc.ARCHIVE)
        assert len(lines) == p.records and sum(x["length"] for x in lines) == len(data) == p.bytes
        for x in lines:
            one = gzip.decompress(data[x["offset"]:x["offset"] + x["length"]])
            fields, block = warc.parse_record(one)
            assert one.endswith(b"\r\n\r\n") and fields["warc-date"] == "2024-05-06T07:08:09Z" and fields["content-length"] == str(len(block))
            assert "evil" not in fields
            if fields["warc-type"] == "response":
                payloads.setdefault(fields["warc-record-id"], []).append(block.split(b"\r\n\r\n", 1)[1])
    assert payloads["<urn:record:14>"] == [b"\x00" * 300_000] and payloads["<urn:record:6>"] == [b""]
    for range_bytes in (1, 1 << 20):
        got = warc.read_archives(spark, written, range_bytes).collect()
        assert len(got) == len(PAGES)
        for r in got:
            assert (r.payload is None) == (r.record_type == "revisit")
            assert r.payload is None or bytes(r.payload) in payloads[f"<{r.record_id}>"]


def test_text_ids_and_no_pages(spark, tmp_dir):
    df = spark.createDataFrame([("a b+%2B>é", "p"), ("", "q"), (None, "r")], "page_id string, html string").selectExpr("*", "cast(null as string) as url")
    got = warc.read_archives(spark, warc.write_archives(df)).select(warc.row_id("record_id").alias("i"), "payload", "target_uri").collect()
    assert sorted((r.i or "", bytes(r.payload)) for r in got) == [("", b"q"), ("", b"r"), ("a b+%2B>é", b"p")] and all(r.target_uri is None for r in got)
    none = spark.createDataFrame([], "page_id bigint, url string, html string")
    assert warc.read_archives(spark, warc.write_archives(none)).count() == 0


def test_failed_tasks_leave_no_package(spark, tmp_dir):
    from pyspark.sql import functions as F

    bad = frame(spark, PAGES).withColumn("html", F.when(F.col("page_id") == 14, F.raise_error(F.lit("lost")).cast("string")).otherwise(F.col("html")))
    with pytest.raises(Exception, match="lost"):
        warc.write_archives(bad.coalesce(1), folder=tmp_dir + "/p").count()
    assert not os.path.exists(tmp_dir + "/p") or os.listdir(tmp_dir + "/p") == []


# --- archives of other writers ---------------------------------------------------------

def plain_record(kind, ident, payload, http=True, extra=""):
    block = (b"HTTP/1.0 200 OK\r\nX: y\r\n\r\n" if http else b"") + payload
    mime = "application/http" if http else "text/plain"
    return (f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <{ident}>\r\n{extra}Content-Type: {mime}\r\nContent-Length: {len(block)}\r\n\r\n").encode() + block + b"\r\n\r\n"


RECORDS = [plain_record("warcinfo", "urn:i", b"software: x", False), plain_record("response", "urn:1", b"one\r\n\r\nmore"),
           plain_record("resource", "urn:2", b"two", False), plain_record("response", "urn:3", os.urandom(3 << 20))]


def facts(rows):
    return sorted((r.record_type, r.record_id, r.payload and bytes(r.payload)) for r in rows)


WANT = sorted([("warcinfo", "urn:i", None), ("response", "urn:1", b"one\r\n\r\nmore"), ("resource", "urn:2", b"two"),
               ("response", "urn:3", RECORDS[3][RECORDS[3].index(b"X: y\r\n\r\n") + 8:-4])])


@pytest.mark.parametrize("gzipped", [True, False])
def test_members_without_an_index(spark, tmp_path, gzipped):
    data = b"".join(gzip.compress(r) if gzipped else r for r in RECORDS)
    with zipfile.ZipFile(tmp_path / "a.wacz", "w") as z:
        z.writestr("archive/", "")
        z.writestr("archive/one.warc", data)
        z.writestr("archive/empty.warc", b"")
        z.writestr("pages/pages.jsonl", "{}", compress_type=zipfile.ZIP_DEFLATED)
    assert facts(warc.read_archives(spark, paths(spark, tmp_path / "a.wacz")).collect()) == WANT


def test_one_index_of_several_members(spark, tmp_path):
    parts, lines = {"one.warc.gz": b"", "two.warc.gz": b""}, []
    for n, r in enumerate(RECORDS):
        name = list(parts)[n % 2]
        gz = gzip.compress(r)
        lines.append("k 2024 " + json.dumps({"filename": name, "offset": str(len(parts[name])), "length": str(len(gz))}))
        parts[name] += gz
    with zipfile.ZipFile(tmp_path / "a.wacz", "w") as z:
        z.writestr("indexes/index.cdxj", "!meta\n" + "\n".join(lines))
        for name, data in parts.items():
            z.writestr("archive/" + name, data)
    assert facts(warc.read_archives(spark, paths(spark, tmp_path / "a.wacz")).collect()) == WANT


def reader(data):
    return lambda at, n: data[at:at + n]


def zipped(n=5, comment=b"", **kw):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for i in range(n):
            info = zipfile.ZipInfo(f"archive/é{i}.warc")
            info.extra = b"\xfe\xca\x03\x00abc"
            info.comment = b"PK\x05\x06" + bytes(40)
            z.writestr(info, bytes([i]) * i * 50)
        z.comment = comment
    return out.getvalue()


@pytest.mark.parametrize("comment", [b"", b"PK\x05\x06 in a comment " + bytes(30), b"c" * 65535])
@pytest.mark.parametrize("zip64", [False, True])
@pytest.mark.parametrize("before", [b"", b"#!/bin/sh\n" * 9])
def test_central_directory(monkeypatch, comment, zip64, before):
    if zip64:  # the limits beyond which ZIP64 records are written
        monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 20)
        monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 2)
    data = before + zipped(comment=comment)
    assert (b"PK\x06\x06" in data) == zip64
    monkeypatch.setattr(warc, "BLOCK", 64)  # entries across blocks
    read = reader(data)
    found = list(warc.members(read, len(data)))
    assert [m.name for m in found] == [f"archive/é{i}.warc" for i in range(5)]
    for i, m in enumerate(found):
        at = warc.data_offset(read, m)
        assert data[at:at + m.size] == bytes([i]) * i * 50


def test_offsets_beyond_four_gigabytes(spark, tmp_path):
    # a hole of 5 GB before the records: no disk is used, but offsets need ZIP64
    path = tmp_path / "far.wacz"
    with open(path, "wb") as f:
        f.seek(5 << 30)
        with zipfile.ZipFile(f, "w") as z:
            z.writestr("archive/a.warc.gz", b"".join(gzip.compress(r) for r in RECORDS))
    got = warc.read_archives(spark, paths(spark, path)).collect()
    assert facts(got) == WANT and min(r.offset for r in got) > 5 << 30


def test_many_members():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for i in range(70_000):  # more than two bytes count
            z.writestr(f"m{i}", b"")
    data = out.getvalue()
    names = [m.name for m in warc.members(reader(data), len(data))]
    assert names == [f"m{i}" for i in range(70_000)]


def test_damaged_packages_are_errors(spark, tmp_path):
    good = zipped()
    for bad in (b"", b"text", good[:-1], good[:40], good.replace(b"PK\x01\x02", b"PK\x01\x03", 1)):
        with pytest.raises(ValueError):
            list(warc.members(reader(bad), len(bad)))

    def package(name, archive, line=None, method=zipfile.ZIP_STORED):
        with zipfile.ZipFile(tmp_path / name, "w") as z:
            z.writestr("archive/a.warc.gz", archive, compress_type=method)
            if line:
                z.writestr("indexes/index.cdxj", "k 1 " + json.dumps({"filename": "a.warc.gz"} | line))
        return tmp_path / name

    gz = gzip.compress(RECORDS[1])
    false = gzip.compress(plain_record("response", "urn:x", b"p", extra="WARC-Payload-Digest: sha1:" + "A" * 32 + "\r\n"))
    cases = [("compressed", package("a", gz * 50, method=zipfile.ZIP_DEFLATED)), ("beyond the end", package("b", gz, {"offset": 5, "length": len(gz)})),
             ("not as long", package("c", gz, {"offset": 0, "length": len(gz) - 3})), ("cut off", package("d", gz[:-9])),
             ("not its digest", package("e", false)), ("not a WARC record", package("f", gzip.compress(b"hello\r\n\r\n")))]
    for what, path in cases:
        with pytest.raises(Exception, match=what):
            warc.read_archives(spark, paths(spark, path)).collect()


def test_a_bad_checksum_is_an_error(spark, tmp_path):
    gz = bytearray(gzip.compress(RECORDS[2], 0))
    gz[-12] ^= 1
    with pytest.raises(zlib.error):
        zlib.decompressobj(31).decompress(bytes(gz))
    with zipfile.ZipFile(tmp_path / "x", "w") as z:
        z.writestr("archive/a.warc.gz", bytes(gz))
    with pytest.raises(Exception, match="(?i)incorrect data check"):
        warc.read_archives(spark, paths(spark, tmp_path / "x")).collect()
