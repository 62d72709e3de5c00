"""WARC: round trips, damaged archives, odd rows and the rules for revisits."""

import base64
import gzip
import hashlib
import io
import os

import pytest
from pyspark.sql import functions as F

from lotwise.llm import warc

PAGES = "page_id long, url string, html string, payload_bytes long, file string, top int"


@pytest.fixture(scope="module")
def pages(spark):
    long_text = "é<p>0123456789</p>" * 200_000
    rows = [
        (1, "http://a/x y", "same", 7, "f", 1), (2, None, "same", 7, "f", 1), (9, "http://a/\r\nWARC-Type: request", "same", 7, "f", 1),
        (3, "u", None, 7, "f", 1), (4, "u", "", 7, "f", 1), (5, "u", long_text, 7, "f", 1), (6, "u", "a\r\n\r\nb\r\n\r\n", 7, "f", 1),
        (None, "u", "same", 7, "f", 1), (None, "u", "alone", 7, "f", 1), (None, "u", "alone", 7, "f", 1), (9, "u", "same", 7, "f", 1),
    ]
    return spark.createDataFrame(rows, PAGES)


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def test_revisits(pages):
    got = {tuple(r) for r in warc.archive_pages(pages).collect()}
    same, alone = (4, digest("same")), (5, digest("alone"))
    long_text = "é<p>0123456789</p>" * 200_000
    assert got == {
        (1, *same, "revisit", 9), (2, *same, "revisit", 9), (9, *same, "response", None), (None, *same, "revisit", 9),
        (3, 0, digest(""), "revisit", 4), (4, 0, digest(""), "response", None), (5, len(long_text.encode()), digest(long_text), "response", None),
        (6, 10, digest("a\r\n\r\nb\r\n\r\n"), "response", None), (None, *alone, "response", None),
    }
    assert warc.archive_pages(pages).count() == pages.count()


def test_least_bytes_and_no_rows(pages):
    kinds = {(r["page_id"], r["record_type"]) for r in warc.archive_pages(pages.where("page_id < 5"), least_bytes=5).collect()}
    assert kinds == {(k, "response") for k in (1, 2, 3, 4)}
    assert warc.archive_pages(pages.where("false")).collect() == []


def test_round_trip_in_many_archives(spark, pages):
    files = warc.write_archives(warc.plan_records(pages), archive_bytes=1)
    assert files.count() == files.agg(F.sum("records")).first()[0] == pages.count()
    read = warc.read_archives(files, payloads=True, chunk=7).where("record_type = 'response'").collect()
    stored = sorted(r["payload"].decode() for r in read)
    want = [r["html"] or "" for r in pages.where("page_id is null and html = 'alone' or page_id in (4, 5, 6, 9)").collect()]
    assert stored == sorted(want)
    assert {r["headers"].get("warc-target-uri") for r in read} >= {"http://a/%0D%0AWARC-Type:%20request", "u"}


def test_members_are_plain_gzip(pages):
    row = warc.write_archives(warc.plan_records(pages.where("page_id = 6").coalesce(1))).first()
    path = row["file"].removeprefix("file://")
    with open(path, "rb") as f:
        data = f.read()
    assert os.path.getsize(path) == row["bytes"] and gzip.decompress(data).count(b"WARC/1.1\r\n") == 2
    assert [r.headers["warc-type"] for r in warc.read_records(io.BytesIO(data))] == ["warcinfo", "response"]


def archive(*blocks, **wrong):
    out = []
    for block in blocks:
        headers = [("WARC-Type", "resource"), ("WARC-Block-Digest", "sha1:" + warc.base32_sha1(hashlib.sha1(block).digest()))]
        out.append(warc.member(headers, block))
    return out


def faults(data, chunk=11):
    return [(r.payload_bytes, r.fault) for r in warc.read_records(io.BytesIO(data), chunk=chunk)]


def test_damage():
    one, two, three = archive(b"first", b"x" * 5000, b"third")
    assert faults(one + two + three) == [(5, None), (5000, None), (5, None)]
    assert faults(b"") == []
    cut = faults(one + two[:-20])
    assert cut[0] == (5, None) and cut[1][1] == "the archive ends inside a member"
    assert faults(one + b"no gzip" + three)[1][1].startswith("gzip: ")
    lied = warc.member([("WARC-Type", "resource"), ("WARC-Block-Digest", "sha1:AAAA")], b"lie")
    assert faults(lied + one) == [(3, "wrong block"), (5, None)]
    assert faults(gzip.compress(b"WARC/1.1\r\nContent-Length: 9\r\n\r\nshort\r\n\r\n"))[0][1] is not None
    assert faults(gzip.compress(b"WARC/1.1\r\nContent-Length: 3\r\n\r\nlonger\r\n\r\n")) == [(3, "wrong record end")]
    assert faults(gzip.compress(b"WARC/1.1\r\nContent-Length: -1\r\n\r\n"))[0][1] == "a record states no Content-Length"
    assert faults(gzip.compress(b"GET / HTTP/1.1\r\n\r\n"))[0][1] == "no WARC record"
    offsets = [r.offset for r in warc.read_records(io.BytesIO(one + two + three), chunk=64)]
    assert offsets == [0, len(one), len(one) + len(two)]


def test_faults_stop_verdicts(spark, tmp_path):
    bad = warc.page_record(1, "u", b"text", 4, hashlib.sha1(b"other").digest(), None)
    lost = warc.page_record(2, "u", None, 4, hashlib.sha1(b"text").digest(), 77)
    for name, data, message in (("bad", bad, "wrong payload"), ("lost", lost, "unresolved revisit")):
        (tmp_path / name).write_bytes(data)
        files = spark.createDataFrame([(str(tmp_path / name),)], "file string")
        with pytest.raises(Exception, match=message):
            warc.page_verdicts(warc.read_archives(files)).collect()
