"""Web archives: exact round trips, transactions over several hops, and repeated payloads against a plain version."""

from __future__ import annotations

import base64
import gzip
import hashlib

import pytest

from terraloom.llm import warc

PAGES = "page_id bigint, url string, html string, record_type string, digest string"


def plain(pages: list[tuple], least: int = 0) -> list[tuple]:
    out = []
    for page_id, _, html in pages:
        payload = (html or "").encode()
        alike = [p for p, _, h in pages if (h or "") == (html or "") and p is not None]
        largest = max(alike, default=None) if len(payload) >= least else page_id
        again = largest is not None and (page_id is None or page_id < largest)
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        out.append((page_id, len(payload), digest, "revisit" if again else "response", largest if again else None))
    return sorted(out, key=str)


def table(spark, pages):
    return spark.createDataFrame([(*p, "x", "y") for p in pages], PAGES)


ODD = [
    "a", "", None, "\r\n", "\r", "x\r\n\r\n", "x\r\n\r\n\r\n", "\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n", "WARC/1.1\r\nContent-Length: 1\r\n\r\na",
    "\r\n\r\nWARC/1.", "\r\n\r\nWARC/1.\r\n\r\nWARC/1.", "é" * 100_000, "\x00�" * 9, "WARC/1." * 30_000, "\r\n\r\nWARC/1" * 30_000, ("\r\n" * 7 + "WARC/1.0\r\n") * 3_000,
]


def test_pages_come_back(spark):
    pages = [(i, f"http://e.com/{i} \r\nWARC-Type: x WARC/1.1\r\n\r\nWARC/1." if i % 2 else None, h) for i, h in enumerate(ODD)]
    pages += [(100 + i, "u", h) for i, h in enumerate(ODD[:6])] + [(None, "u", "a"), (None, "v", "only null"), (103, "u", "\r\n"), (200, "w", "twice"), (200, "w2", "twice"), (300, "z", "same row"), (300, "z", "same row")]
    pages += [(1000 + i, "hot", "copied") for i in range(3000)]
    pages += [(9000 + i, "sized", f"{i}\r\n\r\n" + "z" * (i * 37 % 900) + "\r\n" * (i % 5)) for i in range(4000)]  # marks fall on all places of a buffer
    for least in (0, 2):
        got = [tuple(r)[:5] for r in warc.revisited(table(spark, pages), least).collect()]
        assert sorted(got, key=str) == plain(pages, least)
    assert warc.revisited(table(spark, []).where("false")).count() == 0


def test_payloads_come_back(spark, tmp_path):
    pages = [(i, "u", h) for i, h in enumerate(ODD)]
    warc.archive(table(spark, pages), str(tmp_path / "w"))
    rows = warc.captures(warc.records(spark, str(tmp_path / "w"))).collect()
    got = {int(r.metadata[0].fields[0].value): r for r in rows}
    assert len(rows) == len(pages) and set(got) == set(range(len(ODD)))
    for i, h in enumerate(ODD):
        r = got[i].response
        assert r.status == 200 and len(got[i].requests) == 1 and not got[i].others
        assert (None if r.type == "revisit" else bytes(r.payload)) == (None if i == 1 else (h or "").encode())


def record(kind: str, name: str, to: list[str], block: bytes, content: str = "text/plain") -> bytes:
    head = [f"WARC-Type: {kind}", f"WARC-Record-ID: <{name}>", f"content-type: {content}", *[f"WARC-Concurrent-To: <{t}>" for t in to], f"Content-Length: {len(block)}"]
    return b"WARC/1.0\r\n" + "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def archive_bytes() -> bytes:
    return b"".join([
        record("warcinfo", "info", [], b"software: none"),
        record("metadata", "m3", ["m2"], b"a: 3\r\nb: 4\r\n", "application/warc-fields"),  # three hops to the response
        record("metadata", "m2", ["q1"], b"", "application/warc-fields"),
        record("request", "q1", ["r1"], b"GET / HTTP/1.1\r\nHost: e\r\n\r\n", "application/http;msgtype=request"),
        record("resource", "x1", [], b"WARC/1.0\r\n\r\nWARC/1.0\r\n"),
        record("request", "q2", [], b"", "application/http;msgtype=request"),
        record("response", "r2", ["q2", "m4"], b"HTTP/1.0 404 Not found\r\nA: b\r\n\r\n" + bytes(range(256)) * 40, "application/http;msgtype=response"),
        record("metadata", "m4", ["nowhere"], b"z", "text/plain"),
        record("response", "r1", [], b"HTTP/1.1 200 OK\r\n\r\n" + b"\r\n\r\nWARC/1.0\r\n" * 500, "application/http;msgtype=response"),
    ])


@pytest.mark.parametrize("form", ["plain", "gzip", "members"])
def test_transactions(spark, tmp_path, form):
    data = archive_bytes()
    if form == "plain":
        (tmp_path / "a.warc").write_bytes(data)
    else:  # one stream, or a member for each half
        (tmp_path / "a.warc.gz").write_bytes(gzip.compress(data) if form == "gzip" else gzip.compress(data[:777]) + gzip.compress(data[777:]))
    (tmp_path / "b.warc").write_bytes(record("metadata", "m5", ["m3"], b"late", "text/plain"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")  # plain files are cut in the middle of records
    try:
        rows = {r.capture: r for r in warc.captures(warc.records(spark, str(tmp_path))).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert set(rows) == {"r1", "r2", "info", "x1"}
    assert [[x.record_id for x in rows["r1"][k]] for k in ("requests", "metadata", "others")] == [["q1"], ["m2", "m3", "m5"], []]
    assert [[x.record_id for x in rows["r2"][k]] for k in ("requests", "metadata", "others")] == [["q2"], ["m4"], []]
    assert bytes(rows["r1"].response.payload) == b"\r\n\r\nWARC/1.0\r\n" * 500 and rows["r2"].response.status == 404
    assert bytes(rows["r2"].response.payload) == bytes(range(256)) * 40
    assert rows["info"].response is None and bytes(rows["x1"].others[0].payload) == b"WARC/1.0\r\n\r\nWARC/1.0\r\n"
    assert [tuple(f) for f in rows["r1"].metadata[1].fields] == [("a", "3"), ("b", "4")]


@pytest.mark.parametrize("bad", [b"no archive at all", record("metadata", "m", [], b"1234")[:-7], record("metadata", "m", [], b"1") + b"rest"])
def test_damage_is_told(spark, tmp_path, bad):
    (tmp_path / "a.warc").write_bytes(bad)
    with pytest.raises(Exception, match="Damaged"):
        warc.records(spark, str(tmp_path)).collect()


def test_digests(spark):
    row = spark.range(1).select(*[warc.base32_sha1(warc.F.lit(t)).alias(str(i)) for i, t in enumerate(["", "a", "é" * 99])]).first()
    assert list(row) == [base64.b32encode(hashlib.sha1(t.encode()).digest()).decode() for t in ["", "a", "é" * 99]]
