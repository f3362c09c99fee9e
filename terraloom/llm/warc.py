"""Web archives: written from pages, read back, and put together capture by capture.

``archive`` writes a request, a response (or a revisit, for a payload that another page's response holds) and a metadata record
for each page. A record is one line of Spark's text writer, whose line end is the blank line that ends a record, so the files
are committed by Spark and lie wherever Spark can write. They are gzip files; the whole file is one stream.

``records`` reads archives. Spark cuts the stream before each ``WARC/1.`` (a mark of which no part begins like the mark: the reader
can miss others where its buffer ends); where a head or payload itself holds that mark, the declared
length of the record shows that it is not complete, and the next cuts are put back behind it, byte for byte. A record whose
length can't be met raises an error. A gzip file is read by one task from its first byte to its last; cut pieces of plain files
are first brought into order by a shuffle. A task holds one record and a few MB of output.

``captures`` joins the records of a transaction: responses and revisits are the anchors, every other record joins the anchor
that its WARC-Concurrent-To (in either direction, over any number of hops) leads to; of several, that with the least identifier.
One nested row for each anchor: the response, and lists of requests, metadata and other records, each list in order of record
identifiers. A record that leads to no anchor is a row of its own without a response: nothing is lost. Records that repeat an
identifier are the same record: a companion counts once, an anchor is a row each time. The companions of one capture form one row.

Defined results: null html is an empty payload; a null or odd url is escaped or left out; a null page_id has no number in
the metadata record and is never the largest of its payload unless all are null; pages that repeat number and payload are all
responses or all revisits; an empty table gives an archive without records and no row. Other columns stay out.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terraloom.llm.common import scratch_dir, written

BREAK, MARK = "\r\n\r\n", "WARC/1."
ANCHORS = ("response", "revisit")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
BATCH_BYTES = 4 << 20
SCHEMA = "record_id string, type string, target_uri string, date string, concurrent_to array<string>, refers_to_id string, content_type string, status int, fields array<struct<name: string, value: string>>, payload_bytes bigint, payload_digest string, payload binary"
_TEXT = pa.string()
_PAIR = pa.struct([("name", _TEXT), ("value", _TEXT)])
_ARROW = pa.schema([
    ("record_id", _TEXT), ("type", _TEXT), ("target_uri", _TEXT), ("date", _TEXT), ("concurrent_to", pa.list_(_TEXT)), ("refers_to_id", _TEXT), ("content_type", _TEXT),
    ("status", pa.int32()), ("fields", pa.list_(_PAIR)), ("payload_bytes", pa.int64()), ("payload_digest", _TEXT), ("payload", pa.binary()),
])


# --- writing ------------------------------------------------------------------------------------------------------

def base32_sha1(data: Column) -> Column:
    """The SHA-1 of bytes or text in upper-case base 32: 160 bits are four groups of 40, each eight digits."""
    digits = F.sha1(data)
    groups = [F.lpad(F.conv(F.substring(digits, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _identifier(kind: str, digest: Column) -> Column:
    """A record's identifier by what the page holds, so that a task that runs again writes the same."""
    h = F.md5(F.to_json(F.struct(F.lit(kind), F.col("page_id"), F.col("url"), digest), {"ignoreNullFields": "false"}))
    return F.concat(F.lit("urn:uuid:"), F.concat_ws("-", *[F.substring(h, *at) for at in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]))


def _record(kind: Column | str, identifier: Column, head: list[tuple[str, Column]], block: Column) -> Column:
    lines = [F.lit("WARC/1.1\r\nWARC-Type: "), F.lit(kind) if isinstance(kind, str) else kind, F.lit(f"\r\nWARC-Date: {DATE}\r\nWARC-Record-ID: <"), identifier, F.lit(">\r\n")]
    lines += [F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit("")) for name, value in head]
    return F.concat(*lines, F.lit("Content-Length: "), F.octet_length(block).cast("string"), F.lit(BREAK), block)


def archive(pages: DataFrame, folder: str, least_bytes: int = 0) -> str:
    """Write three records for each row of (page_id, url, html) into ``folder``; payloads of fewer than ``least_bytes`` are never revisits."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumns({"digest": base32_sha1(F.col("payload")), "strong": F.sha2(F.col("payload"), 256)}).withColumn("identifier", _identifier("response", F.col("digest")))
    shared = rows.where(F.octet_length("payload") >= least_bytes).groupBy("strong")
    shared = shared.agg(F.max(F.struct(F.coalesce("page_id", F.lit(-(1 << 63))), "identifier")).alias("m"), F.max("page_id").alias("largest"), F.count("*").alias("n")).where("n > 1")
    # Written first: the join's other side is then a table of one row a payload, beside which a hot payload can be split.
    shared = written(shared.select("strong", "largest", F.col("m.identifier").alias("first")), "payloads")
    rows = rows.join(shared, "strong", "left").withColumn("again", F.coalesce(F.col("page_id") < F.col("largest"), F.col("page_id").isNull() & F.col("largest").isNotNull()))
    uri = F.col("url")
    for found, put in ((" ", "%20"), ("\t", "%09"), ("\r", "%0D"), ("\n", "%0A")):
        uri = F.replace(uri, F.lit(found), F.lit(put))
    answer = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length("payload").cast("string"), F.lit(BREAK))
    ask = F.concat(F.lit("GET "), F.coalesce(uri, F.lit("/")), F.lit(" HTTP/1.1\r\n\r\n"))
    about = F.coalesce(F.concat(F.lit("page-id: "), F.col("page_id").cast("string"), F.lit("\r\n")), F.lit(""))
    at, digest = F.col("identifier"), F.col("digest")
    pointed = lambda to: F.concat(F.lit("<"), to, F.lit(">"))
    made = [
        _record("request", _identifier("request", digest), [("WARC-Target-URI", uri), ("WARC-Concurrent-To", pointed(at)), ("Content-Type", F.lit("application/http;msgtype=request"))], ask),
        _record(
            F.when(F.col("again"), "revisit").otherwise("response"), at,
            [("WARC-Target-URI", uri), ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), digest)), ("WARC-Refers-To", F.when(F.col("again"), pointed(F.col("first")))),
             ("WARC-Profile", F.when(F.col("again"), PROFILE)), ("Content-Type", F.lit("application/http;msgtype=response"))],
            F.when(F.col("again"), answer).otherwise(F.concat(answer, F.col("payload"))),
        ),
        _record("metadata", _identifier("metadata", digest), [("WARC-Concurrent-To", pointed(at)), ("Content-Type", F.lit("application/warc-fields"))], about),
    ]
    rows.select(F.explode(F.array(*made)).alias("value")).write.text(folder, compression="gzip", lineSep=BREAK)
    return folder


# --- reading ------------------------------------------------------------------------------------------------------

class Damaged(ValueError):
    """An archive holds bytes that form no record."""


def _lines(head: bytes) -> list[tuple[str, str]]:
    folded = re.sub(rb"\r?\n[ \t]+", b" ", head)
    pairs = (line.partition(b":") for line in re.split(rb"\r?\n", folded) if b":" in line)
    return [(n.strip().decode("utf-8", "replace").lower(), v.strip().decode("utf-8", "replace")) for n, _, v in pairs]


class _Open:
    """A record that isn't complete yet: ``need`` is None until its head is."""

    def __init__(self, piece: bytes) -> None:
        self.parts, self.need, self.have = [], None, 0
        self._grow(piece)

    def _grow(self, piece: bytes) -> None:
        self.parts.append(piece)
        self.have += len(piece)
        if self.need is None and BREAK.encode() in piece:
            version, _, rest = b"".join(self.parts).partition(b"\n")
            head, _, body = rest.partition(BREAK.encode())
            if version.rstrip() not in (b"0", b"1"):
                raise Damaged(f"no record begins with {(MARK.encode() + version[:40])!r}")
            self.fields, self.parts, self.have = _lines(head), [body], len(body)
            self.need = int(dict(self.fields).get("content-length", -1))
            if self.need < 0:
                raise Damaged("a record without Content-Length")

    @property
    def complete(self) -> bool:
        return self.need is not None and self.have >= self.need

    def more(self, piece: bytes) -> None:
        """What follows a mark that lay within the record."""
        self._grow(MARK.encode() + piece)

    def block(self) -> bytes:
        block = b"".join(self.parts)
        if block[self.need :].strip(b"\r\n"):
            raise Damaged(f"{len(block)} bytes where a record declares {self.need}")
        return block[: self.need]


def _bare(identifier: str | None) -> str | None:
    return identifier.strip("<> ") if identifier else None


def _row(record: _Open, keep: bool) -> tuple:
    fields, block = dict(record.fields), record.block()
    kind, content = fields.get("warc-type"), fields.get("content-type", "")
    payload, status, inner = block, None, []
    if content.startswith("application/http"):
        head, _, payload = block.partition(b"\r\n\r\n")
        first, _, rest = head.partition(b"\r\n")
        inner = _lines(rest)
        status = int(m[1]) if (m := re.match(rb"HTTP/\S+ (\d{3})", first)) else None
    elif content == "application/warc-fields":
        inner, payload = _lines(block), b""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    said = fields.get("warc-payload-digest", "").removeprefix("sha1:").upper() or None
    size: int | None = len(payload)
    if kind == "revisit":  # the payload lies elsewhere; the server's own heads say how long it was
        digest, size, payload = said, int(dict(inner).get("content-length", len(payload))), None
    elif kind == "response" and said and re.fullmatch("[A-Z2-7]{32}", said) and said != digest:
        raise Damaged(f"the payload of {fields.get('warc-record-id')} has another digest than declared")
    concurrent = [_bare(v) for n, v in record.fields if n == "warc-concurrent-to"]
    pairs = [{"name": n, "value": v} for n, v in inner]
    return (_bare(fields.get("warc-record-id")), kind, fields.get("warc-target-uri"), fields.get("warc-date"), concurrent, _bare(fields.get("warc-refers-to")), content or None, status, pairs, size, digest, payload if keep else None)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(_ARROW)], schema=_ARROW)


def records(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The records of all archives below ``path``; without ``payloads`` their length and digest only, taken from the whole payload."""
    cut = spark.read.text(path, lineSep=MARK)
    cut = cut.select("value", "_metadata.file_path", F.col("_metadata.file_block_start").alias("start"))
    if not all(f.endswith(".gz") for f in cut.inputFiles()):
        cut = cut.withColumn("line", F.monotonically_increasing_id()).repartition("file_path").sortWithinPartitions("file_path", "start", "line")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, record, at = [], 0, None, None

        def close() -> None:
            nonlocal record, size
            if record:
                if not record.complete:
                    raise Damaged(f"{at} ends within a record")
                held.append(_row(record, payloads))
                size += 500 + (record.need if payloads else 0)
            record = None

        for batch in batches:
            for value, path in zip(batch.column(0), batch.column(1), strict=True):
                piece, path = value.as_py(), path.as_py()
                if path != at:
                    close()
                    at = path
                    piece = piece.removeprefix(MARK.encode())
                    if not piece.strip():
                        continue
                if record and not record.complete:
                    record.more(piece)
                else:
                    close()
                    record = _Open(piece)
                if size >= BATCH_BYTES:
                    yield _batch(held)
                    held, size = [], 0
        close()
        yield _batch(held)

    return cut.select(F.col("value").cast("binary").alias("value"), "file_path").mapInArrow(run, SCHEMA)


# --- transactions -------------------------------------------------------------------------------------------------

def _anchored(found: DataFrame) -> DataFrame:
    """(record_id, capture) of every record that links to an anchor lead to: rounds of joins along the links, as many as the longest chain."""
    forth = found.select(F.col("record_id").alias("a"), F.explode("concurrent_to").alias("b"))
    links = forth.unionByName(forth.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct()
    known = written(found.where(F.col("type").isin(*ANCHORS)).select("record_id", F.col("record_id").alias("capture")).distinct(), "anchors")
    left = found.where(~F.col("type").isin(*ANCHORS) | F.col("type").isNull()).select("record_id").distinct().count()
    frontier, out = known, [known]
    while left:
        near = frontier.select(F.col("record_id").alias("b"), "capture")
        new = links.join(near, "b").groupBy(F.col("a").alias("record_id")).agg(F.min("capture").alias("capture"))
        for before in out:
            new = new.join(before.select("record_id"), "record_id", "left_anti")
        frontier = written(new, "linked")
        got = frontier.count()
        if not got:
            break
        out.append(frontier)
        left -= got
    whole = out[0]
    for part in out[1:]:
        whole = whole.unionByName(part)
    return whole


def captures(found: DataFrame) -> DataFrame:
    """One nested row for each transaction of the records: capture, response, requests, metadata, others."""
    found = written(found, "records")
    anchor = F.coalesce(F.col("type").isin(*ANCHORS), F.lit(False))
    whole = F.struct(*found.columns)
    rest = found.where(~anchor).dropDuplicates(["record_id"])
    led = rest.join(_anchored(found), "record_id", "left")
    of = lambda kind: F.array_sort(F.collect_list(F.when(kind, F.struct("record_id", whole.alias("r")))), lambda a, b: F.when(a.record_id < b.record_id, -1).when(a.record_id > b.record_id, 1).otherwise(0))
    kinds = {"requests": F.col("type").eqNullSafe("request"), "metadata": F.col("type").eqNullSafe("metadata")}
    kinds["others"] = ~(kinds["requests"] | kinds["metadata"])
    lists = led.groupBy(F.coalesce("capture", "record_id").alias("capture")).agg(*[F.transform(of(kind), lambda x: x.r).alias(name) for name, kind in kinds.items()])
    anchors = found.where(anchor).select(F.col("record_id").alias("capture"), whole.alias("response"))
    return anchors.join(lists, "capture", "full").select("capture", "response", *[F.coalesce(name, F.array().cast(lists.schema[name].dataType)).alias(name) for name in kinds])


def revisited(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Archive the pages, read the archives back and tell for each capture what its records say of the page."""
    spark = pages.sparkSession
    folder = archive(pages, f"{scratch_dir(spark)}/terraloom-warc-{uuid.uuid4().hex}", least_bytes)
    number = F.filter(F.try_element_at("metadata", F.lit(1))["fields"], lambda f: f["name"] == "page-id")
    rows = captures(records(spark, folder, payloads=False)).select(
        "capture", F.try_element_at(number, F.lit(1))["value"].cast("bigint").alias("page_id"), "response.payload_bytes", "response.payload_digest",
        F.col("response.type").alias("record_type"), F.col("response.refers_to_id"), F.col("response.target_uri"),
    )
    rows = written(rows, "captures")
    of = rows.where("record_type = 'response'").groupBy(F.col("capture").alias("refers_to_id")).agg(F.max("page_id").alias("refers_to"))
    return rows.join(written(of, "responses"), "refers_to_id", "left").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "target_uri")


#: The same rows by counting equal payloads.
SQL = """
WITH p AS (SELECT page_id, url, coalesce(html, '') AS payload FROM pages),
d AS (SELECT *, sha1(payload) AS h, max(page_id) OVER (PARTITION BY payload) AS largest FROM p)
SELECT page_id, strlen(payload)::BIGINT AS payload_bytes,
  translate(to_base(('0x' || substr(h, 1, 10))::BIGINT, 32, 8) || to_base(('0x' || substr(h, 11, 10))::BIGINT, 32, 8) || to_base(('0x' || substr(h, 21, 10))::BIGINT, 32, 8) || to_base(('0x' || substr(h, 31, 10))::BIGINT, 32, 8),
    '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') AS payload_digest,
  CASE WHEN page_id < largest THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN page_id < largest THEN largest END AS refers_to,
  replace(replace(replace(replace(url, ' ', '%20'), chr(9), '%09'), chr(13), '%0D'), chr(10), '%0A') AS target_uri
FROM d"""
