"""Secret scans confirmed by structure.

Patterns give candidates; a base64 or hex candidate is reported as a key or token only after it was decoded and its inside
fits: DER sequences whose nested lengths add up to the whole, OpenSSH key files whose length-prefixed fields do, and signed
tokens whose header is a JSON object that names an algorithm. Three plain kinds (assign, access, hex) are reported as the
patterns find them.

Spans are in code points, end exclusive. Defined results: null is an empty text; each row gets a row; other columns stay out.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "der", "openssh", "jwt")
BASE = KINDS[:3]
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ASSIGN_WORDS = ("passw", "secret", "token", "api_key", "apikey")
#: Runs are taken whole, so a least length inside the pattern finds the same as dropping short matches.
ACCESS, HEX = re.compile(r"AKIA[A-Z0-9]{16,}"), re.compile(r"[0-9a-f]{24,}")
#: Standard base64 may run over lines; the URL-safe alphabet stays on one.
BLOB, URL_BLOB = re.compile(r"[A-Za-z0-9+/]{40,}(?:\r?\n[A-Za-z0-9+/]+)*={0,2}"), re.compile(r"[A-Za-z0-9_-]{40,}={0,2}")
HEX_BLOB = re.compile(r"[0-9A-Fa-f]{48,}")
JWT = re.compile(r"(?<![A-Za-z0-9_-])(eyJ[A-Za-z0-9_-]+)\.([A-Za-z0-9_-]+)\.([A-Za-z0-9_-]*)")
SCHEMA = "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string"


def decoded(text: str) -> bytes | None:
    """Bytes of standard or URL-safe base64 with or without padding; None if it isn't that."""
    body = re.sub(r"\s", "", text).rstrip("=").replace("-", "+").replace("_", "/")
    if len(body) % 4 == 1:
        return None
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def der_fields(data: bytes) -> list[tuple[int, bytes]] | None:
    """Tags and contents that fill ``data`` exactly; None if the lengths don't add up."""
    at, out = 0, []
    while at < len(data):
        if at + 2 > len(data):
            return None
        tag, size, at = data[at], data[at + 1], at + 2
        if size & 0x80:
            width = size & 0x7F
            if not 1 <= width <= 4 or at + width > len(data):
                return None
            size, at = int.from_bytes(data[at : at + width], "big"), at + width
        if at + size > len(data):
            return None
        out.append((tag, data[at : at + size]))
        at += size
    return out


def is_der_key(data: bytes) -> bool:
    """A private or public key: one sequence that is the whole, and inside it one of the known layouts."""
    top = der_fields(data)
    if not top or len(top) != 1 or top[0][0] != 0x30:
        return False
    fields = der_fields(top[0][1])
    if not fields:
        return False
    tags = [tag for tag, _ in fields]
    numbers = len(fields) >= 8 and set(tags) == {0x02}  # RSA or DSA: version and numbers
    wrapped = tags[:3] == [0x02, 0x30, 0x04] and _is_algorithm(fields[1][1])  # PKCS#8
    encrypted = tags == [0x30, 0x04] and _is_algorithm(fields[0][1])
    curve = tags[:2] == [0x02, 0x04] and fields[0][1] == b"\x01" and len(fields[1][1]) >= 16  # EC
    public = tags == [0x30, 0x03] and _is_algorithm(fields[0][1])
    return numbers or wrapped or encrypted or curve or public


def _is_algorithm(data: bytes) -> bool:
    fields = der_fields(data)
    return bool(fields) and fields[0][0] == 0x06


def is_openssh_key(data: bytes) -> bool:
    """The magic word, then cipher, KDF and KDF options, a key count, and so many public keys, each after its length."""
    magic = b"openssh-key-v1\0"
    if not data.startswith(magic):
        return False
    at, sizes = len(magic), []
    for field in range(3):
        size = int.from_bytes(data[at : at + 4], "big")
        at += 4 + size
        sizes.append(size)
        if at > len(data) or (field == 0 and not size):
            return False
    keys, at = int.from_bytes(data[at : at + 4], "big"), at + 4
    if not 1 <= keys <= 16:
        return False
    for _ in range(keys + 1):
        at += 4 + int.from_bytes(data[at : at + 4], "big")
        if at > len(data):
            return False
    return at == len(data)


def is_token_header(text: str) -> bool:
    data = decoded(text)
    try:
        header = json.loads(data) if data else None
    except ValueError:
        return False
    return isinstance(header, dict) and isinstance(header.get("alg"), str)


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the plain kinds, leftmost without overlap within a kind, sorted."""
    found = [(m.start(), "hex", m.end()) for m in HEX.finditer(text)]
    if "AKIA" in text:
        found += [(m.start(), "access", m.end()) for m in ACCESS.finditer(text)]
    low = text.lower()
    if any(word in low for word in ASSIGN_WORDS):
        found += [(m.start(), "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    return sorted(found, key=_order)


def _order(span: tuple[int, str, int]) -> tuple[int, int]:
    return span[0], KINDS.index(span[1])


def confirmed_spans(text: str) -> list[tuple[int, str, int]]:
    """Spans whose decoded structure shows a key or a signed token."""
    found = set()
    for pattern in (BLOB, URL_BLOB):
        for m in pattern.finditer(text):
            # Words on the line after a blob may look like more of it: the first line alone is tried too.
            for blob in dict.fromkeys([m[0], m[0].split("\n")[0].rstrip("\r")]):
                data = decoded(blob)
                kind = "der" if data and is_der_key(data) else "openssh" if data and is_openssh_key(data) else None
                if kind:
                    found.add((m.start(), kind, m.start() + len(blob)))
                    break
    for m in HEX_BLOB.finditer(text):
        if len(m[0]) % 2 == 0 and is_der_key(bytes.fromhex(m[0])):
            found.add((m.start(), "der", m.end()))
    if "eyJ" in text:
        found |= {(m.start(), "jwt", m.end()) for m in JWT.finditer(text) if is_token_header(m[1]) and decoded(m[2])}
    return sorted(found, key=_order)


def all_spans(text: str) -> list[tuple[int, str, int]]:
    return sorted(base_spans(text) + confirmed_spans(text), key=_order)


def listed(spans: list[tuple[int, str, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, kind, end in spans)


def _reports(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), *[(f"n_{k}", pa.int64()) for k in BASE], ("base_sha256", pa.string()), ("spans", pa.string())])
    for batch in batches:
        rows = []
        for text in batch.column("text"):
            spans = all_spans(text.as_py() or "")
            base = [s for s in spans if s[1] in BASE]
            rows.append((*(sum(s[1] == k for s in base) for k in BASE), hashlib.sha256(listed(base).encode()).hexdigest(), listed(spans)))
        columns = list(zip(*rows, strict=True)) or [[]] * 5
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array(list(c), f.type) for c, f in zip(columns, list(schema)[1:], strict=True)]], schema=schema)


def report(docs: DataFrame) -> DataFrame:
    """Counts and spans of each row."""
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(_reports, SCHEMA)


def merged(spans: list[tuple[int, str, int]]) -> list[tuple[int, int]]:
    """Union of spans, left to right."""
    out: list[list[int]] = []
    for start, _, end in spans:
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [(a, b) for a, b in out]


def masked(text: str | None, mask: str = "[SECRET]") -> str | None:
    if not text:
        return text
    parts, at = [], 0
    for start, end in merged(all_spans(text)):
        parts += [text[at:start], mask]
        at = end
    return text if not parts else "".join([*parts, text[at:]])


def redacted(docs: DataFrame) -> DataFrame:
    """``docs`` with every span replaced; ``n_chars``, where there is one, follows the text. Other columns and clean texts stay as they are."""
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("text")
            old = batch.column(at).to_pylist()
            new = [masked(t) for t in old]
            columns = list(batch.columns)
            columns[at] = pa.array(new, batch.schema.field(at).type)
            if "n_chars" in names:
                n = batch.schema.get_field_index("n_chars")
                columns[n] = pa.array([c if a is b else len(b) for a, b, c in zip(old, new, columns[n].to_pylist(), strict=True)], batch.schema.field(n).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(run, docs.schema)
