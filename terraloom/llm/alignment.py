"""Cross-tokenizer alignment: which tokens of two vocabularies end together, and how often each pair of ids does.

Each text is encoded twice, by a byte-level vocabulary A (from space and text) and by a piece vocabulary B (which puts the
space there itself). Where a token of A and one of B end at the same byte, both sequences are cut; the two tokens that end
there are linked. A text is cut before single spaces between other characters and between words and marks first: no token of either vocabulary reaches
across such a place (checked for B when a worker starts), so chunks are encoded once and looked up afterwards; both lookups
give what the whole text gives. A text of which any chunk comes back with other bytes is encoded whole, and has no tokens if it
differs itself.

The pairs of ids that occur are counted in dense matrices, striped by the id of B: stripe ``s`` has a row for each id ``b`` with
``b % STRIPES == s`` and a column for each id of A. A task packs the links of a batch of texts into one blob for each stripe
(text number, row, column, how often), and a second one without texts. The second ones meet by stripe and are added into the
stripe's matrix with ``np.add.at`` (with many batches first by stripe and a share of them). Row maxima are the best counts.
Links are then dealt by stripe too, beside the counts of their stripe, and looked up in the matrix; a stripe with many batches is
split into shares, each with the counts. Sums for each text of a batch come back as arrays and are added up by batch. A hot
pair is one entry a text in the links and one a batch in the counts; no task holds more than one stripe's matrix, one batch and a row.

Defined results: null and empty texts and texts that don't come back byte by byte have no tokens; rows that repeat an id
are texts of their own; an empty table gives no row. Other columns stay out.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terraloom.llm.common import text_blocks, written
from terraloom.llm.tokens import vocabulary

STRIPES = 128
#: A batch ends with so many links (a pair of ids within one text) or texts; batches of a share of a stripe.
BATCH_LINKS, BATCH_TEXTS, SHARE = 1_500_000, 16_384, 512
#: Chunks kept by a worker, and the longest chunk that is kept.
MOST_CHUNKS, LONGEST_CHUNK = 300_000, 64
#: Pairs in one row of counts.
ROW_PAIRS = 1 << 20
#: A letter that is a token of B by itself, and ASCII marks that A's pattern splits from a letter or digit before them; the apostrophe may begin a suffix and isn't one.
LEAD, MARKS = "a", "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


def _byte_of() -> dict[str, int]:
    """The byte behind each character of a byte-level vocabulary: visible Latin-1 characters stand for themselves, the rest count up from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Pair:
    """Both vocabularies in a worker, and what is known of chunks: (A's ids, B's ids, groups, text of the groups, links), or None where bytes differ."""

    def __init__(self, a_path: str, b_path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        of = _byte_of()
        self.n_a, self.n_b = self.a.get_vocab_size(), self.b.vocab_size()
        self.a_bytes = [bytes(of[c] for c in t) if all(c in of for c in t) else t.encode() for t in map(self.a.id_to_token, range(self.n_a))]
        pieces = [self.b.id_to_piece(i) for i in range(self.n_b)]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.a_sizes, self.b_sizes = (np.array([len(x) for x in y], np.int64) for y in (self.a_bytes, self.b_bytes))
        self.cut = self._cuts([p for i, p in enumerate(pieces) if not (self.b.is_byte(i) or self.b.is_control(i) or self.b.is_unknown(i))])
        digits = [str(i) for i in range(max(self.n_a, self.n_b))]
        self.digits = np.array([d + mark for mark in ",|;" for d in digits], object)
        self.known: dict[str, tuple | None] = {}
        self.before: dict[str, tuple | None] = {}

    @staticmethod
    def _cuts(pieces: list[str]) -> re.Pattern | None:
        """Places that no piece of B reaches across: single spaces within the text, and marks right behind a letter or digit, where A's pattern splits too."""
        if any(re.search("[^▁]▁", p) for p in pieces):
            return None
        joined = set(re.findall(rf"([^\W_])[{re.escape(MARKS)}]", "\n".join(pieces)))
        if LEAD in joined or f"▁{LEAD}" not in pieces:
            return re.compile(r"(?<=\S)(?= \S)")
        return re.compile(rf"(?<=\S)(?= \S)|(?<=[^\W_{re.escape(''.join(sorted(joined)))}])(?=[{re.escape(MARKS)}])")

    def encode(self, chunks: list[str]) -> list[tuple | None]:
        """``chunks`` begin with the space that B puts there, or with a mark behind a word: then B gets a letter before it, whose token is taken off again."""
        if not chunks:
            return []
        wants = [c.encode() for c in chunks]
        a = [x.ids for x in self.a.encode_batch_fast(chunks, add_special_tokens=False)]
        b = self.b.encode([c[1:] if c[0] == " " else LEAD + c for c in chunks], num_threads=1)
        b = [x if c[0] == " " else x[1:] for c, x in zip(chunks, b, strict=True)]
        out: list[tuple | None] = [None] * len(chunks)
        sound = range(len(chunks))
        if not self._lossless(wants, a, b):
            sound = [i for i in sound if self._lossless([wants[i]], [a[i]], [b[i]])]
        if sound:
            for i, found in zip(sound, self._aligned([wants[i] for i in sound], [a[i] for i in sound], [b[i] for i in sound]), strict=True):
                out[i] = found
        return out

    def _lossless(self, wants: list[bytes], a: list[list[int]], b: list[list[int]]) -> bool:
        """Whether the tokens of each chunk are its bytes."""
        ends, joined = np.cumsum([len(w) for w in wants]), b"".join(wants)
        for ids, of, sizes in ((a, self.a_bytes, self.a_sizes), (b, self.b_bytes, self.b_sizes)):
            flat = np.fromiter(chain.from_iterable(ids), np.int64)
            size = np.r_[0, np.cumsum(sizes[flat])][np.cumsum([len(x) for x in ids])]
            if not np.array_equal(size, ends) or b"".join(map(of.__getitem__, flat.tolist())) != joined:
                return False
        return True

    def _aligned(self, wants: list[bytes], a: list[list[int]], b: list[list[int]]) -> list[tuple]:
        """Chunks laid behind each other: tokens that end at the same byte close a group, and none reaches over a chunk's end."""
        n_a, n_b = np.array([len(x) for x in a]), np.array([len(x) for x in b])
        flat_a, flat_b = np.fromiter(chain.from_iterable(a), np.int64), np.fromiter(chain.from_iterable(b), np.int64)
        ends_a, ends_b = np.cumsum(self.a_sizes[flat_a]), np.cumsum(self.b_sizes[flat_b])
        at = np.searchsorted(ends_b, ends_a)  # both reach the same last byte
        last_a = ends_b[at] == ends_a
        last_b = np.zeros(len(flat_b), bool)
        last_b[at[last_a]] = True
        links = (flat_b[last_b] * self.n_a + flat_a[last_a]).tobytes()
        # Groups in order, A's tokens before B's, each id with the mark that follows it.
        group = np.r_[2 * (np.cumsum(last_a) - last_a), 2 * (np.cumsum(last_b) - last_b) + 1]
        each = len(self.digits) // 3
        text = self.digits[np.r_[flat_a + each * last_a, flat_b + 2 * each * last_b][np.argsort(group, kind="stable")]].tolist()
        bounds = np.r_[0, np.cumsum(n_a + n_b)].tolist()
        groups = np.r_[0, np.cumsum(last_a)[np.cumsum(n_a) - 1]].tolist()
        return [
            (x, y, g1 - g0, "".join(text[t0:t1])[:-1], links[8 * g0 : 8 * g1])
            for x, y, g0, g1, t0, t1 in zip(n_a.tolist(), n_b.tolist(), groups[:-1], groups[1:], bounds[:-1], bounds[1:], strict=True)
        ]

    def texts(self, texts: list[str | None]) -> list[list[tuple]]:
        """The chunks' results of each text."""
        if len(self.known) > MOST_CHUNKS // 2:  # chunks of the last half that are met again stay
            self.before, self.known = self.known, {}
        known, before = self.known, self.before
        split = [[] if not t else self.cut.split(" " + t) if self.cut else [" " + t] for t in texts]
        fresh = set().union(*split).difference(known)
        kept = fresh & before.keys()
        known.update((c, before[c]) for c in kept)
        fresh = list(fresh - kept)
        known.update(zip(fresh, self.encode(fresh), strict=True))
        out = []
        for text, chunks in zip(texts, split, strict=True):
            parts = [known[c] for c in chunks]
            if None in parts:
                whole = self.encode([" " + text])[0]
                parts = [whole] if whole else []
            out.append(parts)
        for c in fresh:
            if len(c) > LONGEST_CHUNK:
                del known[c]
        return out


@lru_cache(maxsize=2)
def _pair(a_path: str, b_path: str) -> Pair:
    return Pair(a_path, b_path)


# --- blobs: columns of whole numbers behind each other -------------------------------------------------------------

def _packed(columns: dict[str, np.ndarray], kinds: dict[str, str]) -> bytes:
    return b"".join(np.ascontiguousarray(columns[k], t).tobytes() for k, t in kinds.items())


def _unpacked(blob: bytes, n: int, kinds: dict[str, str]) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k, t in kinds.items():
        out[k] = np.frombuffer(blob, t, n, at)
        at += out[k].nbytes
    return out


LINKS = {"text": "<u2", "row": "<u2", "col": "<u4", "n": "<u4"}
COUNTS = {"row": "<u2", "col": "<u4", "n": "<i8"}
SUMS = {"best": "<i8", "sum": "<i8"}

ENCODED = "kind tinyint, batch bigint, stripe int, at int, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, size int, blob binary"
_ENCODED = pa.schema([
    ("kind", pa.int8()), ("batch", pa.int64()), ("stripe", pa.int32()), ("at", pa.int32()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()),
    ("groups_sha256", pa.string()), ("size", pa.int32()), ("blob", pa.binary()),
])
TEXT, LINK, COUNT = 0, 1, 2


class _Batch:
    """Texts of a task until their links are packed."""

    def __init__(self, number: int, n_a: int) -> None:
        self.number, self.n_a, self.texts, self.codes, self.counts, self.owners, self.size = number, n_a, [], [], [], [], 0

    def add(self, doc_id: int | None, parts: list[tuple]) -> None:
        codes, counts = np.unique(np.frombuffer(b"".join([p[4] for p in parts]), np.int64), return_counts=True)
        sha = hashlib.sha256()
        for i in range(0, len(parts), 10_000):
            sha.update((";" if i else "").encode() + ";".join([p[3] for p in parts[i : i + 10_000]]).encode())
        n = [sum(c) for c in list(zip(*parts, strict=True))[:3]] or [0, 0, 0]
        self.owners.append(np.full(len(codes), len(self.texts), np.uint16))
        self.codes.append(codes)
        self.counts.append(counts)
        self.size += len(codes)
        self.texts.append((doc_id, *n, n[2], sha.hexdigest() if parts else ""))

    def rows(self) -> Iterator[tuple]:
        for at, text in enumerate(self.texts):
            yield (TEXT, self.number, None, at, *text, None, None)
        if not self.size:
            return
        codes, n, text = np.concatenate(self.codes), np.concatenate(self.counts), np.concatenate(self.owners)
        b, col = np.divmod(codes, self.n_a)
        order = np.argsort(b % STRIPES, kind="stable")
        b, col, n, text = b[order], col[order], n[order], text[order]
        cuts = np.searchsorted(b % STRIPES, np.arange(STRIPES + 1))
        for s in range(STRIPES):
            at = slice(cuts[s], cuts[s + 1])
            if cuts[s] == cuts[s + 1]:
                continue
            row, size = b[at] // STRIPES, int(cuts[s + 1] - cuts[s])
            yield (LINK, self.number, s, None, None, None, None, None, None, None, size, _packed({"text": text[at], "row": row, "col": col[at], "n": n[at]}, LINKS))
            keys, where = np.unique(row * self.n_a + col[at], return_inverse=True)
            total = np.zeros(len(keys), np.int64)
            np.add.at(total, where, n[at])
            yield (COUNT, self.number, s, None, None, None, None, None, None, None, len(keys), _packed({"row": keys // self.n_a, "col": keys % self.n_a, "n": total}, COUNTS))


def _arrow(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)


def encoded(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Rows of three kinds: a text with its counts, links of a batch and stripe, counts of a batch and stripe."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, first = _pair(a_path, b_path), TaskContext.get().partitionId() << 32
        held = _Batch(first, pair.n_a)
        for batch in batches:
            for lo, hi, _, _ in text_blocks(batch.column("text")):
                part = batch.slice(lo, hi - lo)
                for doc_id, parts in zip(part.column("doc_id").to_pylist(), pair.texts(part.column("text").to_pylist()), strict=True):
                    held.add(doc_id, parts)
                    if held.size >= BATCH_LINKS or len(held.texts) == BATCH_TEXTS:
                        yield _arrow(list(held.rows()), _ENCODED)
                        held = _Batch(held.number + 1, pair.n_a)
        yield _arrow(list(held.rows()), _ENCODED)

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, ENCODED)


def _matrix(n_a: int, n_b: int) -> np.ndarray:
    return np.zeros((-(-n_b // STRIPES), n_a), np.int64)


def _added(n_a: int, n_b: int):
    """Adds the counts of each (stripe, share) of a task up and gives the pairs that occur."""
    schema = pa.schema([("stripe", pa.int32()), ("size", pa.int32()), ("blob", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, matrix = None, _matrix(n_a, n_b)

        def close() -> Iterator[pa.RecordBatch]:
            row, col = np.nonzero(matrix)
            for i in range(0, len(row), ROW_PAIRS):
                r, c = row[i : i + ROW_PAIRS], col[i : i + ROW_PAIRS]
                yield _arrow([(key[0], len(r), _packed({"row": r, "col": c, "n": matrix[r, c]}, COUNTS))], schema)
            matrix[row, col] = 0

        for batch in batches:
            for stripe, share, size, blob in zip(*(batch.column(c) for c in ("stripe", "share", "size", "blob")), strict=True):
                now = (stripe.as_py(), share.as_py())
                if key is not None and now != key:
                    yield from close()
                key = now
                x = _unpacked(blob.as_buffer(), size.as_py(), COUNTS)
                np.add.at(matrix, (x["row"], x["col"]), x["n"])
        if key is not None:
            yield from close()

    return run


def pair_counts(rows: DataFrame, n_a: int, n_b: int) -> DataFrame:
    """(stripe, size, blob): how often each pair of ids is linked in all texts."""
    counts = rows.where(F.col("kind") == COUNT).select("stripe", (F.xxhash64("batch") % F.lit(1 << 40)).alias("share"), "size", "blob")
    batches = rows.where(F.col("kind") == TEXT).select("batch").distinct().count()
    for shares in [-(-batches // SHARE), 1] if batches > SHARE else [1]:
        counts = counts.withColumn("share", F.pmod("share", F.lit(shares)) if shares > 1 else F.lit(0).cast("bigint"))
        counts = counts.repartition(STRIPES * min(shares, 64), "stripe", "share").sortWithinPartitions("stripe", "share")
        counts = counts.mapInArrow(_added(n_a, n_b), "stripe int, size int, blob binary")
    return written(counts, "pair-counts")


def _scored(n_a: int, n_b: int):
    """Looks the links of each (stripe, share) up in the stripe's counts, which stand before them."""
    schema = pa.schema([("batch", pa.int64()), ("texts", pa.int32()), ("blob", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, matrix, best = None, _matrix(n_a, n_b), None
        for batch in batches:
            for stripe, share, number, size, blob in zip(*(batch.column(c) for c in ("stripe", "share", "batch", "size", "blob")), strict=True):
                now, number, size, blob = (stripe.as_py(), share.as_py()), number.as_py(), size.as_py(), blob.as_buffer()
                if now != at:
                    at, best = now, None
                    matrix[:] = 0
                if number is None:
                    x = _unpacked(blob, size, COUNTS)
                    matrix[x["row"], x["col"]] = x["n"]
                    continue
                if best is None:
                    best = matrix.max(axis=1)
                x = _unpacked(blob, size, LINKS)
                count, n = matrix[x["row"], x["col"]], x["n"].astype(np.int64)
                sums = np.zeros((2, int(x["text"].max()) + 1), np.int64)
                np.add.at(sums[0], x["text"], np.where(count == best[x["row"]], n, 0))
                np.add.at(sums[1], x["text"], count * n)
                yield _arrow([(number, sums.shape[1], _packed({"best": sums[0], "sum": sums[1]}, SUMS))], schema)

    return run


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the sums of each batch of texts up over its stripes."""
    schema = pa.schema([("batch", pa.int64()), ("at", pa.int32()), ("n_best", pa.int64()), ("count_sum", pa.int64())])
    key, total = None, np.zeros((2, BATCH_TEXTS), np.int64)

    def close() -> pa.RecordBatch:
        at = np.flatnonzero(total[1])
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(at), key, np.int64)), pa.array(at.astype(np.int32)), pa.array(total[0, at]), pa.array(total[1, at])], schema=schema)

    for batch in batches:
        for number, texts, blob in zip(*(batch.column(c) for c in ("batch", "texts", "blob")), strict=True):
            number, texts = number.as_py(), texts.as_py()
            if key is not None and number != key:
                yield close()
                total[:] = 0
            key = number
            x = _unpacked(blob.as_buffer(), texts, SUMS)
            total[0, :texts] += x["best"]
            total[1, :texts] += x["sum"]
    if key is not None:
        yield close()


def report(docs: DataFrame, a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """One row for each text: tokens, groups, links, links that are the best of their B id, and the sum of the links' counts."""
    a_path, b_path = a_path or vocabulary("byte_bpe_50k.json"), b_path or vocabulary("piece_bpe_32k.model")
    pair = _pair(a_path, b_path)
    n_a, n_b = pair.n_a, pair.n_b
    rows = written(encoded(docs, a_path, b_path), "aligned")
    counts = pair_counts(rows, n_a, n_b)
    links = rows.where(F.col("kind") == LINK)
    shares = max(1, -(-rows.where(F.col("kind") == TEXT).select("batch").distinct().count() // SHARE))
    links = links.select("stripe", F.pmod(F.xxhash64("batch"), F.lit(shares)).alias("share"), "batch", "size", "blob")
    copies = counts.select("stripe", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(shares - 1).cast("bigint"))).alias("share"), F.lit(None).cast("bigint").alias("batch"), "size", "blob")
    met = copies.unionByName(links).repartition(STRIPES * min(shares, 64), "stripe", "share").sortWithinPartitions("stripe", "share", F.asc_nulls_first("batch"))
    sums = met.mapInArrow(_scored(n_a, n_b), "batch bigint, texts int, blob binary")
    sums = sums.repartition("batch").sortWithinPartitions("batch").mapInArrow(_summed, "batch bigint, at int, n_best bigint, count_sum bigint")
    texts = rows.where(F.col("kind") == TEXT).select("batch", "at", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
    zero = F.lit(0).cast("bigint")
    return texts.join(sums, ["batch", "at"], "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256"
    )
