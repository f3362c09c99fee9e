"""Hierarchical multi-length packing.

Each task encodes its documents and routes every piece to the smallest of several context sizes that holds it. Windows are
then filled from the longest tier down: the longest piece opens a window of its tier, the gap is filled with the longest
pieces of shorter tiers that fit, and what stays open is closed by cutting one piece. Thus every window of a task is full; only
what is left at a task's end (less than the smallest context) is a tail. Tails of up to ``TAILS`` tasks meet in a second,
small step that concatenates them into padded windows of the longest context. Windows of each tier are dealt to step
groups in turn, so groups hold nearly the same number of tokens and the same mix of lengths.

A task holds the documents of one chunk (``CHUNK_IDS`` ids or ``CHUNK_ROWS`` rows, whichever comes first) and what is left of those before it; one
text is encoded whole. Window ids come from the partition number and a count within it. The
pieces are written once, so a task that runs again can't change them.

Defined results: null is an empty text, which still has the end token; each row is packed on its own, repeated ids too; an
empty table gives no piece; other columns stay out.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terraloom.llm.common import written
from terraloom.llm.tokens import encoded, vocabulary

CONTEXTS = (512, 1024, 2048, 4096)
END, STEP_GROUPS, TAILS = 2, 64, 64
CHUNK_IDS, CHUNK_ROWS, CHUNK_TEXTS = 2_000_000, 16_384, 256
SCHEMA = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint, context int, step_group int"
_ARROW = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("context", pa.int32()), ("step_group", pa.int32())])


class Packer:
    """Fills the windows of one task. Pieces are (length, order, doc, start); the pool is sorted by length."""

    def __init__(self, partition: int, contexts: tuple[int, ...] = CONTEXTS, groups: int = STEP_GROUPS) -> None:
        self.contexts, self.groups, self.partition = contexts, groups, partition
        self.pool: list[tuple[int, int, int, int]] = []
        self.docs: dict[int, tuple[int, np.ndarray, int]] = {}  # row -> doc id, ids, ids not yet placed
        self.total = self.rows = self.windows = self.order = 0
        self.dealt = dict.fromkeys(contexts, partition * 7919)
        self.out: list[tuple] = []

    def add(self, doc_id: int, ids: np.ndarray) -> None:
        row, size, longest = self.rows, len(ids), self.contexts[-1]
        self.rows += 1
        self.docs[row] = (doc_id, ids, size)
        whole = size // longest * longest
        for start in range(0, whole, longest):
            self._close([(longest, row, start)], longest)
        if size > whole:
            self._keep(size - whole, row, whole)

    def _keep(self, size: int, row: int, start: int) -> None:
        self.order += 1
        insort(self.pool, (size, self.order, row, start))
        self.total += size

    def _take(self, room: int) -> tuple[int, int, int]:
        """The longest piece that fits, else the head of the shortest one."""
        at = bisect_right(self.pool, (room, float("inf"), 0, 0)) - 1
        size, _, row, start = self.pool.pop(max(at, 0))
        self.total -= size
        if size > room:
            self._keep(size - room, row, start + room)
            size = room
        return size, row, start

    def _close(self, pieces: list[tuple[int, int, int]], context: int | None) -> None:
        if context is None:
            window = group = None
        else:
            window, group = (self.partition << 32) + self.windows, self.dealt[context] % self.groups
            self.windows += 1
            self.dealt[context] += 1
        offset = 0
        for size, row, start in pieces:
            doc_id, ids, left = self.docs[row]
            self.out.append((doc_id, start, size, zlib.crc32(ids[start : start + size].astype("<u4").tobytes()), len(ids), window, offset, context, group))
            offset += size
            if left == size:
                del self.docs[row]
            else:
                self.docs[row] = (doc_id, ids, left - size)

    def fill(self, last: bool = False) -> list[tuple]:
        """Close all windows that can be full; ``last``: smaller ones too, down to the smallest context, then give out the tail."""
        while self.pool:
            context = next(c for c in self.contexts if c >= self.pool[-1][0])
            if self.total < context:
                if not last:
                    break
                context = max((c for c in self.contexts if c <= self.total), default=0)
                if not context:
                    break
            room, pieces = context, []
            while room:
                pieces.append(self._take(room))
                room -= pieces[-1][0]
            self._close(pieces, context)
        if last and self.pool:
            pieces = [(size, row, start) for size, _, row, start in self.pool]
            self.pool, self.total = [], 0
            self._close(pieces, None)
        out, self.out = self.out, []
        return out


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * len(_ARROW)
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, _ARROW, strict=True)], schema=_ARROW)


def _next_fit(tails: pd.DataFrame, longest: int) -> pd.DataFrame:
    """Concatenate the tails of a block of tasks into windows of the longest context."""
    tails = tails.sort_values(["partition", "offset"], kind="stable")
    windows, offsets, window, at = [], [], 0, 0
    for size in tails["length"]:
        if at + size > longest:
            window, at = window + 1, 0
        windows.append(window)
        offsets.append(at)
        at += size
    block = int(tails["partition"].iloc[0]) // TAILS
    return tails.assign(sequence_id=[(1 << 62) + (block << 20) + w for w in windows], offset=offsets, context=longest, step_group=[w % STEP_GROUPS for w in windows]).drop(columns="partition")


def pack(docs: DataFrame, tokenizer: str | None = None, contexts: tuple[int, ...] = CONTEXTS) -> DataFrame:
    """One row for each piece: its document's ids from ``start`` on lie in window ``sequence_id`` at ``offset``."""
    path = tokenizer or vocabulary("word_bpe_49k.json")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, held, rows = Packer(TaskContext.get().partitionId(), contexts), 0, 0
        for batch in batches:
            for lo in range(0, batch.num_rows, CHUNK_TEXTS):
                part = batch.slice(lo, CHUNK_TEXTS)
                texts = [t or "" for t in part.column("text").to_pylist()]
                for doc_id, ids in zip(part.column("doc_id").to_pylist(), encoded(texts, path), strict=True):
                    packer.add(doc_id, np.append(ids, np.uint32(END)))
                    held, rows = held + len(ids) + 1, rows + 1
                if held >= CHUNK_IDS or rows >= CHUNK_ROWS:
                    yield _batch(packer.fill())
                    held = rows = 0
        yield _batch(packer.fill(last=True))

    def with_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId()
        for made in run(batches):
            yield made.append_column("partition", pa.array([number] * made.num_rows, pa.int64()))

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    pieces = written(rows.mapInArrow(with_partition, SCHEMA + ", partition bigint"), "pieces")
    tails = pieces.where("sequence_id IS NULL").groupBy(F.floor(F.col("partition") / TAILS)).applyInPandas(lambda group: _next_fit(group, contexts[-1]), SCHEMA)
    return pieces.where("sequence_id IS NOT NULL").drop("partition").unionByName(tails)


def padding(pieces: DataFrame, longest: int = CONTEXTS[-1]) -> DataFrame:
    """Windows, ids and padding in all: a window is padded to the longest context unless its length is a power of two."""
    windows = pieces.groupBy("sequence_id").agg(F.sum("length").alias("n"))
    power = F.expr("(n & (n - 1)) = 0")
    return windows.agg(F.count("*").alias("windows"), F.sum("n").alias("ids"), F.sum(F.when(power, 0).otherwise(longest - F.col("n"))).alias("padding"))
