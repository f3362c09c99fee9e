"""Shared pieces of the training-data operators: inputs, scratch tables and vectorised text kernels."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: Column, modulus: int) -> Column:
    """The remainder that splits rows into training and held-out folds."""
    return F.crc32(doc_id.cast("string")) % modulus


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names; a temporary one only where none is set (local tests)."""
    sc = spark.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if base is None:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="terraloom-")
        sc.setCheckpointDir(base)
    return base


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: cuts the lineage, survives lost executors.

    As with checkpoints, who owns the folder clears it.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/terraloom-{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def maybe_broadcast(df: DataFrame, rows: int, most_rows: int) -> DataFrame:
    """Broadcast a side whose row count is known and bounded; otherwise leave the join to the optimizer."""
    return F.broadcast(df) if rows <= most_rows else df


# --- text kernels -------------------------------------------------------------------------------------------------

_LOW = np.arange(256, dtype=np.uint8)
_LOW[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_P = np.uint64(0x9E3779B97F4A7C15)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of splitmix."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


_powers: list[np.ndarray] = []


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number modulo 2**64, and of its inverse."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, 1 << 20)
        inverse = np.uint64(pow(int(_P), -1, 1 << 64))
        _powers[:] = [np.concatenate([[np.uint64(1)], np.cumprod(np.full(size, base, np.uint64))]) for base in (_P, inverse)]
    return _powers[0], _powers[1]


def text_blocks(column: pa.Array, most_bytes: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Consecutive rows of a string column as (first, last, bytes, offsets); null is empty, a long text is a block of its own."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    lo, n = 0, len(column)
    while lo < n:
        hi = max(lo + 1, min(n, int(np.searchsorted(offsets, offsets[lo] + most_bytes, "right")) - 1))
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def spaced_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of each text: byte starts, byte ends, and for each text its first word (one more at the end)."""
    ink = np.zeros(len(data) + 2, bool)
    ink[1:-1] = ~_SPACE[data]
    cuts = np.zeros(len(data) + 1, bool)
    cuts[offsets] = True
    starts = np.flatnonzero(ink[1:-1] & (~ink[:-2] | cuts[:-1]))
    ends = np.flatnonzero(ink[1:-1] & (~ink[2:] | cuts[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def hashed_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span after lower-casing A-Z."""
    up, down = _power_tables(len(data))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((_LOW[data].astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64) * _M2)


# --- samples to learn from ----------------------------------------------------------------------------------------

def short(text: Column, most_bytes: int) -> Column:
    """Texts that may be learned from: not null and not longer."""
    return text.isNotNull() & (F.octet_length(text) <= most_bytes)


def texts_of(rows: DataFrame, chosen: DataFrame, on: list[str], most: Column | int) -> list[tuple]:
    """(text, value) of the ``rows`` (doc_id, text, what else is in ``on``) that a bounded set ``chosen`` names, which is broadcast.

    Bounded by rows, not by ids: of each value at most ``most`` rows come to the driver, those of the least id hashes.
    """
    order = [F.xxhash64("doc_id"), F.col("doc_id"), F.col("text")]
    found = rows.join(F.broadcast(chosen.select(*on, *[c for c in ("value",) if c not in on]).distinct()), on)
    found = found.withColumn("rank", F.row_number().over(Window.partitionBy("value").orderBy(*order))).where(F.col("rank") <= most)
    return [(r["text"], r["value"]) for r in found.orderBy(*order).select("text", "value").collect()]


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, in_training: Column, per_class: dict[int, int], most_bytes: int) -> list[tuple[str, int]]:
    """Texts and labels: of each class at most so many training rows, those of the least id hashes among the texts that are short enough.

    Of several labels of an id the least counts; a repeated id is as many rows, and the bound is one of rows.
    """
    rows = docs.where(short(F.col("text"), most_bytes)).select("doc_id", F.col("text").cast("string").alias("text"))
    known = labels.select("doc_id", F.col(label).alias("value")).where(in_training)
    known = known.join(rows.select("doc_id"), "doc_id", "left_semi").distinct()
    parts = [known.where(F.col("value") == v).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n) for v, n in per_class.items()]
    chosen = parts[0]
    for part in parts[1:]:
        chosen = chosen.unionByName(part)
    most = F.coalesce(*[F.when(F.col("value") == v, n) for v, n in per_class.items()])
    return texts_of(rows, chosen.groupBy("doc_id").agg(F.min("value").alias("value")), ["doc_id"], most)


class Adam:
    def __init__(self, parameters: dict[str, np.ndarray], rate: float) -> None:
        self.parameters, self.rate, self.steps = parameters, rate, 0
        self.mean = {k: np.zeros_like(v) for k, v in parameters.items()}
        self.square = {k: np.zeros_like(v) for k, v in parameters.items()}

    def step(self, gradients: dict[str, np.ndarray]) -> None:
        self.steps += 1
        correct = (1 - 0.999**self.steps) ** 0.5 / (1 - 0.9**self.steps)
        for k, g in gradients.items():
            self.mean[k] += 0.1 * (g - self.mean[k])
            self.square[k] += 0.001 * (g * g - self.square[k])
            self.parameters[k] -= self.rate * correct * self.mean[k] / (np.sqrt(self.square[k]) + 1e-8)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))
