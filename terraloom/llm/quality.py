"""A byte-level convolutional network in numpy scores the quality of whole texts.

Bytes are embedded; filters of 8 bytes slide in steps of 4; their answers are max-pooled over chunks of 128 bytes that
overlap by half and cover the whole text; a small layer reads each chunk's pooled vector, so a chunk in which few
filters answer (the same word again and again) stands out; its outputs are averaged over the chunks and give one
probability. The network is fitted on the driver to a sample of at most ``SAMPLE`` labelled texts a class, each of at most
``SAMPLE_BYTES``; texts are scored whole in tasks, ``BLOCK_BYTES`` at a time: of a longer text the sums over its chunks are carried on, so that memory
doesn't grow with its length.

Defined results: a null text is an empty one, which has one chunk of padding and so a score; each row gets a row; without
any labels in the training fold the score is 0.5; labels, language, source and id are no inputs; other columns are ignored by ``score`` and kept by ``accepted``,
whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from terraloom.llm.common import Adam, fold, labelled_sample, sigmoid, text_blocks

MODULUS, HELD_OUT, THRESHOLD = 5, 0, 0.3
SAMPLE, SAMPLE_BYTES = {0: 1200, 1: 2400}, 20_000
#: Training reads at most so many bytes of a sampled text in an epoch, from a random place; scoring reads all.
WINDOW = 2048
DIM, FILTERS, HIDDEN, STEP, BLOCK = 8, 64, 16, 4, 64
PLACES = BLOCK // STEP
#: Bytes scored at a time; a step of a filter takes 64 bytes of memory for each byte.
BLOCK_BYTES = 1 << 18
EPOCHS, LEAST_STEPS, BATCH, RATE = 10, 300, 64, 0.004


def _padded(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Texts in whole blocks of zero-padded bytes, two blocks at least; blocks of each."""
    blocks = np.array([max(2, -(-len(t) // BLOCK)) for t in texts], np.int64)
    out = np.zeros(int(blocks.sum()) * BLOCK, np.uint8)
    at = 0
    for t, n in zip(texts, blocks, strict=True):
        out[at : at + len(t)] = t
        at += int(n) * BLOCK
    return out, blocks


class Network:
    def __init__(self, seed: int = 7) -> None:
        rng = np.random.default_rng(seed)

        def normal(scale: float, *shape: int) -> np.ndarray:
            return (rng.standard_normal(shape) * scale).astype(np.float32)

        width = STEP * DIM
        self.p = {
            "embed": normal(0.5, 256, DIM), "first": normal(width**-0.5, width, FILTERS), "second": normal(width**-0.5, width, FILTERS), "bias": np.zeros(FILTERS, np.float32),
            "mix": normal((2 / FILTERS) ** 0.5, FILTERS, HIDDEN), "mix_bias": np.full(HIDDEN, 0.1, np.float32), "out": normal(0.3, HIDDEN), "out_bias": np.zeros(1, np.float32),
        }
        self.fitted = False

    def _answers(self, data: np.ndarray, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Embedded steps, and each filter's answer at each step; the last step of a text sees padding after it."""
        p = self.p
        steps = p["embed"][data].reshape(-1, STEP * DIM)
        answers = steps @ p["first"]
        after = steps @ p["second"]
        after[:-1] = after[1:]
        after[np.cumsum(blocks) * PLACES - 1] = np.tile(p["embed"][0], STEP) @ p["second"]
        answers += after
        answers += p["bias"]
        return steps, answers

    @staticmethod
    def _chunks(blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The first block of each chunk, and the first chunk of each text."""
        last = np.cumsum(blocks) - 1
        firsts = np.delete(np.arange(int(blocks.sum())), last)
        return firsts, np.concatenate([[0], np.cumsum(blocks - 1)[:-1]])

    def logits(self, texts: list[np.ndarray]) -> np.ndarray:
        p = self.p
        data, blocks = _padded(texts)
        _, answers = self._answers(data, blocks)
        pooled = answers.reshape(-1, PLACES, FILTERS).max(axis=1)
        firsts, heads = self._chunks(blocks)
        chunk = np.maximum(np.maximum(pooled[firsts], pooled[firsts + 1]), 0)
        hidden = np.maximum(chunk @ p["mix"] + p["mix_bias"], 0)
        mean = np.add.reduceat(hidden, heads, axis=0) / (blocks - 1)[:, None]
        return mean @ p["out"] + p["out_bias"]

    def long_logit(self, text: np.ndarray) -> float:
        """The same of one text, some blocks at a time."""
        p, blocks = self.p, max(2, -(-len(text) // BLOCK))
        total, before = np.zeros(HIDDEN), np.zeros((0, FILTERS), np.float32)
        for lo in range(0, blocks, BLOCK_BYTES // BLOCK):
            n = min(BLOCK_BYTES // BLOCK, blocks - lo)
            part = np.zeros(n * BLOCK + STEP, np.uint8)  # and the step after it
            own = text[lo * BLOCK : (lo + n) * BLOCK + STEP]
            part[: len(own)] = own
            steps = p["embed"][part].reshape(-1, STEP * DIM)
            answers = steps[:-1] @ p["first"] + steps[1:] @ p["second"] + p["bias"]
            pooled = np.concatenate([before, answers.reshape(n, PLACES, FILTERS).max(axis=1)])
            chunk = np.maximum(np.maximum(pooled[:-1], pooled[1:]), 0)
            total += np.maximum(chunk @ p["mix"] + p["mix_bias"], 0).sum(axis=0, dtype=float)
            before = pooled[-1:]
        return float(total / (blocks - 1) @ p["out"] + p["out_bias"][0])

    def gradients(self, texts: list[np.ndarray], y: np.ndarray) -> dict[str, np.ndarray]:
        p = self.p
        data, blocks = _padded(texts)
        steps, answers = self._answers(data, blocks)
        cube = answers.reshape(-1, PLACES, FILTERS)
        best = cube.argmax(axis=1)
        pooled = np.take_along_axis(cube, best[:, None], axis=1)[:, 0]
        firsts, heads = self._chunks(blocks)
        later = pooled[firsts + 1] > pooled[firsts]
        chunk = np.maximum(np.where(later, pooled[firsts + 1], pooled[firsts]), 0)
        pre = chunk @ p["mix"] + p["mix_bias"]
        hidden = np.maximum(pre, 0)
        mean = np.add.reduceat(hidden, heads, axis=0) / (blocks - 1)[:, None]
        error = ((sigmoid(mean @ p["out"] + p["out_bias"]) - y) / len(y)).astype(np.float32)
        g = {"out": mean.T @ error, "out_bias": error.sum(keepdims=True)}
        d_pre = np.repeat(error / (blocks - 1), blocks - 1)[:, None].astype(np.float32) * p["out"] * (pre > 0)
        g["mix"], g["mix_bias"] = chunk.T @ d_pre, d_pre.sum(axis=0)
        d_chunk = (d_pre @ p["mix"].T) * (chunk > 0)
        # Only the place that won a chunk's pooling learns from it.
        block = firsts[:, None] + later
        d_answers = np.zeros_like(answers)
        np.add.at(d_answers, (block * PLACES + np.take_along_axis(best, block, axis=0), np.arange(FILTERS)[None, :]), d_chunk)
        follow = np.roll(steps, -1, axis=0)
        ends = np.cumsum(blocks) * PLACES - 1
        follow[ends] = np.tile(p["embed"][0], STEP)
        g["first"], g["second"], g["bias"] = steps.T @ d_answers, follow.T @ d_answers, d_answers.sum(axis=0)
        d_follow = d_answers @ p["second"].T
        d_follow[ends] = 0
        d_bytes = (d_answers @ p["first"].T + np.roll(d_follow, 1, axis=0)).reshape(-1, DIM)
        g["embed"] = np.stack([np.bincount(data, d_bytes[:, i], minlength=256) for i in range(DIM)], axis=1).astype(np.float32)
        return g

    def fit(self, sample: list[tuple[str, int]], epochs: int = EPOCHS, seed: int = 11) -> Network:
        if not sample:
            return self
        rng, adam = np.random.default_rng(seed), Adam(self.p, RATE)
        texts = [np.frombuffer(t.encode(), np.uint8) for t, _ in sample]
        y = np.array([v for _, v in sample], np.float32)
        epochs = max(epochs, -(-LEAST_STEPS * BATCH // len(texts)))  # small samples are read more often
        for epoch in range(epochs):
            adam.rate = RATE * (1 - epoch / epochs) + RATE / 20
            order = rng.permutation(len(texts))
            for at in range(0, len(order), BATCH):
                rows = order[at : at + BATCH]
                cut = []
                for i in rows:
                    start = int(rng.integers(0, max(len(texts[i]) - WINDOW, 0) + 1))
                    cut.append(texts[i][start : start + WINDOW])
                adam.step(self.gradients(cut, y[rows]))
        self.fitted = True
        return self

    def scores(self, texts: list[np.ndarray]) -> np.ndarray:
        if not self.fitted:
            return np.full(len(texts), 0.5)
        if len(texts) == 1 and len(texts[0]) > BLOCK_BYTES:
            return sigmoid(np.array([self.long_logit(texts[0])]))
        return sigmoid(self.logits(texts).astype(float))


def fit(docs: DataFrame, labels: DataFrame) -> Network:
    return Network().fit(labelled_sample(docs, labels, "quality", fold(F.col("doc_id"), MODULUS) != HELD_OUT, SAMPLE, SAMPLE_BYTES))


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for each row of ``docs``."""
    scored = with_score(docs.select("doc_id", "text"), fit(docs, labels), "score")
    held_out = F.coalesce(fold(F.col("doc_id"), MODULUS) == HELD_OUT, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def with_score(docs: DataFrame, network: Network, name: str) -> DataFrame:
    """``docs`` and one column more."""
    shared = docs.sparkSession.sparkContext.broadcast(network)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [np.zeros(0)]
            for _, _, data, offsets in text_blocks(batch.column("text"), BLOCK_BYTES):
                out.append(shared.value.scores([data[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]))
            yield batch.append_column(name, pa.array(np.concatenate(out), pa.float64()))

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(name, DoubleType())]))


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the documents that the classifier rejects."""
    name = "_quality"
    while name in docs.columns:
        name += "_"
    return with_score(docs, fit(docs, labels), name).where(F.col(name) >= THRESHOLD).drop(name)
