"""Subword-bag embeddings averaged into a linear softmax score the toxicity of whole texts.

A word is the bag of its 3- to 5-byte grams with marks at its ends, hashed to ``BUCKETS`` vectors; so a misspelling
shares most of its vectors with the word it comes from. Grams are averaged over segments of ``SEGMENT`` words, a linear
softmax over two classes reads each average, and the segments' log-odds are pooled by a soft maximum, since a few words
make a long text toxic. Embeddings and softmax are trained together in numpy, on the driver, on a sample of at most ``SAMPLE``
labelled texts a class. As the softmax is linear, a gram's vector acts through one number, which is what tasks look up.

Defined results: a null, empty or wordless text has no gram and gets the score of the bias alone; each row gets a row; without
labels in the training fold the score is 0; labels, language, source and id are no inputs; other columns are ignored. Of a text over ``BLOCK_BYTES`` the sums
are carried on from block to block, so that memory doesn't grow with its length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terraloom.llm.common import Adam, fold, labelled_sample, sigmoid, text_blocks

MODULUS, HELD_OUT, THRESHOLD = 4, 2, 0.3
SAMPLE, SAMPLE_BYTES = {0: 2400, 1: 1600}, 8_000
BUCKETS, DIM, SEGMENT, SIZES = 1 << 18, 8, 3, (3, 4, 5)
#: Bytes scored at a time.
BLOCK_BYTES = 1 << 18
EPOCHS, LEAST_STEPS, BATCH, RATE, SHARPNESS = 14, 400, 100, 0.01, 1.0

_FOLDED = np.arange(256, dtype=np.uint8)
_FOLDED[65:91] += 32
_MARK = np.zeros(256, bool)
_MARK[:48] = _MARK[58:65] = _MARK[91:97] = _MARK[123:128] = True
_FOLDED[_MARK] = 32


def grams(data: np.ndarray, offsets: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray, np.ndarray]:
    """For each gram size the buckets at each byte and whether a gram starts there; segment starts; the text of each segment.

    The bytes are those of the texts, each followed by one mark.
    """
    n = len(offsets) - 1
    own = np.arange(len(data)) + np.repeat(np.arange(n), np.diff(offsets)) + 1
    text = np.full(len(data) + n + 1, 32, np.uint8)
    text[own] = _FOLDED[data]
    buckets, valid, starts = _marked(text)
    text_of = np.searchsorted(offsets + np.arange(n + 1), starts, "right") - 1
    first = np.searchsorted(text_of, np.arange(n))
    segment = (np.arange(len(starts)) - first[text_of]) % SEGMENT == 0
    return buckets, valid, starts[segment], text_of[segment]


def _marked(text: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
    """Of folded bytes for each gram size the buckets and whether a gram starts there; and the mark before each word."""
    mark = text == 32
    inside = np.concatenate([[0], np.cumsum(mark)])
    wide = text.astype(np.uint32)
    buckets, valid = [], []
    for size in SIZES:
        last = len(text) - size + 1
        if last <= 0:
            buckets.append(np.zeros(len(text), np.int64))
            valid.append(np.zeros(len(text), bool))
            continue
        h = np.full(last, size, np.uint32)
        for i in range(size):
            h = (h ^ wide[i : last + i]) * np.uint32(0x01000193)
            h ^= h >> np.uint32(15)
        ok = (inside[size - 1 : last + size - 1] - inside[1 : last + 1]) == 0  # no mark but at the ends
        pad = len(text) - last
        buckets.append(np.concatenate([(h & np.uint32(BUCKETS - 1)).astype(np.int64), np.zeros(pad, np.int64)]))
        valid.append(np.concatenate([ok, np.zeros(pad, bool)]))
    return buckets, valid, np.flatnonzero(mark[:-1] & ~mark[1:])


def _pooled(logits: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Soft maximum of each text's segments (texts without any: -inf), and each segment's share in it."""
    top = np.full(n, -np.inf)
    np.maximum.at(top, owner, logits)
    share = np.exp(SHARPNESS * (logits - top[owner]))
    total = np.bincount(owner, share, minlength=n)
    share /= total[owner]
    value = np.bincount(owner, share * logits, minlength=n)
    return np.where(total > 0, value, -np.inf), share


class Classifier:
    def __init__(self) -> None:
        self.weights = np.zeros(BUCKETS, np.float32)
        self.bias, self.fitted = 0.0, False

    def _segments(self, block: tuple, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sums of a table over each segment's grams, and how many there are."""
        buckets, valid, starts, _ = block
        total = sum(np.where(v, table[b], 0) for b, v in zip(buckets, valid, strict=True))
        count = sum(v.astype(np.int32) for v in valid)
        return np.add.reduceat(total, starts), np.add.reduceat(count, starts)

    def logits(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        n = len(offsets) - 1
        block = grams(data, offsets)
        if not len(block[2]):
            return np.full(n, self.bias)
        total, count = self._segments(block, self.weights)
        value, _ = _pooled(total / np.maximum(count, 1) + self.bias, block[3], n)
        return np.where(np.isfinite(value), value, self.bias)

    def long_logit(self, data: np.ndarray) -> float:
        """The same of one text, a block at a time: the open segment's sums and the soft maximum's are carried on."""
        size, ahead = len(data) + 2, max(SIZES) - 1
        words, total, count = 0, 0.0, 0
        top, weight, weighed = -np.inf, 0.0, 0.0

        def pool(logits: np.ndarray) -> None:
            nonlocal top, weight, weighed
            if len(logits):
                most = max(top, float(logits.max()))
                share = np.exp(SHARPNESS * (logits - most))
                before = np.exp(SHARPNESS * (top - most)) if weight else 0.0
                top, weight, weighed = most, weight * before + share.sum(), weighed * before + (share * logits).sum()

        for lo in range(0, size, BLOCK_BYTES):
            hi = min(lo + BLOCK_BYTES, size)
            text = np.full(min(hi + ahead, size) - lo, 32, np.uint8)
            first, last = max(lo, 1), min(lo + len(text), size - 1)  # of the places that hold bytes
            text[first - lo : last - lo] = _FOLDED[data[first - 1 : last - 1]]
            buckets, valid, starts = _marked(text)
            starts = starts[starts < hi - lo]
            values = sum(np.where(v, self.weights[b], 0) for b, v in zip(buckets, valid, strict=True))[: hi - lo]
            numbers = sum(v.astype(np.int32) for v in valid)[: hi - lo]
            segments = starts[(words + np.arange(len(starts))) % SEGMENT == 0]
            cut = int(segments[0]) if len(segments) else hi - lo
            if words:
                total, count = total + float(values[:cut].sum()), count + int(numbers[:cut].sum())
            if len(segments):
                if words:
                    pool(np.array([total / max(count, 1) + self.bias]))
                sums, counts = np.add.reduceat(values, segments), np.add.reduceat(numbers, segments)
                pool(sums[:-1] / np.maximum(counts[:-1], 1) + self.bias)
                total, count = float(sums[-1]), int(counts[-1])
            words += len(starts)
        if words:
            pool(np.array([total / max(count, 1) + self.bias]))
        return weighed / weight if weight else self.bias

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        if not self.fitted:
            return np.zeros(len(offsets) - 1)
        if len(offsets) == 2 and len(data) > BLOCK_BYTES:
            return sigmoid(np.array([self.long_logit(data)]))
        return sigmoid(self.logits(data, offsets).astype(float))

    def fit(self, sample: list[tuple[str, int]], epochs: int = EPOCHS, seed: int = 5) -> Classifier:
        if not sample:
            return self
        rng = np.random.default_rng(seed)
        p = {"vectors": (rng.standard_normal((BUCKETS, DIM)) * 0.1).astype(np.float32), "softmax": (rng.standard_normal((DIM, 2)) * 0.5).astype(np.float32), "bias": np.array([-3.0], np.float32)}
        adam = Adam(p, RATE)
        order = rng.permutation(len(sample))
        batches = []
        for at in range(0, len(order), BATCH):
            texts = [sample[i][0].encode() for i in order[at : at + BATCH]]
            offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
            block = grams(np.frombuffer(b"".join(texts), np.uint8), offsets)
            if len(block[2]):
                batches.append((block, np.array([sample[i][1] for i in order[at : at + BATCH]], np.float32)))
        epochs = max(epochs, -(-LEAST_STEPS // max(len(batches), 1)))  # small samples are read more often
        for epoch in range(epochs):
            adam.rate = RATE * (1 - epoch / epochs) + RATE / 20
            for i in rng.permutation(len(batches)):
                block, y = batches[i]
                buckets, valid, starts, owner = block
                side = p["softmax"][:, 1] - p["softmax"][:, 0]
                total, count = self._segments(block, p["vectors"] @ side)
                count = np.maximum(count, 1)
                logits = total / count + p["bias"][0]
                value, share = _pooled(logits, owner, len(y))
                error = np.where(np.isfinite(value), sigmoid(np.where(np.isfinite(value), value, 0)) - y, 0) / len(y)
                # The gradient of the soft maximum by each segment.
                d_logits = error[owner] * share * (1 + SHARPNESS * (logits - value[owner]))
                spread = np.zeros(len(buckets[0]), np.float64)
                spread[starts[0] :] = np.repeat(d_logits / count, np.diff(np.append(starts, len(buckets[0]))))
                d_table = sum(np.bincount(b, np.where(v, spread, 0), minlength=BUCKETS) for b, v in zip(buckets, valid, strict=True)).astype(np.float32)
                d_side = p["vectors"].T @ d_table
                adam.step({"vectors": d_table[:, None] * side, "softmax": np.stack([-d_side, d_side], axis=1), "bias": np.array([d_logits.sum()], np.float32)})
        self.weights = (p["vectors"] @ (p["softmax"][:, 1] - p["softmax"][:, 0])).astype(np.float32)
        self.bias, self.fitted = float(p["bias"][0]), True
        return self


def fit(docs: DataFrame, labels: DataFrame) -> Classifier:
    return Classifier().fit(labelled_sample(docs, labels, "toxic", fold(F.col("doc_id"), MODULUS) != HELD_OUT, SAMPLE, SAMPLE_BYTES))


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for each row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [np.zeros(0)]
            for _, _, data, offsets in text_blocks(batch.column("text"), BLOCK_BYTES):
                out.append(shared.value.scores(data, offsets))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.concatenate(out), pa.float64())], names=["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    held_out = F.coalesce(fold(F.col("doc_id"), MODULUS) == HELD_OUT, F.lit(False))
    return rows.mapInArrow(run, "doc_id bigint, score double").select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
