"""Language identification by a blended-spectrum string kernel.

A text is the set of the 1- to 3-character grams that occur in it; the kernel of two texts is the number of grams they share,
normalised by their own numbers. ``LANDMARKS`` sampled texts a language span the Nyström approximation, and
one-versus-rest kernel ridge regression is solved on ``SAMPLE`` texts a language (fewer of each where there are more than 16 or 64 languages). Tasks build presence rows over the
landmarks' grams and score them by matrix products, a batch at a time. Characters are folded to the ``ALPHABET`` most
frequent letters of the sample; other letters are one symbol, everything else another.

Defined results: null and texts without any letter are ``und`` with score 0; so is every text when no training row has a
language; each row gets a row; of more than ``MOST_LANGUAGES`` languages those with most sampled texts are learned; language, source and
id are no inputs of a prediction; other columns are ignored. A text is held whole while its grams are marked in a table of fixed size.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terraloom.llm.common import fold, short, texts_of, written

MODULUS, HELD_OUT = 5, 0
#: Bounds of what is learned from: texts and landmarks a language, bytes a text; and in all, whatever the number of languages.
SAMPLE, LANDMARKS, SAMPLE_BYTES = 400, 40, 20_000
MOST_LANGUAGES, SAMPLE_IN_ALL, LANDMARKS_IN_ALL, MARKS_BYTES = 1024, 25_600, 640, 200_000_000
ALPHABET, BASE = 126, 128
OTHER_LETTER = 127
RIDGE, SHARPNESS, BATCH = 1e-3, 6.0, 128
#: Codes of grams: one, two and three symbols follow each other.
SHIFTS = (0, BASE, BASE + BASE**2)
CODES = BASE + BASE**2 + BASE**3


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.array([chr(i).isalpha() for i in range(0x110000)])


def alphabet_of(texts: list[str]) -> np.ndarray:
    """A symbol for each code point: 0 for no letter, 1 to ALPHABET for frequent letters (both cases), OTHER_LETTER for other letters."""
    counts = Counter()
    for text in texts:
        counts.update(text.lower())
    frequent = [c for c, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0])) if c.isalpha()][:ALPHABET]
    table = np.where(_letters(), OTHER_LETTER, 0).astype(np.uint8)
    for i, c in enumerate(frequent, 1):
        for form in {c, c.upper(), c.title()}:
            if len(form) == 1:
                table[ord(form)] = i
    return table


def codes(text: str, table: np.ndarray) -> tuple[list[np.ndarray], bool]:
    """The codes of all grams of a text with a mark before and after it, and whether it has a letter."""
    symbols = table[np.frombuffer(text.encode("utf-32-le"), np.uint32)]
    s = np.zeros(len(symbols) + 2, np.int32)
    s[1:-1] = symbols
    two = s[:-1] * BASE + s[1:]
    return [s, two + SHIFTS[1], two[:-1] * BASE + s[2:] + SHIFTS[2]], bool(symbols.any())


class Model:
    def __init__(self, table: np.ndarray, sample: list[tuple[str, str]]) -> None:
        self.table = table
        self.languages = sorted({v for _, v in sample})
        if not self.languages:
            return
        taken: Counter = Counter()
        turns = []  # the first text of each language, then the second of each
        for text, value in sample:
            if taken[value] < LANDMARKS:
                turns.append((taken[value], len(turns), text))
                taken[value] += 1
        marks = [text for _, _, text in sorted(turns)[:LANDMARKS_IN_ALL]]
        while True:
            sets = [np.unique(np.concatenate(codes(t, table)[0])) for t in marks]
            self.grams = np.unique(np.concatenate(sets))
            if 4 * len(marks) * len(self.grams) <= MARKS_BYTES or len(marks) == 1:
                break
            marks = marks[: len(marks) // 2]
        rows = np.zeros((len(marks), len(self.grams)), np.float32)
        for row, own in zip(rows, sets, strict=True):
            row[np.searchsorted(self.grams, own)] = 1
        self.marks = (rows / np.sqrt(np.array([len(s) for s in sets], np.float32))[:, None]).T.copy()
        values, vectors = np.linalg.eigh((self.marks.T @ self.marks).astype(float))
        keep = values > 1e-6 * values[-1]
        self.root = vectors[:, keep] / np.sqrt(values[keep])
        phi = np.concatenate([self.features([t for t, _ in sample[lo : lo + BATCH]])[0] for lo in range(0, len(sample), BATCH)])
        targets = np.where(np.array([v for _, v in sample])[:, None] == np.array(self.languages), 1.0, -1.0)
        self.offset = targets.mean(axis=0)
        self.weights = np.linalg.solve(phi.T @ phi + RIDGE * len(sample) * np.eye(phi.shape[1]), phi.T @ (targets - self.offset))

    def features(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Nyström features of each text, and whether it has a letter."""
        presence = np.zeros((len(texts), len(self.grams)), np.float32)
        own, lettered = np.zeros(len(texts)), np.zeros(len(texts), bool)
        seen = np.zeros(CODES, bool)
        for i, text in enumerate(texts):
            found, lettered[i] = codes(text, self.table)
            for part in found:
                seen[part] = True
            own[i] = np.count_nonzero(seen)
            presence[i] = seen[self.grams]
            for part in found:
                seen[part] = False
        kernel = (presence @ self.marks) / np.sqrt(np.maximum(own, 1))[:, None]
        return kernel @ self.root, lettered

    def predictions(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        if not self.languages:
            return ["und"] * len(texts), np.zeros(len(texts))
        phi, lettered = self.features(texts)
        margins = phi @ self.weights + self.offset
        best = margins.argmax(axis=1)
        raised = np.exp(SHARPNESS * (margins - margins.max(axis=1, keepdims=True)))
        share = (raised / raised.sum(axis=1, keepdims=True))[np.arange(len(texts)), best]
        return [self.languages[b] if ok else "und" for b, ok in zip(best, lettered, strict=True)], np.where(lettered, share, 0.0)


def fit(docs: DataFrame) -> Model:
    """Learns from at most SAMPLE training rows a language, those of the least id hashes, each with the language of its own row; one pass chooses rows, one fetches their texts."""
    known = docs.where((fold(F.col("doc_id"), MODULUS) != HELD_OUT) & F.col("lang").isNotNull() & short(F.col("text"), SAMPLE_BYTES))
    known = known.select("doc_id", F.col("lang").cast("string").alias("value"), F.col("text").cast("string").alias("text"))
    # Each task keeps its own least hashes before anything is shuffled.
    marked = known.select("doc_id", "value", F.xxhash64("text").alias("digest"))
    rank = F.row_number().over(Window.partitionBy("value").orderBy(F.xxhash64("doc_id"), "doc_id", "digest"))
    ranked = written(marked.withColumn("rank", rank).where(F.col("rank") <= SAMPLE), "sample")
    languages = [r["value"] for r in ranked.groupBy("value").count().orderBy(F.desc("count"), "value").limit(MOST_LANGUAGES).collect()]
    if not languages:
        return Model(alphabet_of([]), [])
    each = min(SAMPLE, max(1, SAMPLE_IN_ALL // len(languages)))
    chosen = ranked.where(F.col("value").isin(languages) & (F.col("rank") <= each))
    found = texts_of(known.withColumn("digest", F.xxhash64("text")), chosen, ["doc_id", "value", "digest"], each)
    sample = [(t, v) for t, v in found if any(c.isalpha() for c in t)]
    return Model(alphabet_of([t for t, _ in sample]), sample)


def predict(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score for each row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, BATCH):
                part = batch.slice(lo, BATCH)
                names, scores = shared.value.predictions([t or "" for t in part.column("text").to_pylist()])
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "lang_pred", "score"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    held_out = F.coalesce(fold(F.col("doc_id"), MODULUS) == HELD_OUT, F.lit(False))
    return rows.mapInArrow(run, "doc_id bigint, lang_pred string, score double").select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
