"""Token totals by source, language and tokenizer version, maintained by signed deltas.

A change is a signed row: an insert adds a document and its tokens, a delete takes them away, a revised count does both. A
batch of changes is added up by key and written under the batch's name; a commit row follows. Totals are the sum over
committed batches, so a batch that is sent again changes nothing, and one that broke off before its commit is written anew. ``compact`` folds batches into one base without changing any total.

Defined results: null sources and languages are keys of their own; null texts count as empty; rows that repeat an id are
counted one by one; keys whose documents and tokens are both 0 leave the totals; an empty batch is committed too.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terraloom.llm.tokens import counted, vocabulary

KEYS = ["source", "lang", "tokenizer"]
#: Version names: the vocabulary file and a number that grows when its use changes; and words between white space.
BPE, WORDS = "word_bpe_49k/1", "space_words/1"
DELTA = "source string, lang string, tokenizer string, docs bigint, tokens bigint"


class Rollup:
    """Totals kept under a path that driver and executors share. One writer at a time.

    ``deltas/<batch>`` holds a batch's sums and ``commits/<batch>`` its commit: one row, written after the sums. ``bases/<number>`` holds the
    totals of folded batches, and ``folded/<number>``, written after them, the batches. The base of the highest number with
    a list is in force; a batch counts if it is committed and not in that list.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def _rows(self, pattern: str, schema: str) -> list:
        """Rows of small tables below a pattern; none where there is no such path."""
        try:
            return self.spark.read.schema(schema).parquet(f"{self.path}/{pattern}").collect()
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return []

    def _put(self, name: str, rows: list[tuple], schema: str) -> None:
        self.spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/{name}")

    def state(self) -> tuple[int, list[str], list[str]]:
        """The number of the base in force (0: none), the batches it holds, and the committed batches beside it."""
        folded = self._rows("folded/*", "number int, batch string")
        number = max((r["number"] for r in folded), default=0)
        held = sorted(r["batch"] for r in folded if r["number"] == number)
        return number, held, sorted({r["batch"] for r in self._rows("commits/*", "batch string")} - set(held))

    def commit(self, batch_id: str, changes: DataFrame) -> bool:
        """Add up signed changes (source, lang, tokenizer, docs, tokens) and commit them under an id; False if it was committed before."""
        if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9_.-]*", batch_id):
            raise ValueError(f"not a batch id: {batch_id!r}")
        _, held, fresh = self.state()
        if batch_id in held or batch_id in fresh:
            return False
        sums = changes.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        sums.write.mode("overwrite").parquet(f"{self.path}/deltas/{batch_id}")
        self._put(f"commits/{batch_id}", [(batch_id,)], "batch string")
        return True

    def totals(self) -> DataFrame:
        number, _, fresh = self.state()
        paths = [f"{self.path}/bases/{number}"] * bool(number) + [f"{self.path}/deltas/{b}" for b in fresh]
        if not paths:
            return self.spark.createDataFrame([], DELTA)
        sums = self.spark.read.schema(DELTA).parquet(*paths).groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        return sums.where("docs <> 0 OR tokens <> 0")

    def compact(self) -> None:
        """Fold everything committed into a new base. Folded deltas are emptied after the new base is in force."""
        number, held, fresh = self.state()
        if not fresh:
            return
        self.totals().write.mode("overwrite").parquet(f"{self.path}/bases/{number + 1}")
        self._put(f"folded/{number + 1}", [(number + 1, b) for b in held + fresh], "number int, batch string")
        for batch in fresh:
            self._put(f"deltas/{batch}", [], DELTA)


def tidied(text: str) -> str:
    """A text without lines that repeat the line before."""
    lines = text.split("\n")
    return "\n".join(x for i, x in enumerate(lines) if not i or x != lines[i - 1])


def measured(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """For each row: doc_id, source, lang, a digest of its text, and its words and ids as it is and after ``tidied``."""
    path = tokenizer or vocabulary("word_bpe_49k.json")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                texts = [t or "" for t in part.column("text").to_pylist()]
                tidy = [tidied(t) for t in texts]
                changed = [i for i, (a, b) in enumerate(zip(texts, tidy, strict=True)) if a != b]
                ids = counted(texts, path)
                new = ids.copy()
                new[changed] = counted([tidy[i] for i in changed], path)
                words = pa.array([len(t.split()) for t in texts], pa.int64()), pa.array([len(t.split()) for t in tidy], pa.int64())
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in ("doc_id", "source", "lang", "digest")], *words, pa.array(ids), pa.array(new)], names=["doc_id", "source", "lang", "digest", "words", "new_words", "ids", "new_ids"])

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "source", "lang", F.md5(text).alias("digest"), text.alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, source string, lang string, digest string, words bigint, new_words bigint, ids bigint, new_ids bigint")


def changes(rows: DataFrame, sign: int, words: str = "words", ids: str = "ids") -> DataFrame:
    """Signed changes of measured rows, one for each tokenizer version."""
    kinds = F.array(F.struct(F.lit(WORDS).alias("tokenizer"), F.col(words).alias("n")), F.struct(F.lit(BPE).alias("tokenizer"), F.col(ids).alias("n")))
    return rows.select("source", "lang", F.inline(kinds)).select(*KEYS, F.lit(sign).cast("bigint").alias("docs"), (sign * F.col("n")).alias("tokens"))


def maintained(rollup: Rollup, rows: DataFrame) -> DataFrame:
    """Three batches over measured rows: all are inserted; tidied texts' counts are revised; copies but the least id are deleted. Each is sent twice."""
    revised = rows.where("words <> new_words OR ids <> new_ids")
    kept = rows.groupBy("digest").agg(F.min_by(F.struct("source", "lang", "new_words", "new_ids"), F.struct("doc_id", F.coalesce("source", F.lit("")), F.coalesce("lang", F.lit("")))).alias("first")).select("first.*")
    batches = {
        "insert": changes(rows, 1),
        "revise": changes(revised, -1).unionByName(changes(revised, 1, "new_words", "new_ids")),
        # Copies are what remains of all rows when one of each text is put back; no group of copies meets in one task.
        "delete-copies": changes(rows, -1, "new_words", "new_ids").unionByName(changes(kept, 1, "new_words", "new_ids")),
    }
    for _ in range(2):
        for name, delta in batches.items():
            rollup.commit(name, delta)
    return rollup.totals()
