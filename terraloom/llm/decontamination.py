"""Benchmark decontamination with DataFrame functions only.

The windows of the benchmark are normalised n-grams kept as (length, hash, words, items). Their table is broadcast when its
measured bytes are at most ``broadcast_bytes``. Training texts are then scanned once: every window position is hashed, looked
up, and a hit is confirmed word by word in the join condition, so only confirmed occurrences leave the scan. One more row a
document, of length 0, meets a row of its own in the table and carries the word count, so no second scan is needed. A larger table is joined by shuffle: of
each position numbers and the hash are sent, of each document its words once, and of each place where a hash met one the words there.

Defined results: null, empty or wordless texts have no words and no hits; benchmark items without words have no window;
repeated items share windows; each row of ``docs`` gets a row, repeated ids too; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terraloom.llm.common import ascii_lower, written

WINDOW = 13
#: What stands between words: ASCII that is neither digit nor lower-case letter; and the same before lower-casing.
GAPS, RAW_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", r"\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F"
#: The most bytes of windows, their words and items counted, that are broadcast.
BROADCAST_BYTES = 150_000_000


def normal_words(text: Column) -> Column:
    return F.filter(F.split(ascii_lower(F.coalesce(text, F.lit(""))), GAPS), lambda w: w != "")


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Distinct windows: len, key, win (words), items (ids that hold it); and the row of length 0."""
    words = benchmark.select("item_id", normal_words(F.col("text")).alias("w")).where(F.size("w") > 0)
    words = words.withColumn("len", F.least(F.size("w"), F.lit(window)))
    spans = words.select("item_id", "len", F.explode(F.transform(F.sequence(F.lit(1), F.size("w") - F.col("len") + 1), lambda i: F.slice("w", i, F.col("len")))).alias("win"))
    real = spans.groupBy("len", "win").agg(F.collect_set("item_id").alias("items")).select("len", F.xxhash64("win").alias("key"), "win", "items")
    counter = benchmark.sparkSession.range(1).select(F.lit(0).alias("len"), F.lit(0).cast("bigint").alias("key"), F.array().cast("array<string>").alias("win"), F.array().cast(real.schema["items"].dataType).alias("items"))
    return real.unionByName(counter)


def scan(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """For each row of ``docs``: row_key, doc_id, n_words, n_hit, spans (sorted word spans: start from 1, end exclusive), items."""
    windows = written(benchmark_windows(benchmark, window), "windows")
    size = F.lit(64) + F.octet_length(F.array_join("win", " ")) + 16 * F.size("win") + 16 * F.size("items")
    facts = windows.agg(F.sum(size).alias("bytes"), F.sort_array(F.collect_set(F.when(F.col("len") > 0, F.col("len")))).alias("lens")).first()
    whole = docs.select("doc_id", normal_words(F.col("text")).alias("w")).withColumn("row_key", F.monotonically_increasing_id())
    small = facts["bytes"] <= broadcast_bytes
    whole = whole if small else written(whole, "words")
    words = whole.withColumn("size", F.explode(F.array(*map(F.lit, facts["lens"] or [window]))))
    # Position 0 is the document's counting row; from 1 on, windows start there.
    places = words.select("doc_id", "row_key", "w", "size", F.explode(F.sequence(F.lit(0), F.greatest(F.size("w") - F.col("size") + 1, F.lit(0)))).alias("pos"))
    counting = F.col("pos") == 0
    places = places.select(
        "doc_id", "row_key", "w", "pos", F.when(counting, F.size("w")).alias("n"),
        F.when(counting, F.lit(0)).otherwise(F.col("size")).alias("at_len"),
        F.when(counting, F.lit(0).cast("bigint")).otherwise(F.xxhash64(F.slice("w", F.greatest("pos", F.lit(1)), F.col("size")))).alias("at_key"),
    )
    same = F.slice("w", F.greatest("pos", F.lit(1)), F.col("at_len")) == F.col("win")
    alike = (F.col("at_len") == F.col("len")) & (F.col("at_key") == F.col("key"))
    span = F.when(F.col("pos") > 0, F.struct(F.col("pos").alias("start"), (F.col("pos") + F.col("at_len")).alias("end")))
    if small:
        found = places.join(F.broadcast(windows), alike & same).select("doc_id", "row_key", "n", span.alias("span"), "items")
    else:
        met = places.where(~counting).select("row_key", "pos", "at_len", "at_key").join(windows.select("len", "key"), alike, "left_semi")
        # The words of the place alone go on to the windows, not those of the document.
        here = met.join(whole, "row_key").select("doc_id", "row_key", "pos", "at_len", "at_key", F.slice("w", F.col("pos"), F.col("at_len")).alias("here"))
        hits = here.join(windows, alike & (F.col("here") == F.col("win"))).select("doc_id", "row_key", F.lit(None).cast("int").alias("n"), span.alias("span"), "items")
        none = F.array().cast(windows.schema["items"].dataType)
        found = hits.unionByName(whole.select("doc_id", "row_key", F.size("w").alias("n"), F.lit(None).cast(hits.schema["span"].dataType).alias("span"), none.alias("items")))
    rows = found.groupBy("row_key", "doc_id").agg(F.max("n").alias("n_words"), F.sort_array(F.collect_list("span")).alias("spans"), F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"))
    start = F.struct(F.lit(0).alias("hit"), F.lit(0).alias("reach"))
    covered = F.aggregate("spans", start, lambda a, s: F.struct((a["hit"] + F.greatest(s["end"] - F.greatest(s["start"], a["reach"]), F.lit(0))).alias("hit"), F.greatest(a["reach"], s["end"]).alias("reach")), lambda a: a["hit"])
    return rows.withColumn("n_hit", covered)


def contaminated(n_hit: Column, n_words: Column) -> Column:
    """At least a twentieth of the words lie in benchmark windows."""
    return (n_hit > 0) & (20 * n_hit >= n_words)


def report(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    found = scan(docs, benchmark, window)
    items = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    return found.select(
        "doc_id", F.col("n_words").cast("bigint").alias("n_words"), F.col("n_hit").cast("bigint").alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"), contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"),
    )


def without_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` without the contaminated documents. A repeated id goes if any of its rows is contaminated."""
    bad = report(docs, benchmark, window).where("contaminated").select("doc_id").distinct()
    return docs.join(bad, "doc_id", "left_anti")


def without_spans(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with the hit words, and what follows each of them up to the next word, cut from the text. Ids must be unique."""
    spans = scan(docs, benchmark, window).where(F.size("spans") > 0).select("doc_id", F.col("spans").alias("_spans"))
    units = F.regexp_extract_all("text", F.lit(rf"[^{RAW_GAP}]+[{RAW_GAP}]*"), F.lit(0))
    kept = F.filter(units, lambda _, i: ~F.exists("_spans", lambda s: (i + 1 >= s["start"]) & (i + 1 < s["end"])))
    lead = F.regexp_extract("text", rf"^[{RAW_GAP}]*", 0)
    return docs.join(spans, "doc_id", "left").withColumn("text", F.when(F.col("_spans").isNull(), F.col("text")).otherwise(F.concat(lead, F.array_join(kept, "")))).drop("_spans")


SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(13, len(w)) AS n, array_to_string(list_slice(w, i, i + least(13, len(w)) - 1), ' ') AS win FROM (SELECT item_id, w, unnest(generate_series(1, len(w) - least(13, len(w)) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM bw),
dp AS (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM d, sizes WHERE len(w) >= n),
hits AS (SELECT dp.doc_id, dp.i, dp.n, bw.item_id FROM dp JOIN bw ON bw.n = dp.n AND bw.win = array_to_string(list_slice(dp.w, dp.i, dp.i + dp.n - 1), ' ')),
places AS (SELECT DISTINCT doc_id, p FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM hits)),
nh AS (SELECT doc_id, count(*) AS n_hit FROM places GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN nh USING (doc_id) LEFT JOIN it USING (doc_id)
"""
