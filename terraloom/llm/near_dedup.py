"""MinHash near-duplicates with odd sketches.

1. Each text becomes the set of its 5-word shingles (64-bit hashes). Equal sets are one class from here on.
2. ``BANDS * ROWS`` MinHash samples of a class give its band keys. One-permutation MinHash samples, the least hash in each of
   ``BINS`` ranges, are folded into a parity bitmap, its odd sketch: the population count of two sketches' XOR
   estimates how many of these samples differ, and thus the similarity, with a standard error of 0.007.
3. In each band bucket every member is paired with one leader (the least of a fixed random order, the same in all bands), so a
   bucket of n members gives n-1 pairs. Pairs whose sketches are close are confirmed on full shingle sets.
4. Confirmed links are joined into components. Buckets that still hold several components are compared whole, in blocks,
   by sketch: first each component's closest pair with another is confirmed, then all close pairs across components, each
   in the first bucket that holds both. So no link between components is lost, whatever the size of a bucket.

5. A bucket of more than ``HOT`` members that still holds several components, as of one template, is not compared by blocks:
   its members are dealt again by the rarest shingles of their sets, an exact rule, and compared within these buckets.

Texts are shuffled for confirmation, never sets of all documents; a leader's text goes to several tasks when it has
many partners.

Defined results: a null, empty or blank text has no shingles and is a component of its own; fewer than five words are one
shingle; each row gets a row and is a document of its own: rows that repeat an id are linked by their texts only, a component bears the least
id among its rows, and of that id's rows the one text of the least hash is kept (rows of equal id and text alike); a row without an id is a component of
its own (null) and is kept; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terraloom.llm.common import hashed_words, maybe_broadcast, mix, spaced_words, text_blocks, written

SHINGLE, NUMERATOR, DENOMINATOR = 5, 75, 100
#: At a similarity of 0.75 a pair shares no band with probability (1 - 0.75**5)**48 = 2e-6.
BANDS, ROWS, BINS, SKETCH_BITS = 48, 5, 4096, 4096
#: Sketches may differ by so many standard errors, of sampling and parity together, more than those of a pair at the threshold.
STANDARD_ERRORS = 5.0
BLOCK, HOT = 2048, 8192
#: Rows of pairs that may be broadcast (about 40 bytes each); more are joined by shuffle.
BROADCAST_ROWS = 1_000_000
#: Partners of a leader whose texts come to one task.
PARTNERS = 1024


@lru_cache(maxsize=1)
def _functions() -> tuple[np.ndarray, np.ndarray]:
    """Fixed multipliers and masks of the sampling hashes."""
    rng = np.random.default_rng(20240229)
    n = BANDS * ROWS
    return rng.integers(0, 1 << 32, n, np.uint32) | np.uint32(1), rng.integers(0, 1 << 32, n, np.uint32)


def shingle_sets(column: pa.Array) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    for _, _, data, offsets in text_blocks(column, 1 << 19):
        starts, ends, first = spaced_words(data, offsets)
        words = hashed_words(data, starts, ends)
        n = len(words)
        grams = np.zeros(max(n - SHINGLE + 1, 0), np.uint64)
        for i in range(SHINGLE):
            grams = mix(grams + words[i : n - SHINGLE + 1 + i]) if len(grams) else grams
        for a, b in zip(first[:-1], first[1:], strict=True):
            if b - a >= SHINGLE:
                yield np.unique(grams[a : b - SHINGLE + 1])
            elif b > a:
                short = np.uint64(b - a)
                with np.errstate(over="ignore"):
                    for w in words[a:b]:
                        short = mix(short + w)
                yield np.array([short], np.uint64)
            else:
                yield np.zeros(0, np.uint64)


def _samples(shingles: np.ndarray) -> np.ndarray:
    multipliers, masks = _functions()
    low = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(len(masks), np.iinfo(np.uint32).max, np.uint32)
    for at in range(0, len(low), 1024):
        least = np.minimum(least, ((low[None, at : at + 1024] ^ masks[:, None]) * multipliers[:, None]).min(axis=1))
    return least


def _bands(least: np.ndarray) -> np.ndarray:
    salted = mix(least.astype(np.uint64) + (np.arange(len(least), dtype=np.uint64) << np.uint64(32)))
    return mix(np.cumsum(salted.reshape(BANDS, ROWS), axis=1, dtype=np.uint64)[:, -1]).view(np.int64)


def _odd_sketch(shingles: np.ndarray) -> np.ndarray:
    """Parities of the hashed least shingle of each bin; a bin is a range of hashes, and the shingles are sorted."""
    _, least = np.unique(shingles >> np.uint64(64 - BINS.bit_length() + 1), return_index=True)
    places = mix(shingles[least] ^ np.uint64(0x5851F42D4C957F2D)) % np.uint64(SKETCH_BITS)
    return np.packbits((np.bincount(places.astype(np.int64), minlength=SKETCH_BITS) & 1).astype(np.uint8)).view(np.int64)


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, prints, keys, bits = [], [], [], []
        for shingles in shingle_sets(batch.column("text")):
            sizes.append(len(shingles))
            if not len(shingles):
                prints.append((None, None))
                keys.append(None)
                bits.append(None)
                continue
            mixed = mix(shingles)
            prints.append((int(shingles.sum().view(np.int64)), int(mixed.sum().view(np.int64))))
            keys.append(_bands(_samples(shingles)))
            bits.append(_odd_sketch(shingles))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("digest"), pa.array(sizes, pa.int64()), pa.array([p[0] for p in prints], pa.int64()), pa.array([p[1] for p in prints], pa.int64()), pa.array(keys, pa.list_(pa.int64())), pa.array(bits, pa.list_(pa.int64()))],
            names=["doc_id", "digest", "n_shingles", "print1", "print2", "bands", "sketch"],
        )


def sketches(docs: DataFrame) -> DataFrame:
    return _texts(docs).mapInArrow(_sketches, "doc_id bigint, digest bigint, n_shingles bigint, print1 bigint, print2 bigint, bands array<bigint>, sketch array<bigint>")


def _most_bits(na, nb, ops):
    """How many bits of two sketches of so many shingles may differ; ``ops`` has the functions for columns or arrays."""
    filled = lambda n: (1 - ops["exp"](n * float(np.log(1 - 1 / BINS)))) * float(BINS)
    least = NUMERATOR / DENOMINATOR
    union = (na + nb) / (least + 1.0)
    bins = filled(union)
    differing = filled(na) + filled(nb) - bins * (2.0 * least)
    # Common samples are drawn from the union without repeats; none are left out where every shingle has its own bin.
    sampling = bins * (1 - bins / union) * (4 * least * (1 - least))
    even = ops["exp"](differing * (-2.0 / SKETCH_BITS))
    parity = (1 - even * even) * (SKETCH_BITS / 4) - differing * even * even
    return (1 - even) * (SKETCH_BITS / 2) + ops["sqrt"](parity + sampling * even * even) * STANDARD_ERRORS + 2.0


_COLUMNS = {"exp": F.exp, "sqrt": F.sqrt}
_ARRAYS = {"exp": np.exp, "sqrt": np.sqrt}


def close_pairs(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Of pairs (a, b) those whose sizes and sketches allow the similarity."""
    left = classes.select(F.col("rep").alias("a"), F.col("n_shingles").alias("na"), F.col("sketch").alias("sa"))
    right = classes.select(F.col("rep").alias("b"), F.col("n_shingles").alias("nb"), F.col("sketch").alias("sb"))
    both = pairs.join(left, "a").join(right, "b")
    fit = DENOMINATOR * F.least("na", "nb") >= NUMERATOR * F.greatest("na", "nb")
    differing = sum((F.bit_count(F.col("sa")[i].bitwiseXOR(F.col("sb")[i])) for i in range(SKETCH_BITS // 64)), F.lit(0))
    return both.where(fit & (differing <= _most_bits(F.col("na"), F.col("nb"), _COLUMNS))).select("a", "b")


def _texts(docs: DataFrame) -> DataFrame:
    """doc_id, text and digest, by which the text of one of several rows of an id is found again."""
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("digest", F.xxhash64("text"))


def confirmed(pairs: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """Of the written pairs (a, b) those that are similar on full sets. The texts of a's partners come to a's tasks, so many to each."""
    sized = pairs.join(pairs.groupBy("a").agg(F.count("*").alias("partners")), "a")
    wanted = sized.select("a", F.col("b").alias("rep"), F.pmod(F.xxhash64("b"), F.ceil(F.col("partners") / PARTNERS)).alias("salt"))
    members = wanted.withColumn("leads", F.lit(False))
    leaders = wanted.select("a", F.col("a").alias("rep"), "salt").distinct().withColumn("leads", F.lit(True))
    sent = written(members.unionByName(leaders).join(classes.select("rep", "doc_id", "digest"), "rep"), "sent")
    texts = _texts(docs).join(maybe_broadcast(sent, sent.count(), BROADCAST_ROWS), ["doc_id", "digest"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, leader = None, None
        for batch in batches:
            links: tuple[list[int], list[int]] = ([], [])
            rows = zip(*(batch.column(c).to_pylist() for c in ("a", "salt", "leads", "rep")), strict=True)
            for (a, salt, leads, rep), own in zip(rows, shingle_sets(batch.column("text")), strict=True):
                if leads:
                    group, leader = (a, salt), own
                    continue
                assert group == (a, salt), "a leader's row comes first"
                common = len(np.intersect1d(leader, own, assume_unique=True))
                if DENOMINATOR * common >= NUMERATOR * (len(leader) + len(own) - common):
                    links[0].append(a)
                    links[1].append(rep)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in links], names=["a", "b"])

    ordered = texts.repartition("a", "salt").sortWithinPartitions("a", "salt", F.desc("leads"))
    return ordered.mapInArrow(run, "a bigint, b bigint")


def components(links: DataFrame) -> DataFrame:
    """Connected components of links (a, b) by alternating large-star and small-star steps: node, component (its least node)."""
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    edges = written(edges, "edges")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").unionByName(down.select("u", F.col("m").alias("v"))).distinct()
        edges = written(small, "edges")
        state = tuple(edges.agg(F.count("*"), F.sum("v"), F.sum(F.xxhash64("u", "v") % 1_000_003)).first())
        if state == before:
            break
        before = state
    heads = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(heads)


def _bucket_pairs(key: int, rows: list[tuple], closest: bool, banded: bool) -> list[tuple[int, int]]:
    """Pairs of a bucket, or of two of its blocks, that lie in different components and may be similar, unless an earlier band's bucket holds both; or only each component's closest."""
    rep, comp, size, side = (np.array([r[i] for r in rows], np.int64) for i in range(4))
    bits, bands = np.array([r[4] for r in rows], np.int64).view(np.uint64), np.array([r[5] for r in rows], np.int64)
    left, right = np.flatnonzero(side <= 1), np.flatnonzero(side != 1)
    found: list[tuple[int, int]] = []
    best: dict[int, tuple[float, int, int]] = {}
    for i in left:
        ok = (comp[right] != comp[i]) & (DENOMINATOR * np.minimum(size[right], size[i]) >= NUMERATOR * np.maximum(size[right], size[i]))
        if side[i] == 0:
            ok &= rep[right] > rep[i]
        near = right[ok]
        if not len(near):
            continue
        differing = np.bitwise_count(bits[near] ^ bits[i]).sum(axis=1, dtype=np.int64)
        spare = _most_bits(size[near].astype(float), float(size[i]), _ARRAYS) - differing
        near, spare = near[spare >= 0], spare[spare >= 0]
        if closest:
            for j, room in zip(near, spare, strict=True):
                for c in (comp[i], comp[j]):
                    if c not in best or room > best[c][0]:
                        best[c] = (room, rep[i], rep[j])
        else:
            if banded:
                near = near[bands[i][(bands[near] == bands[i]).argmax(axis=1)] == key]
            found += [(rep[i], rep[j]) for j in near]
    found += [(a, b) for _, a, b in best.values()]
    return [(int(min(p)), int(max(p))) for p in found]


def rare_buckets(reps: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """key, rep, members: the given classes by each shingle of their prefixes. Sets of the similarity share one, so nothing is missed.

    A prefix is the rarest part of a set: all but so many shingles as a similar set must share, and one more. What very many texts have in
    common, as a template, is thus no bucket unless it is nearly all that they have.
    """
    texts = _texts(docs).join(reps.join(classes.select("rep", "doc_id", "digest"), "rep"), ["doc_id", "digest"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rep, own in zip(batch.column("rep").to_pylist(), shingle_sets(batch.column("text")), strict=True):
                n = len(own)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(n, rep, np.int64)), pa.array(own.view(np.int64)), pa.array(np.full(n, n - -(-NUMERATOR * n // DENOMINATOR) + 1, np.int64))], names=["rep", "key", "prefix"])

    shingles = written(texts.select("rep", "text").mapInArrow(run, "rep bigint, key bigint, prefix bigint"), "shingles")
    often = shingles.groupBy("key").agg(F.count("*").alias("often"))
    # Rows that repeat have equal ranks.
    rank = F.dense_rank().over(Window.partitionBy("rep").orderBy("often", "key"))
    prefixes = written(shingles.join(often, "key").withColumn("rank", rank).where("rank <= prefix").select("key", "rep").distinct(), "prefixes")
    return prefixes.join(prefixes.groupBy("key").agg(F.count("*").alias("members")).where("members > 1"), "key")


def mixed_buckets(members: DataFrame, nodes: DataFrame) -> DataFrame:
    """``members`` (key, rep, members) of buckets that hold several components, each with its component."""
    placed = members.join(nodes.withColumnRenamed("node", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    placed = written(placed, "members")
    mixed = placed.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").select("key")
    return placed.join(written(mixed, "mixed"), "key")


def crossing_pairs(mixed: DataFrame, classes: DataFrame, closest: bool, banded: bool) -> DataFrame:
    """Close pairs across components within mixed buckets; those over BLOCK members are compared block by block."""
    rows = mixed.join(classes.select("rep", "n_shingles", "sketch", "bands"), "rep")
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    rows = rows.withColumn("own", F.pmod(F.xxhash64("rep"), blocks).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    # Side 0: both in one block; 1 and 2: the lower and the higher block of two.
    side = F.when(F.col("own") == F.col("other"), 0).when(F.col("own") < F.col("other"), 1).otherwise(2)
    dealt = rows.select("key", F.least("own", "other").alias("b1"), F.greatest("own", "other").alias("b2"), "rep", "component", "n_shingles", side.alias("side"), "sketch", "bands")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, rows = None, []

        def made(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([p[i] for p in pairs], pa.int64()) for i in (0, 1)], names=["a", "b"])

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("key", "b1", "b2", "rep", "component", "n_shingles", "side", "sketch", "bands")]
            for key, b1, b2, *row in zip(*columns, strict=True):
                if (key, b1, b2) != group:
                    if len(rows) > 1:
                        yield made(_bucket_pairs(group[0], rows, closest, banded))
                    group, rows = (key, b1, b2), []
                rows.append(row)
        if len(rows) > 1:
            yield made(_bucket_pairs(group[0], rows, closest, banded))

    return dealt.repartition("key", "b1", "b2").sortWithinPartitions("key", "b1", "b2").mapInArrow(run, "a bigint, b bigint").distinct()


def _placed(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The sketched rows; and for each class its component's least row: print1, print2, component (its id), first (its digest)."""
    rows = written(sketches(docs), "sketches")
    least = F.min_by(F.struct("doc_id", "digest", "n_shingles", "bands", "sketch"), F.struct("doc_id", "digest"))
    classes = rows.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("print1", "print2").agg(least.alias("own"))
    # Ids may repeat, so classes have numbers of their own.
    classes = written(classes.select(F.monotonically_increasing_id().alias("rep"), "print1", "print2", "own.*"), "classes")
    lead = F.struct(F.xxhash64("rep").alias("rank"), F.col("rep"))
    buckets = classes.select("rep", F.explode("bands").alias("key"))
    keys = written(buckets.groupBy("key").agg(F.count("*").alias("members"), F.min(lead).alias("lead")).where("members > 1").select("key", "members", F.col("lead.rep").alias("leader")), "keys")
    members = written(buckets.join(keys, "key"), "buckets")
    stars = members.where("rep <> leader").select(F.col("leader").alias("a"), F.col("rep").alias("b")).distinct()
    members = members.select("key", "rep", "members")
    tried = written(close_pairs(stars, classes), "pairs")
    links = written(confirmed(tried, classes, docs), "links")
    nodes = written(components(links), "nodes")
    rare = None
    # The second pass confirms every close pair that still crosses components, so a third would find none.
    for closest in (True, False):
        known = tried.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        mixed = mixed_buckets(members, nodes)
        hot = mixed.where(F.col("members") > HOT).select("rep").distinct()
        if rare is None and not hot.isEmpty():
            rare = written(rare_buckets(hot, classes, docs), "rare")
        crossing = crossing_pairs(mixed.where(F.col("members") <= HOT), classes, closest, True)
        if rare is not None:
            crossing = crossing.unionByName(crossing_pairs(mixed_buckets(rare, nodes), classes, closest, False)).distinct()
        fresh = written(crossing.join(known, ["a", "b"], "left_anti"), "pairs")
        if fresh.isEmpty():
            continue
        tried, links = tried.unionByName(fresh), links.unionByName(written(confirmed(fresh, classes, docs), "links"))
        nodes = written(components(links), "nodes")
    own = classes.select("print1", "print2", "rep", F.struct("doc_id", "digest").alias("row")).join(nodes.withColumnRenamed("node", "rep"), "rep", "left")
    own = own.withColumn("linked", F.col("component").isNotNull())
    heads = own.where("linked").groupBy("component").agg(F.min("row").alias("head"))
    head = F.coalesce("head", "row")
    placed = own.join(heads, "component", "left").select("print1", "print2", head["doc_id"].alias("component"), head["digest"].alias("first"))
    return rows, written(placed, "placed")


def _decided(docs: DataFrame) -> DataFrame:
    """doc_id, digest, n_shingles, component_id, kept (the row has its component's id), stays (it has that id's first text too)."""
    rows, placed = _placed(docs)
    out = rows.select("doc_id", "digest", "n_shingles", "print1", "print2").join(placed, ["print1", "print2"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    kept = F.coalesce(F.col("doc_id") == component, F.lit(True))
    stays = kept & F.coalesce(F.col("digest") == F.coalesce("first", "digest"), F.lit(True))
    return out.select("doc_id", "digest", "n_shingles", component.alias("component_id"), kept.alias("kept"), stays.alias("stays"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for each row of ``docs``."""
    return _decided(docs).drop("digest", "stays")


def without_near_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each component, the one with the least id, and all rows without an id; of rows of equal id and text one stays."""
    keep = _decided(docs).where("stays AND doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("_id"), F.col("digest").alias("_digest")).agg(F.count("*").alias("_n"))
    keep = written(keep, "keep")
    chosen = (docs["doc_id"].cast("bigint") == keep["_id"]) & (F.xxhash64(docs["text"].cast("string")) == keep["_digest"])
    out = docs.join(keep.where("_n = 1"), chosen, "left_semi").unionByName(docs.where(F.col("doc_id").isNull()))
    again = keep.where("_n > 1")
    # Only rows that repeat are compared by text.
    return out if again.isEmpty() else out.unionByName(docs.join(again, chosen, "left_semi").dropDuplicates(["doc_id", "text"]))


#: The same rows in SQL: all pairs of texts that share a shingle are counted, so it is meant for small tables.
SQL = r"""
WITH RECURSIVE t AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents),
p AS (SELECT r, unnest(words) AS a, generate_subscripts(words, 1) AS i FROM t),
g AS (SELECT r, i, concat_ws(' ', a, lead(a, 1) OVER v, lead(a, 2) OVER v, lead(a, 3) OVER v, lead(a, 4) OVER v) AS s, lead(a, 4) OVER v AS fifth FROM p WINDOW v AS (PARTITION BY r ORDER BY i)),
sh AS (SELECT DISTINCT r, s FROM g WHERE fifth IS NOT NULL OR i = 1),
n AS (SELECT r, count(*) AS n FROM sh GROUP BY r),
c AS (SELECT x.r AS a, y.r AS b, count(*) AS shared FROM sh x JOIN sh y ON x.s = y.s AND x.r < y.r GROUP BY ALL),
l AS (SELECT a, b FROM c JOIN n x ON x.r = a JOIN n y ON y.r = b WHERE 100 * shared >= 75 * (x.n + y.n - shared)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
reach AS (SELECT r AS a, r AS b FROM t UNION SELECT reach.a, e.b FROM reach JOIN e ON e.a = reach.b),
k AS (SELECT reach.a AS r, min(t.doc_id) AS component_id FROM reach JOIN t ON t.r = reach.b GROUP BY reach.a)
SELECT t.doc_id, coalesce(n.n, 0) AS n_shingles, k.component_id, t.doc_id = k.component_id AS kept FROM t JOIN k ON k.r = t.r LEFT JOIN n ON n.r = t.r
"""
