"""Queries over the names, requests, answers and boxes of generation runs, with the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terraloom.functions import rules, text
from terraloom.operators import generation, tiles
from terraloom.plans.registry import query, table


def _dealt(key: str, *values: Column | str | None) -> Column:
    """One of the values by the key's remainder; the last one where no other is due."""
    out, n = None, len(values)
    for i, value in enumerate(values):
        value = value if isinstance(value, Column) else F.lit(value)
        due = F.col(key) % n == i
        out = F.when(due, value) if out is None else out.when(due, value)
    return out


# --- names and paths: parts --------------------------------------------------------------------------------------------


@query("""SELECT p_partkey, printf('%04d', p_partkey * 11) || '-' || p_brand || '-v' || printf('%02d', p_size) || '-c' || printf('%02d', p_partkey % 120) || '.' ||
CASE p_partkey % 5 WHEN 0 THEN 'png' WHEN 1 THEN 'jpg' WHEN 2 THEN 'jpg' WHEN 3 THEN 'webp' ELSE 'bin' END AS file FROM part""")
def image_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers of more digits than a name pads to stay whole."""
    kind = text.extension(_dealt("p_partkey", "image/PNG", "image/jpeg", "image/jpg; q=1", "image/webp", F.lit(None).cast("string")))
    name = text.image_name(F.col("p_partkey") * 11, F.col("p_brand"), F.col("p_size"), F.col("p_partkey") % 120, kind)
    return table(spark, sf_dir, "part").select("p_partkey", name.alias("file"))


@query("SELECT o_orderkey, CAST(floor(o_totalprice * 100000) AS BIGINT) & 2147483647 AS seed FROM orders")
def masked_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", text.masked_seed(F.col("o_totalprice") * 100000).alias("seed"))


@query("""WITH n AS (SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'Run-' || CAST(p_partkey AS VARCHAR) WHEN 1 THEN p_name WHEN 2 THEN lower(replace(p_brand, '#', '_')) END AS name,
CASE p_partkey % 3 WHEN 0 THEN '//' || p_brand || '/' WHEN 1 THEN 'a/../' || p_brand ELSE p_brand || '/b.json' END AS path FROM part)
SELECT p_partkey, coalesce(regexp_matches(name, '^[a-zA-Z0-9][a-zA-Z0-9_-]{0,127}$'), false) AS is_run, coalesce(regexp_matches(name, '^[a-z0-9][a-z0-9_-]{0,63}$'), false) AS is_region,
coalesce(regexp_matches(name, '^[a-zA-Z0-9._-]+$'), false) AS is_layer, CASE WHEN NOT contains(path, '..') THEN regexp_replace(path, '^/+|/+$', '', 'g') END AS path FROM n""")
def safe_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = _dealt("p_partkey", F.concat(F.lit("Run-"), F.col("p_partkey").cast("string")), F.col("p_name"), F.lower(F.replace(F.col("p_brand"), F.lit("#"), F.lit("_"))), F.lit(None).cast("string"))
    path = _dealt("p_partkey", F.concat(F.lit("//"), "p_brand", F.lit("/")), F.concat(F.lit("a/../"), "p_brand"), F.concat("p_brand", F.lit("/b.json")))
    checks = [text.is_safe_name(name, kind).alias(f"is_{kind}") for kind in ("run", "region", "layer")]
    return table(spark, sf_dir, "part").select("p_partkey", *checks, text.relative_path(path).alias("path"))


@query("""SELECT p_partkey, sha256('{"layer": "' || lower(p_type) || '", "model": "' || p_brand || '", "x": ' || CAST(p_size AS VARCHAR) || '}') AS cache_key FROM part""")
def cache_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = generation.cache_key({"x": F.col("p_size"), "model": F.col("p_brand"), "layer": F.lower("p_type")})
    return table(spark, sf_dir, "part").select("p_partkey", key.alias("cache_key"))


# --- requests: parts as lines of a prompt file, every fourth empty, every fourth a comment ------------------------------

_REQUESTS_SQL = """l AS (SELECT p_partkey, trim(CASE p_partkey % 4 WHEN 0 THEN '  ' WHEN 1 THEN ' # ' || p_name ELSE ' ' || p_name || ' ' END) AS prompt FROM part),
p AS (SELECT row_number() OVER (ORDER BY p_partkey) AS prompt_no, prompt FROM l WHERE prompt <> '' AND NOT starts_with(prompt, '#')), v AS (SELECT prompt_no, prompt, unnest([0, 1]) AS variant FROM p),
q AS (SELECT *, CAST('0x' || substr(sha256('7:' || CAST(prompt_no AS VARCHAR) || ':0:' || CAST(variant AS VARCHAR)), 1, 8) AS BIGINT) & 2147483647 AS seed FROM v)"""


def _requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = _dealt("p_partkey", "  ", F.concat(F.lit(" # "), "p_name"), F.concat(F.lit(" "), "p_name", F.lit(" ")), F.concat(F.lit(" "), "p_name", F.lit(" ")))
    return generation.requests(generation.prompts(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("line_no"), line.alias("value"))), 2, 7)


@query(f"""WITH {_REQUESTS_SQL} SELECT CAST(prompt_no AS INTEGER) AS prompt_no, prompt, CAST(variant AS INTEGER) AS variant, seed,
printf('%04d', prompt_no) || '-' || substr(regexp_replace(regexp_replace(lower(prompt), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), 1, 40) || '-v' || printf('%02d', variant) || '-c00.png' AS file FROM q""")
def prompt_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _requests(spark, sf_dir).select("prompt_no", "prompt", "variant", "seed", "file")


def _refusing(prompt: str, seed: int) -> bytes:
    """A stand-in for a model that refuses every third seed."""
    if seed % 3 == 0:
        raise ValueError("refused")
    return generation.echo(prompt, seed)


@query(f"WITH {_REQUESTS_SQL} SELECT count(*) AS total, count(*) FILTER (seed % 3 <> 0) AS ok, count(*) FILTER (seed % 3 = 0) AS failed, count(*) = count(*) FILTER (seed % 3 = 0) AS all_failed FROM q")
def generation_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return generation.run_report(generation.generated(_requests(spark, sf_dir), _refusing, 4))


@query("""SELECT p_partkey, 'image/png' AS mime, 'D' || CAST(p_partkey AS VARCHAR) AS data, CAST(NULL AS VARCHAR) AS uri FROM part WHERE p_partkey % 4 = 1
UNION ALL SELECT p_partkey, 'image/webp', NULL, 'files/' || CAST(p_partkey AS VARCHAR) FROM part WHERE p_partkey % 4 = 2""")
def answer_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers that were blocked, with an image within, with one as a file, and no answers at all."""
    answer = lambda part: F.concat(F.lit('"candidates":[{"content":{"parts":[{"text":"t"},'), part, F.lit("]}}]}"))
    inline = answer(F.format_string('{"inlineData":{"mimeType":"image/png","data":"D%d"}}', "p_partkey"))
    file = answer(F.format_string('{"fileData":{"mimeType":"image/webp","fileUri":"files/%d"}}', "p_partkey"))
    response = _dealt("p_partkey", F.concat(F.lit('{"promptFeedback":{"blockReason":"SAFETY"},'), inline), F.concat(F.lit("{"), inline), F.concat(F.lit("{"), file), "no answer")
    return table(spark, sf_dir, "part").select("p_partkey", F.inline(generation.response_images(response)))


# --- boxes and settings: customers -------------------------------------------------------------------------------------

_BOXES_SQL = "b AS (SELECT c_custkey, CAST(c_custkey % 90 AS DOUBLE) AS w, c_nationkey * CAST(2 AS DOUBLE) AS s, CAST(c_custkey % 90 AS DOUBLE) + 7.5 AS e, c_nationkey * CAST(2 AS DOUBLE) + 12.25 AS n FROM customer)"


def _boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    west, south = (F.col("c_custkey") % 90).cast("double"), F.col("c_nationkey") * 2.0
    return table(spark, sf_dir, "customer").select("c_custkey", west.alias("w"), south.alias("s"), (west + 7.5).alias("e"), (south + 12.25).alias("n"))


@query(f"WITH {_BOXES_SQL} SELECT c_custkey, CAST(k AS INTEGER) AS k, CASE WHEN k IN (1, 2) THEN e ELSE w END AS x, CASE WHEN k IN (2, 3) THEN n ELSE s END AS y FROM b, (SELECT unnest(range(5)) AS k)")
def box_rings(spark: SparkSession, sf_dir: str) -> DataFrame:
    ring = rules.bbox_ring(*map(F.col, ("w", "s", "e", "n")))
    return _boxes(spark, sf_dir).select("c_custkey", F.posexplode(ring).alias("k", "p")).select("c_custkey", "k", F.col("p")[0].alias("x"), F.col("p")[1].alias("y"))


@query(f"""WITH {_BOXES_SQL}, h AS (SELECT *, (e - w) * 0.25 AS hx, (n - s) * 0.25 AS hy FROM b), m AS (SELECT *, greatest(w + hx, least(e - hx, w + c_custkey % 10)) AS mx, greatest(s + hy, least(n - hy, s - 1)) AS my FROM h)
SELECT c_custkey, (w + e) / 2 - hx AS w0, (s + n) / 2 - hy AS s0, (w + e) / 2 + hx AS e0, (s + n) / 2 + hy AS n0, mx - hx AS w1, my - hy AS s1, mx + hx AS e1, my + hy AS n1 FROM m""")
def half_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes of half the sides: about their own centre, and about a given one as far as the parent allows."""
    parent = F.array("w", "s", "e", "n")
    own, given = tiles.scaled_bbox(parent, 0.5), tiles.scaled_bbox(parent, 0.5, (F.col("w") + F.col("c_custkey") % 10, F.col("s") - 1))
    return _boxes(spark, sf_dir).select("c_custkey", *[box[i].alias(f"{side}{k}") for k, box in enumerate((own, given)) for i, side in enumerate("wsen")])


@query("""WITH q AS (SELECT c_custkey, ',' || regexp_replace(coalesce(CASE c_custkey % 4 WHEN 0 THEN 'water, green' WHEN 1 THEN 'roads,roads,sea' WHEN 3 THEN c_mktsegment || ' ,green' END, ''), ' *, *', ',', 'g') || ',' AS asked FROM customer)
SELECT c_custkey, concat_ws(',', CASE WHEN contains(asked, ',green,') THEN 'green' END, CASE WHEN contains(asked, ',roads,') THEN 'roads' END, CASE WHEN contains(asked, ',water,') THEN 'water' END) AS layers FROM q""")
def layer_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = _dealt("c_custkey", "water, green", "roads,roads,sea", F.lit(None).cast("string"), F.concat("c_mktsegment", F.lit(" ,green")))
    return table(spark, sf_dir, "customer").select("c_custkey", F.array_join(rules.layer_list(asked, ("green", "roads", "water")), ",").alias("layers"))


@query("SELECT c_custkey, CASE WHEN c_custkey % 5 <> 0 AND c_custkey % 80 <= 49 THEN CAST(c_custkey % 80 AS DOUBLE) / 100 ELSE CAST(0 AS DOUBLE) END AS overlap FROM customer")
def tileset_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlaps that are missing or over 0.49 count as 0."""
    document = F.when(F.col("c_custkey") % 5 == 0, F.lit("{}")).otherwise(F.concat(F.lit('{"overlap": 0.'), F.lpad((F.col("c_custkey") % 80).cast("string"), 2, "0"), F.lit("}")))
    return table(spark, sf_dir, "customer").select("c_custkey", rules.usable_overlap(document).alias("overlap"))
