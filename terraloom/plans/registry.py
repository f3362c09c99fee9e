"""Queries over the driver's tables, by name, with the SQL that gives the same rows.

The tables hold no geometry: each operator runs on columns derived from whole tables, as the comment at each query says.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terraloom.functions import features, geometry, rules, text
from terraloom.functions.projection import mercator_forward, utm_forward, utm_zone
from terraloom.operators import audit, coverage, heights, imaging, ingest, mosaics, rasters, scenes, seams, tiles
from terraloom.sources import geojsonseq, manifest, stac

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
FLAGSHIP = "grid_green_metrics"


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def keep(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- heights: parts as buildings, every third with a height, every third with levels --------------------------------

_BUILDINGS_SQL = """
b AS (SELECT 'part/' || CAST(p_partkey AS VARCHAR) AS id, CASE WHEN p_size % 3 = 0 THEN CAST(p_size AS DOUBLE) / 2 END AS h, CASE WHEN p_size % 3 = 1 THEN p_size END AS l FROM part),
hs AS (SELECT id, round(coalesce(h, l * 3.2, 8.0 + (CAST('0x' || substr(sha256(id), 1, 8) AS BIGINT) % 1201) / 100.0), 6) AS height_m, CASE WHEN h IS NULL THEN l END AS levels_int,
  CASE WHEN h IS NOT NULL THEN 'height' WHEN l IS NOT NULL THEN 'levels' ELSE 'heuristic' END AS height_source FROM b)
"""


def _buildings(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "part").select(
        F.concat(F.lit("part/"), F.col("p_partkey").cast("string")).alias("id"),
        F.when(F.col("p_size") % 3 == 0, F.format_string("%.1f m", F.col("p_size").cast("double") / 2)).alias("height"),
        F.when(F.col("p_size") % 3 == 1, F.concat(F.col("p_size").cast("string"), F.lit(" floors"))).alias("building_levels"),
    )
    return heights.with_heights(rows).withColumn("height_m", F.round("height_m", 6))


@query(f"WITH {_BUILDINGS_SQL} SELECT id, height_m, CAST(levels_int AS INTEGER) AS levels_int, height_source FROM hs")
def building_heights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _buildings(spark, sf_dir).select("id", "height_m", "levels_int", "height_source")


@query(f"WITH {_BUILDINGS_SQL} SELECT count(*) FILTER (height_source = 'height') AS height, count(*) FILTER (height_source = 'levels') AS levels, count(*) FILTER (height_source = 'heuristic') AS heuristic FROM hs")
def height_source_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return heights.source_counts(_buildings(spark, sf_dir))


@query(f"WITH {_BUILDINGS_SQL} SELECT count(*) AS total, count(*) FILTER (height_source = 'height') AS n_height, count(*) FILTER (height_source = 'levels') AS n_levels, count(*) FILTER (height_source = 'heuristic') AS n_heuristic, min(height_m) AS min_m, quantile_disc(height_m, 0.5) AS median_m, quantile_disc(height_m, 0.95) AS p95_m, max(height_m) AS max_m FROM hs")
def height_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return heights.height_report(_buildings(spark, sf_dir))


# --- coverage: orders as rectangles over a grid of 12 x 12 cells of 100 m -------------------------------------------

_PIECES_SQL = """
p AS (SELECT CAST(o_orderkey * 37 % 1150 AS DOUBLE) AS x0, CAST(o_custkey * 53 % 1150 AS DOUBLE) AS y0, CAST(o_orderkey * 37 % 1150 + 10 + o_orderkey % 190 AS DOUBLE) AS x1, CAST(o_custkey * 53 % 1150 + 5 + o_custkey % 90 AS DOUBLE) AS y1 FROM orders),
c AS (SELECT 'utm42n_100m_' || CAST(ix AS VARCHAR) || '_' || CAST(iy AS VARCHAR) AS cell_id, 100.0 * ix AS cx0, 100.0 * iy AS cy0 FROM (SELECT unnest(range(12)) AS ix), (SELECT unnest(range(12)) AS iy)),
s AS (SELECT cell_id, sum((least(x1, cx0 + 100) - greatest(x0, cx0)) * (least(y1, cy0 + 100) - greatest(y0, cy0))) AS a FROM p JOIN c ON x0 < cx0 + 100 AND x1 > cx0 AND y0 < cy0 + 100 AND y1 > cy0 GROUP BY cell_id),
m AS (SELECT c.cell_id, CAST(10000.0 AS DOUBLE) AS cell_area_m2, CAST(coalesce(a, 0) AS DOUBLE) AS green_area_m2, CAST(greatest(0, least(1, coalesce(a, 0) / 10000.0)) AS DOUBLE) AS green_share FROM c LEFT JOIN s USING (cell_id))
"""


def _cover(spark: SparkSession, sf_dir: str) -> DataFrame:
    x0, y0 = F.col("o_orderkey") * 37 % 1150, F.col("o_custkey") * 53 % 1150
    pieces = table(spark, sf_dir, "orders").select(x0.cast("double").alias("x0"), y0.cast("double").alias("y0"), (x0 + 10 + F.col("o_orderkey") % 190).cast("double").alias("x1"), (y0 + 5 + F.col("o_custkey") % 90).cast("double").alias("y1"))
    return coverage.coverage(coverage.grid_cells(spark, (0, 0, 1200, 1200), 100), pieces, 100)


@query(f"WITH {_PIECES_SQL} SELECT * FROM m")
def grid_green_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cover(spark, sf_dir)


@query(f"WITH {_PIECES_SQL} SELECT count(*) AS cells_total, count(*) FILTER (green_area_m2 > 0) AS cells_intersected, min(green_share) AS share_min, max(green_share) AS share_max, round(avg(green_share), 9) AS share_avg FROM m")
def grid_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.coverage_report(_cover(spark, sf_dir)).withColumn("share_avg", F.round("share_avg", 9))


# --- rasters: line items as scene pixels, parts as a mask -----------------------------------------------------------


def _stack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("pixel"), F.col("l_quantity").alias("red"), (F.col("l_extendedprice") / 1000).alias("nir"), F.col("l_linenumber").alias("scl"))


@query("""WITH v AS (SELECT l_partkey AS pixel, CASE WHEN l_linenumber NOT IN (0, 1, 3, 8, 9, 10, 11) AND l_quantity > 0 AND l_extendedprice / 1000 > 0 THEN (l_extendedprice / 1000 - l_quantity) / (l_extendedprice / 1000 + l_quantity) END AS x FROM lineitem),
m AS (SELECT pixel, count(x) AS valid, CASE WHEN count(x) >= 3 THEN median(x) END AS y FROM v GROUP BY pixel)
SELECT pixel, valid, round(y, 9) AS ndvi, CAST(CASE WHEN y IS NOT NULL THEN CASE WHEN y >= 0.3 THEN 1 ELSE 0 END END AS INTEGER) AS green FROM m""")
def ndvi_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rasters.composite(_stack(spark, sf_dir), ["pixel"]).withColumn("ndvi", F.round("ndvi", 9))


def _mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(F.floor(key / 50).cast("int").alias("row"), (key % 50).cast("int").alias("col"), (F.col("p_size") > 15).cast("int").alias("bit"))


def _step_sql(source: str, least: int) -> str:
    return f"(SELECT a.\"row\", a.col, CASE WHEN (SELECT 1) = 1 AND coalesce(n.n, 0) >= {least} THEN 1 ELSE 0 END AS bit FROM {source} a LEFT JOIN (SELECT a.\"row\", a.col, count(*) AS n FROM {source} a JOIN {source} b ON b.\"row\" BETWEEN a.\"row\" - 1 AND a.\"row\" + 1 AND b.col BETWEEN a.col - 1 AND a.col + 1 WHERE b.bit = 1 GROUP BY 1, 2) n ON n.\"row\" = a.\"row\" AND n.col = a.col)"


_MASK_SQL = "m0 AS (SELECT CAST(floor(p_partkey / 50) AS INTEGER) AS \"row\", CAST(p_partkey % 50 AS INTEGER) AS col, CASE WHEN p_size > 15 THEN 1 ELSE 0 END AS bit FROM part)" + "".join(
    f", m{i + 1} AS {_step_sql(f'm{i}', least)}" for i, least in enumerate((9, 1, 1, 9))
)


@query(f"WITH {_MASK_SQL} SELECT \"row\", col, CAST(bit AS INTEGER) AS bit FROM m4")
def morph_open_close(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rasters.cleaned(_mask(spark, sf_dir))


@query(f"WITH {_MASK_SQL} SELECT count(bit) AS valid_px, count(*) FILTER (bit = 1) AS green_px, round(count(*) FILTER (bit = 1) / count(bit), 9) AS green_ratio FROM m4")
def mask_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rasters.mask_report(rasters.cleaned(_mask(spark, sf_dir))).withColumn("green_ratio", F.round("green_ratio", 9))


@query("SELECT l_partkey, arg_min(l_extendedprice, (l_suppkey, l_orderkey, l_linenumber)) AS price FROM lineitem WHERE l_discount > 0.02 GROUP BY l_partkey")
def mosaic_first_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_orderkey", "l_linenumber", F.when(F.col("l_discount") > 0.02, F.col("l_extendedprice")).alias("price"))
    return rasters.first_valid(rows, ["l_partkey"], ["l_suppkey", "l_orderkey", "l_linenumber"], "price")


@query("""WITH w AS (SELECT user_id, value, (CASE event_id % 8 WHEN 0 THEN 0.0 WHEN 1 THEN 1.0 / 3 WHEN 2 THEN 2.0 / 3 ELSE 1.0 END) * (CASE event_id % 8 WHEN 5 THEN 1.0 WHEN 6 THEN 2.0 / 3 WHEN 7 THEN 1.0 / 3 ELSE 1.0 END) AS w FROM events)
SELECT user_id, round(sum(value * w) / sum(w), 6) AS value FROM w GROUP BY user_id""")
def mosaic_blend(spark: SparkSession, sf_dir: str) -> DataFrame:
    weight = tiles.fade_weight(F.col("event_id") % 8, F.lit(8), F.lit(3), F.lit(True), F.lit(True))
    rows = table(spark, sf_dir, "events").select("user_id", "value", weight.alias("w"))
    return rasters.blended(rows, ["user_id"], "value", "w").withColumn("value", F.round("value", 6))


# --- seams: embeddings as tiles of 8 x 8 pixels in a row ------------------------------------------------------------

_SEAM_SQL = """e AS (SELECT vec_id, [CAST(x AS DOUBLE) FOR x IN embedding] AS v FROM embeddings),
s AS (SELECT a.vec_id, list_sum([abs(a.v[i] - b.v[i]) FOR i IN range(1, 65)]) / 64 AS l1, list_sum([(a.v[i] - b.v[i]) * (a.v[i] - b.v[i]) FOR i IN range(1, 65)]) / 64 AS l2 FROM e a JOIN e b ON b.vec_id = a.vec_id + 1)"""


def _seams(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    other = rows.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("b"))
    pairs = rows.select("vec_id", F.col("embedding").alias("a")).join(other, "vec_id")
    return pairs.select("vec_id", seams.mean_difference("a", "b", 1).alias("l1"), seams.mean_difference("a", "b", 2).alias("l2"))


@query(f"WITH {_SEAM_SQL} SELECT vec_id, round(l1, 9) AS l1, round(l2, 9) AS l2, round(l1 + 0.25 * l2, 9) AS score FROM s")
def seam_l1_l2(spark: SparkSession, sf_dir: str) -> DataFrame:
    score = seams.seam_score({"rgb_l1": F.col("l1"), "rgb_l2": F.col("l2")})
    return _seams(spark, sf_dir).select("vec_id", F.round("l1", 9).alias("l1"), F.round("l2", 9).alias("l2"), F.round(score, 9).alias("score"))


@query(f"WITH {_SEAM_SQL} SELECT vec_id, round(l1 + 0.25 * l2, 9) AS score FROM s ORDER BY score DESC, vec_id LIMIT 10")
def worst_seams_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    score = seams.seam_score({"rgb_l1": F.col("l1"), "rgb_l2": F.col("l2")})
    return seams.worst(_seams(spark, sf_dir).select("vec_id", F.round(score, 9).alias("score")), 10, "score", ("vec_id",))


@query("""WITH e AS (SELECT vec_id, [CAST(x AS DOUBLE) FOR x IN embedding] AS v FROM embeddings),
p AS (SELECT vec_id, v, r, c FROM e, (SELECT unnest(range(8)) AS r), (SELECT unnest(range(8)) AS c)),
i AS (SELECT vec_id, v, greatest(r - 1, 0) * 8 AS u, r * 8 AS m, least(r + 1, 7) * 8 AS d, greatest(c - 1, 0) + 1 AS l, c + 1 AS k, least(c + 1, 7) + 1 AS g FROM p),
s AS (SELECT vec_id, (v[u + g] + 2 * v[m + g] + v[d + g]) - (v[u + l] + 2 * v[m + l] + v[d + l]) AS gx, (v[d + l] + 2 * v[d + k] + v[d + g]) - (v[u + l] + 2 * v[u + k] + v[u + g]) AS gy FROM i)
SELECT vec_id, round(avg(sqrt(gx * gx + gy * gy)), 6) AS mean_magnitude FROM s GROUP BY vec_id""")
def seam_sobel(spark: SparkSession, sf_dir: str) -> DataFrame:
    pixels = table(spark, sf_dir, "embeddings").select("vec_id", F.posexplode("embedding").alias("at", "x"))
    pixels = pixels.select("vec_id", F.floor(F.col("at") / 8).cast("int").alias("row"), (F.col("at") % 8).alias("col"), F.col("x").cast("double").alias("value"))
    return seams.sobel_magnitude(pixels, ["vec_id"]).groupBy("vec_id").agg(F.round(F.avg("magnitude"), 6).alias("mean_magnitude"))


@query("""WITH c AS (SELECT label, vec_id, CASE WHEN vec_id % 7 = 0 THEN 'failed' END AS error, round(list_sum([abs(CAST(x AS DOUBLE)) FOR x IN embedding]) / 64, 9) + 0.5 * round(list_sum([CAST(x AS DOUBLE) * CAST(x AS DOUBLE) FOR x IN embedding]) / 64, 9) AS score FROM embeddings)
SELECT label, arg_min(vec_id, (score, vec_id)) FILTER (error IS NULL) AS variant, round(min(score) FILTER (error IS NULL), 9) AS score, count(*) AS candidates, count(*) FILTER (error IS NOT NULL) AS failed FROM c GROUP BY label""")
def candidate_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each vector is a candidate of its label: its mean size as the seam score, its mean square as the structure score."""
    mean = lambda f: F.round(F.aggregate(F.transform("embedding", lambda x: f(x.cast("double"))), F.lit(0.0), lambda a, x: a + x) / 64, 9)
    total = seams.total_score(mean(F.abs), mean(lambda x: x * x), F.lit(0.0), F.lit(False), 0.5, 0.0, 0.0)
    rows = table(spark, sf_dir, "embeddings").select("label", F.col("vec_id").alias("variant"), F.when(F.col("vec_id") % 7 == 0, "failed").alias("error"), total.alias("total_score"))
    return seams.selected(rows, ["label"]).withColumn("score", F.round("score", 9))


# --- tiles ----------------------------------------------------------------------------------------------------------

_TILES_SQL = "t AS (SELECT DISTINCT CAST(p_size + p_size // 4 AS INTEGER) AS x, CAST(p_partkey % 70 AS INTEGER) AS y FROM part)"


def _tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes and keys of all parts as places; every fifth index of x is left out."""
    return table(spark, sf_dir, "part").select((F.col("p_size") + F.floor(F.col("p_size") / 4)).cast("int").alias("x"), (F.col("p_partkey") % 70).cast("int").alias("y")).distinct()


@query(f"WITH {_TILES_SQL} SELECT 'v' AS axis, a.x, a.y, b.x AS ox, b.y AS oy FROM t a JOIN t b ON b.x = a.x + 1 AND b.y = a.y UNION ALL SELECT 'h', a.x, a.y, b.x, b.y FROM t a JOIN t b ON b.x = a.x AND b.y = a.y + 1")
def tile_adjacency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiles.neighbours(_tiles(spark, sf_dir))


@query(f"WITH {_TILES_SQL} SELECT a.x, a.y FROM t a JOIN t b ON b.x = a.x + 1 AND b.y = a.y JOIN t c ON c.x = a.x AND c.y = a.y + 1 JOIN t d ON d.x = a.x + 1 AND d.y = a.y + 1")
def tile_intersections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiles.intersections(_tiles(spark, sf_dir))


@query(f"WITH {_TILES_SQL}, r AS (SELECT min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1 FROM t), g AS (SELECT CAST(x AS INTEGER) AS x, CAST(unnest(range(y0, y1 + 1)) AS INTEGER) AS y FROM (SELECT unnest(range(x0, x1 + 1)) AS x, y0, y1 FROM r)) SELECT g.x, g.y FROM g LEFT JOIN t ON t.x = g.x AND t.y = g.y WHERE t.x IS NULL")
def tile_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiles.missing_tiles(_tiles(spark, sf_dir))


@query("""WITH b AS (SELECT radians(69.103) * 6378137.0 AS x0, ln(tan(pi() / 4 + radians(41.168) / 2)) * 6378137.0 AS y0, radians(69.397) * 6378137.0 AS x1, ln(tan(pi() / 4 + radians(41.434) / 2)) * 6378137.0 AS y1),
t AS (SELECT CAST(x AS INTEGER) AS x, CAST(y AS INTEGER) AS y, x0 + x * (x1 - x0) / 8 AS l, y1 - y * (y1 - y0) / 8 AS u, (x1 - x0) / 8 AS w, (y1 - y0) / 8 AS h FROM b, (SELECT unnest(range(8)) AS x), (SELECT unnest(range(8)) AS y))
SELECT x, y, round(degrees(l / 6378137.0), 6) AS west, round(degrees(2 * atan(exp((u - h) / 6378137.0)) - pi() / 2), 6) AS south, round(degrees(2 * atan(exp((u + 0.1 * h) / 6378137.0)) - pi() / 2), 6) AS north_overlap FROM t""")
def tile_grid_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = tiles.split_bbox(spark, (69.103, 41.168, 69.397, 41.434), 8, 0.1)
    return split.select("x", "y", F.round(F.col("bbox")[0], 6).alias("west"), F.round(F.col("bbox")[1], 6).alias("south"), F.round(F.col("bbox_overlap")[3], 6).alias("north_overlap"))


@query("SELECT c_custkey, round((c_custkey % 100 - c_acctbal / 100) * 1.0, 6) AS u, round((c_custkey % 100 + c_acctbal / 100) * 0.5 - c_nationkey, 6) AS v FROM customer")
def iso_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    u, v = tiles.isometric(F.col("c_custkey") % 100, F.col("c_acctbal") / 100, F.col("c_nationkey"))
    return table(spark, sf_dir, "customer").select("c_custkey", F.round(u, 6).alias("u"), F.round(v, 6).alias("v"))


@query("SELECT s_nationkey, string_agg(CAST(s_suppkey AS VARCHAR), ',' ORDER BY s_acctbal, s_suppkey) AS items FROM supplier GROUP BY s_nationkey")
def painter_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = tiles.painter_order(table(spark, sf_dir, "supplier"), ["s_nationkey"], F.col("s_acctbal"), "s_suppkey")
    return drawn.select("s_nationkey", F.array_join(F.transform("items", lambda i: i.cast("string")), ",").alias("items"))


@query("""SELECT c_custkey, CAST((CASE WHEN c_acctbal >= 0 THEN 32600 ELSE 32700 END) + floor((c_custkey % 360 - 180 + 180) / 6) + 1 AS INTEGER) AS epsg,
round(radians(c_custkey % 360 - 180) * 6378137.0, 4) AS mx, round(ln(tan(pi() / 4 + radians(greatest(-85.05112878, least(85.05112878, c_acctbal / 120))) / 2)) * 6378137.0, 4) AS my FROM customer""")
def map_coordinates(spark: SparkSession, sf_dir: str) -> DataFrame:
    lon, lat = (F.col("c_custkey") % 360 - 180).cast("double"), F.col("c_acctbal") / 120
    x, y = mercator_forward(lon, lat)
    return table(spark, sf_dir, "customer").select("c_custkey", utm_zone(lon, F.col("c_acctbal")).alias("epsg"), F.round(x, 4).alias("mx"), F.round(y, 4).alias("my"))


@query()
def utm_coordinates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transverse Mercator of points near zone 42; too long a series for the SQL side, tested against known points."""
    east, north = utm_forward(F.lit(69.0) + (F.col("c_custkey") % 400) / 1000, F.lit(41.0) + (F.col("c_custkey") % 500) / 1000, 32642)
    return table(spark, sf_dir, "customer").select("c_custkey", F.round(east, 4).alias("east"), F.round(north, 4).alias("north"))


# --- names, seeds, retries ------------------------------------------------------------------------------------------


@query("""SELECT doc_id, CASE WHEN doc_id % 3 = 0 OR source = '' THEN 'hash/' || substr(sha256(text), 1, 16) ELSE source || '/' || CAST(doc_id AS VARCHAR) END AS id,
coalesce(nullif(CASE WHEN doc_id % 2 = 0 THEN lang END, ''), nullif(source, ''), 'green') AS class FROM documents""")
def feature_class_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.when(F.col("doc_id") % 3 != 0, F.col("doc_id"))
    found = features.feature_class("green", {"landuse": F.when(F.col("doc_id") % 2 == 0, F.col("lang")), "leisure": F.col("source")})
    return table(spark, sf_dir, "documents").select("doc_id", features.feature_id(F.col("source"), number, F.col("text")).alias("id"), found.alias("class"))


@query("""SELECT count(*) AS input, count(*) FILTER (value > 0) AS written, count(*) FILTER (value IS NULL OR value <= 0) AS dropped_empty FROM events""")
def ingest_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as points of roads: a sound value is a line of that length, others have no geometry."""
    shape = F.when(F.col("value") > 0, F.concat(F.lit('{"type":"LineString","coordinates":[[0,0],[0,'), F.col("value").cast("string"), F.lit("]]}"))).otherwise(F.lit("null"))
    line = F.concat(F.lit('{"type":"Feature","properties":{"@type":"way","@id":'), F.col("event_id").cast("string"), F.lit(',"highway":"'), F.col("event_type"), F.lit('"},"geometry":'), F.coalesce(shape, F.lit("null")), F.lit("}"))
    return ingest.ingest(table(spark, sf_dir, "events").select(line.alias("line")), "roads")[1].select("input", "written", "dropped_empty")


@query("""SELECT conv_id, turn, CASE WHEN s = '' THEN 'image' ELSE substr(s, 1, 40) END AS slug FROM (SELECT conv_id, turn, regexp_replace(regexp_replace(lower(text), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') AS s FROM conversations)""")
def prompt_slug(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", text.slug(F.col("text")).alias("slug"))


@query("SELECT o_orderkey, CAST('0x' || substr(sha256('7:' || CAST(o_custkey AS VARCHAR) || ':' || CAST(o_orderkey % 9 AS VARCHAR) || ':2'), 1, 8) AS BIGINT) & 2147483647 AS seed FROM orders")
def tile_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", text.tile_seed(F.lit(7), F.col("o_custkey"), F.col("o_orderkey") % 9, F.lit(2)).alias("seed"))


@query("SELECT page_id, (CASE page_id % 5 WHEN 0 THEN 200 WHEN 1 THEN 429 WHEN 2 THEN 500 WHEN 3 THEN 404 ELSE 503 END) IN (429, 500, 502, 503, 504) OR regexp_matches(lower(html), '429|rate|resource exhausted|unavailable|internal|server error|timeout|temporar|502|503|504') AS retry FROM pages")
def retry_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.element_at(F.array(*[F.lit(s) for s in (200, 429, 500, 404, 503)]), (F.col("page_id") % 5 + 1).cast("int"))
    return table(spark, sf_dir, "pages").select("page_id", text.retryable(status, F.col("html")).alias("retry"))


@query("SELECT event_id, round(least(0.5 * power(2, event_id % 10), 30.0) + (event_id % 4) * 0.25, 6) AS seconds FROM events")
def retry_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    seconds = text.backoff(F.col("event_id") % 10, 0.5, 30.0, (F.col("event_id") % 4) * F.lit(0.25))
    return table(spark, sf_dir, "events").select("event_id", F.round(seconds, 6).alias("seconds"))


@query("""WITH v AS (SELECT p_partkey, p_size / 50.0 AS s, CAST(p_size AS DOUBLE) AS h FROM part)
SELECT p_partkey, round(CASE WHEN s <= 0 THEN 0.0 WHEN s <= 0.2 THEN s * 2 WHEN s <= 0.6 THEN 0.4 + (s - 0.2) * 1.25 WHEN s <= 1 THEN 0.9 + (s - 0.6) * 0.25 ELSE 1.0 END, 6) AS ramp, greatest(0, h - 0.8) AS wall_m, CAST(p_partkey % 3 AS BIGINT) AS variant FROM v""")
def style_expr(spark: SparkSession, sf_dir: str) -> DataFrame:
    ramp = text.colour_stop(F.col("p_size") / 50.0, [(0.0, 0.0), (0.2, 0.4), (0.6, 0.9), (1.0, 1.0)])
    feature = F.concat(F.lit("way/"), F.col("p_partkey").cast("string"))
    return table(spark, sf_dir, "part").select("p_partkey", F.round(ramp, 6).alias("ramp"), F.greatest(F.lit(0.0), F.col("p_size") - 0.8).alias("wall_m"), text.facade_variant(feature).alias("variant"))


@query("SELECT o_custkey, arg_max(sha256(o_orderpriority || CAST(o_orderkey AS VARCHAR)), (o_orderdate, o_orderkey)) AS sha256, arg_max(o_totalprice, (o_orderdate, o_orderkey)) AS size FROM orders GROUP BY o_custkey")
def artifact_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    digest = F.sha2(F.concat("o_orderpriority", F.col("o_orderkey").cast("string")), 256)
    """Orders as versions of their customer's file: none is known before, and the last of the new ones counts."""
    at = F.unix_timestamp("o_orderdate") * 100_000_000 + F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias("path"), digest.alias("sha256"), F.col("o_totalprice").alias("size"), at.alias("at"))
    known = rows.limit(0).drop("at")
    return manifest.upserted(known, rows).select(F.col("path").cast("bigint").alias("o_custkey"), "sha256", "size")


# --- rules ----------------------------------------------------------------------------------------------------------


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%dT00:00:00.000Z') AS instant FROM orders")
def http_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    header = F.date_format("o_orderdate", "EEE, dd MMM yyyy '00:00:00 GMT'")
    return table(spark, sf_dir, "orders").select("o_orderkey", rules.instant_of_http_date(header).alias("instant"))


@query("SELECT o_orderkey, CAST(year(o_orderdate) AS VARCHAR) || '-05-01T00:00:00Z/' || CAST(year(o_orderdate) AS VARCHAR) || '-09-30T23:59:59Z' AS season FROM orders")
def season_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", text.season_range(F.year("o_orderdate"), "05-01", "09-30").alias("season"))


@query("SELECT p_partkey, CAST(greatest(p_size, ceil(1.0 / ((p_partkey % 20 + 1) / 40.0))) AS INTEGER) AS steps, CAST(CASE WHEN floor((p_partkey % 20 + 1) / 40.0 * p_size) < 1 THEN greatest(p_size, ceil(1.0 / ((p_partkey % 20 + 1) / 40.0))) ELSE p_size END AS INTEGER) AS raised, CAST(greatest(8, floor(p_size * 7 / 8) * 8) AS INTEGER) AS side FROM part")
def generation_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    strength = (F.col("p_partkey") % 20 + 1) / F.lit(40.0)
    return table(spark, sf_dir, "part").select("p_partkey", rules.effective_steps(F.col("p_size"), strength).alias("steps"), rules.raised_steps(F.col("p_size"), strength).alias("raised"), rules.multiple_of_eight(F.col("p_size") * 7).alias("side"))


@query("""WITH p AS (SELECT user_id, value AS x, CAST(event_id % 1000 AS DOUBLE) AS y FROM events)
SELECT user_id, min(x) AS west, min(y) AS south, max(x) AS east, max(y) AS north, min(x) >= -1000 AND min(y) >= 0 AND max(x) <= 100 AND max(y) <= 999 AS inside FROM p GROUP BY user_id""")
def point_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = table(spark, sf_dir, "events").groupBy("user_id").agg(rules.bbox_over(F.col("value"), (F.col("event_id") % 1000).cast("double")).alias("b"))
    frame = F.array(*[F.lit(v) for v in (-1000.0, 0.0, 100.0, 999.0)])
    return found.select("user_id", *[F.col("b")[i].alias(n) for i, n in enumerate(("west", "south", "east", "north"))], rules.covers(frame, F.col("b"), 0.0).alias("inside"))


@query(f"WITH {_TILES_SQL}, d AS (SELECT DISTINCT x FROM t), n AS (SELECT x, lead(x) OVER (ORDER BY x) AS nx FROM d) SELECT x AS gap_from, nx AS gap_to FROM n WHERE nx > x + 1")
def tile_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return seams.index_gaps(_tiles(spark, sf_dir), "x").toDF("gap_from", "gap_to")


def _strip_sql(strip: int) -> str:
    """Each tile's first columns beside the last ones of the tile to its left; a strip of one column has no gradient."""
    grid = ", ".join(f"greatest(0, least({most}, {c} {d:+d})) AS {c}{n}" for c, most in (("r", 7), ("c", strip - 1)) for n, d in (("a", -1), ("z", 1)))
    side = lambda v, at, n: f"{v}[8 * {at[0]} + {at[1]} + {n}]"
    def slope(v: str, n: int) -> str:
        at = lambda r, c: side(v, (r, c), n)
        gx = f"({at('ra', 'cz')} + 2 * {at('r', 'cz')} + {at('rz', 'cz')} - {at('ra', 'ca')} - 2 * {at('r', 'ca')} - {at('rz', 'ca')})"
        gy = f"({at('rz', 'ca')} + 2 * {at('rz', 'c')} + {at('rz', 'cz')} - {at('ra', 'ca')} - 2 * {at('ra', 'c')} - {at('ra', 'cz')})"
        return f"sqrt({gx} * {gx} + {gy} * {gy})"

    steep = f"abs({slope('a', 1)} - {slope('b', 9 - strip)})" if strip > 1 else "0.0"
    return f"""WITH e AS (SELECT vec_id, CAST(vec_id % 20 AS INTEGER) AS place, [CAST(x AS DOUBLE) FOR x IN embedding] AS v FROM embeddings),
p AS (SELECT *, {grid} FROM (SELECT a.vec_id, a.v AS a, b.v AS b, k // {strip} AS r, k % {strip} AS c FROM e a JOIN e b ON b.vec_id = a.vec_id - 1 AND a.place > 0, (SELECT unnest(range({8 * strip})) AS k))),
s AS (SELECT vec_id, a[8 * r + c + 1] - b[8 * r + c + {9 - strip}] AS g, {steep} AS s FROM p),
m AS (SELECT vec_id, avg(abs(g)) + 0.25 * avg(g * g) + 0.5 * avg(s) AS seam FROM s GROUP BY vec_id)
SELECT place, vec_id // 20 AS variant_row, round(coalesce(seam, 0), 9) AS seam FROM e LEFT JOIN m USING (vec_id)"""


def _strips(spark: SparkSession, sf_dir: str, strip: int) -> DataFrame:
    """The vectors are rows of 20 tiles of 8 x 8 pixels, each scored against its left neighbour."""
    pixels = table(spark, sf_dir, "embeddings").select((F.col("vec_id") % 20).cast("int").alias("x"), F.floor(F.col("vec_id") / 20).alias("y"), F.posexplode("embedding").alias("at", "v"))
    pixels = pixels.select("x", (F.col("y") * 2).alias("y"), F.floor(F.col("at") / 8).cast("int").alias("row"), (F.col("at") % 8).alias("col"), F.col("v").cast("double").alias("value"))
    scored = seams.strip_scores(pixels.withColumn("variant", F.lit(0)), pixels, 8, strip)
    return scored.select(F.col("x").alias("place"), (F.col("y") / 2).cast("bigint").alias("variant_row"), F.round("seam", 9).alias("seam"))


@query(_strip_sql(1))
def candidate_strips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _strips(spark, sf_dir, 1)


@query(_strip_sql(3))
def candidate_strips_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _strips(spark, sf_dir, 3)


@query("""WITH p AS (SELECT CAST(l_suppkey AS BIGINT) AS out_row, l_linenumber * 3 AS out_col, CAST(floor(avg(abs(l_extendedprice / 200000 - l_quantity / 50)) * 255) AS INTEGER) AS level FROM lineitem GROUP BY 1, 2),
d AS (SELECT out_row, out_col - k AS out_col, level / greatest((SELECT max(level) FROM p), 1) AS t FROM p, (SELECT unnest([0, 1]) AS k))
SELECT out_row, CAST(out_col AS INTEGER) AS out_col, CAST(CASE WHEN t < 0.5 THEN round_even(255 * (2 * t), 0) ELSE 255 END AS INTEGER) AS r,
CAST(CASE WHEN t < 0.5 THEN 0 WHEN t < 0.85 THEN round_even(255 * (t - 0.5) / 0.35, 0) ELSE 255 END AS INTEGER) AS g, CAST(CASE WHEN t < 0.85 THEN 0 ELSE round_even(255 * (t - 0.85) / 0.15, 0) END AS INTEGER) AS b FROM d""")
def seam_heatmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every supplier is a row of a picture, every line number a vertical seam three pixels from the next."""
    sides = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("out_row"), (F.col("l_linenumber") * 3).alias("out_col"), (F.col("l_extendedprice") / 200000).alias("a"), (F.col("l_quantity") / 50).alias("b"))
    profile = seams.seam_profile(sides, ["out_row"], "out_col").withColumn("axis", F.lit("v"))
    return seams.heatmap(profile)


# --- mosaics and joins of tiles: vectors as tiles of 8 x 8 pixels, 20 in a row, with a margin of one pixel at each side ---

_MOSAIC_SQL = "t AS (SELECT CAST(vec_id % 20 AS INTEGER) AS x, CAST(vec_id // 20 AS INTEGER) AS y, CAST(k // 8 AS INTEGER) AS r, CAST(k % 8 AS INTEGER) AS c, CAST(floor(embedding[k + 1] * 1000) AS INTEGER) + 1000 AS v FROM embeddings, (SELECT unnest(range(64)) AS k))"


def _mosaic_pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products stay in single precision, as in SQL: just below a whole number they may round up to it."""
    pixels = table(spark, sf_dir, "embeddings").select((F.col("vec_id") % 20).cast("int").alias("x"), F.floor(F.col("vec_id") / 20).cast("int").alias("y"), F.posexplode("embedding").alias("k", "f"))
    return pixels.select("x", "y", F.floor(F.col("k") / 8).cast("int").alias("row"), (F.col("k") % 8).cast("int").alias("col"), (F.floor(F.col("f") * F.lit(1000).cast("float")) + 1000).cast("int").alias("v"))


@query(f"WITH {_MOSAIC_SQL} SELECT y * 6 + r - 1 AS out_row, x * 6 + c - 1 AS out_col, v FROM t WHERE r BETWEEN 1 AND 6 AND c BETWEEN 1 AND 6")
def mosaic_crop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mosaics.cropped(_mosaic_pixels(spark, sf_dir), 8, 1 / 6)


@query(f"""WITH {_MOSAIC_SQL}, a AS (SELECT r, l.x, l.y, n.c - 1 AS d, l.v AS a, n.v AS b, (l.v + n.v) / 2.0 AS m FROM t l JOIN t n USING (r) WHERE n.x = l.x + 1 AND n.y = l.y AND l.c = 7 - n.c AND n.c BETWEEN 1 AND 4)
SELECT x, y, r AS along, CAST(d AS INTEGER) AS distance, round(CASE d WHEN 0 THEN m WHEN 1 THEN (a + 2 * m) / 3 WHEN 2 THEN (2 * a + m) / 3 ELSE a END, 6) AS left_value,
round(CASE d WHEN 0 THEN m WHEN 1 THEN (b + 2 * m) / 3 WHEN 2 THEN (2 * b + m) / 3 ELSE b END, 6) AS right_value FROM a""")
def seam_meeting_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What both sides of each vertical seam become, four pixels wide."""
    pixels = _mosaic_pixels(spark, sf_dir)
    strips = mosaics.seam_strips(pixels, tiles.neighbours(pixels.select("x", "y").distinct()).where("axis = 'v'"), 8, 1 / 6, 4, ["v"])
    met = seams.harmonised(strips.withColumnRenamed("a_v", "a").withColumnRenamed("b_v", "b"), 4)
    value = lambda c: F.round(F.col(c).cast("double"), 6)
    return met.select("x", "y", "along", F.col("distance").cast("int").alias("distance"), value("a").alias("left_value"), value("b").alias("right_value"))


@query(f"""WITH {_MOSAIC_SQL}, a AS (
SELECT y * 6 + r - 1 AS out_row, x * 6 + c - 1 AS out_col, v FROM t WHERE r BETWEEN 1 AND 6 AND c BETWEEN 1 AND 6
UNION ALL SELECT t.y * 6 + r - 1, t.x * 6 + c - 1, v FROM t JOIN (SELECT DISTINCT x, y FROM t) n ON n.x = t.x + 1 AND n.y = t.y WHERE r BETWEEN 1 AND 6 AND c = 7
UNION ALL SELECT t.y * 6 + r - 1, t.x * 6 + c - 1, v FROM t JOIN (SELECT DISTINCT x, y FROM t) n ON n.x = t.x AND n.y = t.y + 1 WHERE r = 7 AND c BETWEEN 1 AND 6
UNION ALL SELECT t.y * 6 + r - 1, t.x * 6 + c - 1, v FROM t JOIN (SELECT DISTINCT x, y FROM t) n ON n.x = t.x + 1 AND n.y = t.y JOIN (SELECT DISTINCT x, y FROM t) s ON s.x = t.x AND s.y = t.y + 1 WHERE r = 7 AND c = 7)
SELECT out_row, out_col, CAST(floor(sum(v) / count(*) + 1e-9) AS INTEGER) AS v FROM a GROUP BY out_row, out_col""")
def mosaic_feather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole tiles laid over each other. With a ramp of one pixel a tile's pixel before its core weighs 0 and that after it 1."""
    return mosaics.blended(_mosaic_pixels(spark, sf_dir), 8, 1 / 6, ["v"])


@query(f"WITH {_TILES_SQL} SELECT max(x) - min(x) + 1 AS width, CAST((max(x) - min(x) + 1) * (max(y) - min(y) + 1) AS BIGINT) AS expected, count(*) AS found, CAST((max(x) - min(x) + 1) * (max(y) - min(y) + 1) AS BIGINT) - count(*) AS missing FROM t")
def mosaic_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mosaics.layout_report(_tiles(spark, sf_dir)).select((F.col("x_max") - F.col("x_min") + 1).alias("width"), "expected", "found", "missing")


@query("""WITH o AS (SELECT o_orderkey AS id, CAST(o_orderkey * 37 % 9000 AS DOUBLE) AS x0, CAST(o_custkey * 53 % 9000 AS DOUBLE) AS y0, CAST(o_orderkey * 37 % 9000 + 3 + o_orderkey % 60 AS DOUBLE) AS x1, CAST(o_custkey * 53 % 9000 + 3 + o_custkey % 60 AS DOUBLE) AS y1 FROM orders),
c AS (SELECT c_custkey AS id, CAST(c_custkey * 91 % 9000 AS DOUBLE) AS x0, CAST(c_custkey * 17 % 9000 AS DOUBLE) AS y0, CAST(c_custkey * 91 % 9000 + 200 AS DOUBLE) AS x1, CAST(c_custkey * 17 % 9000 + 100 AS DOUBLE) AS y1 FROM customer)
SELECT c.id AS c_custkey, count(*) AS met FROM c JOIN o ON o.x0 < c.x1 AND c.x0 < o.x1 AND o.y0 < c.y1 AND c.y0 < o.y1 GROUP BY c.id""")
def spatial_overlap_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    def box(name: str, key: str, x: F.Column, y: F.Column, w: F.Column, h: F.Column, out: str) -> DataFrame:
        return table(spark, sf_dir, name).select(F.col(key).alias(out), x.cast("double").alias("x0"), y.cast("double").alias("y0"), (x + w).cast("double").alias("x1"), (y + h).cast("double").alias("y1"))

    o, c = F.col("o_orderkey"), F.col("c_custkey")
    orders = box("orders", "o_orderkey", o * 37 % 9000, F.col("o_custkey") * 53 % 9000, 3 + o % 60, 3 + F.col("o_custkey") % 60, "rid")
    customers = box("customer", "c_custkey", c * 91 % 9000, c * 17 % 9000, F.lit(200), F.lit(100), "lid")
    return ingest.overlap_counts(customers, orders, 250).withColumnRenamed("lid", "c_custkey")


@query("""WITH o AS (SELECT 'file/' || CAST(o_custkey % 500 AS VARCHAR) AS path, sha256(CAST(o_orderkey AS VARCHAR)) AS sha256, o_orderkey AS size, o_orderkey AS seq FROM orders),
e AS (SELECT 'file/' || CAST(c_custkey % 700 AS VARCHAR) AS path, max(sha256(CAST(c_custkey AS VARCHAR))) AS sha256, max(c_custkey) AS size FROM customer GROUP BY 1),
n AS (SELECT path, arg_max(sha256, seq) AS sha256, arg_max(size, seq) AS size FROM o GROUP BY path)
SELECT coalesce(n.path, e.path) AS path, coalesce(n.sha256, e.sha256) AS sha256, CAST(coalesce(n.size, e.size) AS BIGINT) AS size FROM e FULL JOIN n ON n.path = e.path""")
def manifest_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    file = lambda c, m: F.concat(F.lit("file/"), (F.col(c) % m).cast("string")).alias("path")
    digest = lambda c: F.sha2(F.col(c).cast("string"), 256)
    new = table(spark, sf_dir, "orders").select(file("o_custkey", 500), digest("o_orderkey").alias("sha256"), F.col("o_orderkey").alias("size"), F.col("o_orderkey").alias("at"))
    old = table(spark, sf_dir, "customer").groupBy(file("c_custkey", 700)).agg(F.max(digest("c_custkey")).alias("sha256"), F.max("c_custkey").alias("size"))
    return manifest.upserted(old, new)


@query("""SELECT 'scene/' || CAST(event_id AS VARCHAR) AS id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS datetime, CASE WHEN event_id % 5 <> 0 THEN CAST(event_id % 100 AS DOUBLE) END AS cloud_cover,
CASE WHEN event_id % 3 = 0 THEN 'T' || CAST(user_id AS VARCHAR) ELSE '42T' || event_type END AS tile_id, 'red/' || CAST(event_id AS VARCHAR) AS red FROM events""")
def stac_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a catalogue item, ten thousand at most on a page."""
    number = F.col("event_id").cast("string")
    properties = F.struct(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("datetime"), F.when(F.col("event_id") % 5 != 0, (F.col("event_id") % 100).cast("double")).alias("eo:cloud_cover"),
        F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("T"), F.col("user_id").cast("string"))).alias("s2:tile_id"), F.lit(42).alias("mgrs:utm_zone"), F.lit("T").alias("mgrs:latitude_band"), F.col("event_type").alias("mgrs:grid_square"),
    )
    assets = F.struct(*[F.struct(F.concat(F.lit(f"{k}/"), number).alias("href")).alias(k) for k in ("red", "nir", "scl")])
    item = F.struct(F.concat(F.lit("scene/"), number).alias("id"), properties.alias("properties"), assets.alias("assets"))
    pages = table(spark, sf_dir, "events").groupBy(F.floor(F.col("event_id") / 10_000)).agg(F.to_json(F.struct(F.collect_list(item).alias("features"))).alias("value"))
    return stac.items(pages).select("id", "datetime", "cloud_cover", "tile_id", F.col("assets.red").alias("red"))


# --- geometry kernels: customers as squares, every tenth one crossed, every seventh without a shape --------------------


def _feature_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    x, y, s = F.col("c_custkey") % 300 * 100, F.floor(F.col("c_custkey") / 300) * 100, F.col("c_custkey") % 50 + 1
    corner = lambda a, b: F.format_string("[%d,%d]", (x + s * a).cast("bigint"), (y + s * b).cast("bigint"))
    ring = lambda *corners: F.concat(F.lit("[["), F.concat_ws(",", *[corner(*c) for c in corners]), F.lit("]]"))
    shape = F.when(F.col("c_custkey") % 10 == 0, ring((0, 0), (1, 1), (1, 0), (0, 1), (0, 0))).otherwise(ring((0, 0), (1, 0), (1, 1), (0, 1), (0, 0)))
    node = F.when(F.col("c_custkey") % 7 == 0, F.lit("null")).otherwise(F.concat(F.lit('{"type":"Polygon","coordinates":'), shape, F.lit("}")))
    line = F.concat(F.lit('{"type":"Feature","properties":{"@type":"way","@id":'), F.col("c_custkey").cast("string"), F.lit(',"building":"'), F.col("c_mktsegment"), F.lit('","height":"'), (F.col("c_custkey") % 30).cast("string"), F.lit(' m"},"geometry":'), node, F.lit("}"))
    # Dealt before the lines are written, which takes longer than to read the rows.
    return ingest.dealt(table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")).select(line.alias("line"))


@query("""SELECT 'way/' || CAST(c_custkey AS VARCHAR) AS id, c_mktsegment AS class, CAST(c_custkey % 30 AS DOUBLE) AS height_m, CASE WHEN c_custkey % 10 = 0 THEN 'MultiPolygon' ELSE 'Polygon' END AS kind,
CAST((c_custkey % 50 + 1) * (c_custkey % 50 + 1) AS DOUBLE) / CASE WHEN c_custkey % 10 = 0 THEN 2 ELSE 1 END AS area FROM customer WHERE c_custkey % 7 <> 0""")
def ingest_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = ingest.ingest(_feature_lines(spark, sf_dir), "buildings")
    return heights.with_heights(rows).select("id", "class", "height_m", geometry.st_kind("geometry").alias("kind"), F.round(geometry.st_area("geometry"), 6).alias("area"))


@query("SELECT count(*) AS input, count(*) FILTER (c_custkey % 7 <> 0) AS written, count(*) FILTER (c_custkey % 7 = 0) AS dropped_empty, count(*) FILTER (c_custkey % 7 <> 0 AND c_custkey % 10 = 0) AS invalid, count(*) FILTER (c_custkey % 7 <> 0 AND c_custkey % 10 = 0) AS fixed FROM customer")
def ingest_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.ingest(_feature_lines(spark, sf_dir), "buildings")[1].select("input", "written", "dropped_empty", "invalid", "fixed")


@query("""SELECT 'way/' || CAST(c_custkey AS VARCHAR) AS id, CAST((c_custkey % 50 + 1) * (c_custkey % 50 + 1) AS DOUBLE) / CASE WHEN c_custkey % 10 = 0 THEN 2 ELSE 1 END AS area FROM customer WHERE c_custkey % 7 <> 0""")
def clipped_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What cells of 7 m cut from each shape adds up to its area."""
    rows, _ = ingest.ingest(_feature_lines(spark, sf_dir), "buildings")
    pieces = rows.select("id", "geometry", geometry.st_envelope("geometry").alias("e")).select("id", "geometry", "e.*")
    met = coverage.with_cell_edges(coverage.cells_touched(pieces, 7), 7)
    return met.groupBy("id").agg(F.round(F.sum(geometry.st_area_within("geometry", "cx0", "cy0", "cx1", "cy1")), 6).alias("area"))


@query()
def isometric_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The squares seen from above at an angle, as tiles of 256 pixels. Pictures have no SQL; tests look at pixels."""
    rows, _ = ingest.ingest(_feature_lines(spark, sf_dir), "buildings")
    drawn = imaging.rendered(heights.with_heights(rows), 256, 0.25, 0.25)
    return drawn.select("tx", "ty", F.sha2("content", 256).alias("sha256"))


@query("SELECT count(*) FILTER (a >= 500) AS kept, count(*) FILTER (a < 500) AS dropped_small FROM (SELECT (c_custkey % 50 + 1) * (c_custkey % 50 + 1) / CASE WHEN c_custkey % 10 = 0 THEN 2.0 ELSE 1.0 END AS a FROM customer WHERE c_custkey % 7 <> 0)")
def large_footprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The squares, taken as lying on the web map, of at least 500 square metres, and how many are smaller."""
    sized = ingest.with_fits(ingest.ingest(_feature_lines(spark, sf_dir), "buildings")[0], 500, 3857)
    return sized.agg(F.count_if("fits").alias("kept"), F.count_if(~F.col("fits")).alias("dropped_small"))  # both in one reading


# --- scenes: orders as scenes of their customers' places -------------------------------------------------------------

_ITEMS_SQL = "i AS (SELECT o_orderkey, o_orderdate, floor(o_totalprice) % 100 AS cloud, o_custkey % 100 AS west, o_custkey % 50 AS south, o_orderpriority AS collection FROM orders)"


def _items(spark: SparkSession, sf_dir: str) -> DataFrame:
    west, south = (F.col("o_custkey") % 100).cast("double"), (F.col("o_custkey") % 50).cast("double")
    return table(spark, sf_dir, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd'T'00:00:00'Z'").alias("datetime"), (F.floor("o_totalprice") % 100).cast("double").alias("cloud_cover"), F.array(west, south, west + 2, south + 1).alias("bbox"), F.col("o_orderpriority").alias("collection"))


@query(f"""WITH {_ITEMS_SQL} SELECT o_orderkey FROM i WHERE o_orderdate >= DATE '1994-05-01' AND o_orderdate <= DATE '1997-09-30' AND cloud <= 60 AND west <= 40 AND west + 2 >= 10 AND south <= 30 AND south + 1 >= 5 AND collection IN ('1-URGENT', '2-HIGH', '3-MEDIUM')""")
def scene_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scenes.matching(_items(spark, sf_dir), "1994-05-01T00:00:00Z", "1997-09-30T23:59:59Z", 60, (10, 5, 40, 30), ("1-URGENT", "2-HIGH", "3-MEDIUM")).select("o_orderkey")


@query("""SELECT string_agg(DISTINCT CAST(year(o_orderdate) AS VARCHAR), ',' ORDER BY CAST(year(o_orderdate) AS VARCHAR)) AS years, CAST(min(year(o_orderdate)) AS VARCHAR) || '-05-01T00:00:00Z' AS datetime_start, CAST(max(year(o_orderdate)) AS VARCHAR) || '-09-30T23:59:59Z' AS datetime_end, count(*) AS items FROM orders""")
def scene_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scenes.year_summary(_items(spark, sf_dir), "05-01", "09-30")
    return found.withColumn("years", F.array_join(F.transform("years", lambda y: y.cast("string")), ","))


@query("""WITH b AS (SELECT c_custkey, c_custkey % 90 * 1.0 AS w, c_nationkey * 2.0 AS s, c_custkey % 90 + 7.5 AS e, c_nationkey * 2.0 + 12.25 AS n FROM customer),
i AS (SELECT c_custkey, greatest(w, 30) AS w, greatest(s, 20) AS s, least(e, 60) AS e, least(n, 50) AS n FROM b)
SELECT c_custkey, CAST(floor((50 - n) / 0.5) AS INTEGER) AS row_off, CAST(floor((w - 30) / 0.5) AS INTEGER) AS col_off, CAST(ceil((n - s) / 0.5) AS INTEGER) AS height, CAST(ceil((e - w) / 0.5) AS INTEGER) AS width FROM i WHERE e > w AND n > s""")
def scene_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The window of one tile that each customer's box covers; boxes beside the tile have none."""
    west, south = (F.col("c_custkey") % 90).cast("double"), F.col("c_nationkey") * 2.0
    tile = F.array(*[F.lit(v) for v in (30.0, 20.0, 60.0, 50.0)])
    window = scenes.area_window(tile, F.array(west, south, west + 7.5, south + 12.25), 0.5)
    return table(spark, sf_dir, "customer").select("c_custkey", window.alias("w")).where("w IS NOT NULL").select("c_custkey", "w.*")


@query("""WITH p AS (SELECT CAST(o_custkey % 5 AS INTEGER) AS scene, CAST(o_orderkey % 32 AS INTEGER) AS r, CAST(o_orderkey // 32 % 32 AS INTEGER) AS c, avg(o_totalprice) AS red, max(o_totalprice) + 1000 AS nir FROM orders GROUP BY 1, 2, 3),
k AS (SELECT CAST(c_custkey % 5 AS INTEGER) AS scene, CAST(c_custkey // 5 % 16 AS INTEGER) AS r, CAST(c_custkey // 80 % 16 AS INTEGER) AS c, min(c_nationkey % 12) AS scl FROM customer GROUP BY 1, 2, 3),
j AS (SELECT p.r, p.c, red, nir, scl FROM p JOIN k ON k.scene = p.scene AND k.r = p.r // 2 AND k.c = p.c // 2 WHERE p.r < 30 AND p.c < 28),
m AS (SELECT r, c, count(*) FILTER (scl NOT IN (0, 1, 3, 8, 9, 10, 11)) AS valid, median((nir - red) / (nir + red)) FILTER (scl NOT IN (0, 1, 3, 8, 9, 10, 11)) AS v FROM j GROUP BY r, c)
SELECT r AS "row", c AS col, valid, round(CASE WHEN valid >= 2 THEN v END, 9) AS ndvi, CASE WHEN valid >= 2 THEN CAST(v >= 0.01 AS INTEGER) END AS green FROM m""")
def scene_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bands of 32 x 32 pixels from orders, classes of half as many from customers, within an area of 30 x 28: joined and composed."""
    place = [(F.col("o_custkey") % 5).cast("int").alias("scene"), (F.col("o_orderkey") % 32).cast("int").alias("row"), (F.floor(F.col("o_orderkey") / 32) % 32).cast("int").alias("col")]
    bands = table(spark, sf_dir, "orders").groupBy(*place)
    half = [(F.col("c_custkey") % 5).cast("int").alias("scene"), (F.floor(F.col("c_custkey") / 5) % 16).cast("int").alias("row"), (F.floor(F.col("c_custkey") / 80) % 16).cast("int").alias("col")]
    classes = table(spark, sf_dir, "customer").groupBy(*half).agg(F.min(F.col("c_nationkey") % 12).alias("value"))
    area = spark.range(30).select(F.col("id").cast("int").alias("row"), F.explode(F.sequence(F.lit(0), F.lit(27))).alias("col"))
    stack = scenes.stacked(bands.agg(F.avg("o_totalprice").alias("value")), bands.agg((F.max("o_totalprice") + 1000).alias("value")), classes, 2, area)
    return rasters.composite(stack, ["row", "col"], min_valid=2, threshold=0.01).withColumn("ndvi", F.round("ndvi", 9))


# --- accounts of a run ------------------------------------------------------------------------------------------------


@query(f"""WITH {_TILES_SQL}, xs AS (SELECT DISTINCT x FROM t), ys AS (SELECT DISTINCT y FROM t), n AS (SELECT (SELECT count(*) FROM xs) AS nx, (SELECT count(*) FROM ys) AS ny,
(SELECT count(*) FROM xs a JOIN xs b ON b.x = a.x + 1) AS px, (SELECT count(*) FROM ys a JOIN ys b ON b.y = a.y + 1) AS py) SELECT px * ny + py * nx AS seams_total, px * py AS intersections_total FROM n""")
def seam_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.seam_totals(_tiles(spark, sf_dir))


@query(f"""WITH {_TILES_SQL}, d AS (SELECT DISTINCT x FROM t), g AS (SELECT x AS a, lead(x) OVER (ORDER BY x) AS nxt FROM d), r AS (SELECT min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1 FROM t),
f AS (SELECT CAST(x AS INTEGER) AS x, CAST(unnest(range(y0, y1 + 1)) AS INTEGER) AS y FROM (SELECT unnest(range(x0, x1 + 1)) AS x, y0, y1 FROM r)),
s AS (SELECT 0 AS rank, 'x_index_gap' AS reason, a, nxt, CAST(nxt - a - 1 AS INTEGER) AS missing FROM g WHERE nxt > a + 1 UNION ALL SELECT 2, 'missing_tile', f.x, f.y, NULL FROM f LEFT JOIN t ON t.x = f.x AND t.y = f.y WHERE t.x IS NULL)
SELECT reason, a AS "at", nxt AS "next", missing FROM s ORDER BY rank, a, nxt LIMIT 256""")
def suspicious_seams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gaps of both axes, then places without a tile; the first 256 are the report."""
    own = _tiles(spark, sf_dir)
    skipped = tiles.missing_tiles(own).select(F.lit("missing_tile").alias("reason"), F.col("x").alias("at"), F.col("y").alias("next"))
    return audit.suspicious({axis: seams.index_gaps(own, axis) for axis in "xy"}, skipped)


@query("""WITH s AS (SELECT user_id AS run_id, event_id % 3 AS k, event_id AS a, CAST(length(event_type) AS BIGINT) AS b FROM events)
SELECT run_id, coalesce(CASE WHEN count(*) FILTER (k = 2) > 0 THEN max(a) FILTER (k = 2) ELSE max(a) FILTER (k = 0) END, 0) AS seams_total, coalesce(CASE WHEN count(*) FILTER (k = 2) > 0 THEN max(b) FILTER (k = 2) ELSE max(b) FILTER (k = 0) END, 0) AS seams_skipped,
coalesce(max(a) FILTER (k = 0), 0) AS base_seams_total, coalesce(max(a) FILTER (k = 2), 0) AS post_global_seams_total, coalesce(max(b) FILTER (k = 1), 0) AS global_intersections_skipped, count(*) FILTER (k = 1) > 0 AS global_pass_enabled FROM s GROUP BY run_id""")
def run_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    stage = F.element_at(F.array(*map(F.lit, ("seam", "global", "refine"))), (F.col("event_id") % 3 + 1).cast("int"))
    total, skipped = F.col("event_id"), F.length("event_type").cast("bigint")
    counters = [(skipped if c.endswith("skipped") else total).alias(c) for c in audit.COUNTERS]
    report = audit.quality_report(table(spark, sf_dir, "events").select(F.col("user_id").alias("run_id"), stage.alias("stage"), *counters))
    return report.select("run_id", "seams_total", "seams_skipped", "base_seams_total", "post_global_seams_total", "global_intersections_skipped", "global_pass_enabled")


# --- models, prompts and paths ----------------------------------------------------------------------------------------


@query("SELECT p_partkey, NOT contains(lower(trim(coalesce(CASE p_partkey % 3 WHEN 0 THEN ' Gemini-2.' || p_type WHEN 1 THEN p_name END, ''))), 'gemini-2.') AS allowed FROM part")
def allowed_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit(" Gemini-2."), "p_type")).when(F.col("p_partkey") % 3 == 1, F.col("p_name"))
    return table(spark, sf_dir, "part").select("p_partkey", text.is_allowed_model(model).alias("allowed"))


_RULES_SQL = {
    "head": "'Hard constraints:'", "lean": "'- Lean on the COLOR REFERENCE to keep Tashkent-specific turquoise/mint/blue roofs instead of drifting toward generic browns.'",
    "keep": "'- Preserve per-building roof colors/materials from the ' || {} || ' tile; avoid homogenizing everything.'",
    "tail": "'- Do not copy the anchors or neighbors; use them only as style references.' || chr(10) || '- Do not introduce new large objects that cross tile boundaries.' || chr(10) || '- Keep global lighting/camera consistent with the anchors.'",
}


@query(f"""SELECT conv_id, turn, sha256(trim(replace(replace('The image labeled WHITEBOX: ' || text, 'labeled WHITEBOX', 'labeled INPUT TILE'), 'WHITEBOX', 'INPUT TILE'), ' ') || chr(10) || chr(10) || {_RULES_SQL["head"]} || chr(10) ||
CASE WHEN turn % 3 = 0 THEN {_RULES_SQL["keep"].format("'COLOR REFERENCE'")} || chr(10) || {_RULES_SQL["lean"]} || chr(10) WHEN role = 'user' THEN {_RULES_SQL["keep"].format("'input'")} || chr(10) ELSE '' END || {_RULES_SQL["tail"]}) AS prompt_hash FROM conversations""")
def prompt_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    layer = F.when(F.col("role") == "user", "raw").otherwise("sd_WhiteBox")
    prompt = text.assembled_prompt(F.concat(F.lit("The image labeled WHITEBOX: "), "text"), layer, F.col("turn") % 3 == 0)
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.sha2(prompt, 256).alias("prompt_hash"))


@query("WITH p AS (SELECT page_id, url, CASE page_id % 3 WHEN 0 THEN regexp_extract(url, '^[^/]*//[^/]*') || '/' WHEN 1 THEN url ELSE 'other' END AS root FROM pages), r AS (SELECT page_id, url, regexp_replace(root, '/+$', '') AS root FROM p) SELECT page_id, CASE WHEN url = root THEN '.' WHEN starts_with(url, root || '/') THEN substr(url, length(root) + 2) ELSE url END AS path FROM r")
def relative_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = F.when(F.col("page_id") % 3 == 0, F.concat(F.regexp_extract("url", "^[^/]*//[^/]*", 0), F.lit("/"))).when(F.col("page_id") % 3 == 1, F.col("url")).otherwise("other")
    return table(spark, sf_dir, "pages").select("page_id", text.path_below(root, F.col("url")).alias("path"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority ELSE 'ff' || lower(hex(o_orderpriority)) END AS bytes, strftime(o_orderdate, '%Y-%m-%d') AS day, o_custkey FROM orders")
def json_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes that are text and bytes that aren't, a date and a number, as JSON can hold them."""
    raw = F.encode("o_orderpriority", "UTF-8")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 2 == 0, raw).otherwise(F.concat(F.lit(b"\xff"), raw)).alias("bytes"), F.col("o_orderdate").cast("date").alias("day"), "o_custkey")
    return rows.select(*geojsonseq.jsonable(rows, ["o_orderkey", "bytes", "day", "o_custkey"]))
