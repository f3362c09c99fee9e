"""From catalogue items to a stack of pixels: which scenes, which window, bands on one grid, and the summary over years."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terraloom.functions.text import season_range
from terraloom.operators.rasters import expanded


def matching(items: DataFrame, start: str, end: str, most_cloud: float, bbox: tuple[float, float, float, float] | None = None, collections: tuple[str, ...] = ()) -> DataFrame:
    """Items within a time range (both ends included) and under a cloud cover; of given collections and meeting a box, where there are such columns (collection, bbox). Unknown values don't match."""
    kept = items.where((F.col("datetime").cast("timestamp") >= F.lit(start).cast("timestamp")) & (F.col("datetime").cast("timestamp") <= F.lit(end).cast("timestamp")) & (F.col("cloud_cover") <= most_cloud))
    if collections and "collection" in items.columns:
        kept = kept.where(F.col("collection").isin(*collections))
    if bbox and "bbox" in items.columns:
        west, south, east, north = bbox
        own = lambda i: F.col("bbox")[i]
        kept = kept.where((own(0) <= east) & (own(2) >= west) & (own(1) <= north) & (own(3) >= south))
    return kept


def search_body(collection: str, bbox: tuple[float, float, float, float], season: str, most_cloud: float, page: int = 200) -> dict:
    """The request that asks a catalogue for the same."""
    return {"collections": [collection], "bbox": list(bbox), "datetime": season, "limit": page, "query": {"eo:cloud_cover": {"lte": most_cloud}}}


def year_summary(items: DataFrame, first_day: str, last_day: str) -> DataFrame:
    """years (sorted), start of the first year's season, end of the last one's, and the number of items."""
    year = F.year(F.col("datetime").cast("timestamp"))
    out = items.agg(F.sort_array(F.collect_set(year)).alias("years"), F.min(year).alias("_first"), F.max(year).alias("_last"), F.count("*").alias("items"))
    ends = lambda y: F.split(season_range(F.col(y), first_day, last_day), "/")
    return out.select("years", ends("_first")[0].alias("datetime_start"), ends("_last")[1].alias("datetime_end"), "items")


def area_window(tile: Column, area: Column, pixel: Column | float) -> Column:
    """The window of a raster (tile and area as west, south, east, north) that covers the common box: row_off, col_off, height, width, the offsets cut down and the lengths rounded up; null where they don't meet."""
    size = pixel if isinstance(pixel, Column) else F.lit(float(pixel))
    west, south, east, north = F.greatest(tile[0], area[0]), F.greatest(tile[1], area[1]), F.least(tile[2], area[2]), F.least(tile[3], area[3])
    cut = lambda c: F.floor(c / size).cast("int")
    up = lambda c: F.ceil(c / size).cast("int")
    window = F.struct(cut(tile[3] - north).alias("row_off"), cut(west - tile[0]).alias("col_off"), up(north - south).alias("height"), up(east - west).alias("width"))
    return F.when((east > west) & (north > south), window)


def within_window(pixels: DataFrame, window: Column) -> DataFrame:
    """Pixels (row, col) of a window, counted from its corner."""
    row, col = F.col("row") - window["row_off"], F.col("col") - window["col_off"]
    kept = pixels.where((row >= 0) & (row < window["height"]) & (col >= 0) & (col < window["width"]))
    return kept.withColumns({"row": row, "col": col})


def stacked(red: DataFrame, nir: DataFrame, classes: DataFrame, factor: int = 2, area: DataFrame | None = None) -> DataFrame:
    """scene, row, col, red, nir, scl of each pixel that both bands have, on their grid; the class is that of the ``factor`` times larger pixel that holds it. Only pixels of ``area``, where given: (row, col), or spans (row, first, last) as ``rasters.area_spans`` makes them of a polygon.

    Bands are (scene, row, col, value). All are equality joins on keys; the first two share their partitioning.
    """
    keys = ["scene", "row", "col"]
    both = red.select(*keys, F.col("value").alias("red")).join(nir.select(*keys, F.col("value").alias("nir")), keys)
    if area is not None:
        area = expanded(area) if "first" in area.columns else area
        both = both.join(area.select("row", "col"), ["row", "col"], "left_semi")
    coarse = classes.select("scene", F.col("row").alias("_row"), F.col("col").alias("_col"), F.col("value").alias("scl"))
    fine = both.withColumns({"_row": F.floor(F.col("row") / factor).cast("int"), "_col": F.floor(F.col("col") / factor).cast("int")})
    return fine.join(coarse, ["scene", "_row", "_col"]).select(*keys, "red", "nir", "scl")
