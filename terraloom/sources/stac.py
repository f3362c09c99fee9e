"""Catalogue items of scenes: pages of JSON to one normal table."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Band names and their asset keys.
ASSETS = {"B04": "red", "B08": "nir", "SCL": "scl"}
MOST_PAGES = 5000


def pages(fetch: Callable[[dict], dict], body: dict, most: int = MOST_PAGES) -> Iterator[dict]:
    """Follow the next links of a search; ``fetch`` posts a body and returns a page."""
    for _ in range(most):
        page = fetch(body)
        yield page
        following = [link for link in page.get("links", []) if link.get("rel") == "next" and str(link.get("method", "")).upper() == "POST"]
        if not following:
            return
        body = following[0]["body"]
    raise RuntimeError(f"more than {most} pages")


def _text(path: str, kind: str = "string") -> Column:
    return F.try_variant_get("item", path, kind)


def items(documents: DataFrame, bands: tuple[str, ...] = ("B04", "B08", "SCL"), value: str = "value") -> DataFrame:
    """id, datetime, cloud_cover, tile_id, proj_epsg and assets of each item in pages of JSON text. A missing band fails the job."""
    listed = documents.select(F.explode(F.try_variant_get(F.parse_json(value), "$.features", "array<variant>")).alias("item"))
    grid = [_text(f"$.properties['mgrs:{part}']") for part in ("utm_zone", "latitude_band", "grid_square")]
    assets = []
    for band in bands:
        key = ASSETS.get(band, band)
        href = _text(f"$.assets['{key}'].href")
        assets.append(F.coalesce(href, F.raise_error(F.concat(F.lit(f"no {key} in "), _text("$.id")))).alias(key))
    return listed.select(
        _text("$.id").alias("id"), _text("$.properties.datetime").alias("datetime"), _text("$.properties['eo:cloud_cover']", "double").alias("cloud_cover"),
        F.coalesce(_text("$.properties['s2:tile_id']"), F.concat(*grid)).alias("tile_id"), _text("$.properties['proj:epsg']", "int").alias("proj_epsg"), F.struct(*assets).alias("assets"),
    )


def by_tile(found: DataFrame) -> DataFrame:
    return found.groupBy(F.coalesce("tile_id", F.lit("unknown_tile")).alias("tile_id")).agg(F.count("*").alias("items"), F.min("datetime").alias("first"), F.max("datetime").alias("last"))


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Saved pages, one file each."""
    return spark.read.text(path, wholetext=True)
