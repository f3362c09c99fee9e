"""Pixel tables: vegetation composites over scenes, mosaics of tiles, and binary morphology.

A raster is a long table keyed by pixel. No operator collects a raster: composites group by pixel, mosaics by world pixel,
and morphology runs on chunks with a margin.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terraloom.functions import geometry as g
from terraloom.functions.spans import centre_spans as spans_of_centres
from terraloom.functions.spans import joined as joined_spans
from terraloom.operators import chunks

#: Scene classes that are never vegetation (no data, saturated, shadow, clouds, snow).
EXCLUDED_CLASSES = (0, 1, 3, 8, 9, 10, 11)
MIN_VALID, THRESHOLD, NODATA, MASK_NODATA = 3, 0.3, -9999.0, 255


def valid_pixel(excluded: tuple[int, ...] = EXCLUDED_CLASSES) -> Column:
    return ~F.col("scl").isin(*sorted({0, *excluded})) & (F.col("red") > 0) & (F.col("nir") > 0)


def ndvi() -> Column:
    return (F.col("nir") - F.col("red")) / (F.col("nir") + F.col("red"))


def composite(stack: DataFrame, keys: list[str], excluded: tuple[int, ...] = EXCLUDED_CLASSES, min_valid: int = MIN_VALID, threshold: float = THRESHOLD) -> DataFrame:
    """valid, ndvi (median over valid scenes, null under ``min_valid``) and green (1, 0 or null) of each pixel."""
    value = F.when(valid_pixel(excluded), ndvi())
    out = stack.groupBy(*keys).agg(F.count(value).alias("valid"), F.median(value).alias("_median"))
    out = out.withColumn("ndvi", F.when(F.col("valid") >= min_valid, F.col("_median"))).drop("_median")
    return out.withColumn("green", F.when(F.col("ndvi").isNotNull(), (F.col("ndvi") >= threshold).cast("int")))


def first_valid(tiles: DataFrame, pixel: list[str], order: list[str], value: str) -> DataFrame:
    """Of overlapping tiles the first non-null value in tile order, at each world pixel."""
    return tiles.where(F.col(value).isNotNull()).groupBy(*pixel).agg(F.min_by(value, F.struct(*order)).alias(value))


def blended(tiles: DataFrame, pixel: list[str], value: str, weight: str) -> DataFrame:
    """Weighted mean at each output pixel; null where all weights are 0."""
    total = F.sum(weight)
    return tiles.groupBy(*pixel).agg(F.when(total > 0, F.sum(F.col(value) * F.col(weight)) / total).alias(value))


def _stepped(mask: DataFrame, steps: list[tuple[int, int]]) -> DataFrame:
    """Steps of morphology in one shuffle: chunks with as many pixels around them as there are steps."""
    out = chunks.by_chunk(mask, [], "bit", sum(times for times, _ in steps), chunks.morphology(steps), "bit")
    return out.select(F.col("row").cast(mask.schema["row"].dataType).alias("row"), F.col("col").cast(mask.schema["col"].dataType).alias("col"), F.col("bit").cast("int").alias("bit"))


def dilated(mask: DataFrame, radius: int = 1) -> DataFrame:
    return _stepped(mask, [(radius, 1)])


def eroded(mask: DataFrame, radius: int = 1) -> DataFrame:
    """What lies outside counts as 0."""
    return _stepped(mask, [(radius, 9)])


def opened(mask: DataFrame, radius: int = 1) -> DataFrame:
    return _stepped(mask, [(radius, 9), (radius, 1)])


def closed(mask: DataFrame, radius: int = 1) -> DataFrame:
    return _stepped(mask, [(radius, 1), (radius, 9)])


def cleaned(mask: DataFrame, open_radius: int = 1, close_radius: int = 1) -> DataFrame:
    """Opening, then closing, with missing pixels (null bits) as 0; they are missing again afterwards. One shuffle in all."""
    steps = chunks.morphology([(open_radius, 9), (open_radius, 1), (close_radius, 1), (close_radius, 9)])
    kernel = lambda bits, there: np.where(np.isnan(bits), np.nan, steps(bits, there))
    out = chunks.by_chunk(mask, [], "bit", 2 * (open_radius + close_radius), kernel, "bit")
    return out.select("row", "col", F.when(~F.isnan("bit"), F.col("bit").cast("int")).alias("bit"))


def mask_report(mask: DataFrame) -> DataFrame:
    valid, green = F.count("bit"), F.count_if(F.col("bit") == 1)
    return mask.agg(valid.alias("valid_px"), green.alias("green_px"), F.when(valid > 0, green / valid).alias("green_ratio"))


def pixels_within(shapes: DataFrame, left: float, top: float, pixel: float, rows: int | None = None, cols: int | None = None, key: str = "id") -> DataFrame:
    """(key, row, first, last): spans of pixels whose centres a shape (geometry, rows counted downwards from ``top``) holds; null and unreadable shapes have none.

    Each polygon of a shape counts by itself, its holes left out. Without ``rows`` or ``cols`` the grid has no end that way, nor a beginning: pixels above or left of its corner have numbers below 0.
    """
    kind = shapes.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers, found = [np.empty(0, np.int64)], [np.empty((0, 3), np.int64)]
            for i, data in enumerate(batch.column(1).to_pylist()):
                try:
                    shape = g.from_wkb(data) if data is not None else None
                except ValueError:
                    continue
                if shape is None or not shape[0].endswith("Polygon"):
                    continue
                for polygon in shape[1]:
                    rings = [np.column_stack([(r[:, 0] - left) / pixel, (top - r[:, 1]) / pixel]) for r in polygon]
                    spans = spans_of_centres(rings, None if rows is None else (0, rows), cols)
                    found.append(spans)
                    numbers.append(np.full(len(spans), i))
            whole = np.concatenate(found).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(np.concatenate(numbers))), *map(pa.array, whole.T)], names=["key", "row", "first", "last"])

    found = shapes.select(F.col(key).alias("key"), "geometry").mapInArrow(run, f"key {kind}, row int, first int, last int")
    return found.withColumnRenamed("key", key)


def area_spans(spark: SparkSession, area: bytes, left: float, top: float, pixel: float, rows: int, cols: int, block: int = 1024) -> DataFrame:
    """(row, first, last) of one area, its rows dealt to tasks by blocks; of parts that lie over each other pixels come once."""
    polygons = [[np.column_stack([(r[:, 0] - left) / pixel, (top - r[:, 1]) / pixel]) for r in p] for p in g.from_wkb(area)[1]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in batch.column(0).to_pylist():
                spans = np.concatenate([spans_of_centres(rings, (start * block, min((start + 1) * block, rows)), cols) for rings in polygons])
                whole = np.stack(joined_spans(*spans.T), 1).astype(np.int32)
                yield pa.RecordBatch.from_arrays(list(map(pa.array, whole.T)), names=["row", "first", "last"])

    return spark.range(-(-rows // block)).mapInArrow(run, "row int, first int, last int")


def expanded(spans: DataFrame) -> DataFrame:
    """The pixels of spans: what else they have, row, col."""
    return spans.select(*[c for c in spans.columns if c not in ("first", "last")], F.explode(F.sequence("first", "last")).alias("col"))
