"""The pyramid of isometric tiles over several zooms, and which shapes each tile may show.

A view is laid out from the ground's size and the greatest height, as one row. Each shape then finds its tiles by itself: the square
that a tile looks up, back on the ground, is a box on the screen, so a shape's outline, seen on the screen, is cut row of tiles by row
of tiles, exactly, and gives spans of tiles. Only (id, zoom, row, first, last) leaves the task: no tile table is joined and no shape is copied to tiles.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terraloom.functions import geometry as g
from terraloom.functions.geometry import slices
from terraloom.functions.spans import ROWS, edges_of, touched_by_many

#: What is added around the view, and around a tile when it looks for shapes, as shares of a tile.
VIEW_PAD, QUERY_PAD = 0.25, 0.35


@dataclass(frozen=True)
class View:
    """A ground of width x height metres at ``scale`` pixels a metre (zoom 0); what stands up to ``top`` metres gets room above."""

    width: float
    height: float
    scale: float
    size: int = 256
    overlap: float = 0.0
    z_scale: float = 1.0
    top: float = 0.0
    zooms: tuple[int, int] = (0, 0)

    def bounds(self) -> tuple[float, float, float, float]:
        pad, s = self.size * VIEW_PAD, self.scale
        return -s * self.height - pad, -pad - self.top * s * self.z_scale, s * self.width + pad, 0.5 * s * (self.width + self.height) + pad

    @property
    def core(self) -> float:
        return self.size / (1 + 2 * self.overlap)

    def level(self, z: int) -> tuple[float, float, int, int]:
        """Left and top of the first core, columns and rows of a zoom."""
        u0, v0, u1, v1 = self.bounds()
        k = 2.0**z
        return u0 * k, v0 * k, math.ceil((u1 - u0) * k / self.core), math.ceil((v1 - v0) * k / self.core)


def view_of(shapes: DataFrame, scale: float, size: int = 256, overlap: float = 0.0, z_scale: float = 1.0, zooms: tuple[int, int] = (0, 0), height: str = "height_m") -> View:
    """The view of all shapes from (0, 0) on; the greatest height counts, of rows without a shape too."""
    row = shapes.select(F.col(height).alias("h"), g.st_envelope("geometry").alias("e")).agg(F.max("e.x1").alias("w"), F.max("e.y1").alias("d"), F.max("h").alias("h")).first()
    return View(row["w"] or 0.0, row["d"] or 0.0, scale, size, overlap, z_scale, row["h"] or 0.0, zooms)


def layout(spark: SparkSession, view: View) -> DataFrame:
    """z, tx, ty of every tile, the corner of its core and of itself on the screen."""
    margin, parts = view.core * view.overlap, None
    for z in range(view.zooms[0], view.zooms[1] + 1):
        left, top, columns, rows = view.level(z)
        tiles = spark.range(columns * rows).select(F.lit(z).alias("z"), (F.col("id") % columns).cast("int").alias("tx"), F.floor(F.col("id") / columns).cast("int").alias("ty"))
        core_u, core_v = F.col("tx") * view.core + left, F.col("ty") * view.core + top
        tiles = tiles.select("z", "tx", "ty", core_u.alias("core_u"), core_v.alias("core_v"), (core_u - margin).alias("u"), (core_v - margin).alias("v"))
        parts = tiles if parts is None else parts.unionByName(tiles)
    return parts


def candidate_spans(shapes: DataFrame, view: View, key: str = "id") -> DataFrame:
    """(key, z, ty, tx_first, tx_last, depth): rows of tiles that may show each shape (geometry in metres); depth orders them from back to front.

    Null, empty and unreadable shapes have none; lines and points have none either.
    """
    margin, reach = view.core * view.overlap, view.size * QUERY_PAD
    side = view.size + 2 * reach
    kind = shapes.schema[key].dataType.simpleString()
    fields = ["z", "ty", "tx_first", "tx_last", "depth"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, shapes, numbers = batch.column(0), [], []
            for i, data in enumerate(batch.column(1).to_pylist()):
                try:
                    shape = g.from_wkb(data) if data is not None else None
                except ValueError:
                    shape = None
                if shape is None or not shape[0].endswith("Polygon") or g.is_empty(shape):
                    continue
                shapes.append(shape)
                numbers.append(i)
            depth = g.centroids(shapes).sum(1) if shapes else np.empty(0)
            # Each polygon by itself: parts of one shape may lie over each other.
            whose, polygons = [], []
            for n, shape in enumerate(shapes):
                for polygon in shape[1]:
                    edges = edges_of(polygon)
                    if len(edges):
                        whose.append(n)
                        polygons.append(edges)
            whose, numbers = np.array(whose, np.int64), np.array(numbers, np.int64)
            for z in range(view.zooms[0], view.zooms[1] + 1):
                left, top, columns, rows = view.level(z)
                s = view.scale * 2.0**z
                seen = [np.column_stack([(e[:, 0] - e[:, 1]) * s, (e[:, 0] + e[:, 1]) * (s * 0.5), (e[:, 2] - e[:, 3]) * s, (e[:, 2] + e[:, 3]) * (s * 0.5)]) for e in polygons]
                # As many at once as have a bounded number of edges times rows.
                work = np.array([len(e) * min(1 + (np.ptp(e[:, 1::2]) + side) / view.core, ROWS) for e in seen])
                for lo, hi in slices(work):
                    owner = np.repeat(np.arange(lo, hi), [len(e) for e in seen[lo:hi]])
                    spans = touched_by_many(np.concatenate(seen[lo:hi]), owner, left - margin - reach, top - margin - reach, view.core, side, columns, rows)
                    shape = whose[spans[:, 0]]
                    whole = [pa.array(c.astype(np.int32)) for c in (np.full(len(spans), z), *spans[:, 1:].T)]
                    yield pa.RecordBatch.from_arrays([keys.take(pa.array(numbers[shape])), *whole, pa.array(depth[shape])], names=["key", *fields])

    found = shapes.select(F.col(key).alias("key"), "geometry").mapInArrow(run, f"key {kind}, z int, ty int, tx_first int, tx_last int, depth double")
    return found.withColumnRenamed("key", key)


def candidates(shapes: DataFrame, view: View, key: str = "id") -> DataFrame:
    """(key, z, tx, ty, depth): each tile that may show a shape, once."""
    spans = candidate_spans(shapes, view, key)
    return spans.select(key, "z", F.explode(F.sequence("tx_first", "tx_last")).alias("tx"), "ty", "depth").distinct()


def occupied(shapes: DataFrame, view: View, key: str = "id") -> DataFrame:
    """How many shapes each tile that isn't empty may show."""
    return candidates(shapes, view, key).groupBy("z", "tx", "ty").agg(F.count("*").alias("shapes"))
