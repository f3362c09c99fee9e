"""Whole-image kernels run on one image a row: pixel stylisation, rasterised polygons and the isometric view of buildings.

Spark partitions the images; each kernel is numpy on one image.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terraloom.functions import geometry as g
from terraloom.sources.images import decode_png, encode_png

LUMA = np.array([0.299, 0.587, 0.114])


def box_downscaled(image: np.ndarray, scale: float) -> np.ndarray:
    """Area averages over boxes that may cut pixels."""

    def along(x: np.ndarray, n: int) -> np.ndarray:
        size = x.shape[0]
        edges = np.linspace(0, size, n + 1)
        total = np.concatenate([np.zeros((1, *x.shape[1:])), np.cumsum(x, axis=0)])
        low = np.minimum(edges.astype(int), size - 1)
        part = (edges - low).reshape(-1, *[1] * (x.ndim - 1))
        at = total[low] + part * x[low]
        return np.diff(at, axis=0) / (size / n)

    h, w = (max(1, round(s * scale)) for s in image.shape[:2])
    return np.swapaxes(along(np.swapaxes(along(image.astype(float), h), 0, 1), w), 0, 1)


def enhanced(image: np.ndarray, contrast: float, saturation: float) -> np.ndarray:
    out = image.astype(float)
    if contrast != 1:
        mean = round(float((out @ LUMA).mean()))
        out = np.clip(mean + (out - mean) * contrast, 0, 255)
    if saturation != 1:
        gray = (out @ LUMA)[..., None]
        out = np.clip(gray + (out - gray) * saturation, 0, 255)
    return out


def palette(pixels: np.ndarray, colours: int) -> np.ndarray:
    """Median cut: the box with the widest channel is halved at its median until there are enough."""
    boxes = [pixels]
    while len(boxes) < colours:
        spans = [np.ptp(b, axis=0).max() if len(b) > 1 else 0 for b in boxes]
        k = int(np.argmax(spans))
        if spans[k] == 0:
            break
        own = boxes.pop(k)
        axis = int(np.ptp(own, axis=0).argmax())
        order = own[np.argsort(own[:, axis], kind="stable")]
        boxes += [order[: len(order) // 2], order[len(order) // 2 :]]
    return np.array([b.mean(axis=0) for b in boxes])


def quantised(image: np.ndarray, colours: int) -> np.ndarray:
    flat = image.reshape(-1, 3)
    found = palette(flat, colours)
    nearest = ((flat[:, None] - found[None]) ** 2).sum(axis=2).argmin(axis=1)
    return np.rint(found[nearest]).reshape(image.shape)


def edge_strength(image: np.ndarray) -> np.ndarray:
    """Eight times a pixel's luma less its neighbours', within a byte; 0 at the border."""
    gray = image.astype(float) @ LUMA
    out = np.zeros_like(gray)
    around = sum(gray[1 + r : gray.shape[0] - 1 + r, 1 + c : gray.shape[1] - 1 + c] for r in (-1, 0, 1) for c in (-1, 0, 1))
    out[1:-1, 1:-1] = np.clip(9 * gray[1:-1, 1:-1] - around, 0, 255)
    return out


def widened(mask: np.ndarray, size: int) -> np.ndarray:
    """Maximum over an odd window."""
    r = size // 2
    wide = np.pad(mask, r)
    h, w = mask.shape
    return np.max([wide[i : i + h, j : j + w] for i in range(size) for j in range(size)], axis=0)


def lanczos(image: np.ndarray, height: int, width: int) -> np.ndarray:
    """An image of numbers at another size by a windowed sinc of three lobes, which widens as the image shrinks; each axis on its own."""
    out = image.astype(float)
    for axis, size in ((0, height), (1, width)):
        old = out.shape[axis]
        scale = max(old / size, 1.0)
        centre = (np.arange(size) + 0.5) * (old / size) - 0.5
        away = (np.arange(old)[None] - centre[:, None]) / scale
        weights = np.where(np.abs(away) < 3, np.sinc(away) * np.sinc(away / 3), 0.0)
        out = np.moveaxis(np.tensordot(weights / weights.sum(axis=1, keepdims=True), out, (1, axis)), 0, axis)
    return out


def unit_image(image: np.ndarray, height: int, width: int) -> np.ndarray:
    """Three channels at a size, from 0 to 1; resized as whole numbers."""
    rgb = np.repeat(image, 3, axis=2) if image.shape[2] == 1 else image[:, :, :3]
    sized = rgb if rgb.shape[:2] == (height, width) else np.clip(np.rint(lanczos(rgb, height, width)), 0, 255)
    return sized.astype(np.float32) / 255


def edge_statistics(edges: np.ndarray, thickness: int, threshold: int, most_cover: float) -> tuple[np.ndarray, int, float]:
    """The mask of edges, the threshold used and the share covered: the threshold rises by 8, to 250 at most, until edges cover no more than ``most_cover`` (which counts between 0 and 1)."""
    while True:
        mask = widened(edges >= threshold, 2 * (thickness // 2) + 1)
        if not 0 < most_cover < 1 or mask.mean() <= most_cover or threshold >= 250:
            return mask, threshold, float(mask.mean())
        threshold = min(250, threshold + 8)


def stylised(image: np.ndarray, scale: float = 0.5, colours: int = 24, contrast: float = 1.1, saturation: float = 1.1, threshold: int = 40, thickness: int = 1, dark: float = 200.0, most_cover: float = 0.2, ink: tuple[int, int, int] = (20, 20, 30)) -> np.ndarray:
    """Few colours at low resolution with inked edges, shown at the old size by the nearest pixel. The threshold rises until edges cover at most ``most_cover``."""
    low = quantised(enhanced(box_downscaled(image, scale), contrast, saturation), colours)
    h, w = image.shape[:2]
    rows, cols = (np.arange(n) * m // n for n, m in ((h, low.shape[0]), (w, low.shape[1])))
    edges = box_downscaled(edge_strength(image)[..., None], scale)[..., 0]
    mask, _, _ = edge_statistics(edges, thickness, threshold, most_cover)
    mask = mask & (low @ LUMA <= dark)
    low[mask] = ink
    return low[rows][:, cols].astype(np.uint8)


def stylised_tiles(tiles: DataFrame, **settings: object) -> DataFrame:
    """Tiles (x, y, content as PNG) with each image stylised."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            yield pd.DataFrame({"x": part["x"], "y": part["y"], "content": [encode_png(stylised(np.repeat(i, 3, axis=2) if (i := decode_png(bytes(c))).shape[2] == 1 else i[:, :, :3], **settings)) for c in part["content"]]})

    return tiles.select("x", "y", "content").mapInPandas(run, "x int, y int, content binary")


def rasterised(geometry: g.Geometry, left: float, top: float, pixel: float, rows: int, cols: int) -> np.ndarray:
    """1 where a pixel's centre lies inside."""
    x, y = left + (np.arange(cols) + 0.5) * pixel, top - (np.arange(rows) + 0.5) * pixel
    return g.contains(geometry, *np.meshgrid(x, y)).astype(np.uint8)


def _filled(canvas: np.ndarray, points: np.ndarray, colour: tuple[int, int, int]) -> None:
    """Even-odd fill of a polygon by scan lines through pixel centres."""
    h, w = canvas.shape[:2]
    a, b = points, np.roll(points, -1, axis=0)
    for y in range(max(0, math.ceil(points[:, 1].min() - 0.5)), min(h, math.ceil(points[:, 1].max() - 0.5))):
        at = y + 0.5
        met = (a[:, 1] > at) != (b[:, 1] > at)
        xs = np.sort(a[met, 0] + (at - a[met, 1]) / (b[met, 1] - a[met, 1]) * (b[met, 0] - a[met, 0]))
        for x0, x1 in zip(xs[::2], xs[1::2], strict=False):
            canvas[y, max(0, math.ceil(x0 - 0.5)) : max(0, min(w, math.ceil(x1 - 0.5)))] = colour


#: Colours of roofs and of walls in light.
ROOF, WALL_LIGHT = (236, 238, 242), (214, 219, 226)
GROUND = (245, 245, 240)


def drawn(buildings: list[tuple[bytes, float]], u0: float, v0: float, size: int, scale: float, z_scale: float) -> np.ndarray:
    """Buildings (WKB in metres, height) from back to front: walls that face the camera, which stands south-west, then the roof, outer rings only."""
    canvas = np.full((size, size, 3), GROUND, np.uint8)
    shapes = [(g.from_wkb(wkb), h) for wkb, h in buildings]
    for shape, height in sorted(shapes, key=lambda s: sum(g.centroid(s[0]))):
        for polygon in shape[1]:
            ring = polygon[0][:-1] if g.signed_area(polygon[0]) > 0 else polygon[0][:-1][::-1]
            base = np.stack([(ring[:, 0] - ring[:, 1]) * scale - u0, (ring[:, 0] + ring[:, 1]) * scale / 2 - v0], axis=1)
            roof = base - np.array([0, height * z_scale])
            for i in range(len(ring)):
                j = (i + 1) % len(ring)
                dx, dy = ring[j] - ring[i]
                if dx - dy > 0:  # the outward normal (dy, -dx) looks along (-1, -1); only these walls are seen, so all are in light
                    _filled(canvas, np.array([base[i], base[j], roof[j], roof[i]]), WALL_LIGHT)
            _filled(canvas, roof, ROOF)
    return canvas


def rendered(buildings: DataFrame, size: int, scale: float, z_scale: float) -> DataFrame:
    """tx, ty and content (PNG) of every tile that a building (geometry in metres, height_m) may show in; a tile is drawn in one task from the buildings that touch it."""
    rows = buildings.where("geometry IS NOT NULL").withColumn("e", g.st_envelope("geometry"))
    # The seen box of a building: corners of its envelope, and its height upwards.
    u0, u1 = (F.col("e.x0") - F.col("e.y1")) * scale, (F.col("e.x1") - F.col("e.y0")) * scale
    v0, v1 = (F.col("e.x0") + F.col("e.y0")) * (scale / 2) - F.col("height_m") * z_scale, (F.col("e.x1") + F.col("e.y1")) * (scale / 2)
    index = lambda c: F.floor(c / size).cast("int")
    dealt = rows.select("geometry", "height_m", F.explode(F.sequence(index(u0), index(u1))).alias("tx"), index(v0).alias("_v0"), index(v1).alias("_v1"))
    dealt = dealt.select("geometry", "height_m", "tx", F.explode(F.sequence("_v0", "_v1")).alias("ty"))

    def run(part: pd.DataFrame) -> pd.DataFrame:
        tx, ty = int(part["tx"].iloc[0]), int(part["ty"].iloc[0])
        image = drawn([(bytes(w), h) for w, h in zip(part["geometry"], part["height_m"], strict=True)], tx * size, ty * size, size, scale, z_scale)
        return pd.DataFrame({"tx": [tx], "ty": [ty], "content": [encode_png(image)]})

    return dealt.groupBy("tx", "ty").applyInPandas(run, "tx int, ty int, content binary")
