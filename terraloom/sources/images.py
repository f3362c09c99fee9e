"""Tile trees of PNG files, read and written in tasks; 8-bit gray, RGB and RGBA without interlacing."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SIGNATURE = b"\x89PNG\r\n\x1a\n"
CHANNELS = {0: 1, 2: 3, 6: 4}


def encode_png(pixels: np.ndarray) -> bytes:
    """Rows x columns (x channels) of bytes."""
    pixels = np.atleast_3d(np.ascontiguousarray(pixels, np.uint8))
    h, w, n = pixels.shape
    chunk = lambda name, body: struct.pack(">I", len(body)) + name + body + struct.pack(">I", zlib.crc32(name + body))
    rows = np.concatenate([np.zeros((h, 1), np.uint8), pixels.reshape(h, -1)], axis=1)
    head = struct.pack(">IIBBBBB", w, h, 8, {1: 0, 3: 2, 4: 6}[n], 0, 0, 0)
    return SIGNATURE + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(rows.tobytes(), 6)) + chunk(b"IEND", b"")


def decode_png(data: bytes) -> np.ndarray:
    if data[:8] != SIGNATURE:
        raise ValueError("not a PNG")
    at, body, head = 8, b"", None
    while at < len(data):
        size, name = struct.unpack_from(">I4s", data, at)
        part = data[at + 8 : at + 8 + size]
        if name == b"IHDR":
            head = struct.unpack(">IIBBBBB", part)
        elif name == b"IDAT":
            body += part
        at += size + 12
    w, h, depth, kind, _, _, interlace = head
    if depth != 8 or kind not in CHANNELS or interlace:
        raise ValueError("only 8-bit gray, RGB and RGBA are read")
    n = CHANNELS[kind]
    raw = np.frombuffer(zlib.decompress(body), np.uint8).reshape(h, 1 + w * n)
    out = np.zeros((h, w * n), np.uint8)
    before = np.zeros(w * n, np.int32)
    for y in range(h):
        out[y] = _unfiltered(raw[y, 0], raw[y, 1:].astype(np.int32), before, n)
        before = out[y].astype(np.int32)
    return out.reshape(h, w, n)


def _unfiltered(kind: int, line: np.ndarray, up: np.ndarray, n: int) -> np.ndarray:
    if kind == 0:
        return line
    if kind == 2:
        return (line + up) & 255
    if kind == 1:
        return (np.cumsum(line.reshape(-1, n), axis=0) & 255).ravel()
    out = line.tolist()
    above = up.tolist()
    for i in range(len(out)):
        a, b, c = (out[i - n] if i >= n else 0), above[i], (above[i - n] if i >= n else 0)
        if kind == 3:
            guess = (a + b) // 2
        else:
            pa, pb, pc = abs(b - c), abs(a - c), abs(a + b - 2 * c)
            guess = a if pa <= pb and pa <= pc else b if pb <= pc else c
        out[i] = (out[i] + guess) & 255
    return np.array(out)


def read_tiles(spark: SparkSession, root: str) -> DataFrame:
    """x, y, path and content of the files ``0/x/y.png`` below a folder; other names are passed over."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.png").load(root)
    pattern = r"/0/([0-9]+)/([0-9]+)\.png$"
    found = files.where(F.col("path").rlike(pattern))
    return found.select(F.regexp_extract("path", pattern, 1).cast("int").alias("x"), F.regexp_extract("path", pattern, 2).cast("int").alias("y"), "path", "content")


PIXELS = "x int, y int, row int, col int, r int, g int, b int"


def pixels(tiles: DataFrame) -> DataFrame:
    """A long table of the pixels of tiles."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for x, y, content in part[["x", "y", "content"]].itertuples(index=False):
                image = decode_png(bytes(content))
                image = np.repeat(image, 3, axis=2) if image.shape[2] == 1 else image[:, :, :3]
                h, w, _ = image.shape
                rows, cols = np.divmod(np.arange(h * w), w)
                flat = image.reshape(-1, 3)
                yield pd.DataFrame({"x": x, "y": y, "row": rows, "col": cols, "r": flat[:, 0], "g": flat[:, 1], "b": flat[:, 2]}).astype("int32")

    return tiles.select("x", "y", "content").mapInPandas(run, PIXELS)


def encoded(pixels_: DataFrame, keys: list[str]) -> DataFrame:
    """One PNG (``content``) for each image of a long table row, col, r, g, b; places without a pixel are black. An image is built in one task."""

    def build(part: pd.DataFrame) -> pd.DataFrame:
        image = np.zeros((part["row"].max() + 1, part["col"].max() + 1, 3), np.uint8)
        image[part["row"], part["col"]] = part[["r", "g", "b"]].to_numpy()
        return part[keys].head(1).assign(content=[encode_png(image)])

    kinds = ", ".join(f"{k} {pixels_.schema[k].dataType.simpleString()}" for k in keys)
    return pixels_.select(*keys, "row", "col", "r", "g", "b").groupBy(*keys).applyInPandas(build, f"{kinds}, content binary")


#: Endings of image files.
IMAGE_FILES = r"(?i)\.(png|jpg|jpeg|webp)$"


def listed(spark: SparkSession, root: str, most: int | None = None, names: str = r"(?i)\.png$") -> DataFrame:
    """path and length of the image files anywhere below a folder, in path order; at most so many. Contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    found = files.where(F.col("path").rlike(names)).select("path", "length").orderBy("path")
    return found if most is None else found.limit(most)


def anchors(spark: SparkSession, root: str, least: int = 3, most: int = 6) -> list[str]:
    """The images of a folder that show a style, in order; there must be three to six."""
    found = [r["path"] for r in listed(spark, root, most + 1, IMAGE_FILES).collect()]
    if not least <= len(found) <= most:
        raise ValueError(f"{least} to {most} anchors are needed")
    return found
