"""Rasters in chunks: long pixel tables meet as square arrays with a margin, one shuffle for any number of steps.

Every pixel goes to its own chunk, and to those neighbours whose margin it lies in: about 1 + 4 margin / side rows a pixel. A chunk
then runs all steps on arrays and gives out its own pixels, again as a long table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SIDE = 256
#: From the value and the presence of each pixel of a chunk and its margin to a new value of each.
Kernel = Callable[[np.ndarray, np.ndarray], np.ndarray]


def chunk_keys(size: int = SIDE) -> list[Column]:
    """The chunk of a pixel, to lay rasters out in."""
    return [F.floor(F.col("row") / size).cast("int").alias("chunk_row"), F.floor(F.col("col") / size).cast("int").alias("chunk_col")]


def by_chunk(pixels: DataFrame, keys: list[str], value: str, margin: int, kernel: Kernel, out: str, side: int = SIDE) -> DataFrame:
    """Rows (keys, row, col, ``out``): ``kernel`` over each chunk of a raster (row, col, ``value``) and so many pixels around it.

    Absent pixels have value 0 and presence False; null values are NaN. A pixel that occurs twice counts with one of its values.
    """
    over = lambda c: F.sequence(F.floor((F.col(c) - margin) / side), F.floor((F.col(c) + margin) / side))
    sent = pixels.select(*keys, F.col("row").cast("int").alias("row"), F.col("col").cast("int").alias("col"), F.col(value).cast("double").alias("value"), F.explode(over("row")).alias("_i"))
    sent = sent.select("*", F.explode(over("col")).alias("_j"))
    inside = (F.col("row") >= F.col("_i") * side) & (F.col("row") < (F.col("_i") + 1) * side) & (F.col("col") >= F.col("_j") * side) & (F.col("col") < (F.col("_j") + 1) * side)
    groups = sent.groupBy(*keys, "_i", "_j").agg(*[F.collect_list(F.coalesce(c, F.lit(float("nan"))) if c == "value" else F.col(c)).alias(c) for c in ("row", "col", "value")], F.count_if(inside).alias("_own"))
    groups = groups.where("_own > 0").drop("_own")
    kinds = {k: groups.schema[k].dataType.simpleString() for k in keys}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [batch.column(c) for c in ("row", "col", "value")]
            offsets = lists[0].offsets.to_numpy()
            row, col, values = (x.values.to_numpy(zero_copy_only=False) for x in lists)
            tops, lefts = batch.column("_i").to_numpy() * side - margin, batch.column("_j").to_numpy() * side - margin
            held, size = [], 0
            for n in range(batch.num_rows):
                at = slice(offsets[n], offsets[n + 1])
                i, j = row[at] - tops[n], col[at] - lefts[n]
                # The arrays reach as far as there are pixels, so an image that ends within a chunk ends the arrays.
                i0, j0, h, w = int(i.min()), int(j.min()), int(i.max()) + 1, int(j.max()) + 1
                array, there = np.zeros((h - i0, w - j0)), np.zeros((h - i0, w - j0), bool)
                array[i - i0, j - j0], there[i - i0, j - j0] = values[at], True
                made = kernel(array, there)
                a, b = np.nonzero(there)
                a, b = a + i0, b + j0
                own = (a >= margin) & (a < margin + side) & (b >= margin) & (b < margin + side)
                a, b = a[own], b[own]
                held.append((np.full(len(a), n, np.int32), (a + tops[n]).astype(np.int32), (b + lefts[n]).astype(np.int32), made[a - i0, b - j0].astype(float)))
                size += len(a)
                if size > 1 << 18 or n == batch.num_rows - 1:
                    number, r, c, v = (np.concatenate(x) for x in zip(*held, strict=True))
                    yield pa.RecordBatch.from_arrays([*[batch.column(k).take(pa.array(number)) for k in keys], pa.array(r), pa.array(c), pa.array(v)], names=[*keys, "row", "col", out])
                    held, size = [], 0

    return groups.mapInArrow(run, ", ".join([*[f"`{k}` {t}" for k, t in kinds.items()], "row int, col int", f"`{out}` double"]))


def neighbours_set(bits: np.ndarray, there: np.ndarray, least: int) -> np.ndarray:
    """Present pixels of which so many of the 3 x 3 around are set, itself included."""
    p = np.pad(bits, 1)
    h, w = bits.shape
    count = sum(p[i : i + h, j : j + w].astype(np.int8) for i in range(3) for j in range(3))
    return (count >= least) & there


def morphology(steps: list[tuple[int, int]]) -> Kernel:
    """Steps of (how often, how many neighbours at least): 1 dilates, 9 erodes."""

    def kernel(values: np.ndarray, there: np.ndarray) -> np.ndarray:
        bits = (values == 1) & there
        for times, least in steps:
            for _ in range(times):
                bits = neighbours_set(bits, there, least)
        return bits

    return kernel


def sobel(values: np.ndarray, there: np.ndarray) -> np.ndarray:
    """Gradient magnitude, the image's edges repeated; 0 all over where an image is under two pixels high or wide."""
    if min(values.shape) < 2:
        return np.zeros_like(values)
    p = np.pad(values, 1, mode="edge")
    across, down = p[:, 2:] - p[:, :-2], p[2:] - p[:-2]
    gx = across[:-2] + 2 * across[1:-1] + across[2:]
    gy = down[:, :-2] + 2 * down[:, 1:-1] + down[:, 2:]
    return np.sqrt(gx * gx + gy * gy)
