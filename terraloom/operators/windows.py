"""A model run over overlapping windows of one large mosaic, blended back; and repairs around seams and corners.

The mosaic stays a long table. Pixels are dealt to the windows that hold them, each window is one group for the model, and
the results meet again by pixel as weighted means.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terraloom.operators.tiles import fade_weight, window_starts

Paint = Callable[[np.ndarray, int], np.ndarray]


def dealt(pixels: DataFrame, height: int, width: int, window: int, overlap: int) -> DataFrame:
    """Pixels (out_row, out_col) in each window that holds them: wr and wc are the window's start."""
    starts = {"out_row": window_starts(height, window, overlap), "out_col": window_starts(width, window, overlap)}
    holding = lambda c: F.filter(F.array(*map(F.lit, starts[c])), lambda s: (s <= F.col(c)) & (F.col(c) < s + window))
    return pixels.withColumn("wr", F.explode(holding("out_row"))).withColumn("wc", F.explode(holding("out_col")))


def window_weight(at: Column, start: Column, extent: int, window: int, overlap: int) -> Column:
    """Ramps over the overlap, over half a window at most, except at the mosaic's own ends."""
    size = min(window, extent)
    return fade_weight(at - start, F.lit(size), F.lit(max(0, min(overlap, size // 2))), start > 0, start + window < extent)


def painted(pixels: DataFrame, height: int, width: int, paint: Paint, channels: list[str], window: int = 512, overlap: int = 64, seed: int = 0) -> DataFrame:
    """The mosaic after ``paint(image, seed)`` on every window; pixels without weight keep what they had."""
    window = max(64, window)
    own = dealt(pixels.select("out_row", "out_col", *channels), height, width, window, overlap)
    kinds = ", ".join(f"{c} double" for c in channels)

    def run(part: pd.DataFrame) -> pd.DataFrame:
        r0, c0 = int(part["wr"].iloc[0]), int(part["wc"].iloc[0])
        rows, cols = part["out_row"] - r0, part["out_col"] - c0
        image = np.zeros((rows.max() + 1, cols.max() + 1, len(channels)), np.uint8)
        image[rows, cols] = part[channels].to_numpy()
        new = paint(image, seed + r0 * 100_003 + c0)
        out = part[["out_row", "out_col", "wr", "wc"]].copy()
        out[channels] = np.asarray(new)[rows, cols].astype(float)
        return out

    done = own.groupBy("wr", "wc").applyInPandas(run, f"out_row int, out_col int, wr int, wc int, {kinds}")
    weight = window_weight(F.col("out_row"), F.col("wr"), height, window, overlap) * window_weight(F.col("out_col"), F.col("wc"), width, window, overlap)
    done = done.withColumn("w", weight)
    total = F.when(F.sum("w") > 1e-6, F.sum("w"))
    # Cut down to whole numbers, as images are that hold bytes.
    mixed = done.groupBy("out_row", "out_col").agg(*[F.floor(F.greatest(F.lit(0.0), F.least(F.lit(255.0), F.sum(F.col(c) * F.col("w")) / total))).cast("int").alias(f"_{c}") for c in channels])
    joined = pixels.join(mixed, ["out_row", "out_col"], "left")
    return joined.select("out_row", "out_col", *[F.coalesce(f"_{c}", c).alias(c) for c in channels])


def repaired_around(pixels: DataFrame, marks: DataFrame, radius: int, paint: Paint, channels: list[str], seed: int = 0) -> DataFrame:
    """Around each mark (mark_row, mark_col: a corner where tiles meet) the painted pixels are laid over the old ones with a radial weight of 1 at the mark and 0 at ``radius``. Where marks overlap, the least change of weight wins."""
    offsets = F.sequence(F.lit(-radius), F.lit(radius - 1))
    squares = marks.select("mark_row", "mark_col", F.explode(offsets).alias("dr")).withColumn("dc", F.explode(offsets))
    squares = squares.select("mark_row", "mark_col", (F.col("mark_row") + F.col("dr")).alias("out_row"), (F.col("mark_col") + F.col("dc")).alias("out_col"))
    own = squares.join(pixels.select("out_row", "out_col", *channels), ["out_row", "out_col"])
    kinds = ", ".join(f"_{c} double" for c in channels)

    def run(part: pd.DataFrame) -> pd.DataFrame:
        r0, c0 = int(part["mark_row"].iloc[0]), int(part["mark_col"].iloc[0])
        rows, cols = part["out_row"] - r0 + radius, part["out_col"] - c0 + radius
        image = np.zeros((2 * radius, 2 * radius, len(channels)), np.uint8)
        image[rows, cols] = part[channels].to_numpy()
        new = np.asarray(paint(image, seed + r0 * 100_003 + c0)).astype(float)
        far = np.hypot(rows + 0.5 - radius, cols + 0.5 - radius) / radius
        weight = np.maximum(0.0, 1.0 - far) ** 2
        out = part[["out_row", "out_col"]].copy()
        out[[f"_{c}" for c in channels]] = new[rows, cols]
        return out.assign(w=weight)[lambda d: d["w"] > 0]

    done = own.groupBy("mark_row", "mark_col").applyInPandas(run, f"out_row int, out_col int, {kinds}, w double")
    best = done.groupBy("out_row", "out_col").agg(F.max(F.struct("w", *[f"_{c}" for c in channels])).alias("b")).select("out_row", "out_col", "b.*")
    joined = pixels.join(best, ["out_row", "out_col"], "left")
    mixed = lambda c: F.col(c) + (F.col(f"_{c}") - F.col(c)) * F.col("w")
    return joined.select("out_row", "out_col", *[F.when(F.col("w").isNotNull(), F.rint(mixed(c)).cast("int")).otherwise(F.col(c)).alias(c) for c in channels])
