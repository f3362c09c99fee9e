"""Repair of crossings, where four tiles meet, after the seams; and the composition of both passes.

One shuffle brings the four corners of each crossing together: a patch of at most four times the context each way, whatever the tiles'
size. What changed is joined back by pixel. Crossings whose corners share pixels take turns by the parity of their place.
"""

from __future__ import annotations

from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terraloom.operators.bands import KEYS, Paint, context_of, drawn, mixed, repaired, seams_of

Span = tuple[int, int]


def corner_alpha(height: int, width: int, low: bool, left: bool, radius: int) -> np.ndarray:
    """Shares of 255 of a corner's pixels: all of it at the crossing, falling with the square of what is left of the radius.

    ``low`` and ``left``: the crossing lies at the last row, at the first column.
    """
    rows, cols = np.arange(height), np.arange(width)
    far = np.hypot((rows[::-1] if low else rows)[:, None], (cols if left else cols[::-1])[None, :])
    return np.rint(255 * np.maximum(0.0, 1 - far / max(1, radius)) ** 2).astype(np.int64)


def _segments(n: int, m: int, context: int) -> tuple[Span, Span]:
    """What a patch takes of the tile before a crossing and of the one behind it, along one axis."""
    return (max(0, n - m - context), min(n, n - m + context)), (max(0, m - context), min(n, m + context))


def crossed(pixels: DataFrame, size: tuple[int, int], margins: tuple[int, int], paint: Paint, channels: list[str], context: int | None = None, mask_half: int = 24, write_half: int = 24, harmonise_half: int = 8, seed: int = 0, only: DataFrame | None = None) -> DataFrame:
    """Tiles (x, y, row, col, channels of 0 to 255; size and margins as width, height) after the repair of all crossings whose four tiles are there.

    The patch's four parts are painted, laid over the tiles' corners by ``corner_alpha``, then both pairs of columns and both pairs of rows beside the
    crossing are drawn to their means again. ``only`` (x, y of the upper left tile) names the crossings to repair, all by default. Absent pixels count
    as 0 and stay absent; without room for a patch nothing changes; a pixel with a null in a channel counts as absent.
    """
    context = context_of(*margins) if context is None else context
    (w, h), (mx, my) = size, margins
    spans = _segments(w, mx, context), _segments(h, my, context)
    lengths = [[b - a for a, b in s] for s in spans]
    out = pixels.select(*[F.col(c).cast("int").alias(c) for c in (*KEYS, *channels)])
    limit = min(min(pair) for pair in lengths) - 1
    if limit <= 0:
        return out
    masked, wide = max(1, min(mask_half, limit)), max(1, min(write_half, lengths[0][0], lengths[1][0]))
    half = max(0, min(harmonise_half, wide, w - mx, h - my))
    # What is held of each tile: its part of the patch, and the lines that are drawn to their means.
    held = [((min(s[0][0], n - m - half), max(s[0][1], n - m)), (min(s[1][0], m), max(s[1][1], m + half))) for s, n, m in ((spans[0], w, mx), (spans[1], h, my))]
    turns = [2 if axis[1][1] > axis[0][0] else 1 for axis in held]
    for turn in product(*map(range, turns)):
        out = _pass(out, spans, held, (w - mx, h - my), (mx, my), (masked, wide, half), paint, channels, seed, turn, turns, only)
    return out


def _pass(pixels: DataFrame, spans: tuple, held: list, ends: tuple[int, int], margins: tuple[int, int], halves: tuple[int, int, int], paint: Paint, channels: list[str], seed: int, turn: tuple[int, int], turns: list[int], only: DataFrame | None) -> DataFrame:
    masked, wide, half = halves
    within = lambda c, span: (F.col(c) >= span[0]) & (F.col(c) < span[1])
    roles = [
        F.when(within("col", held[0][i]) & within("row", held[1][j]), F.struct((F.col("x") - i).alias("cx"), (F.col("y") - j).alias("cy"), F.lit(i).alias("i"), F.lit(j).alias("j")))
        for j in (0, 1)
        for i in (0, 1)
    ]
    whole = ~F.greatest(*[F.col(c).isNull() for c in channels], F.lit(False))
    dealt = pixels.where(whole).select("row", "col", *channels, F.explode(F.array_compact(F.array(*roles))).alias("p")).select("p.*", "row", "col", *channels)
    for c, n, t in (("cx", turns[0], turn[0]), ("cy", turns[1], turn[1])):
        dealt = dealt.where(F.pmod(F.col(c), F.lit(n)) == t) if n > 1 else dealt
    if only is not None:
        dealt = dealt.join(only.select(F.col("x").alias("cx"), F.col("y").alias("cy")).distinct(), ["cx", "cy"], "left_semi")
    columns = [*KEYS, *[f"_{c}" for c in channels]]

    def run(part: pd.DataFrame) -> pd.DataFrame:
        cx, cy = int(part["cx"].iloc[0]), int(part["cy"].iloc[0])
        corner, rows, cols = (part["j"] * 2 + part["i"]).to_numpy(), part["row"].to_numpy(), part["col"].to_numpy()
        values, images, olds = part[channels].to_numpy(), {}, {}
        for j, i in product((0, 1), (0, 1)):
            own = np.flatnonzero(corner == j * 2 + i)
            if not len(own):
                break
            (c0, c1), (r0, r1) = held[0][i], held[1][j]
            image = np.zeros((r1 - r0, c1 - c0, len(channels)), np.int64)
            image[rows[own] - r0, cols[own] - c0] = values[own]
            images[j, i], olds[j, i] = image, image.copy()
        if len(images) < 4:
            return pd.DataFrame({c: pd.Series(dtype=int) for c in columns})
        cut = {(j, i): (slice(spans[1][j][0] - held[1][j][0], spans[1][j][1] - held[1][j][0]), slice(spans[0][i][0] - held[0][i][0], spans[0][i][1] - held[0][i][0])) for j, i in images}
        patch = np.concatenate([np.concatenate([images[j, i][cut[j, i]] for i in (0, 1)], 1) for j in (0, 1)], 0)
        split = [s[0][1] - s[0][0] for s in spans]
        mask = np.zeros(patch.shape[:2], bool)
        mask[split[1] - masked : split[1] + masked + 1, split[0] - masked : split[0] + masked + 1] = True
        made = np.asarray(paint(patch.astype(np.uint8), mask, seed + cy * 100_003 + cx)).astype(np.int64)
        for (j, i), where in cut.items():
            new = made[split[1] :] if j else made[: split[1]]
            new = new[:, split[0] :] if i else new[:, : split[0]]
            alpha = corner_alpha(*new.shape[:2], j == 0, i == 1, wide)
            images[j, i][where] = mixed(images[j, i][where], new, alpha[:, :, None])
        for d in range(half):
            share = 1.0 if half == 1 else 1.0 - d / (half - 1)
            for j in (0, 1):  # columns side by side, over the patch's rows
                _draw(images[j, 0], images[j, 1], (cut[j, 0][0], ends[0] - 1 - d - held[0][0][0]), (cut[j, 1][0], margins[0] + d - held[0][1][0]), share)
        for d in range(half):
            share = 1.0 if half == 1 else 1.0 - d / (half - 1)
            for i in (0, 1):  # then rows one below the other, over its columns
                _draw(images[0, i], images[1, i], (ends[1] - 1 - d - held[1][0][0], cut[0, i][1]), (margins[1] + d - held[1][1][0], cut[1, i][1]), share)
        out = []
        for (j, i), image in images.items():
            rows, cols = np.nonzero((image != olds[j, i]).any(axis=2))
            place = np.broadcast_to((cx + i, cy + j), (len(rows), 2))
            out.append(np.column_stack([place, rows + held[1][j][0], cols + held[0][i][0], image[rows, cols]]))
        return pd.DataFrame(np.concatenate(out), columns=columns)

    fresh = dealt.groupBy("cx", "cy").applyInPandas(run, ", ".join(f"{c} int" for c in columns))
    return pixels.join(fresh, KEYS, "left").select(*KEYS, *[F.coalesce(f"_{c}", c).alias(c) for c in channels])


def _draw(a: np.ndarray, b: np.ndarray, at: tuple, there: tuple, share: float) -> None:
    """Two lines drawn to their mean."""
    one, other = a[at].copy(), b[there].copy()
    mean = drawn(one, other, 0.5)
    a[at], b[there] = drawn(one, mean, share), drawn(other, mean, share)


def crossings_of(tiles: DataFrame) -> DataFrame:
    """x and y of the upper left tile of each crossing whose four tiles are there."""
    own = tiles.select("x", "y").distinct()
    steps = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for j in (0, 1) for i in (0, 1)])
    met = own.withColumn("s", F.explode(steps)).groupBy((F.col("x") - F.col("s.i")).alias("x"), (F.col("y") - F.col("s.j")).alias("y")).agg(F.count("*").alias("n"))
    return met.where("n = 4").select("x", "y")


def possible(tiles: DataFrame) -> dict[str, int]:
    """How many seams and crossings the indices of the tiles have room for, absent tiles included."""
    found = {}
    for axis in "xy":
        own = tiles.select(axis).where(F.col(axis).isNotNull()).distinct()
        pairs = own.join(own.select((F.col(axis) - 1).alias(axis)), axis, "left_semi")
        found[axis] = own.count(), pairs.count()
    (nx, px), (ny, py) = found["x"], found["y"]
    return {"seams": px * ny + py * nx, "crossings": px * py}


def mended(pixels: DataFrame, size: tuple[int, int], margins: tuple[int, int], paint: Paint, channels: list[str], context: int | None = None, seam_halves: tuple[int, int, int] = (16, 16, 8), crossing_halves: tuple[int, int] = (24, 24), most_seams: int | None = None, most_crossings: int | None = None, seed: int = 0) -> tuple[DataFrame, dict[str, int | bool]]:
    """All seams, then all crossings, and the counts of both passes. The seams' result is a checkpoint, in the folder of ``spark.checkpoint.dir``.

    Of capped passes the first in order are done: seams side by side before those one below the other, by y, then x. Crossings wait for all seams: a capped
    pass that left a seam out, or that met a seam with an absent tile, is not followed by them. Only counts pass through the driver.
    """
    tiles = pixels.select("x", "y").where("x IS NOT NULL AND y IS NOT NULL").distinct()
    room, there = possible(tiles), seams_of(tiles).count()
    done = there if most_seams is None else min(there, most_seams)
    out = repaired(pixels, size, margins, paint, channels, context, *seam_halves, seed=seed, most=most_seams).checkpoint()
    account = {"seams": room["seams"], "seams_done": done, "seams_skipped": room["seams"] - there, "crossings": room["crossings"], "crossings_done": 0, "crossings_skipped": 0, "crossings_run": most_seams is None or done == room["seams"]}
    if account["crossings_run"]:
        found = crossings_of(tiles)
        met = found.count()
        account |= {"crossings_done": met if most_crossings is None else min(met, most_crossings), "crossings_skipped": room["crossings"] - met}
        only = None if most_crossings is None else found.orderBy("y", "x").limit(most_crossings)
        out = crossed(out, size, margins, paint, channels, context, *crossing_halves, seam_halves[2], seed, only)
    return out, account
