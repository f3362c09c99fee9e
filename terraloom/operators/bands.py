"""Repair of bands along seams: a patch from both tiles of a seam is painted anew, and its strips are faded back into the tiles.

Tiles are long pixel tables (x, y, row, col, channels of 0 to 255). One shuffle brings the two strips of each seam together; a patch is
as long as a tile and a few dozen pixels wide. Side-by-side seams come first, then those one below the other, on what the first
left. Where strips of neighbouring seams would share pixels, every second seam is painted first, then the others on what those left.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: From a patch (height x width x channels, bytes), the mask of what is to be painted and a seed to a patch of the same size.
Paint = Callable[[np.ndarray, np.ndarray, int], np.ndarray]
KEYS = ["x", "y", "row", "col"]
#: Values of the seams that a task handles together; a seam with more is handled alone.
MOST_CELLS = 1 << 20


def context_of(margin_x: int, margin_y: int) -> int:
    """How far a patch reaches to both sides of where a tile's core ends."""
    return max(8, min(margin_x, margin_y, 64))


def mixed(old: np.ndarray, new: np.ndarray, alpha: np.ndarray) -> np.ndarray:
    """Bytes mixed by bytes, rounded to the nearest."""
    return (old * (255 - alpha) + new * alpha + 127) // 255


def _ramp(n: int, start: int, end: int) -> np.ndarray:
    """Shares of a strip's pixels; a strip of one pixel is laid over whole."""
    return np.array([255]) if n == 1 else np.rint(np.linspace(start, end, n)).astype(np.int64)


def drawn(a: np.ndarray, b: np.ndarray, share: float) -> np.ndarray:
    """Bytes drawn towards others, cut down to whole numbers."""
    return np.floor(a + share * (b - a)).astype(np.int64)


def strips(first: np.ndarray, second: np.ndarray, ends: tuple[np.ndarray, np.ndarray], mask_half: int, write_half: int, harmonise_half: int, paint: Paint, seeds: list[int]) -> tuple[np.ndarray, np.ndarray] | None:
    """What both tiles of each seam get: the last pixels before the seam of one and the first after it of the other (seams x along x across x channels). ``ends`` are what the two tiles hold there now."""
    split = first.shape[2]
    limit = min(split, second.shape[2]) - 1
    if limit <= 0:
        return None
    masked, n = max(1, min(mask_half, limit)), max(1, min(write_half, limit))
    patches = np.concatenate([first, second], axis=2)
    mask = np.zeros(patches.shape[1:3], bool)
    mask[:, split - masked : split + masked + 1] = True
    made = np.stack([np.asarray(paint(patch, mask.copy(), seed)) for patch, seed in zip(patches.astype(np.uint8), seeds, strict=True)]).astype(np.int64)
    a = mixed(ends[0][:, :, -n:], made[:, :, split - n : split], _ramp(n, 0, 255)[None, None, :, None])
    b = mixed(ends[1][:, :, :n], made[:, :, split : split + n], _ramp(n, 255, 0)[None, None, :, None])
    half = max(0, min(harmonise_half, n))
    for d in range(half):
        one, other = a[:, :, n - 1 - d].copy(), b[:, :, d].copy()
        mean, share = drawn(one, other, 0.5), 1.0 if half == 1 else 1.0 - d / (half - 1)
        a[:, :, n - 1 - d], b[:, :, d] = drawn(one, mean, share), drawn(other, mean, share)
    return a, b


def grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, np.ndarray]]:
    """The columns of many whole groups at a time, from batches of numbers sorted by their first two columns; a group is held whole."""
    held: list[pa.RecordBatch] = []
    key = lambda batch, at: (batch.column(0)[at].as_py(), batch.column(1)[at].as_py())

    def numbers(t: pa.Table) -> dict[str, np.ndarray]:
        return {c: t.column(c).to_numpy() for c in t.column_names}

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        if key(held[0], 0) != (last := key(batch, batch.num_rows - 1)):
            t = pa.Table.from_batches(held)
            one, two = t.column(0).to_numpy() != last[0], t.column(1).to_numpy() != last[1]
            whole = int(np.flatnonzero(one | two)[-1]) + 1
            yield numbers(t.slice(0, whole))
            held = t.slice(whole).to_batches()
    if held:
        yield numbers(pa.Table.from_batches(held))


def _pass(pixels: DataFrame, axis: str, size: tuple[int, int], margins: tuple[int, int], context: int, halves: tuple[int, int, int], paint: Paint, channels: list[str], seed: int, turn: int | None, only: DataFrame | None) -> DataFrame:
    across, along = ("col", "row") if axis == "v" else ("row", "col")
    (n, m), (k, km) = ((size[0], margins[0]), (size[1], margins[1])) if axis == "v" else ((size[1], margins[1]), (size[0], margins[0]))
    a0, a1, b0, b1 = max(0, n - m - context), min(n, n - m + context), max(0, m - context), min(n, m + context)
    reach = min(a1 - a0, b1 - b0) - 1
    if k - km <= km or reach <= 0:
        return pixels
    wide = max(1, min(halves[1], reach))
    dx, dy = (1, 0) if axis == "v" else (0, 1)
    whole = ~F.greatest(*[F.col(c).isNull() for c in (*KEYS[:2], *channels)], F.lit(False))
    at, core = F.col(across), whole & (F.col(along) >= km) & (F.col(along) < k - km)
    side = lambda name, low, high, sx, sy: pixels.where(core & (at >= low) & (at < high)).select((F.col("x") - sx).alias("x"), (F.col("y") - sy).alias("y"), F.lit(name).alias("side"), F.col(along).alias("along"), at.alias("across"), *channels)
    # Beside the patch, what the tiles hold where its strips go; mostly the same pixels.
    sides = side(0, min(a0, n - m - wide), max(a1, n - m), 0, 0).unionByName(side(1, min(b0, m), max(b1, m + wide), dx, dy))
    if turn is not None:
        sides = sides.where(F.pmod(F.col("x" if axis == "v" else "y"), F.lit(2)) == turn)
    if only is not None:
        sides = sides.join(only.where(F.col("axis") == axis).select("x", "y"), ["x", "y"], "left_semi")
    lows = min(a0, n - m - wide), min(b0, m)
    widths = max(a1, n - m) - lows[0], max(b1, m + wide) - lows[1]
    columns = [*KEYS, *[f"_{c}" for c in channels]]
    at_once = max(1, MOST_CELLS // ((k - 2 * km) * sum(widths) * len(channels)))

    def made(x: np.ndarray, y: np.ndarray, seam: np.ndarray, part: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        """What the seams (x, y) get, from their pixels, each of the seam of that number."""
        images, there = [], np.ones(len(x), bool)
        for s in (0, 1):
            own = np.flatnonzero(part["side"] == s)
            image = np.zeros((len(x), k - 2 * km, widths[s], len(channels)), np.int64)
            for p, c in enumerate(channels):
                image[seam[own], part["along"][own] - km, part["across"][own] - lows[s], p] = part[c][own]
            images.append(image)
            there &= np.bincount(seam[own], minlength=len(x)) > 0
        if not there.any():
            return
        (left, right), x, y = (image[there] for image in images), x[there].astype(np.int64), y[there].astype(np.int64)
        (l0, r0), seeds = lows, [seed + j * 100_003 + i for i, j in zip(x.tolist(), y.tolist(), strict=True)]
        ends = left[:, :, n - m - wide - l0 : n - m - l0], right[:, :, m - r0 : m + wide - r0]
        both = strips(left[:, :, a0 - l0 : a1 - l0], right[:, :, b0 - r0 : b1 - r0], ends, halves[0], halves[1], halves[2], paint, seeds)
        for strip, (tx, ty), start in zip(both or (), ((x, y), (x + dx, y + dy)), (n - m - wide, m), strict=False):
            which, i, j = (v.ravel() for v in np.indices(strip.shape[:3], np.int32))
            own = {"x": tx[which], "y": ty[which], along: i + km, across: j + start} | {f"_{c}": strip[..., p].ravel() for p, c in enumerate(channels)}
            yield pa.RecordBatch.from_arrays([pa.array(own[c].astype(np.int32)) for c in columns], names=columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in grouped(batches):
            fresh = np.append(True, (part["x"][1:] != part["x"][:-1]) | (part["y"][1:] != part["y"][:-1]))
            heads, seam = np.flatnonzero(fresh), np.cumsum(fresh) - 1
            for lo in range(0, len(heads), at_once):
                of = heads[lo : lo + at_once]
                rows = slice(of[0], heads[lo + at_once] if lo + at_once < len(heads) else len(seam))
                yield from made(part["x"][of], part["y"][of], seam[rows] - lo, {c: v[rows] for c, v in part.items()})

    # Many seams are handled together: a tile's strip may be a few pixels, far less work than a call for it.
    fresh = sides.repartition("x", "y").sortWithinPartitions("x", "y").mapInArrow(run, ", ".join(f"{c} int" for c in columns))
    joined = pixels.join(fresh, KEYS, "left")
    return joined.select(*KEYS, *[F.coalesce(f"_{c}", c).alias(c) for c in channels])


def seams_of(tiles: DataFrame, axes: str = "vh") -> DataFrame:
    """axis, x and y of each seam of which both tiles are there: v beside x + 1, h above y + 1."""
    own = tiles.select("x", "y").distinct()
    steps = {"v": (1, 0), "h": (0, 1)}
    pairs = [own.join(own.select((F.col("x") - dx).alias("x"), (F.col("y") - dy).alias("y")), ["x", "y"], "left_semi").select(F.lit(a).alias("axis"), "x", "y") for a, (dx, dy) in steps.items() if a in axes]
    return pairs[0] if len(pairs) == 1 else pairs[0].unionByName(pairs[1])


def repaired(pixels: DataFrame, size: tuple[int, int], margins: tuple[int, int], paint: Paint, channels: list[str], context: int | None = None, mask_half: int = 16, write_half: int = 16, harmonise_half: int = 8, axes: str = "vh", seed: int = 0, most: int | None = None) -> DataFrame:
    """Tiles (size and margins as width, height) after the repair of all seams of which both tiles are there; absent pixels stay absent and count as 0, as those with a null do, a pixel written by no seam stays as it is.

    ``most`` is a cap on seams: the first of both tiles there, side by side before one below the other, by y, then x. Where passes depend on each other their results are kept by the caller's checkpoints; two or four shuffles in all.
    """
    context = context_of(*margins) if context is None else context
    out = pixels.select(*[F.col(c).cast("int").alias(c) for c in (*KEYS, *channels)])
    only = None if most is None else seams_of(out, axes).orderBy(F.desc("axis"), "y", "x").limit(most)
    for axis in axes:
        n, m = (size[0], margins[0]) if axis == "v" else (size[1], margins[1])
        shared = n - m - context < m + write_half or m + context > n - m - write_half
        for turn in (0, 1) if shared else (None,):
            out = _pass(out, axis, size, margins, context, (mask_half, write_half, harmonise_half), paint, channels, seed, turn, only)
    return out
