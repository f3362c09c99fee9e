"""Coverage of a grid by shapes of any size: a shape is cut along a tree of quadrants, not copied to each cell.

A quadrant of level L is a square of 2 ** L cells a side. A shape begins with the few quadrants of its own size; each is
halved along both axes until the piece in it has no edge inside (the quadrant is covered, or empty, and goes on without a
shape) or is a block of 2 ** BLOCK cells a side, whose cells are found at once in arrays. So what is clipped and shuffled
grows with the outline. Shapes wider than a block are dealt to all tasks by one shuffle, those of many corners in pieces a few
levels deep; a small one is finished where it is read. Covered quadrants are added up first and become cells, one number
each, just before the grid is joined.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terraloom.functions import geometry as g
from terraloom.functions.spans import repeated

#: Corners from which a shape is large, levels that a large shape goes down before its pieces are dealt out, level of the blocks, level of the quadrants that become cells in one task.
LARGE, DEEP, BLOCK, WHOLE = 1000, 4, 5, 8
#: Rows and bytes of shapes handed on at once.
ROWS, BYTES = 20_000, 8 << 20
#: Cells of the rings of blocks that are found together; a corner counts as 16.
AT_ONCE = 1 << 18
#: ``area`` is what lies inside in each cell of the quadrant; ``wkb`` is the piece of a quadrant that isn't finished. Then the grid's first and last cells, and how many shapes the piece stands for.
PIECES = "level int, qx long, qy long, area double, wkb binary, ix0 long, iy0 long, ix1 long, iy1 long, copies long"
Rings = list[tuple[int, np.ndarray]]
Box = tuple[float, float, float, float]
Grid = tuple[int, int, int, int]
#: Arrays of level, qx, qy and area, or one level, qx, qy and the bytes of a piece or the rings within a block.
Found = tuple
#: Rings within a block, its qx and qy, the grid, and how many shapes they stand for.
Piece = tuple[Rings, int, int, Grid, int]


def _rings(shape: g.Geometry) -> Rings:
    """The rings that hold points, with 1 for outer ones and -1 for holes; none if the shape has no area or a coordinate isn't finite."""
    if not shape[0].endswith("Polygon"):
        return []
    found = [(1 if k == 0 else -1, ring) for part in shape[1] for k, ring in enumerate(part) if len(ring)]
    return found if all(np.isfinite(ring).all() for _, ring in found) else []


def _packed(rings: Rings) -> bytes:
    nothing = np.empty((0, 2))
    return g.to_wkb(("MultiPolygon", [[ring] if sign > 0 else [nothing, ring] for sign, ring in rings]))


def _clipped(rings: Rings, cut: Callable[[np.ndarray], np.ndarray]) -> Rings:
    found = [(sign, cut(ring)) for sign, ring in rings]
    return [(sign, ring) for sign, ring in found if len(ring) > 2]


def _halves(rings: Rings, axis: int, bound: float) -> tuple[Rings, Rings]:
    return _clipped(rings, lambda r: g.half_of_ring(r, axis, bound, -1)), _clipped(rings, lambda r: g.half_of_ring(r, axis, bound, 1))


def _open_inside(ring: np.ndarray, box: Box) -> bool:
    """Whether an edge leaves the box's outline, so that the inside isn't the same everywhere."""
    after = np.roll(ring, -1, axis=0)
    on = np.zeros(len(ring), bool)
    for axis, bound in ((0, box[0]), (0, box[2]), (1, box[1]), (1, box[3])):
        on |= (ring[:, axis] == bound) & (after[:, axis] == bound)
    return not on.all()


def _box(level: int, qx: int, qy: int, size: float) -> Box:
    return (qx << level) * size, (qy << level) * size, ((qx + 1) << level) * size, ((qy + 1) << level) * size


def _started(rings: Rings, size: float, grid: Grid) -> list[tuple[Rings, int, int, int]]:
    """At most 2 x 2 quadrants about as wide as the part of the shape's envelope that lies on the grid, each with its piece."""
    every = np.concatenate([ring for _, ring in rings])
    (x0, y0), (x1, y1) = np.maximum(every.min(axis=0), np.array(grid[:2]) * size), np.minimum(every.max(axis=0), (np.array(grid[2:]) + 1) * size)
    if x1 <= x0 or y1 <= y0:
        return []
    level = 0
    while size * 2**level < max(x1 - x0, y1 - y0):
        level += 1
    out, side = [], size * 2**level
    for qx in range(math.floor(x0 / side), math.ceil(x1 / side)):
        for qy in range(math.floor(y0 / side), math.ceil(y1 / side)):
            box = _box(level, qx, qy, size)
            out.append((_clipped(rings, lambda r: g.clipped_ring(r, box)), level, qx, qy))  # noqa: B023
    return out


def _wound(rings: list[np.ndarray], n: int) -> tuple[np.ndarray, np.ndarray]:
    """What each ring winds around in each of n x n unit cells (ring, x, y), and which of them an edge passes; the rings lie within them.

    An edge counts its height for all cells to its left, and the part to its left in its own cell. Edges between cells pass none.
    """
    size = np.array([len(ring) for ring in rings], np.int64)
    owner, last = np.repeat(np.arange(len(rings)), size), np.cumsum(size) - 1
    start, after = np.concatenate(rings), np.arange(1, size.sum() + 1)
    after[last] = last - size + 1
    step = start[after] - start
    between = ((step == 0) & (start == np.floor(start))).any(axis=1)
    each, at = [np.arange(len(start))] * 2, [np.zeros(len(start)), np.ones(len(start))]
    for axis in (0, 1):
        one, other = start[:, axis], start[:, axis] + step[:, axis]
        i, line = repeated(np.floor(np.minimum(one, other)).astype(np.int64) + 1, np.ceil(np.maximum(one, other)).astype(np.int64) - 1)
        each.append(i)
        at.append((line - one[i]) / step[i, axis])
    each, at = np.concatenate(each), np.concatenate(at)
    order = np.lexsort((at, each))
    each, at = each[order], at[order]
    same = each[1:] == each[:-1]
    edge, middle, part = each[1:][same], (at[1:] + at[:-1])[same] / 2, (at[1:] - at[:-1])[same]
    x, y = (start[edge] + middle[:, None] * step[edge]).T
    height = part * step[edge, 1]
    column, row = (np.clip(np.floor(c), 0, n - 1).astype(np.int64) for c in (x, y))
    cell, shape = (owner[edge] * n + column) * n + row, (len(rings), n, n)
    own = np.bincount(cell, height * (x - column), len(rings) * n * n).reshape(shape)
    whole = np.bincount(cell, height, len(rings) * n * n).reshape(shape)
    left = np.cumsum(whole[:, ::-1], axis=1)[:, ::-1] - whole
    return np.abs(own + left), np.bincount(cell[~between[edge]], minlength=len(rings) * n * n).reshape(shape) > 0


def _blocks(pieces: list[Piece], level: int, size: float) -> Iterator[Found]:
    """The cells of blocks of one level that hold some of the pieces, those of the same block added up; four of the same in a square that no edge passes go on as one, and so on."""
    n = 1 << level
    at, of, signs = [], [], []
    for k, (rings, qx, qy, _, _) in enumerate(pieces):
        corner = (qx << level, qy << level)
        for sign, ring in rings:
            inside = ring / size - corner
            line = np.round(inside)
            inside = np.where(ring == (line + corner) * size, line, inside)  # where the quadrants cut it, exactly on the line
            at.append(np.clip(inside, 0, n))
            of.append(k)
            signs.append(sign)
    wound, by = _wound(at, n)
    total, passed = np.zeros((len(pieces), n, n)), np.zeros((len(pieces), n, n), bool)
    np.add.at(total, of, np.array(signs)[:, None, None] * wound)
    np.logical_or.at(passed, of, by)
    total = np.where(passed, total, np.round(total)).clip(0)
    for k, (_, qx, qy, grid, copies) in enumerate(pieces):
        x0, y0 = qx << level, qy << level
        total[k] *= copies
        total[k, : max(grid[0] - x0, 0)] = total[k, :, : max(grid[1] - y0, 0)] = total[k, max(grid[2] + 1 - x0, 0) :] = total[k, :, max(grid[3] + 1 - y0, 0) :] = 0
    places, block = np.unique(np.array([p[1:3] for p in pieces], np.int64), axis=0, return_inverse=True)
    (qx, qy), block = places.T, block.ravel()
    summed, met = np.zeros((len(qx), n, n)), np.zeros((len(qx), n, n), bool)
    np.add.at(summed, block, total)
    np.logical_or.at(met, block, passed)
    total, passed = summed, met
    for up in range(level + 1):
        m = n >> (up + 1)
        joined = np.zeros((len(qx), m, m), bool)
        alone = total
        if m:
            four = total.reshape(-1, m, 2, m, 2).transpose(0, 1, 3, 2, 4).reshape(-1, m, m, 4)
            joined = (four == four[..., :1]).all(axis=3) & ~passed.reshape(-1, m, 2, m, 2).any(axis=(2, 4))
            alone = total * ~joined.repeat(2, axis=1).repeat(2, axis=2)
        k, i, j = np.nonzero(alone)
        if len(k):
            yield np.full(len(k), up), i + (qx[k] << (level - up)), j + (qy[k] << (level - up)), alone[k, i, j] * size * size
        if not joined.any():
            return
        total, passed = np.where(joined, four[..., 0], 0), ~joined


def _finished(todo: list[tuple[Rings, int, int, int]], size: float, grid: Grid, stop: int = -1) -> Iterator[Found]:
    """Covered quadrants, and the rings within blocks; pieces from level ``stop`` on that are wider than a block are handed on as they are."""
    while todo:
        rings, level, qx, qy = todo.pop()
        first, last = (qx << level, qy << level), (((qx + 1) << level) - 1, ((qy + 1) << level) - 1)
        if not rings or first[0] > grid[2] or first[1] > grid[3] or last[0] < grid[0] or last[1] < grid[1]:
            continue
        box = _box(level, qx, qy, size)
        if level <= BLOCK:
            yield level, qx, qy, rings
            continue
        if not any(_open_inside(ring, box) for _, ring in rings):
            square = (box[2] - box[0]) * (box[3] - box[1])
            times = sum(sign * round(abs(g.signed_area(ring)) / square) for sign, ring in rings)
            if times <= 0:
                continue
            if first[0] >= grid[0] and first[1] >= grid[1] and last[0] <= grid[2] and last[1] <= grid[3]:
                yield np.array([level]), np.array([qx]), np.array([qy]), np.array([times * size * size])
                continue
        elif level <= stop:
            yield level, qx, qy, _packed(rings)
            continue
        for i, half in enumerate(_halves(rings, 0, ((2 * qx + 1) << (level - 1)) * size)):
            for j, quarter in enumerate(_halves(half, 1, ((2 * qy + 1) << (level - 1)) * size)):
                todo.append((quarter, level - 1, 2 * qx + i, 2 * qy + j))


def _batches(found: Iterator[tuple[Found, Grid, int]], cell: float) -> Iterator[pd.DataFrame]:
    names = [c.split()[0] for c in PIECES.split(", ")]

    def frame(closed: list[Found], opened: list[tuple]) -> pd.DataFrame:
        arrays = [np.concatenate([row[k] for row in closed]) for k in range(4)] if closed else [[]] * 4
        both = [pd.DataFrame(dict(zip(names, arrays))), pd.DataFrame(opened, columns=names)]  # noqa: B905
        out = pd.concat([df for df in both if len(df)] or both[1:]).reindex(columns=names)
        return out.astype({c: "Int64" for c in names if c not in ("area", "wkb")}).assign(wkb=out.wkb.astype(object).where(out.wkb.notna(), None))

    closed, opened, rows, size = [], [], 0, 0
    waiting, work = defaultdict(list), Counter()
    for found_one, grid, copies in found:
        if isinstance(found_one[3], list):
            level, qx, qy, rings = found_one
            waiting[level].append((rings, qx, qy, grid, copies))
            work[level] += sum(max(1 << (2 * level), 16 * len(ring)) for _, ring in rings)
            if work[level] < AT_ONCE:
                continue
            made = list(_blocks(waiting.pop(level), level, cell))
            closed += made
            rows += sum(len(m[0]) for m in made)
            del work[level]
        elif isinstance(found_one[3], bytes):
            level, qx, qy, data = found_one
            opened.append((level, qx, qy, None, data, *grid, copies))
            size += len(data)
            rows += 1
        else:
            closed.append((*found_one[:3], found_one[3] * copies))
            rows += len(found_one[0])
        if rows >= ROWS or size >= BYTES:
            yield frame(closed, opened)
            closed, opened, rows, size = [], [], 0, 0
    for level, pieces in waiting.items():
        closed += _blocks(pieces, level, cell)
    if closed or opened:
        yield frame(closed, opened)


def cut_to_quadrants(shapes: DataFrame, cells: DataFrame, size: float) -> DataFrame:
    """level, qx, qy, area: the cells and covered quadrants of the polygons in ``wkb`` (grid coordinates) on the grid of ``cells`` (ix, iy); what shapes hold of the same block is added up where they are cut together.

    A column ``copies`` of ``shapes`` says how many equal shapes a row stands for; their areas are added up. Nulls, bytes that can't be read, other kinds of shapes and shapes with a coordinate that isn't finite count as nothing, as
    do shapes beside the grid; without cells there are no rows. Shapes that overlap count each.
    """

    def first(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def found() -> Iterator[tuple[Found, Grid, int]]:
            for batch in batches:
                for data, copies, *grid in batch[["wkb", "copies", "ix0", "iy0", "ix1", "iy1"]].itertuples(index=False):
                    if data is None or pd.isna(grid[0]):
                        continue
                    try:
                        rings = _rings(g.from_wkb(data))
                    except ValueError:
                        continue
                    grid = tuple(map(int, grid))
                    begun = _started(rings, size, grid) if rings else []
                    deep = DEEP if sum(len(ring) for _, ring in rings) > LARGE else 0
                    for one in _finished(begun, size, grid, max(begun[0][1] - deep, BLOCK + 1) if begun else -1):
                        yield one, grid, int(copies)

        yield from _batches(found(), size)

    def rest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def found(batch: pd.DataFrame) -> Iterator[tuple[Found, Grid, int]]:
            for level, qx, qy, data, *grid, copies in batch.drop(columns="area").itertuples(index=False):
                grid = tuple(map(int, grid))
                for one in _finished([(_rings(g.from_wkb(data)), int(level), int(qx), int(qy))], size, grid):
                    yield one, grid, int(copies)

        for batch in batches:
            yield batch[batch.wkb.isna()]
            yield from _batches(found(batch[batch.wkb.notna()]), size)

    ends = cells.agg(*[f(c).cast("long").alias(f"{c}{n}") for n, f in ((0, F.min), (1, F.max)) for c in ("ix", "iy")])
    copies = F.col("copies") if "copies" in shapes.columns else F.lit(1)
    begun = shapes.select("wkb", copies.cast("long").alias("copies")).crossJoin(F.broadcast(ends)).mapInPandas(first, PIECES)  # one row beside each
    # A stated number, as pieces are few bytes and much work: by their size they would be put together in one task.
    tasks = int(shapes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = begun.repartition(tasks, "level", "qx", "qy", F.xxhash64("wkb"))
    return dealt.mapInPandas(rest, PIECES).select("level", "qx", "qy", "area")


def area_by_cell(shapes: DataFrame, cells: DataFrame, size: float) -> DataFrame:
    """ix, iy and the area of the polygons in ``wkb`` (as often as ``copies`` says, where there is that column) within that cell, for cells where there is some; overlaps count each."""
    wide = F.expr(f"greatest(level - {WHOLE}, 0)")
    parts = cut_to_quadrants(shapes, cells, size).withColumn("wide", wide)
    span = lambda q, by: F.explode(F.expr(f"sequence(shiftleft({q}, {by}), shiftleft({q} + 1, {by}) - 1)"))
    parts = parts.select("level", "wide", span("qx", "wide").alias("qx"), "qy", "area").select(F.expr("level - wide").alias("level"), "qx", span("qy", "wide").alias("qy"), "area")
    summed = parts.groupBy("level", "qx", "qy").agg(F.sum("area").alias("area"))
    spread = summed.select("level", span("qx", "level").alias("ix"), "qy", "area").select("ix", span("qy", "level").alias("iy"), "area")
    return spread.groupBy(F.col("ix").cast("int").alias("ix"), F.col("iy").cast("int").alias("iy")).agg(F.sum("area").alias("area"))
