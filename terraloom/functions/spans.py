"""Polygons as spans on a grid: the pixels whose centres they hold, and the boxes of a row of tiles that they meet.

Both go row by row over the edges alone, so the work grows with the outline and the rows it crosses, not with the area; what
comes out is (row, first, last) with both ends included, for Spark to expand.
"""

from __future__ import annotations

import math

import numpy as np

#: Rows that are worked on at once, so that a shape of any height takes bounded memory beside its own edges.
ROWS = 4096


def edges_of(rings: list[np.ndarray]) -> np.ndarray:
    """Edges (x0, y0, x1, y1) of closed rings."""
    parts = [np.column_stack([r[:-1], r[1:]]) for r in rings if len(r) > 1]
    return np.concatenate(parts) if parts else np.empty((0, 4))


def repeated(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each i the whole numbers first[i] to last[i]: the i of each, and the number."""
    n = np.maximum(last - first + 1, 0)
    i = np.repeat(np.arange(len(n)), n)
    return i, np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + first[i]


def _cut_by_lines(edges: np.ndarray, start: float, step: float, lo: int, hi: int, base: np.ndarray | int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where the lines y = start + k step (lo <= k < hi) lie within the shape: k, x where each stretch begins and ends (even-odd). ``base`` is added to an edge's k, to keep shapes apart."""
    low, high = np.minimum(edges[:, 1], edges[:, 3]), np.maximum(edges[:, 1], edges[:, 3])
    # An edge is met from its lower end on and before its upper one, so that a corner counts once.
    i, k = repeated(np.maximum(np.ceil((low - start) / step), lo).astype(np.int64), np.minimum(np.ceil((high - start) / step) - 1, hi - 1).astype(np.int64))
    x0, y0, x1, y1 = edges[i].T
    x = x0 + (start + k * step - y0) / (y1 - y0) * (x1 - x0)
    k = k + (base[i] if isinstance(base, np.ndarray) else base)
    order = np.lexsort((x, k))
    k, x = k[order], x[order]
    return k[::2], x[::2], x[1::2]


def joined(row: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans of each row, those that overlap or touch as one."""
    there = last >= first
    row, first, last = row[there], first[there], last[there]
    if not len(row):
        return row, first, last
    width = int(last.max() - first.min()) + 3
    a, b = row * width + first - first.min(), row * width + last - first.min()
    order = np.argsort(a, kind="stable")
    a, b = a[order], np.maximum.accumulate(b[order])
    new = np.r_[True, a[1:] > b[:-1] + 1]
    base, ends = a[new], b[np.r_[np.flatnonzero(new)[1:] - 1, len(b) - 1]]
    return base // width, base % width + first.min(), ends % width + first.min()


def centre_spans(rings: list[np.ndarray], rows: tuple[int, int] | None, cols: int | None) -> np.ndarray:
    """Pixels of a grid of unit squares whose centres the rings hold: n x 3 of row, first, last. Without rows or cols the grid has no ends that way."""
    edges, out = edges_of(rings), [np.empty((0, 3), np.int64)]
    if rows is None:
        ends = edges[:, 1::2]
        ends = ends[np.isfinite(ends)]
        rows = (math.floor(ends.min()), math.ceil(ends.max())) if len(ends) else (0, 0)
    for lo in range(rows[0], rows[1], ROWS):
        k, x0, x1 = _cut_by_lines(edges, 0.5, 1.0, lo, min(lo + ROWS, rows[1]))
        first, last = np.ceil(x0 - 0.5).astype(np.int64), np.ceil(x1 - 0.5).astype(np.int64) - 1
        if cols is not None:
            first, last = np.maximum(first, 0), np.minimum(last, cols - 1)
        out.append(np.stack(joined(k, first, last), 1))
    return np.concatenate(out)


def touched_spans(rings: list[np.ndarray], left: float, top: float, step: float, size: float, cols: int, rows: int) -> np.ndarray:
    """Boxes [left + i step, + size] x [top + j step, + size] that share a point with the shape: n x 3 of j, first i, last i.

    What a row of boxes sees of the shape is, seen along the row, where its edges pass through the row and where the row's lower side cuts it.
    """
    edges = edges_of(rings)
    return touched_by_many(edges, np.zeros(len(edges), np.int64), left, top, step, size, cols, rows)[:, 1:]


def touched_by_many(edges: np.ndarray, owner: np.ndarray, left: float, top: float, step: float, size: float, cols: int, rows: int) -> np.ndarray:
    """``touched_spans`` of many shapes at once, given by their edges and the number of each edge's shape: n x 4 of shape, j, first i, last i."""
    out = [np.empty((0, 4), np.int64)]
    low, high = np.minimum(edges[:, 1], edges[:, 3]), np.maximum(edges[:, 1], edges[:, 3])
    base = owner.astype(np.int64) * rows
    for lo in range(0, rows, ROWS):
        hi = min(lo + ROWS, rows)
        first, last = np.ceil((low - size - top) / step), np.floor((high - top) / step)
        i, j = repeated(np.maximum(first, lo).astype(np.int64), np.minimum(last, hi - 1).astype(np.int64))
        x0, y0, x1, y1 = edges[i].T
        with np.errstate(divide="ignore", invalid="ignore"):
            at = lambda y: np.where(y1 == y0, 0.0, np.clip((y - y0) / (y1 - y0), 0, 1))
            t0, t1 = at(top + j * step), np.where(y1 == y0, 1.0, at(top + j * step + size))
        a, b = x0 + t0 * (x1 - x0), x0 + t1 * (x1 - x0)
        k, c0, c1 = _cut_by_lines(edges, top + size, step, lo, hi, base)
        row, x0, x1 = np.r_[base[i] + j, k], np.r_[np.minimum(a, b), c0], np.r_[np.maximum(a, b), c1]
        first, last = np.ceil((x0 - size - left) / step).astype(np.int64), np.floor((x1 - left) / step).astype(np.int64)
        row, first, last = joined(row, np.maximum(first, 0), np.minimum(last, cols - 1))
        out.append(np.stack([row // rows, row % rows, first, last], 1))
    return np.concatenate(out)
