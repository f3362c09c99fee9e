"""Geometry on WKB columns: a small numpy kernel and the Arrow-batched functions over it.

Inside the kernel a geometry is (kind, parts): points are one n x 2 array; lines a list of arrays; polygons a list of
polygons, each a list of closed rings, the first one outside. Third coordinates are read past. Spark has no functions for
areas, clipping or repair, so these run in Pandas functions; envelopes come out as structs to filter and bucket natively.
"""

from __future__ import annotations

import json
import math
import struct
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, BooleanType, DoubleType, LongType, StringType, StructField, StructType

from terraloom.functions.projection import mercator_forward, mercator_inverse, utm_forward, utm_inverse

KINDS = {1: "Point", 2: "LineString", 3: "Polygon", 4: "MultiPoint", 5: "MultiLineString", 6: "MultiPolygon"}
CODES = {name: code for code, name in KINDS.items()}
Geometry = tuple[str, list]
TINY = 1e-12

# --- WKB ----------------------------------------------------------------------------------------------------------


class _Reader:
    def __init__(self, data: bytes) -> None:
        self.data, self.at = data, 0

    def head(self) -> tuple[str, str, int]:
        order = "<" if self.data[self.at] == 1 else ">"
        code = struct.unpack_from(order + "I", self.data, self.at + 1)[0]
        self.at += 5
        if code & 0x20000000:  # an SRID follows
            self.at += 4
        dims = 2 + bool(code & 0x80000000 or (code & 0xFFFF) // 1000 in (1, 3)) + bool(code & 0x40000000 or (code & 0xFFFF) // 1000 in (2, 3))
        kind = KINDS.get((code & 0xFFFF) % 1000)
        if kind is None:
            raise ValueError(f"geometry code {code}")
        return order, kind, dims

    def count(self, order: str) -> int:
        self.at += 4
        return struct.unpack_from(order + "I", self.data, self.at - 4)[0]

    def points(self, order: str, dims: int, n: int) -> np.ndarray:
        out = np.frombuffer(self.data, order + "f8", n * dims, self.at).reshape(n, dims)[:, :2].astype(float)
        self.at += 8 * n * dims
        return out

    def geometry(self) -> Geometry:
        order, kind, dims = self.head()
        if kind == "Point":
            return kind, [self.points(order, dims, 1)]
        if kind == "LineString":
            return kind, [self.points(order, dims, self.count(order))]
        if kind == "Polygon":
            return kind, [[self.points(order, dims, self.count(order)) for _ in range(self.count(order))]]
        return kind, [p for _ in range(self.count(order)) for p in self.geometry()[1]]


def from_wkb(data: bytes) -> Geometry:
    """A ValueError if the bytes can't be read."""
    try:
        return _Reader(bytes(data)).geometry()
    except (struct.error, IndexError) as e:
        raise ValueError("broken WKB") from e


def _line(points: np.ndarray) -> bytes:
    return struct.pack("<I", len(points)) + np.ascontiguousarray(points, "<f8").tobytes()


def to_wkb(geometry: Geometry) -> bytes:
    kind, parts = geometry
    head = lambda k: struct.pack("<BI", 1, CODES[k])
    single = kind.removeprefix("Multi")
    body = {"Point": lambda p: np.ascontiguousarray(p, "<f8").tobytes(), "LineString": _line, "Polygon": lambda p: struct.pack("<I", len(p)) + b"".join(map(_line, p))}[single]
    if kind == single:
        return head(kind) + (body(parts[0]) if parts else struct.pack("<I", 0))
    return head(kind) + struct.pack("<I", len(parts)) + b"".join(head(single) + body(p) for p in parts)


# --- GeoJSON ------------------------------------------------------------------------------------------------------


def from_geojson(node: dict) -> Geometry:
    kind, c = node["type"], node["coordinates"]
    xy = lambda points: np.array([p[:2] for p in points], float).reshape(-1, 2)
    if kind == "Point":
        return kind, [xy([c])] if c else []
    if kind == "LineString":
        return kind, [xy(c)]
    if kind == "Polygon":
        return kind, [[xy(r) for r in c]] if c else []
    if kind == "MultiPoint":
        return kind, [xy([p]) for p in c]
    if kind == "MultiLineString":
        return kind, [xy(line) for line in c]
    if kind == "MultiPolygon":
        return kind, [[xy(r) for r in p] for p in c]
    raise ValueError(f"geometry type {kind}")


def to_geojson(geometry: Geometry) -> dict:
    kind, parts = geometry
    shown = [[r.tolist() for r in p] if isinstance(p, list) else p.tolist() for p in parts]
    if kind.endswith("Point"):
        shown = [p[0] for p in shown]
    return {"type": kind, "coordinates": shown if kind.startswith("Multi") else (shown[0] if shown else [])}


# --- measures -----------------------------------------------------------------------------------------------------


def arrays(geometry: Geometry) -> list[np.ndarray]:
    return [a for p in geometry[1] for a in (p if isinstance(p, list) else [p])]


def is_empty(geometry: Geometry) -> bool:
    return not any(len(a) for a in arrays(geometry))


def envelope(geometry: Geometry) -> tuple[float, float, float, float] | None:
    found = [a for a in arrays(geometry) if len(a)]
    every = np.concatenate(found) if found else np.zeros((0, 2))
    every = every[np.isfinite(every).all(axis=1)]
    return (*every.min(axis=0), *every.max(axis=0)) if len(every) else None


def signed_area(ring: np.ndarray) -> float:
    if len(ring) < 3:
        return 0.0
    x, y = (ring - ring[0]).T
    return float(np.dot(x[:-1], y[1:]) - np.dot(y[:-1], x[1:])) / 2  # what closes the ring is 0, as the first point is


def area(geometry: Geometry) -> float:
    if not geometry[0].endswith("Polygon"):
        return 0.0
    return sum(abs(signed_area(p[0])) - sum(abs(signed_area(h)) for h in p[1:]) for p in geometry[1] if p)


def outer_points(geometry: Geometry) -> int:
    """Coordinates of outer rings, the closing ones included; of other kinds all."""
    return sum(len(p[0]) if isinstance(p, list) else len(p) for p in geometry[1] if len(p))


def centroid(geometry: Geometry) -> tuple[float, float]:
    weight, sx, sy = 0.0, 0.0, 0.0
    for p in geometry[1] if geometry[0].endswith("Polygon") else []:
        for k, ring in enumerate(p):
            origin = ring[0]
            x, y = (ring - origin).T
            cross = x * np.roll(y, -1) - np.roll(x, -1) * y
            a = cross.sum() / 2
            sign = (1 if k == 0 else -1) * (1 if a >= 0 else -1)
            weight += sign * a
            sx += sign * (((x + np.roll(x, -1)) * cross).sum() / 6 + origin[0] * a)
            sy += sign * (((y + np.roll(y, -1)) * cross).sum() / 6 + origin[1] * a)
    if abs(weight) > TINY:
        return sx / weight, sy / weight
    every = np.concatenate(arrays(geometry))
    return tuple(every.mean(axis=0))


def centroids(shapes: list[Geometry]) -> np.ndarray:
    """``centroid`` of many polygonal shapes at once, n x 2."""
    rings = [(i, 1 if k == 0 else -1, r) for i, shape in enumerate(shapes) for p in shape[1] for k, r in enumerate(p) if len(r)]
    owner, sign, size = np.array([i for i, _, _ in rings], np.int64), np.array([s for _, s, _ in rings]), np.array([len(r) for _, _, r in rings], np.int64)
    points = np.concatenate([np.empty((0, 2)), *(r for _, _, r in rings)])
    first = np.cumsum(size) - size
    after = np.arange(1, len(points) + 1)
    after[first + size - 1] = first
    ring = np.repeat(np.arange(len(rings)), size)
    start = points[first]
    (x, y), (nx, ny) = (points - start[ring]).T, (points[after] - start[ring]).T
    cross = x * ny - nx * y
    add = lambda v: np.bincount(ring, v, len(rings))
    a = add(cross) / 2
    sign = np.where(a >= 0, sign, -sign)
    whole = lambda v: np.bincount(owner, sign * v, len(shapes))
    weight, sx, sy = whole(a), whole(add((x + nx) * cross) / 6 + start[:, 0] * a), whole(add((y + ny) * cross) / 6 + start[:, 1] * a)
    with np.errstate(divide="ignore", invalid="ignore"):
        out = np.column_stack([sx / weight, sy / weight])
    for i in np.flatnonzero(~(np.abs(weight) > TINY)):
        out[i] = centroid(shapes[i])
    return out


# --- clipping -----------------------------------------------------------------------------------------------------


def half_of_ring(points: np.ndarray, axis: int, bound: float, sign: int) -> np.ndarray:
    """The part of a ring on one side of a line along an axis: above the bound with sign 1, below it with -1."""
    depth = sign * (points[:, axis] - bound)
    inside = depth >= 0
    if inside.all():
        return points
    after, after_depth = np.roll(points, -1, axis=0), np.roll(depth, -1)
    crosses = inside != (after_depth >= 0)
    t = np.where(crosses, depth / np.where(crosses, depth - after_depth, 1), 0)
    cut = points + t[:, None] * (after - points)
    cut[:, axis] = bound
    both = np.stack([points, cut], axis=1).reshape(-1, 2)
    return both[np.stack([inside, crosses], axis=1).ravel()]


def clipped_ring(ring: np.ndarray, box: tuple[float, float, float, float]) -> np.ndarray:
    """The part of a ring within a box, edge by edge of the box; its signed area is right even where pieces are joined along the edge."""
    points = ring[:-1] if len(ring) > 1 and (ring[0] == ring[-1]).all() else ring
    for axis, bound, sign in ((0, box[0], 1), (0, box[2], -1), (1, box[1], 1), (1, box[3], -1)):
        if not len(points):
            break
        points = half_of_ring(points, axis, bound, sign)
    return points


def area_within(geometry: Geometry, box: tuple[float, float, float, float]) -> float:
    total = 0.0
    for p in geometry[1] if geometry[0].endswith("Polygon") else []:
        for k, ring in enumerate(p):
            total += (1 if k == 0 else -1) * abs(signed_area(clipped_ring(ring, box)))
    return max(total, 0.0)


def areas_within(shapes: list[Geometry], shape: np.ndarray, boxes: np.ndarray) -> np.ndarray:
    """``area_within`` of many at once: shapes[shape[i]] and boxes[i] (x0, y0, x1, y1). An edge counts the strip between itself and the box's left side, within the box."""
    rings = [(i, 1 if k == 0 else -1, r) for i, g in enumerate(shapes) if g[0].endswith("Polygon") for p in g[1] for k, r in enumerate(p) if len(r) > 2]
    total = np.zeros(len(shape))
    if not rings:
        return total
    edges = [np.column_stack([r, np.roll(r, -1, axis=0)]) for _, _, r in rings]
    n_rings = np.bincount([i for i, _, _ in rings], minlength=len(shapes))
    first_ring = np.cumsum(n_rings) - n_rings
    n_edges = np.array([len(e) for e in edges])
    first_edge, edges, signs = np.cumsum(n_edges) - n_edges, np.concatenate(edges), np.array([s for _, s, _ in rings])
    spread = lambda n: np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    for lo, hi in slices(np.bincount(np.repeat(np.arange(len(shapes)), n_rings), n_edges, len(shapes))[shape]):
        own = shape[lo:hi]
        row = np.repeat(np.arange(hi - lo), n_rings[own])
        ring = first_ring[own][row] + spread(n_rings[own])
        part = np.repeat(np.arange(len(ring)), n_edges[ring])
        ax, ay, bx, by = edges[first_edge[ring][part] + spread(n_edges[ring])].T
        x0, y0, x1, y1 = boxes[lo:hi][row][part].T
        with np.errstate(divide="ignore", invalid="ignore"):
            at = lambda v, a, b: np.where(a == b, 0.0, np.clip((v - a) / (b - a), 0, 1))
            ends = np.sort(np.stack([at(y0, ay, by), np.where(ay == by, 0.0, at(y1, ay, by))]), axis=0)
            cuts = np.sort(np.stack([ends[0], *(np.clip(at(v, ax, bx), *ends) for v in (x0, x1)), ends[1]]), axis=0)
        wide = np.clip(ax + cuts * (bx - ax), x0, x1) - x0
        found = ((wide[1:] + wide[:-1]) * np.diff(cuts, axis=0)).sum(0) / 2 * (by - ay)
        total[lo:hi] = np.bincount(row, signs[ring] * np.abs(np.bincount(part, found, len(ring))), hi - lo)
    return np.maximum(total, 0)


def slices(sizes: np.ndarray, most: int = 1 << 17) -> list[tuple[int, int]]:
    """Neighbouring rows put together up to a size; a larger one is alone."""
    out, lo, held = [], 0, 0
    for i, size in enumerate(sizes.tolist()):
        if held and held + size > most:
            out.append((lo, i))
            lo, held = i, 0
        held += size
    return [*out, (lo, len(sizes))] if len(sizes) > lo else out


def contains(geometry: Geometry, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Even-odd test of points against all rings."""
    inside = np.zeros(np.shape(x), bool)
    for ring in arrays(geometry):
        corners = ring.tolist()
        for (x0, y0), (x1, y1) in zip(corners[:-1], corners[1:], strict=True):
            if y0 != y1:
                inside ^= ((y0 > y) != (y1 > y)) & (x < (x1 - x0) * (y - y0) / (y1 - y0) + x0)
    return inside


def meets_box(geometry: Geometry, box: tuple[float, float, float, float]) -> bool:
    """Whether a polygon and a box share any point, touching included."""
    x0, y0, x1, y1 = box
    for ring in arrays(geometry):
        a, b = ring[:-1], ring[1:]
        lo, hi = np.minimum(a, b), np.maximum(a, b)
        near = (lo[:, 0] <= x1) & (hi[:, 0] >= x0) & (lo[:, 1] <= y1) & (hi[:, 1] >= y0)
        d = b - a
        sides = np.stack([d[:, 0] * (cy - a[:, 1]) - d[:, 1] * (cx - a[:, 0]) for cx, cy in ((x0, y0), (x0, y1), (x1, y0), (x1, y1))], axis=1)
        if (near & (sides.min(axis=1) <= 0) & (sides.max(axis=1) >= 0)).any():
            return True
    return bool(contains(geometry, np.array([x0]), np.array([y0]))[0])


def meet(one: Geometry, other: Geometry) -> bool:
    """Whether two polygonal geometries share any point, touching included: edges that meet, or one within the other."""
    ours, theirs = ([np.column_stack([r[:-1], r[1:]]) for r in arrays(x) if len(r) > 1] for x in (one, other))
    if not ours or not theirs:
        return False
    a, b = np.concatenate(ours), np.concatenate(theirs)
    side = lambda p0, p1, q: (p1[..., 0] - p0[..., 0]) * (q[..., 1] - p0[..., 1]) - (p1[..., 1] - p0[..., 1]) * (q[..., 0] - p0[..., 0])
    for lo in range(0, len(a), max(1, 1_000_000 // len(b))):
        p = a[lo : lo + max(1, 1_000_000 // len(b)), None, :]
        p0, p1, q0, q1 = p[..., :2], p[..., 2:], b[None, :, :2], b[None, :, 2:]
        near = ((np.minimum(p0, p1) <= np.maximum(q0, q1)) & (np.minimum(q0, q1) <= np.maximum(p0, p1))).all(-1)
        if (near & (side(p0, p1, q0) * side(p0, p1, q1) <= 0) & (side(q0, q1, p0) * side(q0, q1, p1) <= 0)).any():
            return True
    return _part_within(one, other) or _part_within(other, one)


def _part_within(inner: Geometry, outer: Geometry) -> bool:
    """Whether any ring of one lies in the other, for parts that don't touch."""
    firsts = np.array([r[0] for r in arrays(inner) if len(r)])
    return bool(contains(outer, firsts[:, 0], firsts[:, 1]).any())


# --- validity and repair ------------------------------------------------------------------------------------------


def _crossings(rings: list[np.ndarray]) -> list[list[list[float]]]:
    """For each ring and edge the places along it (0 to 1) where it meets another edge other than at a shared end."""
    # Plain numbers: arrays of two are slow.
    plain = [ring.tolist() for ring in rings]
    edges = [(k, i, ring[i], ring[i + 1]) for k, ring in enumerate(plain) for i in range(len(ring) - 1)]
    places: list[list[list[float]]] = [[[] for _ in range(max(len(ring) - 1, 0))] for ring in rings]
    order = sorted(range(len(edges)), key=lambda e: min(edges[e][2][0], edges[e][3][0]))
    active: list[int] = []
    for e in order:
        k, i, p, q = edges[e]
        left = min(p[0], q[0])
        active = [o for o in active if max(edges[o][2][0], edges[o][3][0]) >= left]
        for o in active:
            m, j, r, s = edges[o]
            if max(p[1], q[1]) < min(r[1], s[1]) or max(r[1], s[1]) < min(p[1], q[1]):
                continue
            for t, u in _meet(p, q, r, s):
                if TINY < t < 1 - TINY:
                    places[k][i].append(t)
                if TINY < u < 1 - TINY:
                    places[m][j].append(u)
        active.append(e)
    return places


def _meet(p: list[float], q: list[float], r: list[float], s: list[float]) -> list[tuple[float, float]]:
    dx, dy, ex, ey, fx, fy = q[0] - p[0], q[1] - p[1], s[0] - r[0], s[1] - r[1], r[0] - p[0], r[1] - p[1]
    cross = dx * ey - dy * ex
    scale = math.hypot(dx, dy) * math.hypot(ex, ey)
    if scale == 0:
        return []
    if abs(cross) > TINY * scale:
        t, u = (fx * ey - fy * ex) / cross, (fx * dy - fy * dx) / cross
        return [(t, u)] if -TINY <= t <= 1 + TINY and -TINY <= u <= 1 + TINY else []
    if abs(fx * dy - fy * dx) > TINY * max(scale, math.hypot(dx, dy) * math.hypot(fx, fy)):
        return []
    dd, ee = dx * dx + dy * dy, ex * ex + ey * ey
    on_d = [(((x[0] - p[0]) * dx + (x[1] - p[1]) * dy) / dd, u) for x, u in ((r, 0.0), (s, 1.0))]
    on_e = [(t, ((x[0] - r[0]) * ex + (x[1] - r[1]) * ey) / ee) for x, t in ((p, 0.0), (q, 1.0))]
    return [(t, u) for t, u in on_d + on_e if 0 <= t <= 1 and 0 <= u <= 1]


def is_valid(geometry: Geometry) -> bool:
    """Closed rings of some area that don't cross themselves or each other, with holes inside their outer ring."""
    if not geometry[1] or not all(np.isfinite(a).all() for a in arrays(geometry)):
        return False
    for p in geometry[1]:
        for ring in p:
            if len(ring) < 4 or (ring[0] != ring[-1]).any() or abs(signed_area(ring)) <= TINY * max(1e-300, np.ptp(ring, axis=0).max() ** 2):
                return False
            inner = ring[:-1]
            if len(np.unique(inner, axis=0)) < len(inner) - (np.diff(ring, axis=0) == 0).all(axis=1).sum():
                return False
    rings = arrays(geometry)
    if any(place for ring in _crossings(rings) for place in ring):
        return False
    for p in geometry[1]:
        for hole in p[1:]:
            if not contains(("Polygon", [[p[0]]]), *((hole[:1] + hole[1:2]) / 2).T)[0]:
                return False
    outers = [p[0] for p in geometry[1]]
    for a, ring in enumerate(outers):
        for b, other in enumerate(outers):
            if a != b and contains(("Polygon", [geometry[1][b]]), *((ring[:1] + ring[1:2]) / 2).T)[0] and len(other):
                return False
    return True


def plainly_convex(rings: list[np.ndarray]) -> np.ndarray:
    """Which rings are closed, finite, turn one way at every corner and once around, and have some area: as polygons these are valid. Rings of one length are tested together; False says nothing."""
    out, by_length = np.zeros(len(rings), bool), {}
    for i, ring in enumerate(rings):
        if len(ring) >= 4:
            by_length.setdefault(len(ring), []).append(i)
    for numbers in by_length.values():
        points = np.stack([rings[i] for i in numbers])
        with np.errstate(invalid="ignore", over="ignore"):
            step = np.diff(points, axis=1)
            after = np.roll(step, -1, axis=1)
            cross, dot = step[..., 0] * after[..., 1] - step[..., 1] * after[..., 0], (step * after).sum(-1)
            length = np.hypot(*np.moveaxis(step, -1, 0))
            clear = np.abs(cross) > 1e-9 * length * np.roll(length, -1, axis=1)
            one_way = (cross > 0).all(1) | (cross < 0).all(1)
            once = np.abs(np.abs(np.arctan2(cross, dot).sum(1)) - 2 * np.pi) < 1
            from_first = points - points[:, :1]
            area = (from_first[:, :-1, 0] * from_first[:, 1:, 1] - from_first[:, :-1, 1] * from_first[:, 1:, 0]).sum(1) / 2
            wide = np.maximum(1e-300, np.ptp(points, axis=1).max(1) ** 2)
            out[numbers] = np.isfinite(points).all((1, 2)) & (points[:, 0] == points[:, -1]).all(1) & clear.all(1) & one_way & once & (np.abs(area) > 2 * TINY * wide)
    return out


def plainly_within(outers: list[np.ndarray], inners: list[np.ndarray]) -> np.ndarray:
    """Which inner rings lie clearly within their outer ring, which must be plainly convex. Rings of the same lengths are tested together; False says nothing."""
    out, by_length = np.zeros(len(outers), bool), {}
    for i, (outer, inner) in enumerate(zip(outers, inners, strict=True)):
        by_length.setdefault((len(outer), len(inner)), []).append(i)
    for (n, m), numbers in by_length.items():
        step = max(1, 200_000 // (n * m))
        for lo in range(0, len(numbers), step):
            some = numbers[lo : lo + step]
            around, points = np.stack([outers[i] for i in some]), np.stack([inners[i] for i in some])
            edge, to = np.diff(around, axis=1)[:, :, None], points[:, None] - around[:, :-1, None]
            depth = edge[..., 0] * to[..., 1] - edge[..., 1] * to[..., 0]
            least = 1e-9 * np.hypot(edge[..., 0], edge[..., 1]) * np.ptp(around, axis=1).max(1)[:, None, None]
            out[some] = (depth > least).all((1, 2)) | (depth < -least).all((1, 2))
    return out


def repaired(geometry: Geometry) -> Geometry | None:
    """The even-odd area of all rings as valid polygons: edges are cut where they meet, edges met twice cancel, and the faces' outlines are walked; None if no area is left."""
    rings = [r if len(r) and (r[0] == r[-1]).all() else np.concatenate([r, r[:1]]) for r in arrays(geometry) if len(r) >= 3 and np.isfinite(r).all()]
    if not rings:
        return None
    every = np.concatenate(rings)
    # Meeting points are found up to rounding; an odd grain keeps round coordinates off the edges of its cells.
    grain = max(np.ptp(every, axis=0).max(), 1e-300) * 0.7310585786e-9
    node = lambda p: (round(float(p[0]) / grain), round(float(p[1]) / grain))
    at: dict[tuple[int, int], np.ndarray] = {}
    count: dict[tuple, int] = {}
    for ring, places in zip(rings, _crossings(rings), strict=True):
        for i, cuts in enumerate(places):
            stops = [ring[i], *[ring[i] + t * (ring[i + 1] - ring[i]) for t in sorted(set(cuts))], ring[i + 1]]
            for a, b in zip(stops, stops[1:], strict=False):
                na, nb = node(a), node(b)
                at.setdefault(na, a)
                at.setdefault(nb, b)
                if na != nb:
                    key = (na, nb) if na < nb else (nb, na)
                    count[key] = count.get(key, 0) + 1
    links: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for (a, b), n in count.items():
        if n % 2:
            links.setdefault(a, []).append(b)
            links.setdefault(b, []).append(a)
    turn = lambda a, b: math.atan2(at[b][1] - at[a][1], at[b][0] - at[a][0])
    for a in links:
        links[a].sort(key=lambda b: turn(a, b))
    # Walk every face with its area on the left: at each node leave by the next edge clockwise from the one we came by.
    seen, outer, holes = set(), [], []
    for a in links:
        for b in links[a]:
            if (a, b) in seen:
                continue
            path, u, v = [], a, b
            while (u, v) not in seen:
                seen.add((u, v))
                path.append(u)
                around = links[v]
                u, v = v, around[around.index(u) - 1]
            for loop in _loops(path):
                ring = np.array([at[n] for n in [*loop, loop[0]]])
                size = signed_area(ring)
                if len(loop) > 2 and abs(size) > grain * grain:
                    (outer if size > 0 else holes).append(ring)
    # A face counts if its inside is in the area by the even-odd rule.
    whole = ("Polygon", [rings])
    faces = [r for r in outer if contains(whole, *_beside(r))[0]]
    if not faces:
        return None
    polygons = [[f] for f in faces]
    for hole in holes:
        # An outline walked clockwise has the area outside it on its left; it belongs to the smallest face around that place.
        x, y = _beside(hole)
        around = [p for p in polygons if contains(("Polygon", [[p[0]]]), x, y)[0]]
        if around and contains(whole, x, y)[0]:
            min(around, key=lambda p: abs(signed_area(p[0]))).append(hole)
    return ("Polygon", polygons) if len(polygons) == 1 else ("MultiPolygon", polygons)


def _loops(path: list) -> list[list]:
    """A closed walk cut where it comes back to a node, so that no ring touches itself."""
    loops, stack, place = [], [], {}
    for n in [*path, path[0]]:
        if n in place:
            cut = place[n]
            loops.append(stack[cut:])
            for m in stack[cut:]:
                del place[m]
            del stack[cut:]
        place[n] = len(stack)
        stack.append(n)
    return loops


def _beside(ring: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A point just left of the middle of a ring's longest edge."""
    steps = np.diff(ring, axis=0)
    k = int(np.hypot(*steps.T).argmax())
    x, y = (ring[k] + ring[k + 1]) / 2 + 1e-6 * np.array([-steps[k][1], steps[k][0]])
    return np.array([x]), np.array([y])


# --- simplification -----------------------------------------------------------------------------------------------


def _douglas_peucker(points: np.ndarray, tolerance: float) -> np.ndarray:
    keep = np.zeros(len(points), bool)
    keep[[0, -1]] = True
    todo = [(0, len(points) - 1)]
    while todo:
        i, j = todo.pop()
        if j <= i + 1:
            continue
        d = points[j] - points[i]
        off = points[i + 1 : j] - points[i]
        length = math.hypot(*d)
        far = np.abs(d[0] * off[:, 1] - d[1] * off[:, 0]) / length if length else np.hypot(off[:, 0], off[:, 1])
        k = int(far.argmax())
        if far[k] > tolerance:
            keep[i + 1 + k] = True
            todo += [(i, i + 1 + k), (i + 1 + k, j)]
    return points[keep]


def simplified(geometry: Geometry, tolerance: float) -> Geometry:
    """Rings with fewer points within the tolerance; a ring that would collapse or cross something keeps a smaller tolerance, at last its own points."""
    kind, parts = geometry
    if not kind.endswith("Polygon"):
        return kind, [_douglas_peucker(p, tolerance) if len(p) > 2 else p for p in parts]
    for shrink in (1.0, 0.5, 0.25, 0.125):
        out = []
        for p in parts:
            rings = []
            for ring in p:
                far = int(np.hypot(*(ring - ring[0]).T).argmax())
                halves = [_douglas_peucker(ring[: far + 1], tolerance * shrink), _douglas_peucker(ring[far:], tolerance * shrink)]
                new = np.concatenate([halves[0][:-1], halves[1]])
                rings.append(new if len(new) >= 4 else ring)
            out.append(rings)
        if is_valid((kind, out)):
            return kind, out
    return geometry


def lod_tolerance(size: float) -> float:
    """Metres: a fiftieth of the side of a square of that area, between a half and eight."""
    return min(8.0, max(0.5, 0.02 * math.sqrt(size)))


# --- reprojection -------------------------------------------------------------------------------------------------


def projected(geometry: Geometry, source: int, target: int) -> Geometry:
    """Vertices only; from or to degrees (4326), UTM zones and the web map (3857)."""
    if source == target:
        return geometry

    def move(a: np.ndarray) -> np.ndarray:
        x, y = a.T
        if source != 4326:
            x, y = mercator_inverse(x, y) if source == 3857 else utm_inverse(x, y, source)
        if target != 4326:
            x, y = mercator_forward(x, y) if target == 3857 else utm_forward(x, y, target)
        return np.stack([x, y], axis=1)

    kind, parts = geometry
    return kind, [[move(r) for r in p] if isinstance(p, list) else move(p) for p in parts]


# --- column functions ---------------------------------------------------------------------------------------------


def _each(f: Callable) -> Callable:
    """A function of a geometry and further values over a WKB series; null where the bytes are null or can't be read."""

    def run(wkb: pd.Series, *more: pd.Series) -> list:
        out = []
        for data, *rest in zip(wkb, *more, strict=True):
            try:
                out.append(None if data is None else f(from_wkb(data), *rest))
            except ValueError:
                out.append(None)
        return out

    return run


_ONE_RING = struct.pack("<BII", 1, CODES["Polygon"], 1)


def _one_ring(wkb: pd.Series) -> tuple[dict[int, tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """Polygons of one ring in two dimensions, by number of points: which rows, and their points in one array. And all other rows."""
    data, by_length = wkb.to_numpy(dtype=object), {}
    for i, d in enumerate(data):
        plain = d is not None and len(d) > 13 and d[:9] == _ONE_RING and len(d) == 13 + 16 * int.from_bytes(d[9:13], "little")
        by_length.setdefault(len(d) // 16 if plain else 0, []).append(i)
    rest = np.array(by_length.pop(0, []), np.int64)
    points = lambda rows: np.frombuffer(b"".join(data[i][13:] for i in rows), "<f8").reshape(len(rows), -1, 2)
    return {n: (np.array(rows), points(rows)) for n, rows in by_length.items()}, rest


def _rings_meet(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``meet`` of many pairs of single rings, k x n x 2 and k x m x 2."""
    side = lambda p0, p1, q: (p1[..., 0] - p0[..., 0]) * (q[..., 1] - p0[..., 1]) - (p1[..., 1] - p0[..., 1]) * (q[..., 0] - p0[..., 0])

    def holds(outer: np.ndarray, at: np.ndarray) -> np.ndarray:
        (x0, y0), (x1, y1) = np.moveaxis(outer[:, :-1], -1, 0), np.moveaxis(outer[:, 1:], -1, 0)
        x, y = at[:, :1], at[:, 1:]
        with np.errstate(divide="ignore", invalid="ignore"):
            return (((y0 > y) != (y1 > y)) & (x < (x1 - x0) * (y - y0) / (y1 - y0) + x0)).sum(1) % 2 == 1

    out, step = np.zeros(len(a), bool), max(1, 200_000 // (a.shape[1] * b.shape[1]))
    for lo in range(0, len(a), step):
        one, other = a[lo : lo + step], b[lo : lo + step]
        p0, p1, q0, q1 = one[:, :-1, None], one[:, 1:, None], other[:, None, :-1], other[:, None, 1:]
        near = ((np.minimum(p0, p1) <= np.maximum(q0, q1)) & (np.minimum(q0, q1) <= np.maximum(p0, p1))).all(-1)
        cut = (near & (side(p0, p1, q0) * side(p0, p1, q1) <= 0) & (side(q0, q1, p0) * side(q0, q1, p1) <= 0)).any((1, 2))
        out[lo : lo + step] = cut | holds(other, one[:, 0]) | holds(one, other[:, 0])
    return out


def _distinct(wkb: pd.Series) -> tuple[list[Geometry], np.ndarray]:
    """Shapes read once each, and the number of each row's; -1 where the bytes are null or can't be read."""
    shapes, known, numbers = [], {}, np.empty(len(wkb), np.int64)
    for i, data in enumerate(wkb):
        n = known.get(data)
        if n is None:
            try:
                n = -1 if data is None else len(shapes)
                if n >= 0:
                    shapes.append(from_wkb(data))
            except ValueError:
                n = -1
            known[data] = n
        numbers[i] = n
    return shapes, numbers


ENVELOPE = StructType([StructField(c, DoubleType()) for c in ("x0", "y0", "x1", "y1")])


@F.pandas_udf(ENVELOPE)
def st_envelope(wkb: pd.Series) -> pd.DataFrame:
    rings, rest = _one_ring(wkb)
    out = np.full((len(wkb), 4), np.nan)
    for rows, points in rings.values():
        out[rows] = np.column_stack([points.min(1), points.max(1)])
        rest = np.r_[rest, rows[~np.isfinite(points).all((1, 2))]]
    out[rest] = np.array([r or (np.nan,) * 4 for r in _each(envelope)(wkb.iloc[rest])], float).reshape(-1, 4)
    return pd.DataFrame(out, columns=["x0", "y0", "x1", "y1"])


@F.pandas_udf(DoubleType())
def st_area(wkb: pd.Series) -> pd.Series:
    rings, rest = _one_ring(wkb)
    out = np.full(len(wkb), np.nan)
    for rows, points in rings.values():
        x, y = np.moveaxis(points - points[:, :1], -1, 0)
        out[rows] = np.abs((x * np.roll(y, -1, axis=1) - y * np.roll(x, -1, axis=1)).sum(1)) / 2 if points.shape[1] > 2 else 0.0
    out[rest] = np.array(_each(area)(wkb.iloc[rest]), float)
    return pd.Series(out)


@F.pandas_udf(StringType())
def st_kind(wkb: pd.Series) -> pd.Series:
    return pd.Series(_each(lambda g: g[0])(wkb), dtype=object)


@F.pandas_udf(LongType())
def st_points(wkb: pd.Series) -> pd.Series:
    return pd.Series(_each(outer_points)(wkb), dtype="Int64")


@F.pandas_udf(BooleanType())
def st_valid(wkb: pd.Series) -> pd.Series:
    return pd.Series(_each(is_valid)(wkb), dtype="boolean")


@F.pandas_udf(DoubleType())
def st_area_within(wkb: pd.Series, x0: pd.Series, y0: pd.Series, x1: pd.Series, y1: pd.Series) -> pd.Series:
    shapes, numbers = _distinct(wkb)
    there = np.array([n >= 0 for n in numbers], bool)
    out = np.full(len(wkb), np.nan)
    out[there] = areas_within(shapes, numbers[there], np.column_stack([x0, y0, x1, y1]).astype(float)[there])
    return pd.Series(out).astype(object).where(there, None)


@F.pandas_udf(BooleanType())
def st_meets_box(wkb: pd.Series, x0: pd.Series, y0: pd.Series, x1: pd.Series, y1: pd.Series) -> pd.Series:
    return pd.Series(_each(lambda g, *box: meets_box(g, box))(wkb, x0, y0, x1, y1), dtype="boolean")


@F.pandas_udf(BooleanType())
def st_meet(wkb: pd.Series, other: pd.Series) -> pd.Series:
    (ours, _), (theirs, _) = _one_ring(wkb), _one_ring(other)
    out, left = np.full(len(wkb), None, object), np.ones(len(wkb), bool)
    for one, a in ours.values():
        for two, b in theirs.values():
            rows, i, j = np.intersect1d(one, two, assume_unique=True, return_indices=True)
            if len(rows) and a.shape[1] > 1 and b.shape[1] > 1:
                out[rows] = _rings_meet(a[i], b[j])
                left[rows] = False
    rest = np.flatnonzero(left)
    out[rest] = _each(lambda g, o: None if o is None else meet(g, from_wkb(o)))(wkb.iloc[rest], other.iloc[rest])
    return pd.Series(out, dtype="boolean")


@F.pandas_udf(BinaryType())
def st_polygon(points: pd.Series) -> pd.Series:
    """A polygon of one ring, given as x, y, x, y and so on; it is closed here."""
    ring = lambda p: np.asarray(p, float).reshape(-1, 2)
    return pd.Series([None if p is None else to_wkb(("Polygon", [[np.concatenate([ring(p), ring(p)[:1]])]])) for p in points], dtype=object)


@F.pandas_udf(StringType())
def st_geojson(wkb: pd.Series) -> pd.Series:
    return pd.Series(_each(lambda g: None if is_empty(g) else json.dumps(to_geojson(g)))(wkb), dtype=object)


@F.pandas_udf(StructType([StructField("x", DoubleType()), StructField("y", DoubleType())]))
def st_centroid(wkb: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([r or (None, None) for r in _each(centroid)(wkb)], columns=["x", "y"], dtype=float)


def st_project(wkb: Column, source: int, target: int) -> Column:
    @F.pandas_udf(BinaryType())
    def run(data: pd.Series) -> pd.Series:
        return pd.Series(_each(lambda g: to_wkb(projected(g, source, target)))(data), dtype=object)

    return run(wkb)
