"""Spans, chunks and the pyramid against plain loops, shape pairs, and the catalogue as a source with a server that counts what it is asked."""

from __future__ import annotations

import json
import math
import threading
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from terraloom.functions import geometry as g
from terraloom.functions.spans import centre_spans, touched_spans
from terraloom.operators import bands, chunks, ingest, pyramid, rasters, scenes, seams, windows
from terraloom.sources import catalogue, geoparquet


def star(rng: np.random.Generator, cx: float, cy: float, reach: float) -> np.ndarray:
    turns = np.sort(rng.uniform(0, 2 * np.pi, 9))
    far = rng.uniform(0.2, 1, 9) * reach
    ring = np.column_stack([cx + far * np.cos(turns), cy + far * np.sin(turns)])
    return np.concatenate([ring, ring[:1]])


def test_spans_are_those_of_single_tests():
    rng = np.random.default_rng(1)
    for _ in range(60):
        rings = [star(rng, 20, 25, 18), star(rng, 22, 24, 5)]
        shape = ("Polygon", [rings])
        got = {(r, c) for r, a, b in centre_spans(rings, (3, 40), 35) for c in range(a, b + 1)}
        x, y = np.meshgrid(np.arange(35) + 0.5, np.arange(3, 40) + 0.5)
        assert got == {(r + 3, c) for r, c in zip(*np.nonzero(g.contains(shape, x, y)), strict=True)}
        left, top, step, size = -7.3, -4.1, 5.7, float(rng.uniform(1, 9))
        boxes = touched_spans(rings, left, top, step, size, 9, 10)
        got = {(j, i) for j, a, b in boxes for i in range(a, b + 1)}
        assert len(got) == (boxes[:, 2] - boxes[:, 1] + 1).sum()  # each box once
        want = {(j, i) for j in range(10) for i in range(9) if g.meets_box(shape, (left + i * step, top + j * step, left + i * step + size, top + j * step + size))}
        assert got == want


def test_a_hole_shows_in_no_small_box():
    ring = lambda a, b: np.array([(a, a), (b, a), (b, b), (a, b), (a, a)], float)
    got = {(j, i) for j, a, b in touched_spans([ring(0, 100), ring(10, 90)], 0, 0, 10, 9, 10, 10) for i in range(a, b + 1)}
    assert (5, 5) not in got and (0, 0) in got and len(got) == 100 - 49  # boxes that begin on the hole's outline touch the shape


def test_chunks_equal_plain_morphology_and_gradients(spark, monkeypatch):
    rng = np.random.default_rng(2)
    bits, there = rng.integers(0, 2, (41, 57)), rng.random((41, 57)) < 0.9
    rows = [(int(r), int(c), None if rng.random() < 0.05 else int(bits[r, c])) for r, c in zip(*np.nonzero(there), strict=True)]
    mask = spark.createDataFrame(rows, "row int, col int, bit int")
    whole = {(r, c): b for r, c, b in rows}

    def stepped(now: dict, least: int) -> dict:
        return {(r, c): int(sum(now.get((r + i, c + j), 0) for i in (-1, 0, 1) for j in (-1, 0, 1)) >= least) for r, c in now}

    want = {k: b or 0 for k, b in whole.items()}
    for least in (9, 1, 1, 1, 9, 9):
        want = stepped(want, least)
    original = chunks.by_chunk
    for side in (7, 256):
        monkeypatch.setattr(chunks, "by_chunk", lambda *a, side=side: original(*a, side))
        got = {(r.row, r.col): r.bit for r in rasters.cleaned(mask, 1, 2).collect()}
        assert got == {k: None if whole[k] is None else v for k, v in want.items()}
        values = rng.random((23, 17))
        image = spark.createDataFrame([(k, r, c, float(values[r, c])) for k, h in ((1, 23), (2, 1), (3, 2)) for r in range(h) for c in range(17)], "tile int, row int, col int, value double")
        found = {(r.tile, r.row, r.col): r.magnitude for r in seams.sobel_magnitude(image, ["tile"]).collect()}
        for tile, h in ((1, 23), (3, 2)):
            p = np.pad(values[:h], 1, mode="edge")
            gx = sum(w * (p[1 + i : 1 + i + h, 2:] - p[1 + i : 1 + i + h, :-2]) for i, w in ((-1, 1), (0, 2), (1, 1)))
            gy = sum(w * (p[2:, 1 + i : 18 + i] - p[:-2, 1 + i : 18 + i]) for i, w in ((-1, 1), (0, 2), (1, 1)))
            assert all(math.isclose(found[tile, r, c], np.hypot(gx, gy)[r, c], abs_tol=1e-9) for r in range(h) for c in range(17))
        assert all(v == 0 for (t, _, _), v in found.items() if t == 2) and len(found) == 26 * 17
    plan = rasters.cleaned(mask)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    assert rasters.cleaned(mask.where("false")).count() == 0


def test_pyramid_finds_each_tile_once(spark):
    rng = np.random.default_rng(3)
    shapes = [(i, g.to_wkb(("Polygon", [[star(rng, *rng.uniform(50, 950, 2), 90)]])), float(i % 9)) for i in range(40)]
    two = ("MultiPolygon", [[star(rng, 300, 300, 80)], [star(rng, 310, 310, 80)]])  # parts that lie over each other
    shapes += [(40, g.to_wkb(two), 2.0), (41, None, 99.0), (42, b"?", 1.0), (43, g.to_wkb(("Polygon", [])), 1.0), (44, g.to_wkb(("Point", [np.array([[5.0, 5.0]])])), 1.0)]
    df = spark.createDataFrame(shapes, "id long, geometry binary, height_m double")
    view = pyramid.view_of(df.where("id <> 42"), 0.3, 128, 0.1, 1.0, (0, 2))
    assert view.top == 99.0
    got = [(r.id, r.z, r.tx, r.ty) for r in pyramid.candidates(df, view).collect()]
    want = set()
    for z in range(3):
        left, top, columns, rows = view.level(z)
        s, margin, reach = 0.3 * 2**z, view.core * 0.1, 128 * 0.35
        assert spark.range(1).count() and pyramid.layout(spark, view).where(F.col("z") == z).count() == columns * rows
        for i, data, _ in shapes[:41]:
            kind, parts = g.from_wkb(data)
            flat = (kind, [[np.column_stack([(r[:, 0] - r[:, 1]) * s, (r[:, 0] + r[:, 1]) * s / 2]) for r in p] for p in parts])
            for tx in range(columns):
                for ty in range(rows):
                    u, v = left + tx * view.core - margin - reach, top + ty * view.core - margin - reach
                    box = (u, v, u + 128 + 2 * reach, v + 128 + 2 * reach)
                    if any(g.meets_box(("Polygon", [p]), box) for p in flat[1]):
                        want.add((i, z, tx, ty))
    assert sorted(got) == sorted(want)
    assert pyramid.candidates(df.where("false"), view).count() == 0


def test_shape_pairs(spark):
    square = lambda x, y, s: np.array([(x, y), (x + s, y), (x + s, y + s), (x, y + s), (x, y)], float)
    wkb = lambda *rings: g.to_wkb(("Polygon", [list(rings)]))
    left = spark.createDataFrame([(1, wkb(square(0, 0, 100), square(10, 10, 80))), (2, wkb(square(200, 0, 10))), (3, None), (4, g.to_wkb(("MultiPolygon", [[square(500, 500, 5)], [square(20, 20, 5)]])))], "lid int, geometry binary")
    right = spark.createDataFrame([(1, wkb(square(40, 40, 5))), (2, wkb(square(210, 5, 3))), (3, wkb(square(2, 2, 5))), (4, wkb(square(-50, -50, 1000))), (5, wkb(square(19, 19, 9))), (6, wkb(np.array([(95, 120), (125, 90), (130, 130), (95, 120)], float)))], "rid int, geometry binary")
    got = {(r.lid, r.rid) for r in ingest.shape_pairs(left, right, 30).collect()}
    assert got == {(1, 3), (1, 4), (2, 2), (2, 4), (4, 4), (4, 5)}  # within the hole, and envelopes alone, don't meet


def test_area_spans_join_by_row(spark):
    ring = lambda a, b: np.array([(a, a), (b, a), (b, b), (a, b), (a, a)], float)
    area = g.to_wkb(("MultiPolygon", [[ring(1, 9), ring(3, 5)], [ring(8, 12)]]))
    spans = rasters.area_spans(spark, area, 0.0, 16.0, 1.0, 16, 16, 5)
    pixels = spark.createDataFrame([(0, r, c, float(r * 16 + c)) for r in range(16) for c in range(16)], "scene int, row int, col int, value double")
    classes = spark.createDataFrame([(0, r, c, 4) for r in range(8) for c in range(8)], "scene int, row int, col int, value int")
    got = {(r.row, r.col) for r in scenes.stacked(pixels, pixels, classes, 2, spans).collect()}
    x, y = np.meshgrid(np.arange(16) + 0.5, 15.5 - np.arange(16))
    inside = g.contains(("Polygon", [[ring(1, 9), ring(3, 5)]]), x, y) | g.contains(("Polygon", [[ring(8, 12)]]), x, y)
    assert got == {(int(r), int(c)) for r, c in zip(*np.nonzero(inside), strict=True)}


def test_rgb_strips_and_modes(spark):
    rng = np.random.default_rng(4)
    tiles = {xy: rng.random((5, 5, 3)) for xy in ((0, 0), (1, 0), (0, 1), (1, 1))}
    rows = [(x, y, 0, r, c, *map(float, t[r, c])) for (x, y), t in tiles.items() for r in range(5) for c in range(5)]
    df = spark.createDataFrame(rows, "x int, y int, variant int, row int, col int, r double, g double, b double")

    def gradient(lum: np.ndarray) -> np.ndarray:
        if min(lum.shape) < 2:
            return np.zeros_like(lum)
        return chunks.sobel(lum, lum == lum)

    def pair(a: np.ndarray, b: np.ndarray) -> float:
        lum = lambda x: x @ np.array(seams.LUMA)
        return np.abs(a - b).mean() + 0.25 * ((a - b) ** 2).mean() + 0.5 * np.abs(gradient(lum(a)) - gradient(lum(b))).mean()

    own, left, top, corner = tiles[1, 1], tiles[0, 1], tiles[1, 0], tiles[0, 0]
    for strip in (0, 1, 3, 9):
        n = max(1, min(strip, 5))
        parts = {"left": pair(left[:, 5 - n :], own[:, :n]), "top": pair(top[5 - n :], own[:n]), "tl": pair(corner[5 - n :, 5 - n :], own[:n, :n])}
        for mode, sides in (("left+top", ("left", "top")), ("left,top", ("left", "top")), ("top-left", ("left", "top", "tl")), ("tl", ("tl",)), ("none", ())):
            got = {(r.x, r.y): r.seam for r in seams.strip_scores(df, df.drop("variant"), 5, strip, neighbours=mode, channels=("r", "g", "b")).collect()}
            assert set(got) == set(tiles) and got[0, 0] == 0
            assert math.isclose(got[1, 1], sum(parts[s] for s in sides), abs_tol=1e-9)


def test_heat_colours(spark):
    levels = [0.0, 0.25, 0.4999, 0.5, 0.6, 0.85, 0.9, 1.0]

    def plain(t: float) -> tuple[int, int, int]:
        if t < 0.5:
            return round(255 * 2 * t), 0, 0
        return (255, round(255 * (t - 0.5) / 0.35), 0) if t < 0.85 else (255, 255, round(255 * (t - 0.85) / 0.15))

    df = spark.createDataFrame([(t,) for t in levels], "t double").select("t", *seams.heat_colour(F.col("t")))
    assert {r.t: (r.r, r.g, r.b) for r in df.collect()} == {t: plain(t) for t in levels}
    profile = spark.createDataFrame([(2, 5, "v", 0.5), (3, 5, "v", 1.0), (3, 5, "h", 0.25), (3, 4, "h", 0.0), (0, 0, "v", 0.1)], "out_row int, out_col int, axis string, l1 double")
    got = {(r.out_row, r.out_col): (r.r, r.g, r.b) for r in seams.heatmap(profile, 4, 6).collect()}
    low = plain(63 / 63)  # what the horizontal seams cover is not seen, so it is not the greatest
    assert got == {(2, 5): low, (2, 4): (0, 0, 0), (3, 5): low, (3, 4): (0, 0, 0), (0, 0): plain(25 / 63)}


def test_windows_cut_to_whole_numbers(spark):
    df = spark.createDataFrame([(r, c, 10) for r in range(70) for c in range(70)], "out_row int, out_col int, v int")
    got = windows.painted(df, 70, 70, lambda image, seed: np.full(image.shape, 3.9), ["v"])
    assert {r.v for r in got.select("v").distinct().collect()} == {3}
    assert {r.v for r in windows.painted(df, 70, 70, lambda image, seed: np.full(image.shape, 300.0), ["v"]).select("v").distinct().collect()} == {255}


# --- the catalogue ------------------------------------------------------------------------------------------------

ITEMS = [
    {"id": f"s{i:03}", "properties": {"datetime": f"2024-{i % 12 + 1:02}-{i % 28 + 1:02}T{i % 24:02}:30:00.500Z", "eo:cloud_cover": i % 101, "s2:tile_id": None if i % 2 else f"T{i}", "mgrs:utm_zone": 42, "mgrs:latitude_band": "T", "mgrs:grid_square": "XY", "proj:epsg": 32642},
     "assets": {k: {"href": f"{k}/{i}"} for k in ("red", "nir", "scl")}}
    for i in range(300)
]


@pytest.fixture
def server():
    asked = []

    class Search(BaseHTTPRequestHandler):
        def do_POST(self):  # noqa: N802
            body = json.loads(self.rfile.read(int(self.headers["content-length"])))
            asked.append(body)
            start, end = body["datetime"].split("/")
            most = body.get("query", {}).get("eo:cloud_cover", {}).get("lte", 100)
            found = [x for x in ITEMS if start[:-1] <= x["properties"]["datetime"][:19] <= end[:-1] and x["properties"]["eo:cloud_cover"] <= most]
            at = body.get("token", 0)
            page = {"features": found[at : at + body["limit"]], "links": [{"rel": "self"}]}
            if at + body["limit"] < len(found):
                page["links"].append({"rel": "next", "method": "POST", "body": body | {"token": at + body["limit"]}})
            data = json.dumps(page).encode()
            self.send_response(200)
            self.send_header("content-length", str(len(data)))
            self.end_headers()
            self.wfile.write(data)

        def log_message(self, *_):
            pass

    http = ThreadingHTTPServer(("127.0.0.1", 0), Search)
    threading.Thread(target=http.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{http.server_port}", asked
    http.shutdown()


def test_catalogue_pushes_filters_into_requests(spark, server):
    url, asked = server
    catalogue.register(spark)
    read = lambda **o: spark.read.format("scene_catalogue").options(**{"url": url, "collection": "c", "datetime": "2024-01-01T00:00:00Z/2024-12-31T23:59:59Z", "limit": "7"} | o).load()
    every = read()
    rows = every.collect()
    assert sorted(r.id for r in rows) == [x["id"] for x in ITEMS] and every.rdd.getNumPartitions() == 12
    assert {r.tile_id for r in rows if int(r.id[1:]) % 2} == {"42TXY"} and rows[0].assets.nir.startswith("nir/")
    asked.clear()
    some = read(bbox="1,2,3,4").where("datetime >= '2024-03-05T00:00:00Z' AND datetime < '2024-06-10T00:00:00Z' AND cloud_cover <= 40 AND tile_id = '42TXY'")
    want = [x["id"] for x in ITEMS if "2024-03-05" <= x["properties"]["datetime"] < "2024-06-10T00:00:00Z" and x["properties"]["eo:cloud_cover"] <= 40 and int(x["id"][1:]) % 2]
    assert sorted(r.id for r in some.collect()) == want and want
    assert {b["datetime"][:7] for b in asked} == {"2024-03", "2024-04", "2024-05", "2024-06"}
    assert all(b["query"] == {"eo:cloud_cover": {"lte": 40.0}} and b["bbox"] == [1, 2, 3, 4] and b["limit"] == 7 for b in asked)
    asked.clear()
    assert read().where("datetime > '2025-01-01T00:00:00Z'").count() == 0 and not asked


@pytest.mark.parametrize("wrong", ["2024-01-01/2024-02-01", "2024-01-01T00:00:00Z", "2024-01-01T00:00:00+00:00/2024-02-01T00:00:00Z", "2024-02-01T00:00:00Z/2024-01-01T00:00:00Z", "/", "2024-13-01T00:00:00Z/2024-14-01T00:00:00Z", "2024-01-01T00:00:00Z/2024-02-01T00:00:00Z/2024-02-01T00:00:00Z"])
def test_time_ranges_are_checked(wrong):
    with pytest.raises(ValueError):
        catalogue.time_range(wrong)


def test_items_are_checked():
    with pytest.raises(ValueError, match="without id"):
        catalogue.normal({"id": ""})
    with pytest.raises(ValueError, match="lacks"):
        catalogue.normal({"id": "a", "assets": {"red": {"href": "x"}}})
    ends = list(catalogue.months(*catalogue.time_range("2023-12-31T23:59:59Z/2024-02-01T00:00:00Z")))
    assert [(a.isoformat()[:19], b.isoformat()[:19]) for a, b in ends] == [("2023-12-31T23:59:59", "2023-12-31T23:59:59"), ("2024-01-01T00:00:00", "2024-01-31T23:59:59"), ("2024-02-01T00:00:00", "2024-02-01T00:00:00")]


def test_cells_for_box(spark):
    catalogue.register(spark)
    boxes = "(0D,0D,2D,1D,1D),(0.5D,0.5D,0.5D,0.5D,1D),(1D,0D,0D,1D,1D),(NULL,0D,1D,1D,1D),(0D,0D,CAST('Infinity' AS DOUBLE),1D,1D),(-1.5D,-0.5D,-0.5D,0.5D,0.5D),(0D,0D,1D,1D,0D)"
    got = spark.sql(f"SELECT w, ix, iy FROM VALUES {boxes} AS b(w, s, e, n, size), LATERAL cells_for_bbox(w, s, e, n, size)").collect()
    assert sorted((r.w, r.ix, r.iy) for r in got) == [(-1.5, -3, -1), (-1.5, -3, 0), (-1.5, -2, -1), (-1.5, -2, 0), (0.0, 0, 0), (0.0, 1, 0), (0.5, 0, 0)]


# --- layers as files ----------------------------------------------------------------------------------------------

def test_a_failed_write_leaves_the_old_layer(spark, tmp_path):
    at = str(tmp_path / "layers" / "roads")
    point = g.to_wkb(("Point", [np.array([[1.0, 2.0]])]))
    rows = spark.range(10).select("id", F.lit(point).alias("geometry"))
    assert geoparquet.write(rows, at, 4326) == 10
    broken = rows.select(F.when(F.col("id") == 9, F.raise_error(F.lit("broken")).cast("long")).otherwise(F.col("id")).alias("id"), "geometry").repartition(5)
    with pytest.raises(Exception, match="broken"):
        geoparquet.write(broken, at, 4326)
    assert geoparquet.read(spark, at).count() == 10 and [p.name for p in (tmp_path / "layers").iterdir() if not p.name.startswith(".")] == ["roads"]
    # A layer may be read, changed and written to its own place: the old files stay until the new ones are whole.
    assert geoparquet.write(geoparquet.read(spark, at).where("id < 3"), f"file:{at}", 32642) == 3
    back = geoparquet.read(spark, f"file://{at}")
    assert sorted(r.id for r in back.collect()) == [0, 1, 2] and geoparquet.crs_of(back, 0) == 32642
    assert geoparquet.write(rows.where("false"), at, 4326) == 0 and geoparquet.read(spark, at).count() == 0


# --- bands along seams --------------------------------------------------------------------------------------------

def plain_bands(tiles: dict, w: int, h: int, mx: int, my: int, context: int, mask_half: int, write_half: int, harmonise: int, paint) -> dict:
    """One seam after the other, pixel by pixel."""
    tiles = {k: v.astype(int).copy() for k, v in tiles.items()}

    def one(left: np.ndarray, right: np.ndarray, n: int, m: int, k: int, km: int) -> None:  # across the second axis
        a0, a1, b0, b1 = max(0, n - m - context), min(n, n - m + context), max(0, m - context), min(n, m + context)
        split, width = a1 - a0, a1 - a0 + b1 - b0
        limit = min(split, width - split) - 1
        if limit <= 0 or k - km <= km:
            return
        half, mask = max(1, min(write_half, limit)), np.zeros((k - 2 * km, width), bool)
        mask[:, split - max(1, min(mask_half, limit)) : split + max(1, min(mask_half, limit)) + 1] = True
        made = paint(np.concatenate([left[km : k - km, a0:a1], right[km : k - km, b0:b1]], 1).astype(np.uint8), mask, 0).astype(int)
        for i in range(km, k - km):
            for j in range(half):
                up = 255 if half == 1 else round(255 * j / (half - 1))
                down = 255 if half == 1 else round(255 - 255 * j / (half - 1))
                for tile, at, new, alpha in ((left, n - m - half + j, made[i - km, split - half + j], up), (right, m + j, made[i - km, split + j], down)):
                    tile[i, at] = np.floor((tile[i, at] * (255 - alpha) + new * alpha) / 255 + 0.5)
            near = min(harmonise, half)
            for d in range(near):
                a, b = left[i, n - m - 1 - d].copy(), right[i, m + d].copy()
                mean, t = np.floor(a + 0.5 * (b - a)), 1.0 if near == 1 else 1 - d / (near - 1)
                left[i, n - m - 1 - d], right[i, m + d] = np.floor(a + t * (mean - a)), np.floor(b + t * (mean - b))

    for x, y in sorted(tiles, key=lambda p: (p[0] % 2, p[0])):
        if (x + 1, y) in tiles:
            one(tiles[x, y], tiles[x + 1, y], w, mx, h, my)
    for x, y in sorted(tiles, key=lambda p: (p[1] % 2, p[1])):
        if (x, y + 1) in tiles:
            one(tiles[x, y].transpose(1, 0, 2), tiles[x, y + 1].transpose(1, 0, 2), h, my, w, mx)
    return tiles


@pytest.mark.parametrize("context, write_half, harmonise", [(3, 3, 2), (6, 2, 5), (9, 9, 9), (2, 1, 1)])
def test_bands(spark, context, write_half, harmonise):
    """Wide strips overlap those of the next seam, so that every second seam is painted first."""
    rng = np.random.default_rng(6)
    w, h, mx, my = 14, 12, 2, 3
    tiles = {xy: rng.integers(0, 256, (h, w, 2)) for xy in ((0, 0), (1, 0), (2, 0), (0, 1), (1, 1), (4, 1))}
    paint = lambda patch, mask, seed: np.where(mask[:, :, None], 255 - patch, patch // 2)
    rows = [(x, y, r, c, *map(int, t[r, c])) for (x, y), t in tiles.items() for r in range(h) for c in range(w)]
    df = spark.createDataFrame(rows, "x int, y int, row int, col int, a int, b int")
    got = bands.repaired(df, (w, h), (mx, my), paint, ["a", "b"], context, 1, write_half, harmonise)
    want = plain_bands(tiles, w, h, mx, my, context, 1, write_half, harmonise, paint)
    assert {(r.x, r.y, r.row, r.col): (r.a, r.b) for r in got.collect()} == {(x, y, r, c): tuple(map(int, t[r, c])) for (x, y), t in want.items() for r in range(h) for c in range(w)}
    assert bands.repaired(df.where("false"), (w, h), (mx, my), paint, ["a", "b"], context).count() == 0
    assert bands.context_of(5, 90) == 8 and bands.context_of(70, 90) == 64


def test_bands_of_many_seams(spark, monkeypatch):
    """Groups that go on in the next batch are whole, seams are painted by handfuls and one by one, and a null counts as absent."""
    batches = [pa.RecordBatch.from_pydict({"x": x, "y": y, "v": v}) for x, y, v in (([1, 1, 2], [1, 1, 1], [1, 2, 3]), ([], [], []), ([2], [1], [4]), ([2, 2, 2], [1, 3, 3], [5, 6, 7]), ([3], [3], [8]))]
    batches[1] = batches[1].cast(batches[0].schema)
    assert [g["v"].tolist() for g in bands.grouped(iter(batches))] == [[1, 2], [3, 4, 5], [6, 7], [8]]
    rng = np.random.default_rng(8)
    w, h, mx, my = 12, 10, 3, 2
    paint = lambda patch, mask, seed: np.where(mask[:, :, None], 255 - patch, patch)
    tiles = {(x, y): rng.integers(0, 256, (h, w, 2)) for x in range(9) for y in range(4)}
    for image in tiles.values():
        image[4, w - mx - 2] = image[4, mx + 1] = 0  # to be null below
    rows = [(x, y, r, c, *(int(v) if (r, c) not in ((4, w - mx - 2), (4, mx + 1)) else None for v in t[r, c])) for (x, y), t in tiles.items() for r in range(h) for c in range(w)]
    df = spark.createDataFrame(rows, "x int, y int, row int, col int, a int, b int")
    want = plain_bands(tiles, w, h, mx, my, 3, 1, 2, 1, paint)
    held = int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))
    try:
        for records, cells in ((7, 1 << 20), (held, 1 << 20), (held, 1)):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", records)
            monkeypatch.setattr(bands, "MOST_CELLS", cells, raising=False)
            got = {(r.x, r.y, r.row, r.col): (r.a, r.b) for r in bands.repaired(df, (w, h), (mx, my), paint, ["a", "b"], 3, 1, 2, 1).collect()}
            assert len(got) == len(rows)
            assert all(v == tuple(want[x, y][r, c]) or v == (None, None) and (r, c) in ((4, w - mx - 2), (4, mx + 1)) for (x, y, r, c), v in got.items())
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", held)
