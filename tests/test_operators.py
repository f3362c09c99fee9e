"""Operators of the release engine on small tables."""

from __future__ import annotations

import random
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from terraloom.functions import geometry as g
from terraloom.functions import text
from terraloom.operators import coverage, generation, heights, ingest, rasters, seams, tiles
from terraloom.sources import geojsonseq, geoparquet, images, manifest, stac

SQUARE = [[69.200, 41.300], [69.201, 41.300], [69.201, 41.301], [69.200, 41.301], [69.200, 41.300]]
BOWTIE = [[69.202, 41.3], [69.203, 41.301], [69.203, 41.3], [69.202, 41.301], [69.202, 41.3]]


def feature(number, geometry, **properties):
    return json.dumps({"type": "Feature", "properties": {"@type": "way", "@id": number, **properties}, "geometry": geometry})


def polygon(points):
    return {"type": "Polygon", "coordinates": [points]}


def box(x0, y0, x1, y1):
    return ("Polygon", [[np.array([[x0, y0], [x1, y0], [x1, y1], [x0, y1], [x0, y0]], float)]])


def test_ingest(spark, tmp_path):
    lines = [feature(1, polygon(SQUARE), building="yes", height="10m", **{"building:levels": "3", "name": "A"}), "", feature(2, polygon(BOWTIE), building="house"), feature(3, None, building="yes"), json.dumps({"type": "Feature", "properties": {}, "geometry": {"type": "Point", "coordinates": [1, 2]}})]
    (tmp_path / "b.geojsonseq").write_text("".join(f"\x1e{x}\n" for x in lines))
    rows, report = ingest.ingest(geojsonseq.read_lines(spark, str(tmp_path / "b.geojsonseq")), "buildings")
    got = {r.id: r for r in rows.collect()}
    assert rows.columns == ingest.COLUMNS and set(got) == {"way/1", "way/2"}
    assert (got["way/1"]["class"], got["way/1"].height, got["way/1"].building_levels, got["way/1"].name) == ("yes", "10m", "3", "A")
    assert g.from_wkb(got["way/2"].geometry)[0] == "MultiPolygon"
    facts = report.first().asDict()
    assert facts == {"input": 4, "written": 2, "dropped_empty": 2, "invalid": 1, "fixed": 1, "skipped_invalid": 0, "geometry_types": ["MultiPolygon", "Polygon"]}
    road = spark.createDataFrame([(json.dumps({"type": "Feature", "properties": {"highway": ""}, "geometry": {"type": "LineString", "coordinates": [[0, 0], [1, 1]]}}),)], "line string")
    first = ingest.ingest(road, "roads")[0].first()
    assert first.id.startswith("hash/") and len(first.id) == 21 and first["class"] == "road"
    empty, report = ingest.ingest(spark.createDataFrame([], "line string"), "green")
    assert empty.columns == ingest.COLUMNS and empty.count() == 0 and report.first()["geometry_types"] == ["Polygon", "MultiPolygon"]
    with pytest.raises(Exception, match="MALFORMED|malformed|Malformed|INVALID"):
        ingest.ingest(spark.createDataFrame([("{broken",)], "line string"), "green")[0].collect()


def test_layer_tags(spark):
    rows = spark.createDataFrame([("a", {"leisure": "park"}), ("a", {"leisure": "pitch"}), ("w", {"highway": "x"}), ("w", {"leisure": "park"}), ("a", {"natural": "wetland"})], "kind string, tags map<string,string>")
    flags = rows.select(*[ingest.in_layer(x, F.col("kind"), F.col("tags")).alias(x) for x in ingest.LAYER_TAGS]).collect()
    assert [(r.green, r.roads, r.water) for r in flags] == [(True, False, False), (False, False, False), (False, True, False), (False, False, False), (False, False, True)]


def test_heights(spark):
    rows = spark.createDataFrame([("way/101", "12m", None), ("way/102", None, "3"), ("way/103", None, None), (None, "12,5", "-1"), ("a", "12 M", None), ("b", "0", "2"), ("d", None, " 7 floors"), ("c", "40 ft", "3.5")], "id string, height string, building_levels string")
    out = {r.id: (round(r.height_m, 6), r.levels_int, r.height_source) for r in heights.with_heights(rows).collect()}
    assert out["way/101"] == (12.0, None, "height") and out["way/102"] == (9.6, 3, "levels") and out["way/103"] == (9.92, None, "heuristic")
    assert out["a"] == (12.0, None, "height") and out["b"] == (0.0, None, "height") and out["d"] == (22.4, 7, "levels") and out["c"] == (9.6, 3, "levels") and out[None][2] == "heuristic"
    again = heights.with_heights(heights.with_heights(rows))
    assert again.columns == ["id", "height", "building_levels", "height_m", "levels_int", "height_source"]
    bare = heights.with_heights(spark.createDataFrame([("x",)], "id string"))
    assert heights.source_counts(bare).first().asDict() == {"height": 0, "levels": 0, "heuristic": 1}
    with pytest.raises(ValueError):
        heights.with_heights(spark.createDataFrame([("x",)], "name string"))


def test_coverage_of_half_a_cell(spark):
    cells = coverage.grid_cells(spark, (500000, 4570000, 500500, 4570500), 500)
    assert cells.first().cell_id == "utm42n_500m_1000_9140" and cells.count() == 1
    half = g.to_wkb(g.projected(box(500000, 4570000, 500250, 4570500), 32642, 4326))
    green = spark.createDataFrame([("1", half), ("2", None), ("3", b"broken")], "id string, geometry binary")
    row = ingest.green_coverage(cells, green, 500).first()
    assert row.green_share == pytest.approx(0.5, abs=1e-6) and row.green_area_m2 == pytest.approx(125000, rel=1e-6)
    twice = ingest.green_coverage(cells, green.unionByName(green), 500).first()
    assert twice.green_area_m2 == pytest.approx(250000, rel=1e-6) and twice.green_share == pytest.approx(1.0)
    none = coverage.coverage_report(ingest.green_coverage(cells, green.limit(0), 500)).first()
    assert (none.cells_total, none.cells_intersected, none.share_max) == (1, 0, 0.0)
    with pytest.raises(ValueError):
        coverage.grid_cells(spark, (0, 0, 0, 10), 5)


def test_cells_over_an_area(spark):
    cells = coverage.grid_cells(spark, (0, 0, 400, 400), 100)
    triangle = g.to_wkb(("Polygon", [[np.array([[0, 0], [399, 0], [0, 399], [0, 0]], float)]]))
    kept = {(r.ix, r.iy) for r in ingest.cells_over(cells, triangle).collect()}
    assert kept == {(x, y) for x in range(4) for y in range(4) if x + y <= 3}


def test_spatial_pairs_once(spark):
    rng = np.random.default_rng(1)
    rows = [(i, *(float(v) for v in (x, y, x + w, y + h))) for i, (x, y, w, h) in enumerate(rng.integers(1, 300, (60, 4)))]
    left = spark.createDataFrame(rows, "lid int, x0 double, y0 double, x1 double, y1 double")
    got = sorted((r.lid, r.rid) for r in ingest.spatial_pairs(left, left.withColumnRenamed("lid", "rid"), 50).collect())
    assert got == sorted((a[0], b[0]) for a in rows for b in rows if a[1] < b[3] and b[1] < a[3] and a[2] < b[4] and b[2] < a[4])


def test_simplified_layer(spark):
    t = np.linspace(0, 2 * np.pi, 241)
    ring = np.stack([69.25 + 0.001 * np.cos(t), 41.35 + 0.001 * np.sin(t)], axis=1)
    ring[-1] = ring[0]
    table = spark.createDataFrame([("a", g.to_wkb(("Polygon", [[ring]])), 1), ("b", b"??", 2), ("c", None, 3)], "id string, geometry binary, extra int")
    out, report = ingest.simplified(table)
    rows = {r.id: r for r in out.collect()}
    assert out.columns == table.columns and rows["b"].geometry == b"??" and rows["c"].geometry is None
    assert 4 <= g.outer_points(g.from_wkb(rows["a"].geometry)) < 241
    assert (report.first().written, report.first().simplified) == (3, 1)


def test_composite_edges(spark):
    pixels = [(1, 10.0, 30.0, 4), (1, 10.0, 20.0, 4), (1, 10.0, 10.0, 4), (1, 0.0, 50.0, 4), (1, 10.0, 90.0, 3), (2, 10.0, 30.0, 4), (2, 10.0, 30.0, 8)]
    rows = {r.pixel: r for r in rasters.composite(spark.createDataFrame(pixels, "pixel int, red double, nir double, scl int"), ["pixel"]).collect()}
    assert (rows[1].valid, round(rows[1].ndvi, 6), rows[1].green) == (3, round(1 / 3, 6), 1)
    assert (rows[2].valid, rows[2].ndvi, rows[2].green) == (1, None, None)


def plain_morphology(mask: np.ndarray, kind: str) -> np.ndarray:
    wide = np.pad(mask, 1)
    parts = [wide[1 + r : wide.shape[0] - 1 + r, 1 + c : wide.shape[1] - 1 + c] for r in (-1, 0, 1) for c in (-1, 0, 1)]
    return np.max(parts, axis=0) if kind == "dilate" else np.min(parts, axis=0)


def test_morphology(spark):
    mask = (np.random.default_rng(2).random((12, 15)) < 0.7).astype(int)
    rows = [(int(r), int(c), None if (r, c) == (3, 3) else int(v)) for (r, c), v in np.ndenumerate(mask)]
    table = spark.createDataFrame(rows, "row int, col int, bit int")
    mask[3, 3] = 0
    for kind in ("erode", "dilate", "dilate", "erode"):
        mask = plain_morphology(mask, kind)
    got = {(r.row, r.col): r.bit for r in rasters.cleaned(table).collect()}
    assert got.pop((3, 3)) is None and all(mask[k] == v for k, v in got.items())


def test_sobel(spark):
    image = np.random.default_rng(3).random((5, 7))
    rows = [(1, int(r), int(c), float(v)) for (r, c), v in np.ndenumerate(image)]
    got = {(r.row, r.col): r.magnitude for r in seams.sobel_magnitude(spark.createDataFrame(rows, "tile int, row int, col int, value double"), ["tile"]).collect()}
    wide = np.pad(image, 1, mode="edge")
    at = lambda r, c: wide[1 + r : 6 + r, 1 + c : 8 + c]
    gx = at(-1, 1) + 2 * at(0, 1) + at(1, 1) - at(-1, -1) - 2 * at(0, -1) - at(1, -1)
    gy = at(1, -1) + 2 * at(1, 0) + at(1, 1) - at(-1, -1) - 2 * at(-1, 0) - at(-1, 1)
    assert all(np.hypot(gx, gy)[k] == pytest.approx(v) for k, v in got.items()) and len(got) == 35


def test_candidates_and_weights(spark):
    rows = [(0, 0, 2.0, None), (0, 1, 1.0, None), (0, 2, 1.0, None), (0, 3, 0.1, "x"), (1, 0, 5.0, "x")]
    out = {r.tile: (r.variant, r.score, r.candidates, r.failed) for r in seams.selected(spark.createDataFrame(rows, "tile int, variant int, total_score double, error string"), ["tile"]).collect()}
    assert out == {0: (1, 1.0, 4, 1), 1: (None, None, 1, 1)}
    assert seams.usable_weights({"rgb_l1": float("nan"), "other": 1}) == seams.WEIGHTS and seams.usable_weights({"rgb_l2": 2}) == {"rgb_l2": 2.0}


def test_tile_arithmetic(spark):
    split = {(r.x, r.y): r for r in tiles.split_bbox(spark, (69.103, 41.168, 69.397, 41.434), 4, 0.1).collect()}
    assert len(split) == 16 and split[0, 0].bbox[3] == pytest.approx(41.434) and split[3, 3].bbox[1] == pytest.approx(41.168)
    assert split[1, 1].bbox_overlap[0] < split[1, 1].bbox[0] and split[0, 0].bbox_3857[2] == pytest.approx(split[1, 0].bbox_3857[0])
    assert tiles.window_starts(100, 64, 16) == [0, 36] and tiles.window_starts(50, 64, 0) == [0] and tiles.window_starts(160, 64, 16) == [0, 48, 96] and tiles.window_starts(100, 10, 16) == [0, 36]
    for bad in ((65, 0.1), (0, 0.1), (4, 0.5)):
        with pytest.raises(ValueError):
            tiles.split_bbox(spark, (0, 0, 1, 1), *bad)
    found = tiles.neighbours(spark.createDataFrame([(0, 0), (1, 0), (3, 0), (0, 1), (1, 1)], "x int, y int"))
    assert {(r.axis, r.x, r.y) for r in found.collect()} == {("v", 0, 0), ("v", 0, 1), ("h", 0, 0), ("h", 1, 0)}
    row = spark.range(1).select(tiles.crop_margin(F.lit(512), 0.1).alias("m"), *[c.alias(n) for c, n in zip(tiles.ground_of(*tiles.isometric(F.lit(3.0), F.lit(5.0), F.lit(0.0), 2.0), 2.0), "xy", strict=True)], tiles.scaled_bbox(F.array(*map(F.lit, (0.0, 0.0, 10.0, 20.0))), 0.5).alias("b")).first()
    assert row.m == 43 and (row.x, row.y) == (3.0, 5.0) and row.b == [2.5, 5.0, 7.5, 15.0]


def test_text_columns(spark):
    row = spark.range(1).select(
        text.slug(F.lit(" A  Big--City! ")).alias("a"), text.slug(F.lit("???")).alias("b"), text.relative_path(F.lit("/a/b/")).alias("c"), text.relative_path(F.lit("a/../b")).alias("d"),
        text.is_safe_name(F.lit("run-1"), "run").alias("e"), text.is_safe_name(F.lit("-run"), "run").alias("f"), text.season_range(F.lit(2020), "05-01", "09-30").alias("g"), text.backoff(F.lit(3), 1, 5).alias("h"),
        text.retryable(F.lit(404), F.lit("Deadline exceeded"), ("deadline",)).alias("i"), text.image_name(F.lit(3), F.lit("x"), F.lit(1), F.lit(2), text.extension(F.lit("image/PNG"))).alias("j"), text.facade_variant(F.lit("way/5")).alias("k"), text.facade_variant(F.lit("x/y")).alias("l"),
    ).first()
    assert tuple(row) == ("a-big-city", "image", "a/b", None, True, False, "2020-05-01T00:00:00Z/2020-09-30T23:59:59Z", 5.0, True, "0003-x-v01-c02.png", 2, 0)


def test_stac(spark):
    def item(i, square, cloud):
        return {"id": f"s{i}", "properties": {"datetime": "2020-06-01T00:00:00Z", "eo:cloud_cover": cloud, "mgrs:utm_zone": 42, "mgrs:latitude_band": "T", "mgrs:grid_square": square, "proj:epsg": 32642}, "assets": {k: {"href": f"{k}{i}"} for k in ("red", "nir", "scl")}}

    served = {1: {"features": [item(1, "VL", 1.5), item(2, "VL", None)], "links": [{"rel": "next", "method": "POST", "body": {"page": 2}}]}, 2: {"features": [item(3, "WL", 3)], "links": []}}
    found = list(stac.pages(lambda body: served[body["page"]], {"page": 1}))
    rows = stac.items(spark.createDataFrame([(json.dumps(p),) for p in found], "value string"))
    assert [(r.id, r.tile_id, r.cloud_cover, r.assets.red) for r in rows.orderBy("id").collect()] == [("s1", "42TVL", 1.5, "red1"), ("s2", "42TVL", None, "red2"), ("s3", "42TWL", 3.0, "red3")]
    assert {(r.tile_id, r["items"]) for r in stac.by_tile(rows).collect()} == {("42TVL", 2), ("42TWL", 1)}
    with pytest.raises(RuntimeError):
        list(stac.pages(lambda body: served[1], {"page": 1}, 3))


def test_png_tiles(spark, tmp_path):
    rng = np.random.default_rng(5)
    for x, y in ((0, 0), (1, 0)):
        path = tmp_path / "0" / str(x) / f"{y}.png"
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(images.encode_png(rng.integers(0, 256, (6, 5, 3), np.uint8)))
    (tmp_path / "0" / "bad.png").write_bytes(b"x")
    found = images.read_tiles(spark, str(tmp_path))
    back = images.encoded(images.pixels(found), ["x", "y"])
    assert {(r.x, r.y): bytes(r.content) for r in found.collect()} == {(r.x, r.y): bytes(r.content) for r in back.collect()}
    gray = rng.integers(0, 256, (4, 4), np.uint8)
    assert (images.decode_png(images.encode_png(gray))[:, :, 0] == gray).all()


def test_geoparquet_and_export(spark, tmp_path):
    table = spark.createDataFrame([("a", g.to_wkb(box(0, 0, 1, 1)), 12.0), ("b", None, None)], "id string, geometry binary, height_m double")
    geoparquet.write(table, str(tmp_path / "t"), 32642)
    back = geoparquet.read(spark, str(tmp_path / "t"))
    assert geoparquet.crs_of(back, 4326) == 32642 and geoparquet.crs_of(table, 4326) == 4326
    geojsonseq.write_features(back.withColumn("shape", g.st_geojson("geometry")), str(tmp_path / "out"), "shape", ["id", "height_m"])
    lines = [x for p in (tmp_path / "out").glob("part-*") for x in p.read_text().split("\n") if x]
    assert len(lines) == 1 and lines[0][0] == "\x1e" and json.loads(lines[0][1:])["properties"] == {"id": "a", "height_m": 12.0}


def test_manifest(spark, tmp_path):
    (tmp_path / "f.bin").write_bytes(b"dummy")
    document = {"run_id": "run-1", "created_at": "2026-02-07T00:00:00.000Z", "aoi": {"id": "a", "bbox": [1, 2, 3, 4], "crs": "EPSG:4326"}, "sources": {"osm": {"size": 3, "sha256": "AB" * 32, "date": None}}, "notes": "", "artifacts": [{"path": "old", "sha256": "0" * 64, "size": 1}]}
    new = manifest.hashed_files(spark, str(tmp_path / "f.bin"))
    once = manifest.committed(spark, document, new)
    assert manifest.committed(spark, once, new) == once and len(once["artifacts"]) == 2
    broken = manifest.problems({"run_id": "-x", "extra": 1, "artifacts": [{"path": "p", "sha256": "z", "size": -1}]})
    assert "$.extra: is not allowed" in broken and "$.run_id: has a wrong form" in broken and "$.artifacts[0].sha256: has a wrong form" in broken
    assert {"$.notes: is missing", "$.aoi: is missing", "$.sources: is missing"} <= set(broken)
    odd = manifest.problems(document | {"created_at": "2026-13-07T00:00:00Z", "aoi": {"id": "", "bbox": [1, 2, 3], "crs": "4326"}, "sources": {"osm": {"date": "today", "size": -1, "more": 1}}, "notes": None})
    assert set(odd) == {"$.created_at: has a wrong form", "$.aoi.id: has a wrong form", "$.aoi.bbox: has a wrong form", "$.aoi.crs: has a wrong form", "$.sources.osm.date: has a wrong form", "$.sources.osm.size: has a wrong form", "$.sources.osm.more: is not allowed", "$.notes: has a wrong form"}
    rows = spark.range(20).withColumn("v", F.col("id") * 2)
    assert manifest.content_digest(rows) == manifest.content_digest(rows.repartition(3)) != manifest.content_digest(rows.limit(19))


def tile_pixels(spark, tiles_, size, value):
    rows = [(x, y, r, c, value(x, y, r, c)) for x, y in tiles_ for r in range(size) for c in range(size)]
    return spark.createDataFrame(rows, "x int, y int, row int, col int, v int")


def test_mosaics(spark):
    from terraloom.operators import mosaics

    size, overlap = 12, 0.25  # a margin of 2 and a core of 8
    places = [(0, 0), (1, 0), (0, 1)]
    world = tile_pixels(spark, places, size, lambda x, y, r, c: (y * 8 + r) * 31 + (x * 8 + c) * 7)
    want = {(y * 8 + r, x * 8 + c): (y * 8 + r + 2) * 31 + (x * 8 + c + 2) * 7 for x, y in places for r in range(8) for c in range(8)}
    got = {(r.out_row, r.out_col): r.v for r in mosaics.cropped(world, size, overlap).collect()}
    assert got == want
    mixed = {(r.out_row, r.out_col): r.v for r in mosaics.blended(world, size, overlap, ["v"]).collect()}
    assert {k: mixed[k] for k in want} == want  # tiles agree, so blending changes nothing
    darker = mosaics.cropped(world, size, overlap).withColumn("v", F.lit(0))
    back = mosaics.written_back(world, darker, size, overlap, ["v"])
    assert {r.v == 0 for r in back.where("row BETWEEN 2 AND 9 AND col BETWEEN 2 AND 9").collect()} == {True}
    assert back.where("row < 2 AND v <> 0").count() == world.where("row < 2 AND v <> 0").count()
    assert mosaics.layout_report(world).first().asDict() == {"x_min": 0, "x_max": 1, "y_min": 0, "y_max": 1, "expected": 4, "found": 3, "missing": 1}


def test_harmonised_seams(spark):
    from terraloom.operators import mosaics

    flat = tile_pixels(spark, [(0, 0), (1, 0)], 12, lambda x, y, r, c: 100 + 40 * x)
    seam = tiles.neighbours(flat.select("x", "y").distinct())
    out = {(r.x, r.col): r.v for r in mosaics.harmonised_seams(flat, seam, 12, 0.25, 4, ["v"]).where("row = 5").collect()}
    assert [out[0, c] for c in (5, 6, 7, 8, 9)] == [100, 100, 107, 113, 120] and [out[1, c] for c in (2, 3, 4, 5, 6)] == [120, 127, 133, 140, 140]


def test_imaging(spark):
    from terraloom.operators import imaging

    image = np.random.default_rng(4).integers(0, 256, (30, 41, 3)).astype(np.uint8)
    small = imaging.box_downscaled(image, 0.3)
    assert small.shape == (9, 12, 3) and small.mean() == pytest.approx(image.mean())
    out = imaging.stylised(image, colours=6)
    assert out.shape == image.shape and len(np.unique(out.reshape(-1, 3), axis=0)) <= 7
    table = spark.createDataFrame([(0, 0, images.encode_png(image)), (1, 0, images.encode_png(image[:, :, 0]))], "x int, y int, content binary")
    assert [images.decode_png(bytes(r.content)).shape for r in imaging.stylised_tiles(table).orderBy("x").collect()] == [(30, 41, 3)] * 2
    mask = imaging.rasterised(box(1, 1, 3, 3), 0, 4, 1, 4, 4)
    assert mask.tolist() == [[0, 0, 0, 0], [0, 1, 1, 0], [0, 1, 1, 0], [0, 0, 0, 0]]
    rows = [(g.to_wkb(box(10, 10, 20, 20)), 5.0), (g.to_wkb(box(60, 10, 70, 20)), 3.0), (None, 1.0)]
    drawn = imaging.rendered(spark.createDataFrame(rows, "geometry binary, height_m double"), 32, 1.0, 1.0).collect()
    first = next(images.decode_png(bytes(r.content)) for r in drawn if (r.tx, r.ty) == (0, 0))
    assert first.shape == (32, 32, 3) and (first[10, 0] == imaging.ROOF).all()
    # The camera stands south-west: of a square only the walls whose normals look to -x or -y are drawn, above the roof of what has no height.
    flat, tall = (imaging.drawn([(g.to_wkb(box(10, 10, 20, 20)), h)], -20, 0, 40, 1.0, 1.0) for h in (0.0, 4.0))
    lit = (tall == imaging.WALL_LIGHT).all(axis=2)
    roof = lambda image: (image == imaging.ROOF).all(axis=2)
    assert not (flat == imaging.WALL_LIGHT).all(axis=2).any() and (roof(tall)[:-4] == roof(flat)[4:]).all() and not (lit & roof(tall)).any()
    assert lit.sum() == 0 or np.nonzero(lit)[0].max() < 15  # walls to the north-east of row 15, the middle of the base, are never seen
    wide = np.arange(60, dtype=float).reshape(6, 10, 1)
    assert np.allclose(imaging.lanczos(np.full((7, 9, 3), 5.0), 4, 20), 5) and np.allclose(imaging.lanczos(wide, 6, 10), wide)
    assert imaging.lanczos(wide, 3, 5).shape == (3, 5, 1) and imaging.lanczos(wide, 3, 5).mean() == pytest.approx(wide.mean(), rel=0.02)
    assert imaging.unit_image(image, 30, 41)[3, 4] == pytest.approx(image[3, 4] / 255) and imaging.unit_image(image[:, :, :1], 8, 8).shape == (8, 8, 3)
    strength = np.arange(100.0).reshape(10, 10) * 2.5
    assert [imaging.edge_statistics(strength, 1, 40, c)[1:] for c in (0.2, 1.0)] == [(200, 0.2), (40, 0.84)]


def test_strips_against_plain_scores(spark):
    rng = np.random.default_rng(3)
    cand, left, top, corner = (rng.normal(size=(6, 6)) for _ in range(4))

    def magnitude(v):
        w = np.pad(v, 1, mode="edge")
        gx = (w[:-2, 2:] + 2 * w[1:-1, 2:] + w[2:, 2:]) - (w[:-2, :-2] + 2 * w[1:-1, :-2] + w[2:, :-2])
        gy = (w[2:, :-2] + 2 * w[2:, 1:-1] + w[2:, 2:]) - (w[:-2, :-2] + 2 * w[:-2, 1:-1] + w[:-2, 2:])
        return np.hypot(gx, gy)

    def plain(a, b):
        return np.abs(a - b).mean() + 0.25 * ((a - b) ** 2).mean() + 0.5 * np.abs(magnitude(a) - magnitude(b)).mean()

    long = lambda x, y, v: [(x, y, r, c, float(v[r, c])) for r in range(6) for c in range(6)]
    chosen = spark.createDataFrame(long(0, 1, left) + long(1, 0, top) + long(0, 0, corner), "x int, y int, row int, col int, value double")
    candidates = spark.createDataFrame(long(1, 1, cand), "x int, y int, row int, col int, value double").withColumn("variant", F.lit(0))
    sides = {"left": plain(cand[:, :2], left[:, 4:]), "top": plain(cand[:2], top[4:]), "tl": plain(cand[:2, :2], corner[4:, 4:])}
    for asked in ("left", "left+top", "left+top+top-left"):
        want = sum(sides[s.replace("top-left", "tl")] for s in asked.split("+"))
        assert seams.strip_scores(candidates, chosen, 6, 2, neighbours=asked).first().seam == pytest.approx(want)
    assert text.structure_weights("sd_WHITEBOX", False)["rgb_l1"] == 0.15 and text.structure_weights("sd_WHITEBOX", True) == text.structure_weights("raw", False)


def test_feature_files(spark, tmp_path):
    from terraloom.sources import geojsonseq

    rows = spark.createDataFrame([(2, "b", bytearray(b"\xff"), '{"type": "Point", "coordinates": [1, 2]}'), (1, None, bytearray(b"ok"), '{"type": "Point", "coordinates": [3, 4]}'), (3, "c", None, None)], "id int, name string, raw binary, shape string")
    assert geojsonseq.write_features(rows, str(tmp_path / "seq"), "shape", ["id", "raw"]) == {"written": 2, "dropped": 1}
    lines = [json.loads(v.value.lstrip("\x1e")) for v in spark.read.text(str(tmp_path / "seq")).collect()]
    assert {(f["properties"]["id"], f["properties"]["raw"]) for f in lines} == {(1, "ok"), (2, "ff")}
    for name, table in (("all", rows), ("none", rows.limit(0))):
        geojsonseq.write_collection(table, str(tmp_path / name), "shape", ["id", "name"], ["id"])
        (file,) = (tmp_path / name).glob("part-*")
        found = json.loads(file.read_text())
        assert found["type"] == "FeatureCollection" and [f["properties"]["id"] for f in found["features"]] == ([1, 2] if name == "all" else [])


def test_geoparquet_footer(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    from terraloom.sources import geoparquet

    wkb = g.to_wkb(box(0, 0, 1, 1))
    geo = {"version": "1.0.0", "primary_column": "geometry", "columns": {"geometry": {"encoding": "WKB", "geometry_types": ["Polygon"], "crs": {"type": "ProjectedCRS", "id": {"authority": "EPSG", "code": 32642}}}}}
    for name, crs, want in (("utm", geo["columns"]["geometry"]["crs"], 32642), ("world", {"id": {"authority": "OGC", "code": "CRS84"}}, 4326), ("odd", {"name": "own"}, None), ("none", None, 4326)):
        column = geo["columns"]["geometry"] | {"crs": crs}
        own = geo | {"columns": {"geometry": column if crs else {k: v for k, v in column.items() if k != "crs"}}}
        table = pa.table({"id": ["a"], "geometry": [wkb]}).replace_schema_metadata({"geo": json.dumps(own)})
        pq.write_table(table, tmp_path / f"{name}.parquet")
        if want is None:
            with pytest.raises(ValueError):
                geoparquet.read(spark, str(tmp_path / f"{name}.parquet"))
        else:
            assert geoparquet.crs_of(geoparquet.read(spark, str(tmp_path / f"{name}.parquet")), 0) == want
    rows = spark.createDataFrame([(i, bytearray(wkb)) for i in range(9)], "id int, geometry binary").repartition(3)
    at = str(tmp_path / "ours")
    for table, n in ((rows, 9), (rows.limit(0), 0), (rows, 9)):
        assert geoparquet.write(table, at, 32642, kinds=["Polygon"]) == n
        back = geoparquet.read(spark, at)
        assert back.count() == n and geoparquet.crs_of(back, 0) == 32642 and back.dtypes == rows.dtypes
    for file in (tmp_path / "ours").glob("*.parquet"):
        meta = json.loads(pq.read_schema(file).metadata[b"geo"])
        assert meta["columns"]["geometry"]["crs"]["id"]["code"] == 32642 and meta["primary_column"] == "geometry"


def test_listed_images(spark, tmp_path):
    for name in ("a/b.PNG", "a/c.jpg", "d.png", "e.txt", "f.webp"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(b"x")
    names = lambda rows: [r.path.rsplit("/", 1)[1] for r in rows]
    assert names(images.listed(spark, str(tmp_path)).collect()) == ["b.PNG", "d.png"] and names(images.listed(spark, str(tmp_path), 1).collect()) == ["b.PNG"]
    assert [p.rsplit("/", 1)[1] for p in images.anchors(spark, str(tmp_path))] == ["b.PNG", "c.jpg", "d.png", "f.webp"]
    with pytest.raises(ValueError):
        images.anchors(spark, str(tmp_path), most=3)


def test_large_enough_and_search_body(spark):
    from terraloom.operators import ingest, scenes

    side = 0.001  # 111 m north, 84 m east at 41 degrees; on the web map 111 m and 148 m
    rows = spark.createDataFrame([(1, bytearray(g.to_wkb(box(69, 41, 69 + side, 41 + side)))), (2, None)], "id int, geometry binary")
    for least, kept in ((16_000, [1]), (17_000, [])):
        large, report = ingest.large_enough(rows, least)
        assert [r.id for r in large.collect()] == kept and report.first().dropped_small == 2 - len(kept)
    body = scenes.search_body("c", (1, 2, 3, 4), "2020/2021", 60)
    assert body["query"] == {"eo:cloud_cover": {"lte": 60}} and body["limit"] == 200 and body["bbox"] == [1, 2, 3, 4]


def test_generation(spark):
    from terraloom.operators import generation

    lines = spark.createDataFrame([(0, "# note"), (1, " A cat "), (2, ""), (3, "Dogs!"), (4, "more")], "line_no int, value string")
    asked = generation.requests(generation.prompts(lines, 2), 2, 7)
    assert {r.file for r in asked.collect()} == {"0001-a-cat-v00-c00.png", "0001-a-cat-v01-c00.png", "0002-dogs-v00-c00.png", "0002-dogs-v01-c00.png"}

    def model(prompt, seed):
        if prompt.startswith("D"):
            raise ValueError("no dogs")
        return generation.echo(prompt, seed)

    done = generation.generated(asked, model, 2).cache()
    assert generation.run_report(done).first().asDict() == {"total": 4, "ok": 2, "failed": 2, "all_failed": False}
    calls = []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise TimeoutError
        return b"x"

    assert generation.with_retries(flaky, lambda e: True, 3, lambda n: 0, lambda s: None) == b"x"
    answer = json.dumps({"candidates": [{"content": {"parts": [{"text": "hi"}, {"inlineData": {"mimeType": "image/png", "data": "AA"}}]}}, {"content": {"parts": []}}]})
    blocked = json.dumps({"promptFeedback": {"blockReason": "SAFETY"}})
    got = [r.i for r in spark.createDataFrame([(answer,), (blocked,), ("{",)], "a string").select(generation.response_images(F.col("a")).alias("i")).collect()]
    assert [(p.mime, p.data) for p in got[0]] == [("image/png", "AA")] and got[1:] == [None, None]
    import hashlib

    key = spark.range(1).select(generation.cache_key({"b": F.lit("x y"), "a": F.lit(3)}).alias("k")).first().k
    assert key == hashlib.sha256(json.dumps({"b": "x y", "a": 3}, sort_keys=True).encode()).hexdigest()


def test_choice_along_the_grid(spark):
    from terraloom.operators import generation

    rng = np.random.default_rng(9)
    own = [(x, y, v, float(rng.random())) for x in range(3) for y in range(3) for v in range(3)]
    pairs = [(x, y, v, ox, oy, w, float(rng.random())) for x in range(3) for y in range(3) for ox, oy in ((x - 1, y), (x, y - 1)) if ox >= 0 and oy >= 0 for v in range(3) for w in range(3)]
    got = {(r.x, r.y): r.variant for r in generation.chosen_along_grid(spark.createDataFrame(own, "x int, y int, variant int, cost double"), spark.createDataFrame(pairs, "x int, y int, variant int, ox int, oy int, other_variant int, cost double")).collect()}
    cost = {p[:6]: p[6] for p in pairs}
    want: dict = {}
    for y in range(3):
        for x in range(3):
            scores = [c + sum(cost[x, y, v, ox, oy, want[ox, oy]] for ox, oy in ((x - 1, y), (x, y - 1)) if (ox, oy) in want) for a, b, v, c in own if (a, b) == (x, y)]
            want[x, y] = int(np.argmin(scores))
    assert got == want


def test_windows_and_repairs(spark):
    from terraloom.operators import windows

    rows = [(r, c, r + c) for r in range(70) for c in range(100)]
    mosaic = spark.createDataFrame(rows, "out_row int, out_col int, v int")
    same = windows.painted(mosaic, 70, 100, lambda image, seed: image, ["v"], 64, 16)
    assert {tuple(r) for r in same.collect()} == set(rows)
    lighter = windows.painted(mosaic, 70, 100, lambda image, seed: image + 10, ["v"], 64, 16)
    assert {(r.out_row, r.out_col, r.v - 10) for r in lighter.collect()} == set(rows)
    marks = spark.createDataFrame([(20, 30)], "mark_row int, mark_col int")
    fixed = {(r.out_row, r.out_col): r.v for r in windows.repaired_around(mosaic, marks, 8, lambda image, seed: image + 100, ["v"]).collect()}
    assert fixed[0, 0] == 0 and fixed[20, 30] > 120 and fixed[20, 37] - 57 < 10 and len(fixed) == len(rows)


def test_rules(spark):
    from terraloom.functions import rules

    assert rules.year_list("2019, 2017,2019") == [2017, 2019] and rules.year_list("2020-2018") == [2018, 2019, 2020] and rules.year_list("2021") == [2021]
    for bad in ("x", "1000-2000", "20"):
        with pytest.raises(ValueError):
            rules.year_list(bad)
    assert rules.byte_range("bytes=0-3", 26) == (0, 3) and rules.byte_range("bytes=-5", 26) == (21, 25) and rules.byte_range("bytes=20-", 26) == (20, 25) and rules.byte_range(None, 26) is None
    for bad in ("bytes=0-1,3-4", "bytes=30-", "bytes=-", "lines=1-2"):
        with pytest.raises(ValueError):
            rules.byte_range(bad, 26)
    shape = '{"type":"Point","coordinates":[1,2]}'
    row = spark.range(1).select(
        rules.first_geometry(F.lit('{"features":[{"geometry":%s}]}' % shape)).alias("a"), rules.first_geometry(F.lit('{"type":"Feature","geometry":%s}' % shape)).alias("b"), rules.first_geometry(F.lit(shape)).alias("c"),
        rules.usable_overlap(F.lit('{"overlap":0.1}')).alias("d"), rules.usable_overlap(F.lit('{"overlap":0.9}')).alias("e"), rules.layer_list(F.lit("roads, green,roads,x"), ("green", "water", "roads")).alias("f"),
        rules.instant_of_http_date(F.lit("Sat, 07 Feb 2026 01:02:03 GMT")).alias("g"), rules.instant_of_http_date(F.lit("soon")).alias("h"), rules.bbox_ring(*map(F.lit, (0, 1, 2, 3))).alias("i"),
    ).first()
    assert row.a == row.b == row.c == shape and (row.d, row.e, row.f) == (0.1, 0.0, ["green", "roads"])
    assert (row.g, row.h, row.i) == ("2026-02-07T01:02:03.000Z", None, [[0, 1], [2, 1], [2, 3], [0, 3], [0, 1]])


def test_strips_gaps_and_heat(spark):
    a = tile_pixels(spark, [(0, 0), (1, 0)], 4, lambda x, y, r, c: 10 * x + c).withColumnRenamed("v", "value")
    own = a.where("x = 1").withColumn("variant", F.lit(0))
    got = seams.strip_scores(own, a, 4, 2).first()
    assert got.seam == pytest.approx(8 + 0.25 * 64)  # columns 0, 1 of the right tile over columns 2, 3 of the left one
    assert seams.index_gaps(spark.createDataFrame([(0, 0), (1, 0), (4, 0), (6, 0)], "x int, y int"), "x").collect() == [(1, 4), (4, 6)]
    heat = seams.heatmap(spark.createDataFrame([(0, 0, "v", 4.0), (0, 0, "h", 2.0), (1, 0, "v", 4.0)], "out_row int, out_col int, axis string, l1 double"))
    assert {(r.out_row, r.r, r.g, r.b) for r in heat.collect()} == {(0, 255, 0, 0), (1, 255, 255, 255)}  # half the greatest is pure red


def test_grid_choice_reads_only_the_last_diagonal_and_takes_empty_tables(spark):
    own = spark.createDataFrame([], "x int, y int, variant int, cost double")
    pairs = spark.createDataFrame([], "x int, y int, variant int, ox int, oy int, other_variant int, cost double")
    assert generation.chosen_along_grid(own, pairs).collect() == []
    rng = random.Random(5)
    side, variants = 4, 3
    cost = {(x, y, v): float(rng.randrange(50)) for x in range(side) for y in range(side) for v in range(variants)}
    rows = [(x, y, v, x - dx, y - dy, o, float(rng.randrange(50))) for x, y, v in cost for dx, dy in ((1, 0), (0, 1)) if x >= dx and y >= dy for o in range(variants)]
    seam = {r[:6]: r[6] for r in rows}
    best: dict[tuple[int, int], tuple[float, int]] = {}
    for x, y in sorted(((x, y) for x in range(side) for y in range(side)), key=sum):
        near = [(i, j) for i, j in ((x - 1, y), (x, y - 1)) if (i, j) in best]
        best[x, y] = min((cost[x, y, v] + sum(seam[x, y, v, i, j, best[i, j][1]] for i, j in near), v) for v in range(variants))
    got = generation.chosen_along_grid(spark.createDataFrame([(*k, c) for k, c in cost.items()], own.schema), spark.createDataFrame(rows, pairs.schema)).collect()
    assert {(r.x, r.y): (r.score, r.variant) for r in got} == best


def test_missing_tiles_of_negative_indices_and_of_no_tiles(spark):
    own = spark.createDataFrame([(-1, 2), (1, 3), (1, 3)], "x int, y int")
    assert sorted(map(tuple, tiles.missing_tiles(own).collect())) == [(-1, 3), (0, 2), (0, 3), (1, 2)]
    assert tiles.missing_tiles(own).schema == own.schema
    assert tiles.missing_tiles(own.limit(0)).collect() == []
