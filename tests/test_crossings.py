"""Crossings against a loop over pixels, and the order of the two passes."""

from __future__ import annotations

import math

import numpy as np
import pytest

from terraloom.operators import bands, crossings

SCHEMA = "x int, y int, row int, col int, a int, b int"


def paint(patch, mask, seed):
    return np.where(mask[:, :, None], 255 - patch, patch // 2)


def table_of(spark, tiles: dict):
    rows = [(x, y, r, c, *map(int, t[r, c])) for (x, y), t in tiles.items() for r in range(t.shape[0]) for c in range(t.shape[1])]
    return spark.createDataFrame(rows, SCHEMA)


def tiles_of(df) -> dict:
    return {(r.x, r.y, r.row, r.col): (r.a, r.b) for r in df.collect()}


def flat(tiles: dict) -> dict:
    return {(x, y, r, c): tuple(map(int, t[r, c])) for (x, y), t in tiles.items() for r in range(t.shape[0]) for c in range(t.shape[1])}


def plain_crossings(tiles: dict, w: int, h: int, mx: int, my: int, context: int, mask_half: int, write_half: int, harmonise: int) -> dict:
    """One crossing after the other, in the order of their turns."""
    tiles = {k: v.astype(int).copy() for k, v in tiles.items()}
    (l0, l1), (r0, r1) = (max(0, w - mx - context), min(w, w - mx + context)), (max(0, mx - context), min(w, mx + context))
    (t0, t1), (b0, b1) = (max(0, h - my - context), min(h, h - my + context)), (max(0, my - context), min(h, my + context))
    limit = min(l1 - l0, r1 - r0, t1 - t0, b1 - b0) - 1
    half, wide = max(1, min(mask_half, limit)), max(1, min(write_half, l1 - l0, t1 - t0))
    shared_x = max(r1, mx + harmonise) > min(l0, w - mx - harmonise)
    shared_y = max(b1, my + harmonise) > min(t0, h - my - harmonise)
    order = sorted(tiles, key=lambda p: (p[0] % 2 if shared_x else 0, p[1] % 2 if shared_y else 0, p))
    for x, y in order:
        corners = [tiles.get(p) for p in ((x, y), (x + 1, y), (x, y + 1), (x + 1, y + 1))]
        if limit <= 0 or any(t is None for t in corners):
            continue
        tl, tr, bl, br = corners
        patch = np.concatenate([np.concatenate([tl[t0:t1, l0:l1], tr[t0:t1, r0:r1]], 1), np.concatenate([bl[b0:b1, l0:l1], br[b0:b1, r0:r1]], 1)], 0)
        sx, sy = l1 - l0, t1 - t0
        mask = np.zeros(patch.shape[:2], bool)
        mask[sy - half : sy + half + 1, sx - half : sx + half + 1] = True
        made = paint(patch.astype(np.uint8), mask, 0).astype(int)
        for i in range(patch.shape[0]):
            for j in range(patch.shape[1]):
                dy, dx = (sy - 1 - i if i < sy else i - sy), (sx - 1 - j if j < sx else j - sx)
                alpha = round(255 * max(0.0, 1 - math.hypot(dx, dy) / wide) ** 2)
                tile = (tl if j < sx else tr) if i < sy else (bl if j < sx else br)
                at = (t0 + i if i < sy else b0 + i - sy), (l0 + j if j < sx else r0 + j - sx)
                tile[at] = np.floor((tile[at] * (255 - alpha) + made[i, j] * alpha) / 255 + 0.5)
        near = min(harmonise, wide, w - mx, h - my)

        def draw(a, at, b, there, d):
            p, q = a[at].copy(), b[there].copy()
            mean, t = np.floor(p + 0.5 * (q - p)), 1.0 if near == 1 else 1 - d / (near - 1)
            a[at], b[there] = np.floor(p + t * (mean - p)), np.floor(q + t * (mean - q))

        for left, right, top, bottom in ((tl, tr, t0, t1), (bl, br, b0, b1)):
            for d in range(near):
                for r in range(top, bottom):
                    draw(left, (r, w - mx - 1 - d), right, (r, mx + d), d)
        for upper, lower, first, last in ((tl, bl, l0, l1), (tr, br, r0, r1)):
            for d in range(near):
                for c in range(first, last):
                    draw(upper, (h - my - 1 - d, c), lower, (my + d, c), d)
    return tiles


def some_tiles(w: int, h: int) -> dict:
    rng = np.random.default_rng(8)
    return {xy: rng.integers(0, 256, (h, w, 2)) for xy in ((0, 0), (1, 0), (2, 0), (0, 1), (1, 1), (2, 1), (0, 2), (1, 2), (5, 5))}


@pytest.mark.parametrize("context, write_half, harmonise", [(3, 3, 2), (2, 9, 9), (7, 5, 5), (4, 1, 1), (3, 2, 0)])
def test_crossings(spark, context, write_half, harmonise):
    w, h, mx, my = 14, 12, 2, 3
    tiles = some_tiles(w, h)
    got = crossings.crossed(table_of(spark, tiles), (w, h), (mx, my), paint, ["a", "b"], context, 1, write_half, harmonise)
    assert tiles_of(got) == flat(plain_crossings(tiles, w, h, mx, my, context, 1, write_half, harmonise))


def test_no_room_no_tiles_nulls(spark):
    tiles = some_tiles(6, 6)
    df = table_of(spark, tiles)
    assert tiles_of(crossings.crossed(df, (6, 6), (0, 0), paint, ["a", "b"], 1)) == flat(tiles)
    assert crossings.crossed(df.where("false"), (6, 6), (1, 1), paint, ["a", "b"], 2).count() == 0
    assert crossings.possible(df.where("false")) == {"seams": 0, "crossings": 0} and crossings.crossings_of(df.where("false")).count() == 0
    holed = df.selectExpr("x", "y", "row", "col", "IF(x = 1 AND y = 1, NULL, a) AS a", "b", "'more' AS cx")
    found = tiles_of(crossings.crossed(holed, (6, 6), (1, 1), paint, ["a", "b"], 2, 1, 2, 1))
    assert found == tiles_of(holed)  # every crossing here touches the tile that has no value


def test_order_of_passes(spark):
    w, h, mx, my = 14, 12, 2, 3
    tiles = some_tiles(w, h)
    df = table_of(spark, tiles)
    first = {}
    for (x, y, r, c), v in tiles_of(bands.repaired(df, (w, h), (mx, my), paint, ["a", "b"], 3, 1, 3, 2)).items():
        first.setdefault((x, y), np.zeros((h, w, 2), int))[r, c] = v
    run = lambda **caps: crossings.mended(df, (w, h), (mx, my), paint, ["a", "b"], 3, (1, 3, 2), (1, 3), **caps)
    out, account = run()
    assert tiles_of(out) == flat(plain_crossings(first, w, h, mx, my, 3, 1, 3, 2))
    # Indices 0 to 2 and 5 on both axes: 2 pairs beside 4 indices each way; 10 seams and 3 crossings have all their tiles.
    assert account == {"seams": 16, "seams_done": 10, "seams_skipped": 6, "crossings": 4, "crossings_done": 3, "crossings_skipped": 1, "crossings_run": True}
    out, account = run(most_crossings=1)
    assert account["crossings_done"] == 1
    left = {k: v for k, v in first.items() if k in ((0, 0), (1, 0), (0, 1), (1, 1))}
    assert tiles_of(out) == flat(first | plain_crossings(left, w, h, mx, my, 3, 1, 3, 2))
    out, account = run(most_seams=2)
    assert not account["crossings_run"] and account["seams_done"] == 2
    row = {k: v for k, v in tiles.items() if k[1] == 0}
    assert tiles_of(out) == flat(tiles) | tiles_of(bands.repaired(table_of(spark, row), (w, h), (mx, my), paint, ["a", "b"], 3, 1, 3, 2, "v"))
    assert not run(most_seams=99)[1]["crossings_run"]  # seams with absent tiles count as left out
