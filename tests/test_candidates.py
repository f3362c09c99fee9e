"""Resampling against loops, total scores, and a search that is broken off and goes on."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from terraloom.operators import candidates, seams


def plain_axis(image: np.ndarray, n_out: int) -> np.ndarray:
    """Along the second axis, output by output."""
    n_in = image.shape[1]
    if n_in == n_out:
        return image
    scale = max(n_in / n_out, 1.0)
    out = np.zeros((image.shape[0], n_out), int)
    for o in range(n_out):
        centre = (o + 0.5) * n_in / n_out
        at = [i for i in range(n_in) if max(0, int(centre - 3 * scale + 0.5)) <= i < min(n_in, int(centre + 3 * scale + 0.5))]
        sinc = lambda t: 1.0 if t == 0 else math.sin(math.pi * t) / (math.pi * t)
        raw = [sinc(t) * sinc(t / 3) if abs(t) < 3 else 0.0 for t in ((i - centre + 0.5) / scale for i in at)]
        whole = [int(math.copysign(math.floor(abs(k / sum(raw) * 4194304) + 0.5), k)) for k in raw]
        for r in range(image.shape[0]):
            out[r, o] = min(255, max(0, (2097152 + sum(int(image[r, i]) * k for i, k in zip(at, whole, strict=True))) >> 22))
    return out


@pytest.mark.parametrize("size, to", [((9, 14), (4, 5)), ((5, 6), (11, 6)), ((4, 4), (4, 4)), ((7, 3), (1, 9))])
def test_resampled(spark, size, to):
    image = np.random.default_rng(2).integers(0, 256, size)
    df = spark.createDataFrame([(0, r, c, int(image[r, c])) for r in range(size[0]) for c in range(size[1])], "id int, row int, col int, v int")
    got = {(r.row, r.col): r.v for r in candidates.resampled(df, ["id"], size, to, ["v"]).collect()}
    want = plain_axis(plain_axis(image, to[1]).T, to[0]).T
    assert got == {(r, c): int(want[r, c]) for r in range(to[0]) for c in range(to[1])}


def test_resampling_keeps_what_is_flat(spark):
    df = spark.range(64 * 64).select(F.lit("a").alias("id"), (F.col("id") / 64).cast("int").alias("row"), (F.col("id") % 64).cast("int").alias("col"), F.lit(201).alias("v"), F.lit(None).cast("int").alias("u"))
    small = candidates.resampled(df, ["id"], (64, 64), (10, 20), ["v", "u"])
    assert small.count() == 200 and small.select("v", "u").distinct().collect() == [(201, 0)]
    assert candidates.resampled(df.where("false"), ["id"], (64, 64), (10, 20), ["v"]).count() == 0
    for n_in, n_out in ((1024, 128), (3, 1000)):
        assert len(candidates.axis_weights(n_in, n_out)) <= 6 * max(n_in, n_out) + 2 * n_out


def grid(spark, width: int, height: int, seed: int = 1):
    rng = np.random.default_rng(seed)
    rows = [(x, y, r, c, *map(int, rng.integers(0, 256, 3))) for x in range(width) for y in range(height) for r in range(4) for c in range(4)]
    return spark.createDataFrame(rows, "x int, y int, row int, col int, r int, g int, b int")


SCORING = candidates.Scoring(4, 2, "left+top", structure_px=2, structure_weight=0.5, fallback_penalty=0.1)


class Asked:
    """Answers made of the input by plain columns, and a table of what was asked for."""

    def __init__(self, path: str, broken=lambda x, y, variant: F.lit(False), stop_at: int | None = None):
        self.path, self.broken, self.stop_at, self.steps = path, broken, stop_at, 0

    def __call__(self, asked, inputs, before):
        self.steps += 1
        if self.steps == self.stop_at:
            raise ConnectionError("the service went away")
        asked.write.mode("append").parquet(self.path)
        bad = self.broken(F.col("x"), F.col("y"), F.col("variant"))
        sound = asked.where(~bad).join(inputs, ["x", "y"])
        turn = lambda c, k: ((F.col(c) * (F.col("variant") * 2 + 1) + k * F.col("variant")) % 256).alias(c)
        rows = sound.select("key", "row", "col", turn("r", 3), turn("g", 5), turn("b", 7), F.lit(None).cast("string").alias("error"), (F.col("variant") == 2).alias("fallback"))
        none = [F.lit(None).cast("int").alias(c) for c in ("row", "col", "r", "g", "b")]
        return rows.unionByName(asked.where(bad).select("key", *none, F.lit("refused").alias("error"), F.lit(False).alias("fallback")))


def plain_search(df, variants: int) -> dict:
    """Tile after tile, each candidate against what was chosen before, by the operator for one tile."""
    tiles = {}
    for r in df.collect():
        tiles.setdefault((r.x, r.y), np.zeros((4, 4, 3), int))[r.row, r.col] = (r.r, r.g, r.b)
    small = lambda t: np.stack([plain_axis(plain_axis(t[:, :, c], 2).T, 2).T for c in range(3)], 2)
    used = dict(SCORING.seam_weights)

    def pair(a, b, weights):
        a, b = a / 255, b / 255
        la, lb = (i @ np.array(seams.LUMA) for i in (a, b))

        def magnitude(p):
            p = np.pad(p, 1, mode="edge")
            h, w = p.shape[0] - 2, p.shape[1] - 2
            at = lambda i, j: p[i : i + h, j : j + w]
            gx = at(0, 0) + 2 * at(1, 0) + at(2, 0) - at(0, 2) - 2 * at(1, 2) - at(2, 2)
            gy = at(0, 0) + 2 * at(0, 1) + at(0, 2) - at(2, 0) - 2 * at(2, 1) - at(2, 2)
            return np.hypot(gx, gy)

        return weights["rgb_l1"] * np.abs(a - b).mean() + weights["rgb_l2"] * ((a - b) ** 2).mean() + weights["sobel_l1"] * np.abs(magnitude(la) - magnitude(lb)).mean()

    chosen, out = {}, {}
    for x, y in sorted(tiles, key=lambda p: (p[0] + p[1], p)):
        scores = []
        for v in range(variants):
            made = (tiles[x, y] * (2 * v + 1) + np.array([3, 5, 7]) * v) % 256
            total = 0.5 * pair(small(tiles[x, y]), small(made), candidates.STRUCTURE) + (0.1 if v == 2 else 0)
            if (x - 1, y) in chosen:
                total += pair(chosen[x - 1, y][:, 2:], made[:, :2], used)
            if (x, y - 1) in chosen:
                total += pair(chosen[x, y - 1][2:], made[:2], used)
            scores.append((total, v, made))
        best = min(scores, key=lambda s: s[:2])
        chosen[x, y], out[x, y] = best[2], (best[1], pytest.approx(best[0]))
    return out


def test_search_goes_on_where_it_stopped(spark, tmp_path):
    df, root, log = grid(spark, 3, 2), str(tmp_path / "out"), str(tmp_path / "asked")
    make = lambda: candidates.Search(spark, root, {"model": "m"}, SCORING, 3)
    with pytest.raises(ConnectionError):
        make().run(df, Asked(log, stop_at=3))
    assert spark.read.parquet(log).count() == 9  # the first tile and the two behind it
    second = Asked(log)
    got = {(r.x, r.y): (r.variant, r.score) for r in make().run(df, second).collect()}
    assert got == plain_search(df, 3) and second.steps == 2
    keys = spark.read.parquet(log)
    assert keys.count() == 18 == keys.select("key").distinct().count()  # nothing was asked for twice
    third = Asked(log)
    assert make().run(df, third).count() == 6 and third.steps == 0
    # Answers outlive lost choices: nothing is asked for again.
    search = make()
    system, at = search._path("chosen")
    system.delete(at, True)
    again = Asked(log)
    assert {(r.x, r.y): (r.variant, r.score) for r in search.run(df, again).collect()} == got and again.steps == 0
    with pytest.raises(ValueError, match="another configuration"):
        candidates.Search(spark, root, {"model": "n"}, SCORING, 3)
    assert candidates.Search(spark, root, {"model": "n"}, SCORING, 3, force=True).read("chosen").count() == 0


def test_search_with_failures(spark, tmp_path):
    df, root, log = grid(spark, 2, 1), str(tmp_path / "out"), str(tmp_path / "asked")
    make = lambda: candidates.Search(spark, root, {}, SCORING, 2)
    got = {(r.x, r.y): r for r in make().run(df, Asked(log, lambda x, y, v: (x == 1) | (v == 0))).collect()}
    assert (got[0, 0].variant, got[0, 0].failed, got[1, 0].variant, got[1, 0].score, got[1, 0].failed) == (1, 1, None, None, 2)
    assert make().read("chosen").select("x").distinct().collect() == [(0,)]
    got = {(r.x, r.y): r for r in make().run(df, Asked(log)).collect()}
    assert got[1, 0].variant is not None and got[1, 0].failed == 0
    assert candidates.Search(spark, str(tmp_path / "none"), {}, SCORING, 2).run(df.where("false"), Asked(log)).count() == 0
