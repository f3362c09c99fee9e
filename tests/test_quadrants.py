"""Shapes cut along quadrants against a clip of each cell, and what is shuffled for large ones."""

from __future__ import annotations

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from terraloom.functions import geometry as g
from terraloom.operators import coverage, ingest, quadrants
from tests.test_places import star


def box(x0: float, y0: float, x1: float, y1: float) -> np.ndarray:
    return np.array([(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)], float)


def tables(spark, shapes, bounds, size):
    cells = coverage.grid_cells(spark, bounds, size)
    return spark.createDataFrame([(None if s is None else s if isinstance(s, bytes) else g.to_wkb(s),) for s in shapes], "wkb binary"), cells


def by_cell(shapes, cells, size):
    return {(r.ix, r.iy): r.area for r in quadrants.area_by_cell(shapes, cells, size).collect()}


@pytest.mark.parametrize(("large", "block"), [(1000, 5), (5, 0), (5, 2)])
def test_areas_equal_a_clip_of_each_cell(spark, monkeypatch, large, block):
    monkeypatch.setattr(quadrants, "LARGE", large)
    monkeypatch.setattr(quadrants, "BLOCK", block)
    monkeypatch.setattr(quadrants, "DEEP", 1)
    monkeypatch.setattr(quadrants, "WHOLE", 2)
    rng, size = np.random.default_rng(4), 3.7
    shapes = [("Polygon", [[star(rng, *rng.uniform(-60, 60, 2), float(rng.choice([2, 15, 90])))]]) for _ in range(40)]
    shapes.append(("Polygon", [[box(-500, -500, 500, 500), box(-10.5, -8, 3.7 * 4, 3.7 * 4)]]))
    shapes.append(("MultiPolygon", [[box(-40, -40, 0, 0)], [box(-20, -20, 20, 20)]]))  # parts that overlap
    shapes.append(("Polygon", [[np.array([(-30, -30), (30, 30), (30, -30), (-30, 30), (-30, -30)], float)]]))  # a ring that crosses itself
    shapes.append(("Polygon", [[np.concatenate([box(-29.6, -29.6, 29.6, 29.6), box(-29.6, -29.6, 29.6, 29.6)[1:]])]]))  # once around, twice
    df, cells = tables(spark, [*shapes, shapes[0]], (-50, -30, 45, 52), size)
    got, want = by_cell(df, cells, size), {}
    for ix, iy in {(r.ix, r.iy) for r in cells.collect()}:
        want[ix, iy] = sum(g.area_within(s, (ix * size, iy * size, (ix + 1) * size, (iy + 1) * size)) for s in [*shapes, shapes[0]])
    assert set(got) <= set(want)
    assert {k: pytest.approx(v, abs=1e-7) for k, v in want.items()} == {k: got.get(k, 0.0) for k in want}


def test_nothing_counts_as_nothing(spark):
    odd = [None, b"", b"broken", ("LineString", [box(0, 0, 9, 9)]), ("Polygon", []), ("Polygon", [[box(0, 0, np.inf, 9)]]), ("Polygon", [[box(500, 500, 900, 900)]]), ("Polygon", [[box(1, 1, 1, 8)]])]
    df, cells = tables(spark, odd, (0, 0, 100, 100), 10)
    assert by_cell(df, cells, 10) == {}
    whole, _ = tables(spark, [("Polygon", [[box(0, 0, 100, 100)]])], (0, 0, 100, 100), 10)
    assert by_cell(whole, cells.limit(0), 10) == {} and by_cell(whole.limit(0), cells, 10) == {}
    assert by_cell(whole, cells, 10) == {(i, j): pytest.approx(100) for i in range(10) for j in range(10)}
    shares = ingest.green_coverage(cells, df.select(F.col("wkb").alias("geometry")), 10, 32642, 32642)
    assert shares.columns == ["cell_id", "cell_area_m2", "green_area_m2", "green_share"]
    assert {tuple(r)[1:] for r in shares.collect()} == {(100.0, 0.0, 0.0)} and shares.count() == 100


def test_rows_grow_with_the_outline(spark, monkeypatch):
    """A disc of 20,000 corners: twice the width makes twice the rows, and all pieces that are dealt out together hold little more than its corners."""
    monkeypatch.setattr(quadrants, "LARGE", 100)
    turns = np.linspace(0, 2 * np.pi, 20_000, endpoint=False)
    made = []
    for reach in (1000, 2000):
        ring = reach * np.column_stack([np.cos(turns), np.sin(turns)])
        df, cells = tables(spark, [("Polygon", [[np.concatenate([ring, ring[:1]])]])], (-2100, -2100, 2100, 2100), 10)
        cut = quadrants.cut_to_quadrants(df, cells, 10)
        made.append(cut.count())
        total = cut.agg(F.sum(F.expr("area * shiftleft(1L, 2 * level)"))).first()[0]
        assert total == pytest.approx(np.pi * reach**2, rel=1e-6)
    assert made[1] < 2.3 * made[0] < 0.15 * np.pi * 200**2
    rings = quadrants._rings(("Polygon", [[np.concatenate([ring, ring[:1]])]]))
    grid = (-210, -210, 209, 209)
    begun = quadrants._started(rings, 10, grid)
    dealt = [r[3] for r in quadrants._finished(begun, 10, grid, begun[0][1] - 2) if isinstance(r[3], bytes)]
    assert len(dealt) > 8 and sum(map(len, dealt)) < 1.1 * 16 * 20_000


def test_one_plan_without_range_joins(spark, capsys):
    df, cells = tables(spark, [("Polygon", [[box(0, 0, 90, 90)]])], (0, 0, 100, 100), 10)
    ingest.green_coverage(cells, df.select(F.col("wkb").alias("geometry")), 10, 32642, 32642).explain()
    plan = capsys.readouterr().out
    assert plan.count("BroadcastNestedLoopJoin") == 1  # the one row of the grid's ends
    assert not re.search(r"Exchange hashpartitioning\(cell_id", plan)


def test_equal_shapes_are_cut_once(spark, monkeypatch):
    shapes = [("Polygon", [[box(3, 3, 57, 41)]])] * 9 + [("Polygon", [[box(20, 20, 90, 90), box(30, 30, 40, 40)]])]
    df, cells = tables(spark, shapes, (0, 0, 100, 100), 10)
    once, _ = tables(spark, shapes[8:], (0, 0, 100, 100), 10)
    weighed = once.distinct().withColumn("copies", F.when(F.length("wkb") < 120, 9).otherwise(1))
    assert by_cell(weighed, cells, 10) == {k: pytest.approx(v) for k, v in by_cell(df, cells, 10).items()}
    cut, read = [], ingest.area_by_cell
    monkeypatch.setattr(ingest, "area_by_cell", lambda flat, *more: cut.append(flat.count()) or read(flat, *more))
    shares = ingest.green_coverage(cells, df.select(F.col("wkb").alias("geometry")), 10, 32642, 32642)
    assert cut == [2] and shares.agg(F.sum("green_area_m2")).first()[0] == pytest.approx(9 * 54 * 38 + 70 * 70 - 100)


def test_blocks_of_many_shapes_at_once(spark):
    """Pieces of one block are added up, holes and shapes that cross the block's side included."""
    shapes = [("Polygon", [[box(x, x, x + 30, x + 17), box(x + 4, x + 4, x + 9, x + 9)]]) for x in range(-20, 60, 7)]
    df, cells = tables(spark, shapes, (-30, -30, 120, 120), 10)
    want = {}
    for ix, iy in {(r.ix, r.iy) for r in cells.collect()}:
        want[ix, iy] = sum(g.area_within(s, (ix * 10, iy * 10, ix * 10 + 10, iy * 10 + 10)) for s in shapes)
    got = by_cell(df, cells, 10)
    assert {k: pytest.approx(v, abs=1e-7) for k, v in want.items()} == {k: got.get(k, 0.0) for k in want}
    found = list(quadrants._blocks([(quadrants._rings(s), 0, 0, (-3, -3, 12, 12), 1) for s in shapes[3:6]], 5, 10))
    assert sum(len(f[0]) for f in found) == len({(lv, x, y) for f in found for lv, x, y in zip(*f[:3], strict=True)})
