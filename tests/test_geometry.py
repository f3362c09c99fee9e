"""The geometry kernel: round trips, areas, repair and simplification."""

from __future__ import annotations

import struct

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from terraloom.functions import geometry as g
from terraloom.functions.projection import mercator_forward, mercator_inverse, utm_forward, utm_inverse, utm_zone


def ring(*points: tuple[float, float]) -> np.ndarray:
    return np.array([*points, points[0]], float)


SQUARE = ("Polygon", [[ring((0, 0), (10, 0), (10, 10), (0, 10)), ring((2, 2), (4, 2), (4, 4), (2, 4))]])
BOWTIE = ("Polygon", [[ring((69.202, 41.3), (69.203, 41.301), (69.203, 41.3), (69.202, 41.301))]])


@pytest.mark.parametrize("shape", [SQUARE, ("Point", [np.array([[1.0, 2.0]])]), ("LineString", [np.array([[0.0, 1], [2, 3]])]), ("MultiPolygon", SQUARE[1] * 2), ("MultiLineString", [np.array([[0.0, 1], [2, 3]])] * 2), ("MultiPoint", [np.array([[1.0, 2.0]])] * 2)])
def test_round_trips(shape):
    for back in (g.from_wkb(g.to_wkb(shape)), g.from_geojson(g.to_geojson(shape))):
        assert back[0] == shape[0] and all((a == b).all() for a, b in zip(g.arrays(back), g.arrays(shape), strict=True))


def test_byte_order_and_third_coordinate():
    big = b"\x00" + struct.pack(">II6d", 1002, 2, 1, 2, 9, 3, 4, 9)
    assert g.from_wkb(big)[1][0].tolist() == [[1, 2], [3, 4]]
    extended = struct.pack("<BI3d", 1, 0x80000001, 5, 6, 7)
    assert g.from_wkb(extended)[1][0].tolist() == [[5, 6]]
    with pytest.raises(ValueError):
        g.from_wkb(struct.pack("<BI", 1, 7))


def test_measures():
    assert g.area(SQUARE) == 96 and g.outer_points(SQUARE) == 5 and g.envelope(SQUARE) == (0, 0, 10, 10)
    assert g.area_within(SQUARE, (3, 3, 12, 12)) == 48
    assert sum(g.area_within(SQUARE, (x, y, x + 3, y + 3)) for x in range(0, 12, 3) for y in range(0, 12, 3)) == pytest.approx(96)
    assert g.meets_box(SQUARE, (10, 10, 11, 11)) and not g.meets_box(SQUARE, (2.5, 2.5, 3.5, 3.5)) and not g.meets_box(SQUARE, (11, 0, 12, 1))
    assert g.centroid(("Polygon", [SQUARE[1][0][:1]])) == pytest.approx((5, 5))


def test_bowtie_becomes_two_triangles():
    assert not g.is_valid(BOWTIE)
    fixed = g.repaired(BOWTIE)
    assert fixed[0] == "MultiPolygon" and len(fixed[1]) == 2 and g.is_valid(fixed) and g.area(fixed) == pytest.approx(5e-7)


def test_repair_keeps_holes_and_drops_nothing():
    assert g.area(g.repaired(SQUARE)) == 96 and len(g.repaired(SQUARE)[1][0]) == 2
    assert g.repaired(("Polygon", [[ring((0, 0), (1, 1), (2, 2))]])) is None


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 1000), st.integers(0, 1000)), min_size=4, max_size=9, unique=True))
def test_repair_is_the_even_odd_area(points):
    shape = ("Polygon", [[ring(*points)]])
    fixed = g.repaired(shape)
    rng = np.random.default_rng(0)
    x, y = rng.random((2, 300)) * 1000 + 0.123
    inside = g.contains(shape, x, y)
    assert (g.contains(fixed, x, y) == inside).mean() > 0.99 if fixed else inside.mean() < 0.01


def test_simplification():
    t = np.linspace(0, 2 * np.pi, 241)
    circle = np.stack([80 * np.cos(t), 80 * np.sin(t)], axis=1)
    circle[-1] = circle[0]
    shape = ("Polygon", [[circle]])
    light = g.simplified(shape, g.lod_tolerance(g.area(shape)))
    assert 4 <= g.outer_points(light) < 60 and g.is_valid(light) and g.area(light) > 0.95 * g.area(shape)
    assert g.lod_tolerance(1) == 0.5 and g.lod_tolerance(1e9) == 8.0 and g.lod_tolerance(10_000) == 2.0


def test_projections():
    lon, lat = np.array([69.103, 69.2, 69.397, 66.001]), np.array([41.168, 41.3, 41.434, -0.5])
    for epsg in (32642, 32742):
        back = utm_inverse(*utm_forward(lon, lat, epsg), epsg)
        assert np.allclose(back, (lon, lat), atol=1e-11)
    east, north = utm_forward(np.array([69.0]), np.array([0.0]), 32642)
    assert east[0] == pytest.approx(500000) and north[0] == pytest.approx(0)
    assert np.allclose(mercator_inverse(*mercator_forward(lon, lat)), (lon, lat))
    assert mercator_forward(np.array([180.0]), np.array([90.0]))[1][0] == pytest.approx(20037508.342789, abs=1e-3)
    assert utm_zone(69.2, 41.3) == 32642 and utm_zone(-180.0, -1.0) == 32701
    half = ("Polygon", [[ring((500000, 4570000), (500250, 4570000), (500250, 4570500), (500000, 4570500))]])
    there = g.projected(half, 32642, 4326)
    assert g.area(g.projected(there, 4326, 32642)) == pytest.approx(125000, rel=1e-9)
    with pytest.raises(ValueError):
        utm_forward(lon, lat, 4326)


def test_repair_of_a_hole_that_touches_its_outline():
    fixed = g.repaired(("Polygon", [[ring((5, 7), (1, 7), (7, 0), (9, 10), (0, 9), (3, 0))]]))
    x, y = np.random.default_rng(1).random((2, 500)) * 10
    assert (g.contains(fixed, x, y) == g.contains(("Polygon", [[ring((5, 7), (1, 7), (7, 0), (9, 10), (0, 9), (3, 0))]]), x, y)).all()
