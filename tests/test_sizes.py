"""Queries on tables that differ from the small ones in what larger tables bring: rare values, more copies, places further out."""

from __future__ import annotations

import duckdb
import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from terraloom.functions import geometry as g
from terraloom.functions import spans
from terraloom.operators import ingest

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


def equals_sql(spark, folder, name: str, **tables: pa.Table) -> int:
    """Whether a query equals its SQL on tables made here; how many rows."""
    db = duckdb.connect()
    for table, rows in tables.items():
        pq.write_table(rows, folder / f"{table}.parquet")
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    df = QUERIES[name](spark, str(folder))
    columns = ", ".join(f'"{c}"' for c in sorted(df.columns))
    want = db.execute(f"SELECT {columns} FROM ({ORACLES[name]})").fetchall()
    got = [tuple(r[c] for c in sorted(df.columns)) for r in df.collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    return len(got)


def vectors(times: int, n: int = 240) -> pa.Table:
    """Vectors of floats whose product with ``times`` is whole in single precision and just below in double."""
    whole = np.arange(1, 999, dtype=np.float64)
    near = np.nextafter((whole / times).astype(np.float32), np.float32(0))
    values = np.concatenate([near, (whole / times).astype(np.float32)])
    close = values[np.floor(values * np.float32(times)) != np.floor(values.astype(np.float64) * times)]
    assert len(close)
    rows = np.random.default_rng(4).choice(close, (n, 64))
    return pa.table({"vec_id": pa.array(range(n), pa.int64()), "embedding": pa.array(rows.tolist(), pa.list_(pa.float32())), "label": pa.array([0] * n, pa.int32())})


@pytest.mark.parametrize("name", ["mosaic_crop", "mosaic_feather", "seam_meeting_values"])
def test_products_of_mosaics_are_single_precision(spark, tmp_path, name):
    assert equals_sql(spark, tmp_path, name, embeddings=vectors(1000))


@pytest.mark.parametrize("name", ["candidate_totals", "seam_bands"])
def test_products_of_tiles_are_single_precision(spark, tmp_path, name):
    assert equals_sql(spark, tmp_path, name, embeddings=vectors(255))


def test_a_place_whose_reference_is_missing_has_no_structure(spark, tmp_path):
    # The last place has variants 0 and 1 only, and its reference would be variant 2.
    assert equals_sql(spark, tmp_path, "candidate_totals", embeddings=vectors(1000, 166)) == 166


def customers(*keys: int) -> pa.Table:
    return pa.table({"c_custkey": pa.array(keys, pa.int64()), "c_name": [f"c{k}" for k in keys], "c_nationkey": pa.array([k % 25 for k in keys], pa.int32()), "c_acctbal": [float(k % 99) for k in keys], "c_mktsegment": [f"m{k % 5}" for k in keys]})


def test_shapes_have_pixels_wherever_they_lie(spark, tmp_path):
    # Keys over 300,000 lie above the grid's corner, those over 600,000 far above.
    assert equals_sql(spark, tmp_path, "shape_pixels", customer=customers(*range(10, 60), *range(299_950, 300_350), *range(899_990, 900_060))) > 400


def test_lines_of_one_piece_are_dealt_to_all_tasks(spark):
    lines = spark.createDataFrame([('{"type":"Feature","properties":{"building":"yes"},"geometry":{"type":"Polygon","coordinates":[[[0,0],[1,0],[1,1],[0,0]]]}}',)] * 40, "line string").coalesce(1)
    rows = ingest.ingest(lines, "buildings")[0]
    assert rows.groupBy(F.spark_partition_id()).count().count() == 4 and rows.count() == 40


def test_many_areas_within_boxes_are_those_of_single_ones():
    rng = np.random.default_rng(5)

    def star(cx: float, cy: float, reach: float) -> np.ndarray:
        turns, far = np.sort(rng.uniform(0, 2 * np.pi, 9)), rng.uniform(0.2, 1, 9) * reach
        ring = np.column_stack([cx + far * np.cos(turns), cy + far * np.sin(turns)])
        return np.concatenate([ring, ring[:1]])

    square = np.array([(0, 0), (7, 0), (7, 7), (0, 7), (0, 0)], float)
    shapes = [("Polygon", [[star(20, 20, 18), star(20, 20, 4)]]), ("MultiPolygon", [[star(5, 5, 9)], [star(30, 30, 9)]]), ("Polygon", [[square]]), ("Point", [np.zeros((1, 2))]), ("Polygon", [])]
    shape, corner = rng.integers(0, len(shapes), 500), np.floor(rng.uniform(-5, 35, (500, 2)))
    boxes = np.column_stack([corner, corner + rng.choice([1, 7, 3.3], (500, 1))])
    want = [g.area_within(shapes[i], tuple(box)) for i, box in zip(shape, boxes, strict=True)]
    assert np.allclose(g.areas_within(shapes, shape, boxes), want, atol=1e-9)


def test_what_is_plainly_convex_is_valid():
    rng = np.random.default_rng(6)
    turns = np.arange(6) * 4 * np.pi / 5
    rings = [np.column_stack([np.cos(turns), np.sin(turns)]), np.array([(0, 0), (1, 0), (1, np.nan), (0, 0)])]
    for _ in range(2000):
        ring = rng.integers(0, 6, (rng.integers(3, 7), 2)).astype(float)
        rings.append(np.concatenate([ring, ring[:1]]))
    plain = g.plainly_convex(rings)
    assert 100 < plain.sum() and all(g.is_valid(("Polygon", [[r]])) for r, yes in zip(rings, plain, strict=True) if yes)
    assert not plain[:2].any()


def orders(*keys: int) -> pa.Table:
    return pa.table({"o_orderkey": pa.array(keys, pa.int64()), "o_custkey": pa.array([k // 9 for k in keys], pa.int64())})


@pytest.mark.parametrize("name", ["spatial_overlap_join", "shape_overlaps"])
def test_copies_are_paired_once_and_all_counted(spark, tmp_path, name):
    tables = {"customer": customers(*range(0, 9000, 3), *range(9000, 18000, 3)), "orders": orders(*range(4000), *range(81000, 83000))}
    assert equals_sql(spark, tmp_path, name, **tables) > 1000
    read = ingest.spatial_pairs
    rows = []
    try:
        ingest.spatial_pairs = lambda left, right, size: rows.append(left.count()) or read(left, right, size)
        QUERIES[name](spark, str(tmp_path))
    finally:
        ingest.spatial_pairs = read
    assert rows == [3000]  # 6,000 customers, each box twice


def test_single_rings_meet_in_arrays_as_one_by_one():
    rng = np.random.default_rng(7)
    ring = lambda n: (lambda r: np.concatenate([r, r[:1]]))(rng.integers(0, 9, (n, 2)).astype(float) + rng.integers(0, 6, 2))
    one, other = [[("Polygon", [[ring(int(rng.integers(3, 6)))]]) for _ in range(800)] for _ in range(2)]
    one[0] = ("MultiPolygon", [[ring(3)], [ring(4)]])
    wkb = lambda shapes: pd.Series([g.to_wkb(s) for s in shapes], dtype=object)
    got = g.st_meet.func(wkb(one), wkb(other))
    assert got.tolist() == [g.meet(a, b) for a, b in zip(one, other, strict=True)] and 0 < got.sum() < 800
    assert g.st_envelope.func(wkb(one)).to_numpy().tolist() == [list(g.envelope(s)) for s in one]
    assert np.allclose(g.st_area.func(wkb(one)), [g.area(s) for s in one])
    nulls = g.st_meet.func(pd.Series([None, b"?", g.to_wkb(one[1])], dtype=object), wkb([one[1]] * 3))
    assert nulls.isna().tolist() == [True, True, False] and nulls[2]


def test_centroids_and_spans_of_many_shapes_are_those_of_each():
    rng = np.random.default_rng(8)
    ring = lambda: (lambda r: np.concatenate([r, r[:1]]))(rng.uniform(0, 50, (5, 2)) + rng.uniform(0, 60, 2))
    shapes = [("MultiPolygon", [[ring(), ring()], [ring()]]) for _ in range(50)]
    assert np.allclose(g.centroids(shapes), [g.centroid(s) for s in shapes])
    edges = [spans.edges_of(s[1][0]) for s in shapes]
    many = spans.touched_by_many(np.concatenate(edges), np.repeat(np.arange(50), [len(e) for e in edges]), -3.0, -2.0, 5.7, 8.0, 20, 19)
    for i, s in enumerate(shapes):
        assert many[many[:, 0] == i, 1:].tolist() == spans.touched_spans(s[1][0], -3.0, -2.0, 5.7, 8.0, 20, 19).tolist()


def test_customers_lines_are_dealt_before_they_are_written(spark):
    from terraloom.plans import registry

    lines = registry._feature_lines(spark, "/root/testdata/sf0.001")
    assert lines.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions")) > 1


def test_large_footprints_are_read_once(spark, capsys):
    from terraloom.plans import registry

    found = registry.QUERIES["large_footprints"](spark, "/root/testdata/sf0.001")
    found.explain()
    plan = capsys.readouterr().out
    assert plan.count("FileScan") == 1 and found.columns == ["kept", "dropped_small"]
    # Shapes are made once, above the dealing (plans are printed from the top).
    assert plan.count("shapes(") == 1 and "ArrowEvalPython" not in plan[plan.index("RoundRobin") :]


def test_holes_in_convex_shapes_are_known_in_arrays():
    ring = lambda x0, y0, x1, y1: g.np.array([(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)], float)
    inners = [ring(2, 2, 3, 3), ring(2, 2, 3, 3)[::-1], ring(0, 2, 3, 3), ring(8, 8, 12, 9), ring(20, 20, 21, 21), ring(-1, -1, 11, 11)]
    assert g.plainly_within([ring(0, 0, 10, 10)] * 6, inners).tolist() == [True, True, False, False, False, False]
    assert all(g.is_valid(("Polygon", [[ring(0, 0, 10, 10), inner]])) for inner in inners[:2])
