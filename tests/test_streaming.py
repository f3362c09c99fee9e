"""Layers that grow file by file."""

from __future__ import annotations

import json

from terraloom.streaming.layers import grow_layer


def line(number: int) -> str:
    square = [[0, 0], [1, 0], [1, 1], [0, 1], [0, 0]]
    return "\x1e" + json.dumps({"type": "Feature", "properties": {"@type": "way", "@id": number, "leisure": "park"}, "geometry": {"type": "Polygon", "coordinates": [square]}}) + "\n"


def test_files_are_taken_once(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    for step, numbers in enumerate(([1, 2], [3])):
        (source / f"{step}.geojsonseq").write_text("".join(map(line, numbers)))
        query = grow_layer(spark, str(source), "green", str(tmp_path / "out"), str(tmp_path / "state"))
        query.awaitTermination(120)
    rows = spark.read.parquet(str(tmp_path / "out"))
    assert sorted((r.id, r["class"]) for r in rows.collect()) == [("way/1", "park"), ("way/2", "park"), ("way/3", "park")]
