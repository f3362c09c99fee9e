"""A whole release from two small layers."""

from __future__ import annotations

import json

import pytest

from terraloom.operators import tiles
from terraloom.plans import release

BOX = (69.2, 41.3, 69.22, 41.31)


def square(number: int, x: float, y: float, side: float, **properties) -> str:
    ring = [[x, y], [x + side, y], [x + side, y + side], [x, y + side], [x, y]]
    return json.dumps({"type": "Feature", "properties": {"@type": "way", "@id": number, **properties}, "geometry": {"type": "Polygon", "coordinates": [ring]}})


def test_release(spark, tmp_path):
    (tmp_path / "b.seq").write_text("\n".join([square(1, 69.205, 41.303, 0.001, building="yes", height="12m"), square(2, 69.207, 41.304, 0.001, building="yes")]))
    (tmp_path / "g.seq").write_text(square(3, 69.203, 41.301, 0.004, leisure="park"))
    sources = {"buildings": str(tmp_path / "b.seq"), "green": str(tmp_path / "g.seq")}
    document = release.new_document("run-1", "2026-02-07T00:00:00.000Z", BOX)
    planned, reports = release.build(spark, document, sources, str(tmp_path / "out"), dry_run=True)
    assert not (tmp_path / "out").exists() and len(planned["artifacts"]) == 4 and reports["heights"]["n_height"] == 1
    done, reports = release.build(spark, document, sources, str(tmp_path / "out"))
    assert reports["metrics"]["cells_intersected"] >= 1 and [a["path"] for a in done["artifacts"]] == ["metrics/grid", "vector/buildings", "vector/buildings_simplified", "vector/green"]
    assert release.read_document(spark, str(tmp_path / "out"), "run-1") == done
    again, _ = release.build(spark, done, sources, str(tmp_path / "out"))
    assert again == done  # the same content has the same digests
    parts = tiles.layer_features({"green": spark.read.parquet(str(tmp_path / "out/run-1/vector/green"))}, spark.read.parquet(str(tmp_path / "out/run-1/vector/buildings")))
    assert parts["base"].columns == ["layer", "class", "geometry"] and parts["buildings"].count() == 2
    with pytest.raises(ValueError):
        release.new_document("-bad", "x", BOX)


def test_a_changed_layer_reruns_what_is_made_of_it(spark, tmp_path, monkeypatch):
    (tmp_path / "b.seq").write_text(square(1, 69.205, 41.303, 0.001, building="yes", height="12m"))
    (tmp_path / "g.seq").write_text(square(3, 69.203, 41.301, 0.004, leisure="park"))
    sources, root = {"buildings": str(tmp_path / "b.seq"), "green": str(tmp_path / "g.seq")}, str(tmp_path / "out")
    document = release.new_document("run-2", "2026-02-07T00:00:00.000Z", BOX)
    made, whole = [], release._made
    monkeypatch.setattr(release, "_made", lambda spark, at, stage, key: made.append(stage.path) or whole(spark, at, stage, key))
    commits, commit = [], release._commit
    monkeypatch.setattr(release, "_commit", lambda *a: commits.append(a) or commit(*a))
    assert release.init(spark, document, root)["artifacts"] == [] and (tmp_path / "out/run-2/tiles").is_dir()
    with pytest.raises(FileExistsError):
        release.init(spark, document, root)
    first, reports = release.build(spark, document, sources, root)
    assert made == ["vector/buildings", "vector/green", "vector/buildings_simplified", "metrics/grid"] and len(commits) == 2
    made.clear()
    assert release.build(spark, document, sources, root) == (first, reports) and made == [] and len(commits) == 2
    (tmp_path / "g.seq").write_text(square(3, 69.203, 41.301, 0.005, leisure="park"))
    second, _ = release.build(spark, document, sources, root)
    assert made == ["vector/green", "metrics/grid"] and len(commits) == 3
    same = lambda d: [a for a in d["artifacts"] if "buildings" in a["path"]]
    assert same(first) == same(second) and first != second
    made.clear()
    # Other bytes, the same rows: the layer is read again, and nothing after it.
    (tmp_path / "g.seq").write_text(square(3, 69.203, 41.301, 0.005, leisure="park") + "\n\n")
    assert release.build(spark, document, sources, root)[0] == second and made == ["vector/green"] and len(commits) == 3
    made.clear()
    # A table without its note was not finished.
    (tmp_path / "out/run-2/vector/buildings/_stage.json").unlink()
    assert release.build(spark, document, sources, root)[0] == second and made == ["vector/buildings"]
    other = release.new_document("run-2", "2026-02-07T00:00:00.000Z", (69.2, 41.3, 69.23, 41.31))
    with pytest.raises(ValueError, match="other aoi"):
        release.build(spark, other, sources, root)
    made.clear()
    assert release.build(spark, other, sources, root, force=True)[0]["aoi"] == other["aoi"] and len(made) == 4
    assert not [p.name for p in (tmp_path / "out/run-2").iterdir() if "draft" in p.name]
    with pytest.raises(FileNotFoundError):
        release.read_document(spark, root, "run-9")


def test_digests_of_long_files(spark, tmp_path, monkeypatch):
    import hashlib

    from terraloom.sources import files, manifest

    names = {f"f{i} å.bin": bytes([i]) * (files.PIECE * i + i) for i in range(3)}
    for name, content in names.items():
        (tmp_path / name).write_bytes(content)
    rows = manifest.hashed_files(spark, str(tmp_path)).collect()
    assert sorted((r.sha256, r.size) for r in rows) == sorted((hashlib.sha256(c).hexdigest(), len(c)) for c in names.values())
    plan = manifest.hashed_files(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "content#" not in plan


def test_known_grid(spark):
    assert release.grid_over(spark, (69.103, 41.168, 69.397, 41.434), 500).count() == 3010


def test_pyramid(spark):
    rows = tiles.pyramid_layout(spark, (0, 0, 100, 60), 64, 0.25, 10).collect()
    assert len(rows) == 12 and {r.x for r in rows} == {0, 1, 2, 3} and {r.y for r in rows} == {0, 1, 2}
    first = next(r for r in rows if (r.x, r.y) == (0, 0))
    assert first.core_u == -16 and first.core_v == -26 and first.u == pytest.approx(-16 - 64 / 6)
