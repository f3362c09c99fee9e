"""A release end to end: layers, heights, light outlines, grid, coverage, and the manifest that names what was written."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terraloom.functions import geometry as g
from terraloom.functions.projection import utm_forward
from terraloom.operators import coverage, heights, ingest
from terraloom.sources import files, geojsonseq, geoparquet, manifest

#: The manifest's name and a release's folders.
MANIFEST, FOLDERS = "manifest.json", ("vector", "tiles", "metrics", "aoi")
#: Lies beside a table's files; readers pass over names that begin so. Tables of another version of the stages are made anew.
NOTE, VERSION = "_stage.json", 1


def new_document(run_id: str, created_at: str, bbox: tuple[float, float, float, float], notes: str = "", aoi_id: str = "area") -> dict:
    document = {"run_id": run_id, "created_at": created_at, "aoi": {"id": aoi_id, "bbox": list(bbox), "crs": "EPSG:4326"}, "sources": {"osm": {}}, "notes": notes, "artifacts": []}
    if broken := manifest.problems(document):
        raise ValueError("; ".join(broken))
    return document


def area_of(bbox: tuple[float, float, float, float], epsg: int) -> bytes:
    """The box's outline in grid coordinates, as WKB."""
    w, s, e, n = bbox
    x, y = utm_forward(np.array([w, e, e, w, w]), np.array([s, s, n, n, s]), epsg)
    return g.to_wkb(("Polygon", [[np.stack([x, y], axis=1)]]))


def grid_over(spark: SparkSession, bbox: tuple[float, float, float, float], size: float, epsg: int = 32642) -> DataFrame:
    area = area_of(bbox, epsg)
    cells = ingest.cells_over(coverage.grid_cells(spark, g.envelope(g.from_wkb(area)), size), area)
    if cells.isEmpty():
        raise ValueError("no cell of the grid meets the area")
    return cells


@dataclass(frozen=True)
class Stage:
    """One table of a release: what it is made of (files, and tables by path), what else decides its rows, and how it is made, with the reports on it."""

    path: str
    files: tuple[str, ...]
    tables: tuple[str, ...]
    settings: dict
    make: Callable[[SparkSession, Callable[[str], DataFrame]], tuple[DataFrame, dict[str, DataFrame]]]


def stages(sources: dict[str, str], bbox: tuple[float, float, float, float], size: float, epsg: int = 32642) -> list[Stage]:
    """The stages in an order in which each follows what it is made of."""

    def layer(name: str, source: str) -> Stage:
        def make(spark: SparkSession, read: Callable[[str], DataFrame]) -> tuple[DataFrame, dict[str, DataFrame]]:
            rows, report = ingest.ingest(geojsonseq.read_lines(spark, source), name)
            return (heights.with_heights(rows) if name == "buildings" else rows), {f"ingest/{name}": report}

        return Stage(f"vector/{name}", (source,), (), {"layer": name}, make)

    def light(spark: SparkSession, read: Callable[[str], DataFrame]) -> tuple[DataFrame, dict[str, DataFrame]]:
        rows, report = ingest.simplified(read("vector/buildings"))
        return rows, {"heights": heights.height_report(read("vector/buildings")), "lod": report}

    def grid(spark: SparkSession, read: Callable[[str], DataFrame]) -> tuple[DataFrame, dict[str, DataFrame]]:
        return ingest.green_coverage(grid_over(spark, bbox, size, epsg), read("vector/green"), size, 4326, epsg), {}

    found = [layer(name, source) for name, source in sources.items()]
    if "buildings" in sources:
        found.append(Stage("vector/buildings_simplified", (), ("vector/buildings",), {}, light))
    if "green" in sources:
        found.append(Stage("metrics/grid", (), ("vector/green",), {"bbox": list(bbox), "size": size, "epsg": epsg}, grid))
    return found


def tables(spark: SparkSession, sources: dict[str, str], bbox: tuple[float, float, float, float], size: float, epsg: int = 32642) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """Lazy tables by the path they are written under, and lazy one-row reports by step."""
    data, reports = {}, {}
    for stage in stages(sources, bbox, size, epsg):
        data[stage.path], found = stage.make(spark, data.__getitem__)
        reports |= found | ({"metrics": coverage.coverage_report(data[stage.path])} if stage.path == "metrics/grid" else {})
    return data, reports


def init(spark: SparkSession, document: dict, root: str, force: bool = False) -> dict:
    """An empty release: its folders and its manifest. One that is there is not overwritten without ``force``, which empties its list of artifacts."""
    at = f"{root}/{document['run_id']}"
    if not force and files.read_text(spark, f"{at}/{MANIFEST}") is not None:
        raise FileExistsError(f"{at} holds a release")
    started = document | {"artifacts": []}
    if broken := manifest.problems(started):
        raise ValueError("; ".join(broken))
    for folder in FOLDERS:
        system, path = files.qualified(spark, f"{at}/{folder}")
        system.mkdirs(path)
    _commit(spark, at, started)
    return started


def _commit(spark: SparkSession, at: str, document: dict) -> None:
    files.replace_text(spark, f"{at}/{MANIFEST}", json.dumps(document, indent=2, sort_keys=True) + "\n")


def _made(spark: SparkSession, at: str, stage: Stage, key: str) -> dict:
    """A stage's table written whole, then read for its digest, count and report; the note beside its files says what it was made of."""
    df, reports = stage.make(spark, lambda path: geoparquet.read(spark, f"{at}/{path}"))
    place = f"{at}/{stage.path}"
    if "geometry" in df.columns:
        geoparquet.write(df, place, 4326)
    else:
        df.write.mode("overwrite").parquet(place)
    back = spark.read.parquet(place)
    found = {name: report.first().asDict(True) for name, report in reports.items()}
    if stage.path == "metrics/grid":
        found["metrics"] = coverage.coverage_report(back).first().asDict(True)
    note = {"key": key, "sha256": manifest.content_digest(back), "size": back.count(), "reports": found}
    files.replace_text(spark, f"{place}/{NOTE}", json.dumps(note, sort_keys=True))
    return json.loads(json.dumps(note))


def build(spark: SparkSession, document: dict, sources: dict[str, str], root: str, size: float = 500, dry_run: bool = False, force: bool = False) -> tuple[dict, dict]:
    """The document with its artifacts, and the reports. A dry run reads and reports but writes nothing.

    A stage is keyed by the digests of its files and tables and by its settings, and skipped where its table was made under the same key, so a changed
    layer reruns only what is made of it; a table that comes out the same reruns nothing further. The manifest is written last, and only if it changed. A release
    whose manifest says something else about its area or sources is refused without ``force``, which also reruns all stages.
    """
    at, bbox = f"{root}/{document['run_id']}", tuple(document["aoi"]["bbox"])
    if dry_run:
        data, reports = tables(spark, sources, bbox, size)
        return document | {"artifacts": [{"path": p} for p in sorted(data)]}, {name: df.first().asDict() for name, df in reports.items()}
    text = files.read_text(spark, f"{at}/{MANIFEST}")
    known = None if text is None else json.loads(text)
    if known is None or force:
        known = init(spark, document, root, force)
    elif differing := [k for k in ("aoi", "sources") if known.get(k) != document.get(k)]:
        raise ValueError(f"{at} holds a release with other {' and '.join(differing)}")
    hashed, notes = {}, {}
    for stage in stages(sources, bbox, size):
        for path in stage.files:
            if path not in hashed:
                hashed[path] = sorted(r["sha256"] for r in manifest.hashed_files(spark, path).collect())
        parts = {"path": stage.path, "version": VERSION, "files": [hashed[p] for p in stage.files], "tables": [notes[p]["sha256"] for p in stage.tables], "settings": stage.settings}
        key = sha256(json.dumps(parts, sort_keys=True).encode()).hexdigest()
        last = files.read_text(spark, f"{at}/{stage.path}/{NOTE}")
        note = json.loads(last) if last else {}
        notes[stage.path] = note if note.get("key") == key and not force else _made(spark, at, stage, key)
    entries = [(path, note["sha256"], note["size"]) for path, note in notes.items()]
    out = manifest.committed(spark, known | {k: v for k, v in document.items() if k != "artifacts"} | {"created_at": known["created_at"]}, spark.createDataFrame(entries, manifest.ARTIFACTS))
    if out != known:
        _commit(spark, at, out)
    return out, {name: report for note in notes.values() for name, report in note["reports"].items()}


def read_document(spark: SparkSession, root: str, run_id: str) -> dict:
    text = files.read_text(spark, f"{root}/{run_id}/{MANIFEST}")
    if text is None:
        raise FileNotFoundError(f"{root}/{run_id} holds no release")
    return json.loads(text)
