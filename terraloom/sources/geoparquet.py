"""Parquet with a WKB geometry column and the ``geo`` footer that other tools read and write."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema

from terraloom.sources import files

WORLD = 4326


def with_crs(df: DataFrame, epsg: int, geometry: str = "geometry", kinds: list[str] | None = None) -> DataFrame:
    return df.withMetadata(geometry, {"encoding": "WKB", "epsg": epsg, "geometry_type": kinds or []})


def crs_of(df: DataFrame, default: int, geometry: str = "geometry") -> int:
    """The EPSG code of a table's geometry; the default where it is missing or no number."""
    found = df.schema[geometry].metadata.get("epsg")
    return found if isinstance(found, int) else default


def footer(epsg: int, geometry: str = "geometry", kinds: list[str] | None = None) -> bytes:
    column = {"encoding": "WKB", "geometry_types": kinds or [], "crs": {"id": {"authority": "EPSG", "code": epsg}}}
    return json.dumps({"version": "1.0.0", "primary_column": geometry, "columns": {geometry: column}}).encode()


def epsg_of(geo: dict, geometry: str) -> int | None:
    """The code in a footer: that of the world where a column has no system, none where it has one without a code."""
    column = geo.get("columns", {}).get(geometry)
    if column is None:
        return None
    if "crs" not in column:
        return WORLD
    own = (column["crs"] or {}).get("id", {})
    if own.get("authority") == "OGC" and str(own.get("code", "")).startswith("CRS84"):
        return WORLD
    return int(own["code"]) if own.get("authority", "EPSG") == "EPSG" and str(own.get("code", "")).isdigit() else None


def geo_of(path: str) -> dict:
    """The ``geo`` footer of a file, or of the first file of a folder; empty where there is none. Only a footer is read."""
    system, at = fs.FileSystem.from_uri(files.uri_of(files.qualified(SparkSession.active(), path)[1].toString()))
    info = system.get_file_info(at)
    parts = [at] if info.type == fs.FileType.File else sorted(f.path for f in system.get_file_info(fs.FileSelector(at, recursive=True)) if f.type == fs.FileType.File and f.base_name.endswith(".parquet"))
    found = (pq.read_schema(parts[0], filesystem=system).metadata or {}) if parts else {}
    return json.loads(found.get(b"geo", b"{}"))


def read(spark: SparkSession, path: str, geometry: str = "geometry") -> DataFrame:
    """A table whose geometry column bears the system that the footer names. A footer whose system has no EPSG code is refused."""
    df, geo = spark.read.parquet(path), geo_of(path)
    if geometry not in df.columns or not geo:
        return df
    epsg = epsg_of(geo, geometry)
    if epsg is None:
        raise ValueError(f"the footer of {path} names no EPSG code for {geometry}")
    column = geo["columns"][geometry]
    kinds = column.get("geometry_types", column.get("geometry_type", []))
    return with_crs(df, epsg, geometry, [kinds] if isinstance(kinds, str) else list(kinds))


def write(df: DataFrame, path: str, epsg: int, geometry: str = "geometry", kinds: list[str] | None = None) -> int:
    """Replace a folder by one file for each partition, each with the footer; the number of rows.

    Tasks write into a folder beside it, through the file system that Spark uses for the path; it takes the old one's place when all
    are done, so a job that fails leaves the old layer as it was. A file is written under a name of its own and then takes its
    partition's name, so a task that runs again replaces its own file.
    """
    hadoop, whole = files.qualified(df.sparkSession, path)
    beside = lambda mark: whole.suffix(f".{mark}-{uuid.uuid4().hex}")
    draft_folder = beside("draft")
    uri = files.uri_of(draft_folder.toString())
    schema = to_arrow_schema(df.schema).with_metadata({b"geo": footer(epsg, geometry, kinds)})

    def save(batches: Iterator[pa.RecordBatch], name: str) -> int:
        system, at = fs.FileSystem.from_uri(uri)
        draft, n = f"{at}/.{name}-{uuid.uuid4().hex}", 0
        with pq.ParquetWriter(draft, schema, filesystem=system) as writer:
            for batch in batches:
                writer.write_batch(pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(batch.columns, schema, strict=True)], schema=schema))
                n += batch.num_rows
        system.move(draft, f"{at}/{name}")
        return n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = save(batches, f"part-{TaskContext.get().partitionId():05}.parquet")
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["n"])

    hadoop.mkdirs(draft_folder)
    try:
        rows = sum(r["n"] for r in df.mapInArrow(run, "n bigint").collect()) or save(iter(()), "part-00000.parquet")
    except BaseException:
        hadoop.delete(draft_folder, True)
        raise
    old = beside("old")
    replaced = hadoop.exists(whole)
    if replaced and not hadoop.rename(whole, old):
        raise OSError(f"{path} can't be moved aside")
    if not hadoop.rename(draft_folder, whole):
        raise OSError(f"{uri} can't take the place of {path}")
    if replaced:
        hadoop.delete(old, True)
    return rows
