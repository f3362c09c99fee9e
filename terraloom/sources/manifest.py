"""The release manifest: artifacts by path, latest in force, and the rules of the document."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terraloom.sources import files

#: The fields of the document and of its parts, which of them must be there, and the forms of ids, digests and dates.
RUN_ID, SHA256, CRS = re.compile(r"[a-zA-Z0-9][a-zA-Z0-9_-]{0,127}"), re.compile(r"[a-fA-F0-9]{64}"), re.compile(r"EPSG:[0-9]+")
DATE_TIME = re.compile(r"[0-9]{4}-(0[1-9]|1[0-2])-(0[1-9]|[12][0-9]|3[01])[Tt]([01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9](\.[0-9]+)?([Zz]|[+-][0-9]{2}:[0-9]{2})")
FIELDS = ["run_id", "created_at", "aoi", "sources", "notes", "artifacts"]
AOI, OSM = ["id", "bbox", "crs"], ["region", "url", "date", "etag", "downloaded_at", "path", "sha256", "size", "dry_run"]
SOURCES = ["osm", "sentinel2", "google_photorealistic_3d_tiles"]
ARTIFACTS = "path string, sha256 string, size bigint"


def hashed_files(spark: SparkSession, *paths: str) -> DataFrame:
    """path, sha256 and size of files of any size: listed without their contents, each read piece by piece in a task. A path may be a folder or a pattern."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [files.sha256_of(p) for p in batch.column("path").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("path"), pa.array([d for d, _ in found], pa.string()), pa.array([n for _, n in found], pa.int64())], names=["path", "sha256", "size"])

    # Spark's reader passes over files without bytes; their names are added from a listing.
    empty = spark.createDataFrame([(p,) for p in files.empty_files(spark, *paths)], "path string")
    return spark.read.format("binaryFile").load(list(paths)).select("path").unionByName(empty).mapInArrow(run, ARTIFACTS)


def content_digest(df: DataFrame) -> str:
    """A digest of a table's rows that depends neither on their order nor on file layout."""
    row = F.xxhash64(*[F.col(c) for c in sorted(df.columns)])
    facts = df.agg(F.count("*").alias("n"), F.coalesce(F.sum(row.cast("decimal(38,0)")), F.lit(0)).cast("string").alias("s"), F.coalesce(F.bit_xor(row), F.lit(0)).alias("x"))
    return facts.select(F.sha2(F.concat_ws(":", F.lit(",".join(sorted(df.columns))), "n", "s", "x"), 256)).first()[0]


def upserted(existing: DataFrame, new: DataFrame) -> DataFrame:
    """New entries replace those of the same path; of several new ones the last (by ``at``, where there is one) counts."""
    ranked = existing.select("path", F.struct("sha256", "size").alias("e"), F.struct(F.lit(0).alias("rank"), F.lit(0).cast("bigint").alias("at")).alias("k"))
    at = F.col("at").cast("bigint") if "at" in new.columns else F.lit(0).cast("bigint")
    ranked = ranked.unionByName(new.select("path", F.struct("sha256", "size").alias("e"), F.struct(F.lit(1).alias("rank"), at.alias("at")).alias("k")))
    return ranked.groupBy("path").agg(F.max_by("e", F.struct("k", "e")).alias("e")).select("path", "e.*")


def _is_text(value: object) -> bool:
    return isinstance(value, str) and value != ""


def _is_count(value: object) -> bool:
    return isinstance(value, int) and not isinstance(value, bool) and value >= 0


def _is_form(form: re.Pattern) -> Callable[[object], bool]:
    return lambda value: isinstance(value, str) and form.fullmatch(value) is not None


def _is_box(value: object) -> bool:
    return isinstance(value, list) and len(value) == 4 and all(isinstance(v, (int, float)) and not isinstance(v, bool) for v in value)


def _object(at: str, value: object, required: list[str], allowed: list[str], forms: dict[str, Callable[[object], bool]], nullable: bool = False) -> list[str]:
    """Breaches of one object's rules: fields that are missing, not allowed or of a wrong form."""
    if not isinstance(value, dict):
        return [f"{at}: must be an object"]
    found = [f"{at}.{k}: is missing" for k in sorted(set(required) - set(value))] + [f"{at}.{k}: is not allowed" for k in sorted(set(value) - set(allowed))]
    return found + [f"{at}.{k}: has a wrong form" for k, fits in forms.items() if k in value and not (nullable and value[k] is None) and not fits(value[k])]


def problems(document: dict) -> list[str]:
    """All breaches of the document's rules, as ``$.path: message``."""
    found = _object("$", document, FIELDS, FIELDS, {"run_id": _is_form(RUN_ID), "created_at": _is_form(DATE_TIME), "notes": lambda v: isinstance(v, str), "artifacts": lambda v: isinstance(v, list)})
    if "aoi" in document:
        found += _object("$.aoi", document["aoi"], AOI, AOI, {"id": _is_text, "bbox": _is_box, "crs": _is_form(CRS)})
    if "sources" in document:
        found += _object("$.sources", document["sources"], ["osm"], SOURCES, dict.fromkeys(SOURCES[1:], lambda v: v is None or isinstance(v, dict)))
        osm = document["sources"].get("osm", {}) if isinstance(document["sources"], dict) else {}
        forms = dict.fromkeys(("region", "url", "etag", "path"), _is_text) | dict.fromkeys(("date", "downloaded_at"), _is_form(DATE_TIME))
        found += _object("$.sources.osm", osm, [], OSM, forms | {"sha256": _is_form(SHA256), "size": _is_count, "dry_run": lambda v: isinstance(v, bool)}, nullable=True)
    for i, entry in enumerate(document["artifacts"] if isinstance(document.get("artifacts"), list) else []):
        found += _object(f"$.artifacts[{i}]", entry, ["path", "sha256", "size"], ["path", "sha256", "size"], {"path": _is_text, "sha256": _is_form(SHA256), "size": _is_count})
    return found


def committed(spark: SparkSession, document: dict, new: DataFrame) -> dict:
    """The document with its artifacts upserted, in path order; refused if it breaks a rule. Artifacts are a release's few files."""
    old = [(a["path"], a["sha256"], a["size"]) for a in document.get("artifacts", [])]
    rows = upserted(spark.createDataFrame(old, ARTIFACTS), new).orderBy("path").collect()
    out = document | {"artifacts": [r.asDict() for r in rows]}
    if broken := problems(out):
        raise ValueError("; ".join(broken))
    return json.loads(json.dumps(out))
