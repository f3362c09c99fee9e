"""GeoJSON text sequences: one feature a line, with or without the record separator before it."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

#: White space and separators that a line may carry at its ends.
STRIP = r"^[\s\x1C-\x1F]+|[\s\x1C-\x1F]+$"


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Stripped, non-empty lines as ``line``."""
    return spark.read.text(path).select(F.regexp_replace("value", STRIP, "").alias("line")).where("line <> ''")


def parsed(lines: DataFrame) -> DataFrame:
    """``line`` and its JSON as ``node`` (a variant). A line that isn't JSON fails the job."""
    return lines.withColumn("node", F.parse_json("line"))


def string_property(name: str) -> Column:
    """A property as a string; null if it is missing or null. Names may hold any character but a quote."""
    return F.try_variant_get("node", f"$.properties['{name}']", "string")


def record(body: Column) -> Column:
    return F.concat(F.lit("\x1e"), body)


def jsonable(df: DataFrame, columns: list[str]) -> list[Column]:
    """Columns as JSON can hold them: bytes as text, or in hex where they are no UTF-8; what is no text, number or truth value as text."""
    kinds, out = dict(df.dtypes), []
    for c in columns:
        kind, value = kinds[c], F.col(c)
        if kind == "binary":
            value = F.when(F.is_valid_utf8(value.cast("string")), value.cast("string")).otherwise(F.lower(F.hex(value)))
        elif kind not in ("string", "boolean", "tinyint", "smallint", "int", "bigint", "float", "double"):
            value = value.cast("string")
        out.append(value.alias(c))
    return out


def feature(df: DataFrame, geojson: str, columns: list[str]) -> Column:
    """The text of one feature; nulls are kept."""
    properties = F.to_json(F.struct(*jsonable(df, columns)), {"ignoreNullFields": "false"})
    return F.concat(F.lit('{"type": "Feature", "properties": '), properties, F.lit(', "geometry": '), F.col(geojson), F.lit("}"))


def write_features(features: DataFrame, path: str, geojson: str, columns: list[str]) -> dict[str, int]:
    """One feature a line behind a record separator, with the given columns as properties; rows without geometry are left out. How many were written and dropped."""
    seen, there = Observation(), F.col(geojson).isNotNull()
    counted = features.observe(seen, F.count_if(there).alias("written"), F.count_if(~there).alias("dropped"))
    counted.where(there).select(record(feature(features, geojson, columns)).alias("value")).write.text(path)
    return seen.get


def write_collection(features: DataFrame, path: str, geojson: str, columns: list[str], order: list[str]) -> None:
    """One FeatureCollection in one file, rows without geometry left out. One task writes it, a feature at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lines = lambda some: pa.RecordBatch.from_arrays([pa.array(some, pa.string())], names=["value"])
        comma = ""
        for batch in batches:
            for text in batch.column("value").to_pylist():
                if text is None:
                    yield lines(['{"type": "FeatureCollection", "features": ['])
                else:
                    yield lines([comma + text])
                    comma = ","
        yield lines(["]}"])

    rows = features.where(F.col(geojson).isNotNull()).select(*order, feature(features, geojson, columns).alias("value"))
    rows = rows.toDF(*[f"_{i}" for i in range(len(order))], "value")
    # One row without text goes first and opens the collection, so that one is written where no feature is.
    opening = features.sparkSession.range(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema.fields])
    one = rows.unionByName(opening).repartition(1).sortWithinPartitions(F.col("value").isNotNull(), *[f"_{i}" for i in range(len(order))])
    one.select("value").mapInArrow(run, "value string").write.text(path)
