"""Building heights, and the statistics that go with them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terraloom.functions.features import nearest_rank, parsed_height, parsed_levels, resolved_height


def optional(df: DataFrame, name: str, kind: str = "string") -> Column:
    """The column, or nulls where the table lacks it."""
    return F.col(name) if name in df.columns else F.lit(None).cast(kind)


def with_heights(buildings: DataFrame) -> DataFrame:
    """Adds or replaces height_m, levels_int and height_source; ``id`` must be there, the raw attributes may be missing."""
    if "id" not in buildings.columns:
        raise ValueError("buildings need an id")
    found = resolved_height(F.col("id"), parsed_height(optional(buildings, "height")), parsed_levels(optional(buildings, "building_levels")))
    kept = [c for c in buildings.columns if c not in ("height_m", "levels_int", "height_source")]
    return buildings.select(*kept, found.alias("_h")).select(*kept, "_h.*")


def source_counts(buildings: DataFrame) -> DataFrame:
    """One row with all three sources, zeros included."""
    return buildings.agg(*[F.count_if(F.col("height_source") == s).alias(s) for s in ("height", "levels", "heuristic")])


def height_report(buildings: DataFrame) -> DataFrame:
    counts = [F.count_if(F.col("height_source") == s).alias(f"n_{s}") for s in ("height", "levels", "heuristic")]
    return buildings.agg(F.count("*").alias("total"), *counts, F.min("height_m").alias("min_m"), nearest_rank("height_m", 0.5).alias("median_m"), nearest_rank("height_m", 0.95).alias("p95_m"), F.max("height_m").alias("max_m"))
