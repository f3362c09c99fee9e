"""Columns derived from map features: ids, classes and heights."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The keys that name a feature's class, in order, and the class without any of them.
CLASS_KEYS = {
    "buildings": (("building",), "building"),
    "roads": (("highway",), "road"),
    "water": (("waterway", "water", "natural"), "water"),
    "green": (("landuse", "leisure", "natural"), "green"),
}
#: Metres a level; the heuristic's least height and its number of steps of a centimetre.
LEVEL_M, LEAST_M, STEPS = 3.2, 8.0, 1201


def present(value: Column) -> Column:
    """The string, or null if it is empty."""
    return F.when(value != "", value)


def feature_class(layer: str, properties: dict[str, Column]) -> Column:
    keys, default = CLASS_KEYS[layer]
    return F.coalesce(*[present(properties[k]) for k in keys if k in properties], F.lit(default))


def feature_id(kind: Column, number: Column, line: Column) -> Column:
    """``kind/number``, or a digest of the source line where either is missing."""
    digest = F.concat(F.lit("hash/"), F.substring(F.sha2(line, 256), 1, 16))
    return F.when(present(kind).isNotNull() & number.isNotNull(), F.concat(kind, F.lit("/"), number.cast("string"))).otherwise(digest)


def hex_number(digits: Column) -> Column:
    return F.conv(digits, 16, 10).cast("bigint")


def parsed_height(raw: Column) -> Column:
    """Metres of ``12``, ``12.5``, ``12 m`` or ``0``; null for anything else. White space is Unicode's."""
    return F.regexp_extract(raw, r"(?iU)^\s*([0-9]+(?:\.[0-9]+)?)\s*m?\s*$", 1).try_cast("double")


def parsed_levels(raw: Column) -> Column:
    """The leading whole number; null if there is none or it is 0."""
    number = F.regexp_extract(raw, r"(?U)^\s*([0-9]+)", 1).try_cast("int")
    return F.when(number > 0, number)


def heuristic_height(feature: Column) -> Column:
    """A height from 8 to 20 m that depends on the id alone; a null id counts as empty."""
    number = hex_number(F.substring(F.sha2(F.coalesce(feature, F.lit("")), 256), 1, 8))
    return F.lit(LEAST_M) + (number % STEPS) / F.lit(100.0)


def resolved_height(feature: Column, height: Column, levels: Column) -> Column:
    """height_m, levels_int and height_source: an explicit height, else levels, else the heuristic."""
    by_levels = height.isNull() & levels.isNotNull()
    return F.struct(
        F.coalesce(height, levels * F.lit(LEVEL_M), heuristic_height(feature)).alias("height_m"),
        F.when(by_levels, levels).cast("int").alias("levels_int"),
        F.when(height.isNotNull(), "height").when(by_levels, "levels").otherwise("heuristic").alias("height_source"),
    )


def nearest_rank(value: str, share: float) -> Column:
    """The value at rank ceil(share * n): no interpolation."""
    return F.expr(f"percentile_disc({share}) WITHIN GROUP (ORDER BY {value})")
