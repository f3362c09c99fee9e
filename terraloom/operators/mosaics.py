"""Mosaics of overlapping square tiles as long pixel tables (x, y, row, col, channels), and the way back into tiles.

Only arithmetic on keys and one group by output pixel; no image is held whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terraloom.operators.seams import seam_weight
from terraloom.operators.tiles import fade_weight


def margin_of(size: int, overlap: float) -> int:
    """Pixels of overlap at each side: half to even."""
    return round(size * overlap / (1 + 2 * overlap))


def resized_nearest(pixels: DataFrame, height: Column, width: Column, size: int) -> DataFrame:
    """Pixels of images of any size brought to size x size by the nearest pixel: every source pixel is sent to the places that read it."""
    first = lambda c, n: F.ceil((F.col(c) * size) / n - F.lit(0.5)).cast("int")
    last = lambda c, n: F.ceil(((F.col(c) + 1) * size) / n - F.lit(0.5)).cast("int") - 1
    rest = [c for c in pixels.columns if c not in ("row", "col")]
    rows = pixels.where(first("row", height) <= last("row", height)).withColumn("_r", F.explode(F.sequence(first("row", height), last("row", height))))
    both = rows.where(first("col", width) <= last("col", width)).withColumn("_c", F.explode(F.sequence(first("col", width), last("col", width))))
    return both.select(*rest, F.col("_r").alias("row"), F.col("_c").alias("col"))


def cropped(pixels: DataFrame, size: int, overlap: float) -> DataFrame:
    """Cores side by side: out_row, out_col and the other columns."""
    m = margin_of(size, overlap)
    core = size - 2 * m
    rest = [c for c in pixels.columns if c not in ("x", "y", "row", "col")]
    kept = pixels.where((F.col("row") >= m) & (F.col("row") < size - m) & (F.col("col") >= m) & (F.col("col") < size - m))
    return kept.select((F.col("y") * core + F.col("row") - m).alias("out_row"), (F.col("x") * core + F.col("col") - m).alias("out_col"), *rest)


def blended(pixels: DataFrame, size: int, overlap: float, channels: list[str], feather: int | None = None) -> DataFrame:
    """Tiles laid over each other with linear ramps towards neighbours that exist, as a weighted mean at each output pixel, cut to whole numbers from 0 to 255 or whatever the channels hold."""
    m = margin_of(size, overlap)
    core, reach = size - 2 * m, max(0, min(m, feather if feather else round(0.75 * m)))
    there = pixels.select("x", "y").distinct()
    sides = {"west": (1, 0), "east": (-1, 0), "north": (0, 1), "south": (0, -1)}
    known = there
    for name, (dx, dy) in sides.items():
        known = known.join(there.select((F.col("x") + dx).alias("x"), (F.col("y") + dy).alias("y"), F.lit(True).alias(name)), ["x", "y"], "left")
    known = known.select("x", "y", *[F.coalesce(F.col(n), F.lit(False)).alias(n) for n in sides])
    # A side with a neighbour reaches the feather beyond the core and fades there; one without shows its core only.
    place = {}
    for axis, low, high in (("row", "north", "south"), ("col", "west", "east")):
        start = m - F.when(F.col(low), reach).otherwise(0)
        length = core + F.when(F.col(low), reach).otherwise(0) + F.when(F.col(high), reach).otherwise(0)
        place[axis] = (F.col(axis) - start, length, low, high)
    laid = pixels.join(known, ["x", "y"])
    inside = F.lit(True)
    weight = F.lit(1.0)
    for at, length, low, high in place.values():
        inside = inside & (at >= 0) & (at < length)
        weight = weight * fade_weight(at, length, F.lit(reach), F.col(low), F.col(high))
    laid = laid.where(inside).select((F.col("y") * core + F.col("row") - m).alias("out_row"), (F.col("x") * core + F.col("col") - m).alias("out_col"), weight.alias("w"), *channels)
    total = F.nullif(F.sum("w"), F.lit(0.0))
    return laid.groupBy("out_row", "out_col").agg(*[F.floor(F.sum(F.col(c) * F.col("w")) / total + F.lit(1e-9)).cast("int").alias(c) for c in channels])


def written_back(pixels: DataFrame, mosaic: DataFrame, size: int, overlap: float, channels: list[str]) -> DataFrame:
    """Tiles whose cores come from a processed mosaic; their overlap borders stay."""
    m = margin_of(size, overlap)
    core = size - 2 * m
    keys = pixels.withColumn("out_row", F.col("y") * core + F.col("row") - m).withColumn("out_col", F.col("x") * core + F.col("col") - m)
    new = mosaic.select("out_row", "out_col", *[F.col(c).alias(f"_{c}") for c in channels], F.lit(True).alias("_new"))
    within = (F.col("row") >= m) & (F.col("row") < size - m) & (F.col("col") >= m) & (F.col("col") < size - m)
    joined = keys.join(new, ["out_row", "out_col"], "left")
    return joined.select("x", "y", "row", "col", *[F.when(within & F.col("_new"), F.col(f"_{c}")).otherwise(F.col(c)).alias(c) for c in channels])


def layout_report(tiles: DataFrame) -> DataFrame:
    """Index ranges, tiles expected, found and missing."""
    found = tiles.select("x", "y").distinct()
    expected = (F.max("x") - F.min("x") + 1) * (F.max("y") - F.min("y") + 1)
    return found.agg(F.min("x").alias("x_min"), F.max("x").alias("x_max"), F.min("y").alias("y_min"), F.max("y").alias("y_max"), expected.cast("bigint").alias("expected"), F.count("*").alias("found")).withColumn("missing", F.col("expected") - F.col("found"))


def radial_weight(row: Column, col: Column, centre_row: float, centre_col: float, radius: float) -> Column:
    """round(255 * max(0, 1 - distance / radius) ** 2)"""
    distance = F.hypot(row - F.lit(centre_row), col - F.lit(centre_col))
    near = F.greatest(F.lit(0.0), F.lit(1.0) - distance / F.lit(radius))
    return F.rint(near * near * 255).cast("int")


def seam_strips(pixels: DataFrame, seams: DataFrame, size: int, overlap: float, half: int, channels: list[str]) -> DataFrame:
    """Mirrored pixels on both sides of each seam (as ``neighbours`` lists them): axis, x, y, along, distance, and both sides' channels."""
    m = margin_of(size, overlap)
    core = size - 2 * m
    side = pixels.select("x", "y", "row", "col", *channels)
    out = None
    for axis, across, along in (("v", "col", "row"), ("h", "row", "col")):
        own = seams.where(F.col("axis") == axis)
        a = side.withColumn("distance", F.lit(m + core - 1) - F.col(across)).where((F.col("distance") >= 0) & (F.col("distance") < half))
        b = side.withColumn("distance", F.col(across) - m).where((F.col("distance") >= 0) & (F.col("distance") < half))
        a = a.select("x", "y", F.col(along).alias("along"), "distance", *[F.col(c).alias(f"a_{c}") for c in channels])
        b = b.select(F.col("x").alias("ox"), F.col("y").alias("oy"), F.col(along).alias("along"), "distance", *[F.col(c).alias(f"b_{c}") for c in channels])
        part = own.join(a, ["x", "y"]).join(b, ["ox", "oy", "along", "distance"]).select("axis", "x", "y", "ox", "oy", "along", "distance", *[f"{s}_{c}" for s in "ab" for c in channels])
        out = part if out is None else out.unionByName(part)
    return out


def harmonised_seams(pixels: DataFrame, seams: DataFrame, size: int, overlap: float, half: int, channels: list[str]) -> DataFrame:
    """Tiles with both sides of every seam drawn to their mean, the weight falling from 1 at the seam to 0 at the last of ``half`` pixels. Where two seams meet a pixel, their changes are averaged."""
    m = margin_of(size, overlap)
    core = size - 2 * m
    strips = seam_strips(pixels, seams, size, overlap, half, channels)
    weight = seam_weight(F.col("distance"), half)
    changes = None
    for end, (x, y) in (("a", ("x", "y")), ("b", ("ox", "oy"))):
        across = F.lit(m + core - 1) - F.col("distance") if end == "a" else F.col("distance") + m
        row = F.when(F.col("axis") == "v", F.col("along")).otherwise(across).cast("int")
        col = F.when(F.col("axis") == "v", across).otherwise(F.col("along")).cast("int")
        moved = [((F.col(f"a_{c}") + F.col(f"b_{c}")) / 2 - F.col(f"{end}_{c}")) * weight for c in channels]
        part = strips.select(F.col(x).alias("x"), F.col(y).alias("y"), row.alias("row"), col.alias("col"), *[d.alias(f"d_{c}") for d, c in zip(moved, channels, strict=True)])
        changes = part if changes is None else changes.unionByName(part)
    keys = ["x", "y", "row", "col"]
    changes = changes.groupBy(*keys).agg(*[F.avg(f"d_{c}").alias(f"d_{c}") for c in channels])
    joined = pixels.select(*keys, *channels).join(changes, keys, "left")
    return joined.select(*keys, *[F.rint(F.col(c) + F.coalesce(f"d_{c}", F.lit(0.0))).cast("int").alias(c) for c in channels])
