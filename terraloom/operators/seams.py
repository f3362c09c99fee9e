"""Scores of tile seams, choice among candidates, and the reports on both."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terraloom.operators import chunks

#: The weights of a seam score, and those of luma.
WEIGHTS = {"rgb_l1": 1.0, "rgb_l2": 0.25, "sobel_l1": 0.5}
LUMA = (0.2126, 0.7152, 0.0722)


def usable_weights(given: dict[str, float] | None) -> dict[str, float]:
    """Known, finite weights; the defaults if none is left."""
    kept = {k: float(v) for k, v in (given or {}).items() if k in WEIGHTS and math.isfinite(float(v))}
    return kept or dict(WEIGHTS)


def luma(r: Column, g: Column, b: Column) -> Column:
    return r * LUMA[0] + g * LUMA[1] + b * LUMA[2]


def mean_difference(a: str, b: str, power: int) -> Column:
    """Mean of |a - b| ** power over two arrays of numbers."""
    gap = lambda x, y: F.pow(F.abs(x.cast("double") - y.cast("double")), F.lit(float(power)))
    return F.aggregate(F.zip_with(a, b, gap), F.lit(0.0), lambda s, x: s + x) / F.size(a)


def sobel_magnitude(pixels: DataFrame, keys: list[str], value: str = "value") -> DataFrame:
    """Gradient magnitude of each pixel of images in a long table (row, col), edges repeated; 0 in images under two pixels high or wide."""
    return chunks.by_chunk(pixels, keys, value, 1, chunks.sobel, "magnitude")


def seam_score(metrics: dict[str, Column], weights: dict[str, float] | None = None) -> Column:
    total = F.lit(0.0)
    for name, weight in usable_weights(weights).items():
        if name in metrics:
            total = total + metrics[name] * F.lit(weight)
    return total


def total_score(seam: Column, structure: Column, colour: Column, fallback: Column, structure_weight: float, colour_weight: float, fallback_penalty: float) -> Column:
    return seam + structure * F.lit(structure_weight) + colour * F.lit(colour_weight) + F.when(fallback, F.lit(fallback_penalty)).otherwise(F.lit(0.0))


def selected(candidates: DataFrame, tile: list[str], score: str = "total_score", variant: str = "variant") -> DataFrame:
    """The candidate of least score of each tile, ties by the lowest variant; null where all failed. Failures are counted."""
    sound = F.col("error").isNull()
    best = F.min(F.when(sound, F.struct(F.col(score).alias("score"), F.col(variant).alias("variant"))))
    out = candidates.groupBy(*tile).agg(best.alias("best"), F.count("*").alias("candidates"), F.count_if(~sound).alias("failed"))
    return out.select(*tile, F.col("best.variant").alias("variant"), F.col("best.score").alias("score"), "candidates", "failed")


def worst(seams: DataFrame, n: int = 10, score: str = "score", ties: tuple[str, ...] = ()) -> DataFrame:
    return seams.orderBy(F.desc(score), *ties).limit(n)


def seam_profile(pixels: DataFrame, keys: list[str], along: str) -> DataFrame:
    """Mean absolute difference of the two sides at each place along a seam."""
    return pixels.groupBy(*keys, along).agg(F.avg(F.abs(F.col("a") - F.col("b"))).alias("l1"))


def seam_weight(distance: Column, half: int) -> Column:
    """1 at a seam, falling to 0 at the last of ``half`` pixels; 1 where there is but one."""
    return F.greatest(F.lit(0.0), F.lit(1.0) - distance / F.lit(float(half - 1))) if half > 1 else F.lit(1.0)


def harmonised(pairs: DataFrame, half: int) -> DataFrame:
    """Both sides of a seam drawn to their mean: mirrored pixels are joined as (distance, a, b)."""
    weight = seam_weight(F.col("distance"), half)
    mean = (F.col("a") + F.col("b")) / 2
    return pairs.withColumns({c: F.col(c) + (mean - F.col(c)) * weight for c in "ab"})


def sobel_difference(pairs: DataFrame, keys: list[str]) -> DataFrame:
    """sobel_l1 of each image pair (row, col, value, other): the mean absolute difference of the two gradient magnitudes."""
    # Both images go through one pass, so the pairs are made once.
    sides = F.explode(F.array(F.struct(F.lit(1).alias("sign"), F.col("value").alias("value")), F.struct(F.lit(-1).alias("sign"), F.col("other").alias("value"))))
    images = pairs.select(*keys, "row", "col", sides.alias("_s")).select(*keys, "row", "col", F.col("_s.sign").alias("_sign"), F.col("_s.value").alias("value"))
    gaps = sobel_magnitude(images, [*keys, "_sign"]).groupBy(*keys, "row", "col").agg(F.abs(F.sum(F.col("magnitude") * F.col("_sign"))).alias("gap"))
    return gaps.groupBy(*keys).agg(F.avg("gap").alias("sobel_l1"))


def pair_scores(both: DataFrame, keys: list[str], channels: tuple[str, ...] = ("value",), weights: dict[str, float] | None = None) -> DataFrame:
    """keys and score of image pairs (keys, row, col, channels, and the other image's channels behind ``_``): means over pixels and channels, gradients of luma."""
    used = usable_weights(weights)
    gaps = [F.col(c).cast("double") - F.col(f"_{c}") for c in channels]
    mean = lambda parts: sum(parts[1:], parts[0]) / len(parts)
    metrics = both.groupBy(*keys).agg(F.avg(mean([F.abs(d) for d in gaps])).alias("rgb_l1"), F.avg(mean([d * d for d in gaps])).alias("rgb_l2"))
    if used.get("sobel_l1"):
        light = lambda prefix: luma(*[F.col(prefix + c) for c in channels]) if len(channels) == 3 else F.col(prefix + channels[0])
        lit = both.select(*keys, "row", "col", light("").alias("value"), light("_").alias("other"))
        metrics = metrics.join(sobel_difference(lit, keys), keys)
    return metrics.select(*keys, seam_score({k: F.col(k) for k in used if k in metrics.columns}, used).alias("score"))


#: Where a neighbour lies, across which axes its last pixels meet a candidate's first, and the words that ask for it, anywhere in the mode.
SIDES = {"left": (1, 0, ("col",), ("left",)), "top": (0, 1, ("row",), ("top",)), "tl": (1, 1, ("row", "col"), ("tl", "top-left"))}


def strip_scores(candidates: DataFrame, chosen: DataFrame, size: int, strip: int, weights: dict[str, float] | None = None, neighbours: str = "left+top", channels: tuple[str, ...] = ("value",)) -> DataFrame:
    """Seam score of each candidate (x, y, variant, row, col, channels) against chosen tiles (x, y, row, col, channels), over strips of overlap; 0 without a neighbour.

    ``neighbours`` is searched for the sides' words, so ``top-left`` asks for left, top and corner. The candidate's first ``strip`` columns lie over the left tile's last ones, its
    first rows over the upper tile's last ones. Differences are means over pixels and channels; gradients are those of luma (of red, green and blue; of the one channel else) within a strip.
    """
    strip, both = max(1, min(strip, size)), None
    for side, (dx, dy, across, words) in SIDES.items():
        if not any(w in neighbours for w in words):
            continue
        mine, theirs = candidates, chosen
        for axis in across:
            mine, theirs = mine.where(F.col(axis) < strip), theirs.where(F.col(axis) >= size - strip)
        theirs = theirs.select((F.col("x") + dx).alias("x"), (F.col("y") + dy).alias("y"), *[(F.col(c) - (size - strip if c in across else 0)).alias(c) for c in ("row", "col")], *[F.col(c).alias(f"_{c}") for c in channels])
        part = mine.join(theirs, ["x", "y", "row", "col"]).withColumn("side", F.lit(side))
        both = part if both is None else both.unionByName(part)
    every = candidates.select("x", "y", "variant").distinct()
    if both is None:
        return every.withColumn("seam", F.lit(0.0))
    scored = pair_scores(both, ["x", "y", "variant", "side"], channels, weights)
    return every.join(scored.groupBy("x", "y", "variant").agg(F.sum("score").alias("seam")), ["x", "y", "variant"], "left").fillna(0.0, ["seam"])


def heat_colour(level: Column) -> list[Column]:
    """Red, green and blue of a level from 0 to 1: red rises to the first stop, then green to the second, then blue."""
    #: The stops.
    first, second = 0.5, 0.85
    rise = lambda low, high: F.rint(F.greatest(F.lit(0.0), F.least(F.lit(1.0), (level - low) / (high - low))) * 255).cast("int")
    return [rise(0.0, first).alias("r"), rise(first, second).alias("g"), rise(second, 1.0).alias("b")]


def heatmap(profiles: DataFrame, height: int | None = None, width: int | None = None) -> DataFrame:
    """Both pixels at each place along a seam (out_row, out_col: the pixel behind the seam; axis, l1 from 0 to 1), coloured by their share of the greatest.

    Levels are whole numbers of 255, cut down. At crossings the horizontal seam shows, of seams that share pixels the last one.
    """
    level = F.floor(F.col("l1") * 255).cast("int")
    drawn = profiles.select("axis", level.alias("level"), F.when(F.col("axis") == "h", F.col("out_row")).otherwise(F.col("out_col")).alias("at"), "out_row", "out_col", F.explode(F.array(F.lit(1), F.lit(0))).alias("back"))
    back = lambda c, axis: (F.col(c) - F.when(F.col("axis") == axis, F.col("back")).otherwise(0)).alias(c)
    drawn = drawn.select("axis", "level", "at", back("out_row", "h"), back("out_col", "v")).where("out_row >= 0 AND out_col >= 0")
    for c, most in (("out_row", height), ("out_col", width)):
        drawn = drawn if most is None else drawn.where(F.col(c) < most)
    shown = drawn.groupBy("out_row", "out_col").agg(F.max_by("level", F.struct(F.col("axis") == "h", "at")).alias("level"))
    # The greatest value is one row, so the cross join adds a column and no rows.
    top = shown.agg(F.greatest(F.max("level"), F.lit(1)).alias("top"))
    return shown.crossJoin(F.broadcast(top)).select("out_row", "out_col", *heat_colour(F.greatest(F.col("level"), F.lit(0)) / F.col("top")))


def skip_reasons(pairs: DataFrame) -> DataFrame:
    return pairs.where(F.col("reason").isNotNull()).groupBy("reason").agg(F.count("*").alias("n"))


def index_gaps(tiles: DataFrame, axis: str) -> DataFrame:
    """Consecutive indices along an axis that aren't neighbours: at, next."""
    found = tiles.select(F.col(axis).alias("at")).distinct()
    after = found.select((F.col("at") - 1).alias("at"), F.lit(True).alias("has_next"))
    ends = found.join(after, "at", "left").where("has_next IS NULL").select("at")
    starts = found.select((F.col("at")).alias("next")).join(found.select((F.col("at") + 1).alias("next")), "next", "left_anti")
    # Distinct indices of an axis are few (a tile set's side), so ordering them in one task is its size.
    a = ends.selectExpr("at", "row_number() OVER (ORDER BY at) AS n")
    b = starts.selectExpr("next", "row_number() OVER (ORDER BY next) - 1 AS n")
    return a.join(b, "n").select("at", "next")
