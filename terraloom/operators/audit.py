"""Accounts of a run: how many seams there are, which look suspicious, and one report over its stages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MOST_SUSPICIOUS = 256


def seam_totals(tiles: DataFrame) -> DataFrame:
    """seams_total and intersections_total of a grid of tiles (x, y): consecutive indices of one axis make a seam at every index of the other, and cross each other."""
    at = tiles.select(F.explode(F.array(F.struct(F.lit("x").alias("axis"), F.col("x").alias("at")), F.struct(F.lit("y").alias("axis"), F.col("y").alias("at")))).alias("i")).select("i.*").distinct()
    after = at.select("axis", (F.col("at") - 1).alias("at"), F.lit(True).alias("next"))
    joined = at.join(after, ["axis", "at"], "left")
    count = lambda axis, paired: F.count_if((F.col("axis") == axis) & (F.col("next").isNotNull() if paired else F.lit(True)))
    counts = joined.agg(count("x", False).alias("n_x"), count("y", False).alias("n_y"), count("x", True).alias("pairs_x"), count("y", True).alias("pairs_y"))
    return counts.select((F.col("pairs_x") * F.col("n_y") + F.col("pairs_y") * F.col("n_x")).alias("seams_total"), (F.col("pairs_x") * F.col("pairs_y")).alias("intersections_total"))


def suspicious(gaps: dict[str, DataFrame], skipped: DataFrame, most: int = MOST_SUSPICIOUS) -> DataFrame:
    """The first ``most`` of: gaps between indices of each axis (at, next), then skipped seams (reason, at, next) in their order."""
    rows = skipped.select(F.lit(len(gaps)).alias("rank"), "reason", "at", "next", F.lit(None).cast("int").alias("missing"))
    for rank, (axis, found) in enumerate(gaps.items()):
        rows = rows.unionByName(found.select(F.lit(rank).alias("rank"), F.lit(f"{axis}_index_gap").alias("reason"), "at", "next", (F.col("next") - F.col("at") - 1).cast("int").alias("missing")))
    return rows.orderBy("rank", "at", "next", "reason").limit(most).drop("rank")


COUNTERS = ("seams_total", "seams_processed", "seams_skipped", "intersections_total", "intersections_processed", "intersections_skipped")


def quality_report(stages: DataFrame) -> DataFrame:
    """One row for each run (run_id, stage: seam, global or refine, and the counters): the counters of the last seam stage there is, those of each stage under its own name, and which stages ran."""
    of = lambda stage, c: F.max(F.when(F.col("stage") == stage, F.col(c)))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("bigint")
    ran = lambda stage: F.count_if(F.col("stage") == stage) > 0
    columns = [zero(F.when(ran("refine"), of("refine", c)).otherwise(of("seam", c))).alias(c) for c in COUNTERS]
    columns += [zero(of(stage, c)).alias(f"{name}_{c}") for stage, name in (("seam", "base"), ("refine", "post_global")) for c in COUNTERS[:3]]
    columns += [zero(of("global", c)).alias(f"global_{c}") for c in COUNTERS[3:]]
    return stages.groupBy("run_id").agg(*columns, ran("global").alias("global_pass_enabled"), ran("refine").alias("post_global_seam_enabled"))
