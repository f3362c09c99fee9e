"""A metric grid, and how much of each cell is covered.

Coverage is a bucketed spatial join: each cover piece is exploded to the grid indices that its envelope touches, joined with the
cells by equality of the index, clipped, and added up by cell before the grid is joined back, so an uncovered cell gets 0
and no range join is needed. A piece that spans many cells is split over them by the explode, which also spreads it over tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terraloom.functions.text import cell_id


def grid_cells(spark: SparkSession, bounds: tuple[float, float, float, float], size: float) -> DataFrame:
    """ix, iy, cell_id, cell_area_m2 and the cell's corner coordinates over bounds in metres; an empty grid is an error."""
    x0, y0, x1, y1 = bounds
    first, last = (int(x0 // size), int(y0 // size)), (int(-(-x1 // size)), int(-(-y1 // size)))
    if last[0] <= first[0] or last[1] <= first[1]:
        raise ValueError("the grid has no cells")
    columns = spark.range(first[0], last[0]).select(F.col("id").cast("int").alias("ix"))
    cells = columns.select("ix", F.explode(F.sequence(F.lit(first[1]), F.lit(last[1] - 1))).alias("iy"))
    cells = cells.withColumn("cell_id", cell_id(size, F.col("ix"), F.col("iy"))).withColumn("cell_area_m2", F.lit(float(size) ** 2))
    return with_cell_edges(cells, size)


def with_cell_edges(rows: DataFrame, size: float) -> DataFrame:
    """Rows with ix and iy, and their cell's edges."""
    edge = lambda c, plus: (F.col(c) + plus).cast("double") * F.lit(float(size))
    return rows.withColumns({"cx0": edge("ix", 0), "cy0": edge("iy", 0), "cx1": edge("ix", 1), "cy1": edge("iy", 1)})


def cells_touched(pieces: DataFrame, size: float) -> DataFrame:
    """One row for each piece (x0, y0, x1, y1) and grid index that its envelope overlaps with some area."""
    index = lambda c: F.floor(F.col(c) / F.lit(float(size))).cast("int")
    last = lambda c: (F.ceil(F.col(c) / F.lit(float(size))) - 1).cast("int")
    sound = pieces.where("x1 > x0 AND y1 > y0")
    across = sound.withColumn("ix", F.explode(F.sequence(index("x0"), last("x1"))))
    return across.withColumn("iy", F.explode(F.sequence(index("y0"), last("y1"))))


def rectangle_overlap() -> Column:
    """Area of a piece's envelope within a cell, in closed form."""
    side = lambda a, b, c, d: F.greatest(F.lit(0.0), F.least(F.col(b), F.col(d)) - F.greatest(F.col(a), F.col(c)))
    return side("x0", "x1", "cx0", "cx1") * side("y0", "y1", "cy0", "cy1")


def share(covered: Column, area: Column) -> Column:
    """Covered part between 0 and 1; 0 where the area is missing or not positive."""
    return F.when(area > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), covered / area))).otherwise(F.lit(0.0))


def coverage(cells: DataFrame, pieces: DataFrame, size: float, overlap: Column | None = None) -> DataFrame:
    """cell_id, cell_area_m2, green_area_m2, green_share of each cell. Overlapping pieces count twice in the area, the share is clamped."""
    met = cells_touched(pieces, size).join(cells.select("ix", "iy", "cell_id", "cx0", "cy0", "cx1", "cy1"), ["ix", "iy"])
    sums = met.groupBy("cell_id").agg(F.sum(rectangle_overlap() if overlap is None else overlap).alias("green_area_m2"))
    return with_shares(cells.select("cell_id", "cell_area_m2").join(sums, "cell_id", "left"))


def with_shares(cells: DataFrame) -> DataFrame:
    """Cells with green_area_m2, null where nothing lies: 0 there, and the share of cell_area_m2."""
    out = cells.withColumn("green_area_m2", F.coalesce("green_area_m2", F.lit(0.0)))
    return out.withColumn("green_share", share(F.col("green_area_m2"), F.col("cell_area_m2")))


def coverage_report(metrics: DataFrame) -> DataFrame:
    ok = F.when(~F.isnan("green_share"), F.col("green_share"))
    return metrics.agg(F.count("*").alias("cells_total"), F.count_if(F.col("green_area_m2") > 0).alias("cells_intersected"), F.min(ok).alias("share_min"), F.max(ok).alias("share_max"), F.avg(ok).alias("share_avg"))
