"""Tile arithmetic: grids of boxes with overlap, window starts, margins, adjacency, and the isometric view."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terraloom.functions.projection import mercator_forward, mercator_inverse


def crop_margin(size: Column, overlap: float) -> Column:
    """Pixels of overlap at a side: half to even."""
    return F.rint(size * F.lit(overlap / (1 + 2 * overlap))).cast("int")


def window_starts(extent: int, window: int, overlap: int) -> list[int]:
    """Starts of windows (64 pixels at least) over an extent; the last one is flush with the end."""
    window = max(64, window)
    if extent <= window:
        return [0]
    starts = list(range(0, extent - window + 1, max(1, window - overlap)))
    return starts if starts[-1] == extent - window else [*starts, extent - window]


def fade_weight(position: Column, size: Column, fade: Column, before: Column, after: Column) -> Column:
    """Linear ramps over the first and the last ``fade`` pixels, only towards neighbours that exist: 0, 1/n, 2/n ... up and 1, 1 - 1/n ... 1/n down."""
    rise = F.when(before & (position < fade), position / fade).otherwise(F.lit(1.0))
    fall = F.when(after & (position >= size - fade), (size - position) / fade).otherwise(F.lit(1.0))
    return rise * fall


def split_bbox(spark: SparkSession, bbox: tuple[float, float, float, float], side: int, overlap: float = 0.0) -> DataFrame:
    """side x side boxes of equal size on the web map: x, y (0 is north), the boxes in metres and degrees, and both with an overlap share at each side."""
    if not 1 <= side <= 64 or not 0 <= overlap <= 0.49:
        raise ValueError("the side must be 1 to 64 and the overlap 0 to 0.49")
    west, south, east, north = bbox
    x0, y0 = mercator_forward(F.lit(float(west)), F.lit(float(south)))
    x1, y1 = mercator_forward(F.lit(float(east)), F.lit(float(north)))
    tiles = spark.range(side).select(F.col("id").cast("int").alias("x"), F.explode(F.sequence(F.lit(0), F.lit(side - 1))).alias("y"))
    tiles = tiles.select("x", "y", x0.alias("l"), y1.alias("t"), ((x1 - x0) / side).alias("w"), ((y1 - y0) / side).alias("h"))
    left, top = F.col("l") + F.col("x") * F.col("w"), F.col("t") - F.col("y") * F.col("h")
    tiles = tiles.select("x", "y", left.alias("mx0"), (top - F.col("h")).alias("my0"), (left + F.col("w")).alias("mx1"), top.alias("my1"), (F.col("w") * overlap).alias("ow"), (F.col("h") * overlap).alias("oh"))
    lon0, lat0 = mercator_inverse(F.col("mx0"), F.col("my0"))
    lon1, lat1 = mercator_inverse(F.col("mx1"), F.col("my1"))
    grown = [F.col("mx0") - F.col("ow"), F.col("my0") - F.col("oh"), F.col("mx1") + F.col("ow"), F.col("my1") + F.col("oh")]
    g0, g1 = mercator_inverse(grown[0], grown[1]), mercator_inverse(grown[2], grown[3])
    return tiles.select(
        "x", "y", F.array(lon0, lat0, lon1, lat1).alias("bbox"), F.array("mx0", "my0", "mx1", "my1").alias("bbox_3857"),
        F.array(*g0, *g1).alias("bbox_overlap"), F.array(*grown).alias("bbox_overlap_3857"),
    )


def scaled_bbox(bbox: Column, scale: float, centre: tuple[Column, Column] | None = None) -> Column:
    """A box shrunk about its own centre, or about a given one and then shifted into its parent."""
    if not 0 < scale <= 1:
        raise ValueError("the scale must be over 0 and at most 1")
    out = []
    for axis in (0, 1):
        low, high = bbox[axis], bbox[axis + 2]
        half = (high - low) * F.lit(scale / 2)
        mid = (low + high) / 2 if centre is None else F.greatest(low + half, F.least(high - half, centre[axis]))
        out.append((mid - half, mid + half))
    return F.array(out[0][0], out[1][0], out[0][1], out[1][1])


def isometric(x: Column, y: Column, z: Column, scale: float = 1.0, z_scale: float = 1.0) -> tuple[Column, Column]:
    return (x - y) * F.lit(scale), (x + y) * F.lit(scale / 2) - z * F.lit(z_scale)


def ground_of(u: Column, v: Column, scale: float = 1.0) -> tuple[Column, Column]:
    """The ground point (height 0) seen at (u, v)."""
    return (v * 2 + u) / F.lit(2 * scale), (v * 2 - u) / F.lit(2 * scale)


def painter_order(items: DataFrame, tile: list[str], depth: Column, item: str) -> DataFrame:
    """Items of each tile from back to front; equal depths by id. A tile's items are drawn together, so they are listed together."""
    order = F.sort_array(F.collect_list(F.struct(depth.alias("depth"), F.col(item).alias("item"))))
    return items.groupBy(*tile).agg(F.transform(order, lambda s: s["item"]).alias("items"))


def neighbours(tiles: DataFrame) -> DataFrame:
    """Seams between tiles next to each other: axis (v: side by side, h: one below the other), x, y of the first, ox, oy of the other."""
    other = tiles.select(F.col("x").alias("ox"), F.col("y").alias("oy"))
    right = tiles.join(other, (F.col("ox") == F.col("x") + 1) & (F.col("oy") == F.col("y"))).select(F.lit("v").alias("axis"), "x", "y", "ox", "oy")
    below = tiles.join(other, (F.col("ox") == F.col("x")) & (F.col("oy") == F.col("y") + 1)).select(F.lit("h").alias("axis"), "x", "y", "ox", "oy")
    return right.unionByName(below)


def intersections(tiles: DataFrame) -> DataFrame:
    """Corners where four tiles meet: x, y of the upper left one."""
    at = lambda dx, dy: tiles.select((F.col("x") - dx).alias("x"), (F.col("y") - dy).alias("y"))
    keys = ["x", "y"]
    return tiles.select(*keys).join(at(1, 0), keys, "left_semi").join(at(0, 1), keys, "left_semi").join(at(1, 1), keys, "left_semi")


def missing_tiles(tiles: DataFrame) -> DataFrame:
    """Places within the index ranges that have no tile. The ranges, one row, are found first, so that the places are made in many tasks."""
    own = tiles.select("x", "y")
    x0, x1, y0, y1 = own.agg(F.min("x"), F.max("x"), F.min("y"), F.max("y")).first()
    if x0 is None or y0 is None:
        return own.limit(0)
    height = y1 - y0 + 1
    place = lambda at, axis: at.cast(own.schema[axis].dataType).alias(axis)
    every = own.sparkSession.range((x1 - x0 + 1) * height).select(place(F.floor(F.col("id") / height) + x0, "x"), place(F.col("id") % height + y0, "y"))
    return every.join(own, ["x", "y"], "left_anti")


def pyramid_layout(spark: SparkSession, bounds: tuple[float, float, float, float], size: int, overlap: float, top: float = 0.0, most: int | None = None) -> DataFrame:
    """Tiles of a view (u0, v0, u1, v1): x, y, the left upper corner of each tile's core and of the whole tile. A quarter tile is added around, and ``top`` above for what stands up."""
    core = size / (1 + 2 * overlap)
    u0, v0 = bounds[0] - size / 4, bounds[1] - size / 4 - top
    columns, rows = (max(1, -int(-(high - low) // core)) for low, high in ((u0, bounds[2] + size / 4), (v0, bounds[3] + size / 4)))
    tiles = spark.range(columns).select(F.col("id").cast("int").alias("x"), F.explode(F.sequence(F.lit(0), F.lit(rows - 1))).alias("y"))
    tiles = tiles if most is None else tiles.orderBy("x", "y").limit(most)
    margin = (size - core) / 2
    return tiles.select("x", "y", (F.col("x") * core + u0).alias("core_u"), (F.col("y") * core + v0).alias("core_v"), (F.col("x") * core + u0 - margin).alias("u"), (F.col("y") * core + v0 - margin).alias("v"))


def layer_features(layers: dict[str, DataFrame], buildings: DataFrame | None = None) -> dict[str, DataFrame]:
    """What the vector tilers read: one table of the base layers with their class, and buildings with id and height."""
    base = None
    for name in ("green", "roads", "water"):
        if name in layers:
            part = layers[name].select(F.lit(name).alias("layer"), "class", "geometry")
            base = part if base is None else base.unionByName(part)
    out = {} if base is None else {"base": base}
    if buildings is not None:
        out["buildings"] = buildings.select("id", "height_m", "height_source", "geometry")
    return out
