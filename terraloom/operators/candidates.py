"""Candidates of tiles: images resampled as tables, the total score of a candidate, and a search along a grid that goes on where it stopped."""

from __future__ import annotations

import json
import math
from collections.abc import Callable
from dataclasses import asdict, dataclass
from hashlib import sha256

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terraloom.operators import seams

TILE = ["x", "y"]
CANDIDATE = [*TILE, "variant"]
#: Lobes of the filter, bits of its whole-number weights, weights of the colour score, and of the structure score without and with a reference tile.
LOBES, BITS = 3, 22
COLOUR = {"rgb_l1": 1.0, "rgb_l2": 0.0, "sobel_l1": 0.0}
STRUCTURE, STRUCTURE_OF_REFERENCE = {"rgb_l1": 0.15, "rgb_l2": 0.0, "sobel_l1": 1.0}, {"rgb_l1": 1.0, "rgb_l2": 0.0, "sobel_l1": 0.5}


def axis_weights(n_in: int, n_out: int) -> list[tuple[int, int, int]]:
    """(output, input, weight) of a windowed-sinc filter along one axis; weights are whole shares of 2 ** BITS. About 2 LOBES max(n_in, n_out) rows."""
    step = n_in / n_out
    scale = max(step, 1.0)
    rows = []
    for out in range(n_out):
        centre = (out + 0.5) * step
        first, last = max(0, int(centre - LOBES * scale + 0.5)), min(n_in, int(centre + LOBES * scale + 0.5))
        at = (np.arange(first, last) - centre + 0.5) / scale
        weights = np.where(np.abs(at) < LOBES, np.sinc(at) * np.sinc(at / LOBES), 0.0)
        shares = weights / weights.sum() * (1 << BITS)
        rows += [(out, first + i, math.floor(s + 0.5) if s >= 0 else math.ceil(s - 0.5)) for i, s in enumerate(shares)]
    return rows


def resampled(pixels: DataFrame, keys: list[str], size: tuple[int, int], to: tuple[int, int], channels: list[str]) -> DataFrame:
    """Images (keys, row, col, channels of 0 to 255) of ``size`` at another, both as (height, width): along rows, then along columns, rounded to bytes each time.

    A pixel goes out once for each output it bears on and is summed up before it is sent, so no image is held whole. Absent and null values count as 0; an output without any
    pixel is absent. An axis that keeps its length is left as it is.
    """
    out = pixels.select(*keys, *[F.col(c).cast("int").alias(c) for c in ("row", "col")], *[F.coalesce(F.col(c).cast("bigint"), F.lit(0)).alias(c) for c in channels])
    for axis, n_in, n_out in (("col", size[1], to[1]), ("row", size[0], to[0])):
        if n_in == n_out:
            continue
        # As long as an axis has pixels, so small enough for every task.
        weights = F.broadcast(pixels.sparkSession.createDataFrame(axis_weights(n_in, n_out), f"_out int, {axis} int, _w bigint"))
        other = "row" if axis == "col" else "col"
        summed = lambda c: F.shiftright(F.sum(F.col(c) * F.col("_w")) + F.lit(1 << (BITS - 1)), BITS)
        byte = lambda c: F.greatest(F.lit(0), F.least(F.lit(255), summed(c))).cast("bigint").alias(c)
        out = out.join(weights, axis).groupBy(*keys, other, "_out").agg(*map(byte, channels)).withColumnRenamed("_out", axis)
    return out.select(*keys, "row", "col", *[F.col(c).cast("int").alias(c) for c in channels])


@dataclass(frozen=True)
class Scoring:
    """How candidates are scored: tiles are squares of ``size`` pixels, seams are strips of ``strip``; scores are of channels from 0 to 1."""

    size: int
    strip: int = 48
    neighbours: str = "left+top"
    channels: tuple[str, ...] = ("r", "g", "b")
    seam_weights: tuple[tuple[str, float], ...] = tuple(seams.WEIGHTS.items())
    structure_px: int = 128
    structure_weight: float = 0.0
    structure_weights: tuple[tuple[str, float], ...] | None = None
    colour_weight: float = 0.0
    fallback_penalty: float = 0.0


def _shares(pixels: DataFrame, channels: tuple[str, ...], prefix: str = "") -> list[Column]:
    return [(F.col(c).cast("double") / 255).alias(prefix + c) for c in channels]


def _against(candidates: DataFrame, tiles: DataFrame, channels: tuple[str, ...], weights: dict[str, float], name: str) -> DataFrame:
    """x, y, variant and the score of each candidate against the tile at its own place."""
    theirs = tiles.select(*TILE, "row", "col", *_shares(tiles, channels, "_"))
    both = candidates.select(*CANDIDATE, "row", "col", *_shares(candidates, channels)).join(theirs, [*TILE, "row", "col"])
    return seams.pair_scores(both, CANDIDATE, channels, weights).withColumnRenamed("score", name)


def candidate_scores(candidates: DataFrame, chosen: DataFrame, inputs: DataFrame, scoring: Scoring, references: DataFrame | None = None) -> DataFrame:
    """x, y, variant with seam, structure, colour, penalty and total_score of candidates (x, y, variant, row, col, channels of 0 to 255, and perhaps ``fallback``).

    ``chosen``, ``inputs`` and ``references`` are tiles (x, y, row, col, channels). Seams are scored against chosen neighbours, structure on squares of ``structure_px`` against
    the reference tile, or the input where a tile has none; colour on whole tiles, null without a reference. Scores of weight 0 aren't computed, but colour where there are references.
    """
    channels = scoring.channels
    scaled = lambda df, keys: df.select(*keys, "row", "col", *_shares(df, channels))
    out = seams.strip_scores(scaled(candidates, CANDIDATE), scaled(chosen, TILE), scoring.size, scoring.strip, dict(scoring.seam_weights), scoring.neighbours, channels)
    if scoring.structure_weight > 0:
        base = inputs.select(*TILE, "row", "col", *channels)
        if references is not None:
            given = references.select(*TILE, "row", "col", *channels)
            base = given.unionByName(base.join(given.select(*TILE).distinct(), TILE, "left_anti"))
        weights = dict(scoring.structure_weights or (STRUCTURE if references is None else STRUCTURE_OF_REFERENCE).items())
        small = lambda df, keys: resampled(df, keys, (scoring.size,) * 2, (scoring.structure_px,) * 2, list(channels))
        out = out.join(_against(small(candidates, CANDIDATE), small(base, TILE), channels, weights, "structure"), CANDIDATE, "left")
    else:
        out = out.withColumn("structure", F.lit(None).cast("double"))
    out = out.withColumn("colour", F.lit(None).cast("double")) if references is None else out.join(_against(candidates, references, channels, COLOUR, "colour"), CANDIDATE, "left")
    fallback = F.coalesce(F.col("fallback"), F.lit(False)) if "fallback" in candidates.columns else F.lit(False)
    marked = candidates.groupBy(*CANDIDATE).agg(F.when(F.bool_or(fallback), F.lit(scoring.fallback_penalty)).otherwise(F.lit(0.0)).alias("penalty"))
    none = F.lit(0.0)
    total = F.col("seam") + F.coalesce("structure", none) * scoring.structure_weight + F.coalesce("colour", none) * scoring.colour_weight + F.col("penalty")
    return out.join(marked, CANDIDATE).select(*CANDIDATE, "seam", "structure", "colour", "penalty", total.alias("total_score"))


#: From what is asked (x, y, variant, key), the input tiles and the chosen tiles before them to answers (key, row, col, channels, error, fallback): a row a pixel, or one with an error.
Propose = Callable[[DataFrame, DataFrame, DataFrame], DataFrame]


def tile_digests(pixels: DataFrame, channels: tuple[str, ...], name: str) -> DataFrame:
    """x, y and a digest of each tile's pixels, whatever their order."""
    row = F.xxhash64("row", "col", *channels)
    facts = pixels.groupBy(*TILE).agg(F.count("*").alias("n"), F.sum(row.cast("decimal(38,0)")).cast("string").alias("s"), F.bit_xor(row).alias("b"))
    return facts.select(*TILE, F.sha2(F.concat_ws(":", "n", "s", "b"), 256).alias(name))


class Search:
    """Candidates asked for, scored and chosen along the anti-diagonals of a grid; all that is known lies in tables under ``root``, on a file system that all executors share.

    ``answers``: what was asked for, by a key of the configuration, the place, the variant, the input tile and the chosen neighbours; ``chosen``: pixels of the tiles chosen;
    ``scores``: what they won by. All are laid out by diagonal, a tile or key whole in one file, so a step reads its own diagonal and the two before it, and a commit that was cut off
    leaves whole tiles. A run that was broken off asks for nothing again that was answered without an error in a step that ended asking. Tiles already chosen stay.
    """

    def __init__(self, spark: SparkSession, root: str, config: dict, scoring: Scoring, variants: int, force: bool = False):
        self.spark, self.root, self.scoring, self.variants = spark, root.rstrip("/"), scoring, variants
        self.digest = sha256(json.dumps({"config": config, "scoring": asdict(scoring), "variants": variants}, sort_keys=True).encode()).hexdigest()
        self._guard(force)

    def _path(self, name: str) -> tuple[object, object]:
        jvm = self.spark.sparkContext._jvm
        at = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)
        return at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), at

    def _guard(self, force: bool) -> None:
        """Another configuration's results aren't mixed with this one's; ``force`` drops them."""
        system, at = self._path("")
        if force and system.exists(at):
            system.delete(at, True)
        known = self._path("config/_SUCCESS")
        if known[0].exists(known[1]):
            found = self.spark.read.text(f"{self.root}/config").first()
            if found is None or found[0] != self.digest:
                raise ValueError(f"{self.root} holds results of another configuration")
        elif any(s.exists(p) for s, p in map(self._path, ("answers", "chosen"))):
            raise ValueError(f"{self.root} holds results of an unknown configuration")
        else:
            self.spark.createDataFrame([(self.digest,)], "value string").coalesce(1).write.mode("overwrite").text(f"{self.root}/config")

    def _fields(self, name: str) -> str:
        pixels = "row int, col int, " + ", ".join(f"`{c}` int" for c in self.scoring.channels)
        return {"answers": f"key string, x int, y int, variant int, {pixels}, error string, fallback boolean", "chosen": f"x int, y int, {pixels}", "scores": "x int, y int, variant int, score double, candidates bigint, failed bigint"}[name]

    def read(self, name: str, *diagonals: int) -> DataFrame:
        """What is known: of some diagonals, or all; empty where nothing is."""
        schema = self._fields(name)
        if not diagonals:
            system, at = self._path(name)
            return self.spark.read.schema(schema).parquet(f"{self.root}/{name}/d=*") if system.exists(at) else self.spark.createDataFrame([], schema)
        there = [f"{self.root}/{name}/d={d}" for d in diagonals if (lambda s, p: s.exists(p))(*self._path(f"{name}/d={d}"))]
        return self.spark.read.schema(schema).parquet(*there) if there else self.spark.createDataFrame([], schema)

    def _keep(self, name: str, rows: DataFrame, d: int, *by: str) -> None:
        """Rows in the types of their table, appended to a diagonal."""
        kinds = [f.split(" ") for f in self._fields(name).replace("`", "").split(", ")]
        rows.select(*[F.col(c).cast(t).alias(c) for c, t in kinds]).repartition(*by).write.mode("append").parquet(f"{self.root}/{name}/d={d}")

    def _asked(self, inputs: DataFrame, before: DataFrame) -> DataFrame:
        """x, y, variant and key of everything that tiles need: the same inputs and neighbours have the same key."""
        channels, around = self.scoring.channels, tile_digests(before, self.scoring.channels, "theirs")
        tiles = tile_digests(inputs, channels, "own")
        for side, (dx, dy, _, words) in seams.SIDES.items():
            used = around if any(w in self.scoring.neighbours for w in words) else around.where("false")
            tiles = tiles.join(used.select((F.col("x") + dx).alias("x"), (F.col("y") + dy).alias("y"), F.col("theirs").alias(side)), TILE, "left")
        parts = [F.lit(self.digest), *[F.col(c).cast("string") for c in CANDIDATE], "own", *[F.coalesce(side, F.lit("-")) for side in seams.SIDES]]
        tiles = tiles.withColumn("variant", F.explode(F.sequence(F.lit(0), F.lit(self.variants - 1))))
        return tiles.select(*CANDIDATE, F.sha2(F.concat_ws(":", *parts), 256).alias("key"))

    def run(self, inputs: DataFrame, propose: Propose, references: DataFrame | None = None) -> DataFrame:
        """Scores of all tiles (x, y, row, col, channels) of the grid; a tile of which all candidates failed has a null variant, and is asked for again by the next run.

        A step for each diagonal that has tiles left, so at most as many as the grid's sides are long; rows never pass through the driver.
        """
        if self.variants < 1:
            raise ValueError("at least one variant must be asked for")
        inputs = inputs.where("x IS NOT NULL AND y IS NOT NULL")
        step = (F.col("x") + F.col("y")).cast("int")
        left = inputs.select(*TILE).distinct().join(self.read("chosen").select(*TILE).distinct(), TILE, "left_anti")
        for d in [r["d"] for r in left.select(step.alias("d")).distinct().orderBy("d").collect()]:
            done = self.read("chosen", d).select(*TILE).distinct()
            own = inputs.where(step == d).join(done, TILE, "left_anti")
            before = self.read("chosen", d - 1, d - 2)
            asked = self._asked(own, before)
            unknown = asked.join(self.read("answers", d).where("error IS NULL").select("key").distinct(), "key", "left_anti")
            if not unknown.isEmpty():
                answers = propose(unknown, own, before).join(asked, "key")
                self._keep("answers", answers, d, "key")
            sound = self.read("answers", d).where("error IS NULL").drop("x", "y", "variant").join(asked, "key")
            theirs = None if references is None else references.where(step == d)
            scored = candidate_scores(sound.drop("key", "error"), before, own, self.scoring, theirs)
            best = scored.groupBy(*TILE).agg(F.min(F.struct("total_score", "variant")).alias("b"), F.count("*").alias("n"))
            report = own.select(*TILE).distinct().join(best, TILE, "left")
            found = F.coalesce("n", F.lit(0))
            self._keep("scores", report.select(*TILE, F.col("b.variant").alias("variant"), F.col("b.total_score").alias("score"), F.lit(self.variants).alias("candidates"), (F.lit(self.variants) - found).alias("failed")), d, *TILE)
            # The pixels of what the table says was chosen, so both agree whatever is computed anew.
            winners = self.read("scores", d).where("variant IS NOT NULL").join(done, TILE, "left_anti").groupBy(*TILE).agg(F.min(F.struct("score", "variant")).alias("b")).select(*TILE, F.col("b.variant").alias("variant"))
            self._keep("chosen", sound.join(winners, CANDIDATE), d, *TILE)
        return self.scores()

    def scores(self) -> DataFrame:
        """One row a tile: what was chosen, or that all candidates failed."""
        # A step that was broken off between its tables has scored a tile twice.
        best = F.min(F.when(F.col("variant").isNotNull(), F.struct("score", "variant", "candidates", "failed")))
        last = self.read("scores").groupBy(*TILE).agg(best.alias("b"), F.max("candidates").alias("candidates"), F.max("failed").alias("failed"))
        return last.select(*TILE, F.col("b.variant").alias("variant"), F.col("b.score").alias("score"), F.coalesce("b.candidates", "candidates").alias("candidates"), F.coalesce("b.failed", "failed").alias("failed"))
