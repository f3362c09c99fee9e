"""Generation runs over prompts and tiles, with the model behind an interface, and the choice along a grid of tiles.

The model is any callable; ``echo`` is a deterministic stand-in. Requests are spread over partitions; a failed one is a row
with an error, never a failed job.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terraloom.functions.text import image_name, slug, tile_seed

Model = Callable[[str, int], bytes]


def echo(prompt: str, seed: int) -> bytes:
    """A stand-in whose answer depends on its inputs alone."""
    return f"{prompt}|{seed}".encode()


def prompts(lines: DataFrame, most: int | None = None) -> DataFrame:
    """prompt_no and prompt of the lines that are neither blank nor comments, in order; ``lines`` has line_no and value."""
    kept = lines.select("line_no", F.trim("value").alias("prompt")).where("prompt <> '' AND NOT startswith(prompt, '#')").orderBy("line_no")
    kept = kept if most is None else kept.limit(most)
    # A prompt file is a small, hand-written list: numbering it in one task is its size.
    return kept.selectExpr("row_number() OVER (ORDER BY line_no) AS prompt_no", "prompt")


def requests(prompts_: DataFrame, variants: int, base_seed: int) -> DataFrame:
    tasks = prompts_.withColumn("variant", F.explode(F.sequence(F.lit(0), F.lit(variants - 1))))
    seed = tile_seed(F.lit(base_seed), F.col("prompt_no"), F.lit(0), F.col("variant"))
    return tasks.withColumn("seed", seed).withColumn("file", image_name(F.col("prompt_no"), slug(F.col("prompt")), F.col("variant"), F.lit(0), F.lit("png")))


def with_retries(call: Callable[[], bytes], retryable: Callable[[Exception], bool], attempts: int, wait: Callable[[int], float], sleep: Callable[[float], None] = time.sleep) -> bytes:
    for attempt in range(attempts):
        try:
            return call()
        except Exception as e:
            if attempt + 1 == attempts or not retryable(e):
                raise
            sleep(wait(attempt))
    raise ValueError("no attempt was allowed")


def generated(requests_: DataFrame, model: Model, workers: int, attempts: int = 3) -> DataFrame:
    """The requests with ``content``, or ``error`` where all attempts failed; ``workers`` partitions ask at once."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            contents, errors = [], []
            for prompt, seed in zip(part["prompt"], part["seed"], strict=True):
                try:
                    contents.append(with_retries(lambda p=prompt, s=seed: model(p, int(s)), lambda e: isinstance(e, (TimeoutError, ConnectionError)), attempts, lambda n: min(0.5 * 2**n, 8.0)))
                    errors.append(None)
                except Exception as e:
                    contents.append(None)
                    errors.append(f"{type(e).__name__}: {e}")
            yield part.assign(content=contents, error=errors)

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in requests_.schema.fields)
    return requests_.repartition(workers).mapInPandas(run, f"{fields}, content binary, error string")


def run_report(rows: DataFrame) -> DataFrame:
    failed = F.col("error").isNotNull()
    return rows.agg(F.count("*").alias("total"), F.count_if(~failed).alias("ok"), F.count_if(failed).alias("failed"), (F.count("*") == F.count_if(failed)).alias("all_failed"))


def response_images(response: Column) -> Column:
    """Of a JSON answer the mime type and data of the first inline or file part of each candidate; null if it was blocked or has none."""
    node = F.try_parse_json(response)
    parts = "array<struct<content:struct<parts:array<struct<inlineData:struct<mimeType:string,data:string>,fileData:struct<mimeType:string,fileUri:string>>>>>>"
    candidates = F.from_json(F.get_json_object(response, "$.candidates"), parts)
    first = F.transform(candidates, lambda c: F.get(F.filter(c["content"]["parts"], lambda p: p["inlineData"].isNotNull() | p["fileData"].isNotNull()), F.lit(0)))
    found = F.transform(F.filter(first, lambda p: p.isNotNull()), lambda p: F.struct(F.coalesce(p["inlineData"]["mimeType"], p["fileData"]["mimeType"]).alias("mime"), p["inlineData"]["data"].alias("data"), p["fileData"]["fileUri"].alias("uri")))
    blocked = F.get_json_object(response, "$.promptFeedback.blockReason").isNotNull()
    return F.when(node.isNotNull() & ~blocked & (F.size(found) > 0), found)


def cache_key(fields: dict[str, Column]) -> Column:
    """A digest of named values in name order, as compact as ``json.dumps(sort_keys=True)`` with its default separators writes strings and numbers."""
    parts = []
    for i, name in enumerate(sorted(fields)):
        shown = F.to_json(F.array(fields[name]))
        parts += [F.lit(f"{', ' if i else ''}{json.dumps(name)}: "), F.regexp_replace(shown, r"^\[|\]$", "")]
    return F.sha2(F.concat(F.lit("{"), *parts, F.lit("}")), 256)


def checkpoint_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share for tables between steps."""
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if folder is None:
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return folder


def chosen_along_grid(own: DataFrame, pairs: DataFrame) -> DataFrame:
    """One candidate a tile: its own cost plus seam costs to the chosen left and upper neighbours is least, ties to the lowest variant.

    ``own``: x, y, variant, cost; ``pairs``: x, y, variant, ox, oy, other_variant, cost (from a tile to its left or upper neighbour).
    Tiles on an anti-diagonal don't depend on each other, so each diagonal is one step; pair costs are known beforehand. Costs are laid
    out by diagonal once, and a step reads its own and what the last one wrote, so all steps together read every row twice at most.
    The tables lie in the folder of ``spark.checkpoint.dir``, which must be set.
    """
    spark, root = own.sparkSession, f"{checkpoint_folder(own.sparkSession)}/grid-{uuid.uuid4().hex}"

    def laid_out(df: DataFrame, name: str) -> DataFrame:
        rows = df.withColumn("d", (F.col("x") + F.col("y")).cast("int"))
        rows.repartition("d").write.partitionBy("d").parquet(f"{root}/{name}")
        return spark.read.schema(rows.schema).parquet(f"{root}/{name}")

    costs, seams = laid_out(own, "own"), laid_out(pairs, "pairs")
    form = "x int, y int, variant int, score double"
    last = spark.createDataFrame([], form)
    steps = [r["d"] for r in costs.select("d").distinct().orderBy("d").collect()]
    for d in steps:
        left = last.select(F.col("x").alias("ox"), F.col("y").alias("oy"), F.col("variant").alias("other_variant"))
        seam = seams.where(F.col("d") == d).join(left, ["ox", "oy", "other_variant"]).groupBy("x", "y", "variant").agg(F.sum("cost").alias("seam"))
        total = costs.where(F.col("d") == d).join(seam, ["x", "y", "variant"], "left").withColumn("score", F.col("cost") + F.coalesce("seam", F.lit(0.0)))
        best = total.groupBy("x", "y").agg(F.min(F.struct("score", "variant")).alias("b")).select("x", "y", F.col("b.variant").cast("int").alias("variant"), F.col("b.score").alias("score"))
        best.write.parquet(f"{root}/chosen/d={d}")
        last = spark.read.schema(form).parquet(f"{root}/chosen/d={d}")
    return spark.read.schema(f"{form}, d int").parquet(f"{root}/chosen").drop("d") if steps else last
