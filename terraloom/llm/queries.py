"""The queries of the training-data operators, each over its whole table, and the SQL of those that SQL can express."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from terraloom.llm import alignment, decontamination, divergence, language_id, language_model, media, near_dedup, packing, quality, secrets, token_counts, toxicity, warc
from terraloom.llm.common import load, scratch_dir, written


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.report(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = written(token_counts.measured(load(spark, sf_dir, "documents")), "measured")
    return token_counts.maintained(token_counts.Rollup(spark, f"{scratch_dir(spark)}/rollup-{uuid.uuid4().hex}"), rows)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(load(spark, sf_dir, "documents"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


def op5_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The driver's tables hold no images: each embedding is drawn as one, and an edited copy of each is added."""
    return media.copies(media.gallery(load(spark, sf_dir, "embeddings")))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.predict(load(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(load(spark, sf_dir, "documents"))


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(load(spark, sf_dir, "documents"))


def op10_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score(load(spark, sf_dir, "documents"))


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(load(spark, sf_dir, "documents"))


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.revisited(load(spark, sf_dir, "pages"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.report(load(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1_decontamination,
    "op2_token_counts": op2_token_counts,
    "op3_packing": op3_packing,
    "op4_quality": op4_quality,
    "op5_media": op5_media,
    "op6_language_id": op6_language_id,
    "op7_toxicity": op7_toxicity,
    "op8_near_dedup": op8_near_dedup,
    "op9_secrets": op9_secrets,
    "op10_language_model": op10_language_model,
    "op11_divergence": op11_divergence,
    "op12_warc": op12_warc,
    "op13_alignment": op13_alignment,
}

ORACLES: dict[str, str] = {"op1_decontamination": decontamination.SQL, "op8_near_dedup": near_dedup.SQL, "op11_divergence": divergence.SQL, "op12_warc": warc.SQL}
