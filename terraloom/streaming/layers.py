"""Layers that grow as files arrive. The surveyed work runs in batches only; this is an addition, not parity."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from terraloom.operators.ingest import ingest
from terraloom.sources.geojsonseq import STRIP


def grow_layer(spark: SparkSession, source: str, layer: str, target: str, checkpoint: str) -> StreamingQuery:
    """Ingest every new file of text sequences below ``source`` into ``target``, a folder for each micro-batch.

    A micro-batch that runs again overwrites its own folder, so a restart neither loses nor repeats features.
    """
    lines = spark.readStream.text(source).select(F.regexp_replace("value", STRIP, "").alias("line")).where("line <> ''")

    def keep(batch: DataFrame, number: int) -> None:
        rows, _ = ingest(batch, layer)
        rows.write.mode("overwrite").parquet(f"{target}/batch={number}")

    return lines.writeStream.foreachBatch(keep).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
