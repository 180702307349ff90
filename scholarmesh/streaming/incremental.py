"""Incremental forms: late and repeated candidates, windowed counts, and a sink of mergeable statistics."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def stream(spark: SparkSession, folder: str, schema: T.StructType, files: int = 16) -> DataFrame:
    """A folder of Parquet files as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(folder)


def once(candidates: DataFrame, late: str = "30 days") -> DataFrame:
    """Match candidates without those loaded again within the watermark on created_at."""
    return candidates.withWatermark("created_at", late).dropDuplicatesWithinWatermark(["id"])


def windowed(candidates: DataFrame, width: str = "1 day", late: str = "30 days") -> DataFrame:
    """(start, score_type, n, total, best) per window of created_at; rows later than the watermark are left out."""
    valid = candidates.filter("score is not null and not isnan(score)").withWatermark("created_at", late)
    g = valid.groupBy(F.window("created_at", width), "score_type").agg(F.count("*").alias("n"), F.sum("score").alias("total"), F.max("score").alias("best"))
    return g.select(F.col("window.start").alias("start"), "score_type", "n", "total", "best")


def each_batch(df: DataFrame, checkpoint: str, handle: Callable[[DataFrame, int], None]) -> None:
    """Processes what's there in batches and ends; a batch that was handled isn't again after a restart."""
    df.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
