"""Streams with one text column `value`."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


ROWS_PER_BATCH = 10_000_000
FILES_PER_BATCH = 1_000


def kafka_stream(
    spark: SparkSession, servers: str, topic: str, starting: str = "latest", rows_per_batch: int = ROWS_PER_BATCH, **options: str
) -> DataFrame:
    """A topic from its latest or earliest offset; a checkpoint overrides `starting`.

    A backlog is taken in micro-batches of at most about `rows_per_batch` rows.
    """
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .option("maxOffsetsPerTrigger", rows_per_batch)
        .options(**options)
        .load()
        .select(F.col("value").cast("string").alias("value"))
    )


def file_stream(spark: SparkSession, path: str, files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """Lines of text files, the drop-in for a topic."""
    return spark.readStream.format("text").option("maxFilesPerTrigger", files_per_batch).load(path)
