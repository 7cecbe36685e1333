"""Batch sources: offline feature table, JDBC tables, stored parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clickwatch.operators.dataset import Preprocessing
from clickwatch.schemas import FOREST_NODE, MODEL_DOCUMENT, OFFLINE_FEATURE


def read_offline(spark: SparkSession, root: str) -> DataFrame:
    """All dates of the offline table; its date column prunes directories."""
    return spark.read.schema(OFFLINE_FEATURE).parquet(root)


def read_jdbc(
    spark: SparkSession, url: str, table: str, time: str, lower: str, upper: str, partitions: int = 16, **options: str
) -> DataFrame:
    """A database table read in parallel over ranges of its time column."""
    return (
        spark.read.format("jdbc")
        .options(url=url, dbtable=table, **options)
        .option("partitionColumn", time)
        .option("lowerBound", lower)
        .option("upperBound", upper)
        .option("numPartitions", partitions)
        .load()
    )


def read_model(spark: SparkSession, path: str) -> tuple[DataFrame, Preprocessing, float | None]:
    """(node table, parameters, threshold) of a written model."""
    row = spark.read.schema(MODEL_DOCUMENT).json(f"{path}/document").first()
    params = Preprocessing(tuple(row["mean"]), tuple(row["scale"]), row["cnt_cap"])
    return spark.read.schema(FOREST_NODE).parquet(f"{path}/nodes"), params, row["threshold"]
