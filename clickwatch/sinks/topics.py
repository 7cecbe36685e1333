"""Rows as one JSON text each: topic records or console lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter


def as_json(df: DataFrame, *columns: str | Column) -> DataFrame:
    return df.select(F.to_json(F.struct(*(columns or df.columns))).alias("value"))


def topic_writer(records: DataFrame, servers: str, topic: str) -> DataStreamWriter:
    """Kafka writer that waits for all replicas."""
    return (
        records.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("kafka.acks", "all")
        .option("topic", topic)
    )


def file_topic_writer(records: DataFrame, path: str) -> DataStreamWriter:
    """The same records as lines of text files."""
    return records.writeStream.format("text").option("path", path)


def console_writer(records: DataFrame) -> DataStreamWriter:
    return records.writeStream.format("console").option("truncate", "false")
