"""File sinks: offline feature table, hourly JSON lake, JSON documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickwatch.operators.feature_store import offline_rows
from clickwatch.operators.dataset import Preprocessing
from clickwatch.schemas import MODEL_DOCUMENT

LAKE_PARTITIONS = ("y", "m", "d", "h")


def write_offline(features: DataFrame, root: str) -> None:
    """Feature rows by date, in time order inside each file; reruns replace their dates.

    Rows are spread by ranges of (date, time), not by date alone: a date holding
    most rows is written by several tasks, and each file covers a short time span.
    """
    (
        offline_rows(features)
        .repartitionByRange("ingest_date", "window_end", "geo", "platform")
        .sortWithinPartitions("ingest_date", "window_end")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("ingest_date")
        .parquet(root)
    )


def lake_rows(events: DataFrame, time: str = "timestamp") -> DataFrame:
    """Each event with the parts of its own hour as path columns."""
    ts = F.col(time)
    return events.withColumns(
        {
            "y": F.date_format(ts, "yyyy"),
            "m": F.date_format(ts, "MM"),
            "d": F.date_format(ts, "dd"),
            "h": F.date_format(ts, "HH"),
        }
    )


def write_lake(events: DataFrame, root: str, time: str = "timestamp", rows_per_file: int = 1_000_000) -> None:
    """Events as JSON under y/m/d/h.

    Rows of an hour are brought together so that it gets few files; the rebalance
    splits an hour holding most rows over several tasks and merges small ones.
    """
    (
        lake_rows(events, time)
        .hint("rebalance", *[F.col(c) for c in LAKE_PARTITIONS])
        .write.mode("append")
        .option("maxRecordsPerFile", rows_per_file)
        .partitionBy(*LAKE_PARTITIONS)
        .json(root)
    )


def write_document(spark, path: str, schema: T.StructType, **fields) -> None:
    """A one-row JSON document of a declared schema: parameters, sizes, metrics, threshold."""
    row = tuple(fields.get(name) for name in schema.fieldNames())
    spark.createDataFrame([row], schema).coalesce(1).write.mode("overwrite").json(path)


def write_model(nodes: DataFrame, path: str, params: Preprocessing, threshold: float | None = None, **sizes: int) -> None:
    """A node table and the document of parameters, threshold and split sizes it goes with."""
    nodes.write.mode("overwrite").parquet(f"{path}/nodes")
    fields = {"mean": list(params.mean), "scale": list(params.scale), "cnt_cap": float(params.count_cap), "threshold": threshold}
    write_document(nodes.sparkSession, f"{path}/document", MODEL_DOCUMENT, **fields, **sizes)
