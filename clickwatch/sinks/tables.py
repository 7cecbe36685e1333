"""Table sinks: appends to parquet or, with a driver on the class path, to JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame

from clickwatch.sinks.online_store import QUERY_ID


def append_batch(rows: DataFrame, batch_id: int, path: str) -> None:
    """A micro-batch below its query's id and number: repeating it replaces it, so every row is stored once."""
    query = rows.sparkSession.sparkContext.getLocalProperty(QUERY_ID) or "batch"
    rows.write.mode("overwrite").parquet(f"{path}/{query}/{batch_id}")


def read_batches(spark, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").parquet(path)


def append_jdbc(rows: DataFrame, url: str, table: str, partitions: int = 16, **options: str) -> None:
    """Batched inserts over a bounded number of connections."""
    (
        rows.coalesce(partitions)
        .write.format("jdbc")
        .mode("append")
        .options(url=url, dbtable=table, batchsize="10000", **options)
        .save()
    )
