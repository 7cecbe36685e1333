"""Counts that a running stream observes, kept in a table per query and micro-batch."""

from __future__ import annotations

import json
import threading
from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

OBSERVED = "query_id STRING, batch_id BIGINT, name STRING, metric STRING, value BIGINT"


class ObservedMetrics(StreamingQueryListener):
    """Writes the observed metrics of every progress report below `root`, by query and batch number.

    A repeated batch replaces its own file, so the table counts it once. Register with
    `spark.streams.addListener`. Reports come behind the query; `wait` returns once all of a
    query that has ended are in the table.
    """

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root
        self.ended: dict[str, threading.Event] = defaultdict(threading.Event)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = json.loads(event.progress.json)
        query, batch = progress["id"], progress["batchId"]
        found = progress.get("observedMetrics") or {}
        rows = [(query, batch, name, m, int(v)) for name, metrics in found.items() for m, v in metrics.items() if v is not None]
        if rows and progress.get("numInputRows"):
            table = self.spark.createDataFrame(rows, OBSERVED).coalesce(1)
            table.write.mode("overwrite").parquet(f"{self.root}/{query}/{batch}")

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended[str(event.runId)].set()

    def wait(self, query: StreamingQuery, seconds: float = 60) -> None:
        if not self.ended[str(query.runId)].wait(seconds):
            raise TimeoutError(f"no report of the end of {query.id}")


def read_observed(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(OBSERVED).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").parquet(root)


def observed_totals(observed: DataFrame, name: str) -> DataFrame:
    """metric and its total over all batches."""
    return observed.filter(F.col("name") == name).groupBy("metric").agg(F.sum("value").alias("total"))
