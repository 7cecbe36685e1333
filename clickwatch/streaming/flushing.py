"""Hourly files of a slow or a fast stream: flushed after so many rows or so much time, whichever comes first."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from clickwatch import constants as C
from clickwatch.session import ROCKSDB_PROVIDER
from clickwatch.sinks.files import LAKE_PARTITIONS
from clickwatch.sinks.online_store import QUERY_ID
from clickwatch.streaming.jobs import run

LINES, PROGRESS = "lines", "progress"
_KEY = (*LAKE_PARTITIONS, "lane")
_OUTPUT = "y STRING, m STRING, d STRING, h STRING, lane INT, flush BIGINT, cause STRING, value STRING"


class BufferedLines(StatefulProcessor):
    """Holds the lines of a key as list state; a processing-time timer is set when the first one waits.

    `rows` lines leave as one flush (`size`), what waits when the timer ends leaves as one (`time`). Flushes of
    a key are numbered. A line is either in the state or in a flush, so a restart loses and doubles none.
    """

    def __init__(self, rows: int, wait_ms: int) -> None:
        self.rows, self.wait_ms = rows, wait_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.lines = handle.getListState(LINES, "value STRING")
        self.progress = handle.getValueState(PROGRESS, "waiting INT, flush BIGINT, timer BIGINT")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        waiting, number, timer = self.progress.get() or (0, 0, 0)
        fresh: list[str] = []  # fewer than `rows` between two frames
        for frame in rows:
            fresh += frame["value"].tolist()
            if waiting + len(fresh) < self.rows:
                continue
            if waiting:
                fresh = [line for (line,) in self.lines.get()] + fresh
                self.lines.clear()
                waiting = 0
            if timer:
                self.handle.deleteTimer(timer)
                timer = 0
            full = len(fresh) // self.rows
            leaving, fresh = fresh[: full * self.rows], fresh[full * self.rows :]
            yield self._flushed(key, np.repeat(np.arange(number, number + full), self.rows), "size", leaving)
            number += full
        if fresh:
            self.lines.appendList([(line,) for line in fresh])
            waiting += len(fresh)
        if waiting and not timer:
            timer = timerValues.getCurrentProcessingTimeInMs() + self.wait_ms
            self.handle.registerTimer(timer)
        self.progress.update((waiting, number, timer))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        waiting, number, _ = self.progress.get() or (0, 0, 0)
        if not waiting:
            return
        held = [line for (line,) in self.lines.get()]
        self.lines.clear()
        self.progress.update((0, number + 1, 0))
        yield self._flushed(key, np.full(len(held), number), "time", held)

    @staticmethod
    def _flushed(key, numbers: np.ndarray, cause: str, lines: list[str]) -> pd.DataFrame:
        fixed = {name: [value] * len(lines) for name, value in zip(_KEY, key)}
        return pd.DataFrame({**fixed, "flush": numbers, "cause": [cause] * len(lines), "value": lines})

    def close(self) -> None:
        pass


def flushed_lines(lines: DataFrame, rows: int, wait_seconds: float, lanes: int) -> DataFrame:
    """Lines (`value`, with the lake's path columns) as they leave the buffer of their hour.

    An hour has `lanes` buffers, dealt by a hash of the line, so that a busy hour is held by several tasks.
    """
    lines.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    lane = F.pmod(F.xxhash64("value"), F.lit(lanes)).cast("int").alias("lane")
    keyed = lines.select(*LAKE_PARTITIONS, lane, "value").groupBy(*_KEY)
    processor = BufferedLines(rows, int(wait_seconds * 1000))
    return keyed.transformWithStateInPandas(processor, _OUTPUT, "Append", "ProcessingTime")


def flush_writer(
    lines: DataFrame,
    root: str,
    rows: int = C.LAKE_BATCH_ROWS,
    wait_seconds: float = C.LAKE_BATCH_SECONDS,
    lanes: int = 1,
) -> DataStreamWriter:
    """One file per flush, below the query's id and the batch number, so a repeated batch replaces itself.

    A line goes with its flush's number. A folder holds the flushes of a buffer by cause: those by size are
    written in order and cut after `rows` lines, by time there is one a batch.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty(QUERY_ID) or "batch"
        ordered = batch.sortWithinPartitions(*_KEY, "cause", "flush")
        out = ordered.write.mode("overwrite").partitionBy(*_KEY, "cause").option("maxRecordsPerFile", rows)
        out.json(f"{root}/query={query}/batch={batch_id}")

    return flushed_lines(lines, rows, wait_seconds, lanes).writeStream.outputMode("append").foreachBatch(write)


def run_once(spark: SparkSession, writer: DataStreamWriter, checkpoint: str) -> None:
    """Take in what is there, let timers that are due end, and stop.

    Spark always has another batch ready for a job with processing-time timers, which a running job needs, but
    with which a run over what is available would not stop; so it goes without batches that have no rows.
    """
    setting = "spark.sql.streaming.noDataMicroBatches.enabled"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "false")
    try:
        run(writer, checkpoint, available_now=True).awaitTermination()
    finally:
        spark.conf.set(setting, before)


def read_flushes(spark: SparkSession, root: str) -> DataFrame:
    """Lines with the flush they came with: query, batch, path columns, lane, flush, cause, value."""
    schema = f"value STRING, query STRING, batch BIGINT, {_OUTPUT.removesuffix(', value STRING')}"
    return spark.read.schema(schema).json(root)
