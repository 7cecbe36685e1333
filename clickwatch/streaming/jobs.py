"""The continuous jobs: events to features, to tables, to latest values, to alerts.

Every job is one query with its own checkpoint; the feature topic is the
interface between them. Late rows follow Spark's rule: a row is dropped once the
watermark of the previous batch has passed its window.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery, StreamingQueryListener

from clickwatch import constants as C
from clickwatch.functions import rules
from clickwatch.functions.timefmt import parse_utc
from clickwatch.operators.dataset import SERVING, Preprocessing
from clickwatch.operators.feature_store import latest_online
from clickwatch.operators.forest import Scorer
from clickwatch.operators.scoring import alerts, flagged, scored
from clickwatch.operators.windows import KEYS, as_messages, window_features
from clickwatch.schemas import FEATURE_MESSAGE, LENIENT_FEATURE_MESSAGE
from clickwatch.sinks import online_store
from clickwatch.sinks.files import LAKE_PARTITIONS, lake_rows
from clickwatch.sources.clickstream import parse_events, to_table_rows, window_input


def run(writer: DataStreamWriter, checkpoint: str, available_now: bool = False, every: str = C.CHECKPOINT_INTERVAL) -> StreamingQuery:
    """Start a job: continuously, or over what is there now and then stop."""
    writer = writer.option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=every)
    return writer.start()


# --- events to features -----------------------------------------------------------


def feature_stream(raw: DataFrame, delay: str = C.WATERMARK_DELAY) -> DataFrame:
    """Sliding-window feature messages from raw event text, emitted when closed."""
    timed = window_input(raw).withWatermark("ts", delay)
    return as_messages(window_features(timed, C.WINDOW_SIZE, C.WINDOW_SLIDE))


def window_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Open windows of the window job, from the state its next run starts from: window_end, keys, event_count."""
    state = spark.read.format("statestore").load(checkpoint)
    return state.select(F.col("key.window.end").alias("window_end"), *[f"key.{k}" for k in KEYS], F.col("value.count").alias("event_count"))


# --- events to table and lake --------------------------------------------------------


def checked_events(raw: DataFrame, name: str = "ingest") -> DataFrame:
    """Parsed events with their text and failed rules, from one parse; counts are observed as `name`."""
    checks = rules.click_event_rules()
    return rules.check(parse_events(raw, keep_text=True).observe(name, *rules.quality_metrics(checks)), checks)


def valid_rows(checked: DataFrame) -> DataFrame:
    return to_table_rows(checked.filter(F.size("failed_rules") == 0)).drop("value")


def rejected_rows(checked: DataFrame) -> DataFrame:
    return checked.filter(F.size("failed_rules") > 0)


def ingest_writer(
    checked: DataFrame, append: Callable[[DataFrame, int], None], quarantine: Callable[[DataFrame, int], None]
) -> DataStreamWriter:
    """Each micro-batch is parsed once; its valid rows go to `append`, the others to `quarantine`.

    Both get the batch number, by which a repeated batch can replace itself.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            append(valid_rows(batch).withColumn("created_at", F.current_timestamp()), batch_id)
            quarantine(rejected_rows(batch), batch_id)
        finally:
            batch.unpersist()

    return checked.writeStream.foreachBatch(write)


def lake_writer(rows: DataFrame, root: str, rows_per_file: int = C.LAKE_FILE_ROWS) -> DataStreamWriter:
    """Hourly JSON files, flushed by size or by trigger, exactly once.

    Small flushes (`C.LAKE_BATCH_ROWS`) are for slow topics: they make a file per so many rows.
    """
    return (
        lake_rows(rows)
        .writeStream.format("json")
        .partitionBy(*LAKE_PARTITIONS)
        .option("maxRecordsPerFile", rows_per_file)
        .option("path", root)
    )


# --- features to latest values ---------------------------------------------------------


def parsed_features(raw: DataFrame, strict: bool) -> DataFrame:
    """Valid feature messages from text; strict for scoring, lenient for storing."""
    if strict:
        parsed = rules.parse_json(raw, FEATURE_MESSAGE)
        kept = rules.keep_valid(parsed, rules.strict_feature_rules())
        return kept.withColumn("event_count", F.col("event_count").cast("bigint")).drop(rules.CORRUPT)
    parsed = rules.parse_json(raw, LENIENT_FEATURE_MESSAGE)
    return rules.keep_valid(parsed, rules.lenient_feature_rules()).drop(rules.CORRUPT)


def online_writer(raw: DataFrame, root: str) -> DataStreamWriter:
    """Newest row per key, kept as state and upserted whenever a key was touched."""
    timed = parsed_features(raw, strict=False).withColumn("window_end", parse_utc(F.col("window_end")))
    newest = latest_online(timed.filter(F.col("window_end").isNotNull()))
    return newest.writeStream.outputMode("update").foreachBatch(
        lambda batch, batch_id: online_store.upsert(batch, batch_id, root)
    )


# --- features to alerts --------------------------------------------------------------------


def alert_stream(raw: DataFrame, scorer: Scorer, threshold: float, params: Preprocessing = SERVING) -> DataFrame:
    """Stateless: validate, score inside the JVM, keep flagged windows."""
    return alerts(flagged(scored(parsed_features(raw, strict=True), scorer, params, in_jvm=True), threshold))


# --- lag ------------------------------------------------------------------------------------


def offset_rows(sources: list[dict]) -> list[tuple[str, int, int, int]]:
    """(topic, partition, high water, processed) of the Kafka sources in a progress report."""

    def by_partition(offsets: str | dict | None) -> dict[tuple[str, int], int]:
        offsets = json.loads(offsets) if isinstance(offsets, str) else offsets or {}
        topics = offsets.items() if isinstance(offsets, dict) else ()
        return {(t, int(p)): int(o) for t, parts in topics if isinstance(parts, dict) for p, o in parts.items()}

    rows = []
    for source in sources:
        latest, done = by_partition(source.get("latestOffset")), by_partition(source.get("endOffset"))
        rows += [(*at, latest[at], done[at]) for at in sorted(latest.keys() & done.keys())]
    return rows


def progress_offsets(spark: SparkSession, query: StreamingQuery) -> tuple[DataFrame, DataFrame]:
    """(high water, processed) per topic partition from a Kafka query's last progress."""
    rows = offset_rows((query.lastProgress or {}).get("sources", []))
    schema = "topic STRING, partition INT, offset BIGINT"
    latest = spark.createDataFrame([(t, p, high) for t, p, high, _ in rows], schema)
    return latest, spark.createDataFrame([(t, p, done) for t, p, _, done in rows], schema)


class LagListener(StreamingQueryListener):
    """Hands (query name, topic, partition, high water, processed, lag) of every progress report to `report`.

    Register with `spark.streams.addListener`; it is called after every micro-batch of every query.
    """

    def __init__(self, report: Callable[[list[tuple[str, str, int, int, int, int]]], None]) -> None:
        self.report = report

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = json.loads(event.progress.json)
        name = progress.get("name") or progress.get("id")
        rows = [(name, *row, max(0, row[2] - row[3])) for row in offset_rows(progress.get("sources", []))]
        if rows:
            self.report(rows)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
