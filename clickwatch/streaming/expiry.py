"""Latest values per key that leave state and table once they are older than their time to live."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from clickwatch import constants as C
from clickwatch.functions.timefmt import parse_utc
from clickwatch.operators.feature_store import online_rows
from clickwatch.operators.windows import KEYS
from clickwatch.session import ROCKSDB_PROVIDER
from clickwatch.sinks import online_store
from clickwatch.streaming.jobs import parsed_features

STATE = "newest"
_VALUES = "micros BIGINT, ctr_avg FLOAT, bounce_rate_avg FLOAT, event_count BIGINT"
_UPSERT = f"geo STRING, platform STRING, {_VALUES}, gone BOOLEAN"


class NewestUntilExpired(StatefulProcessor):
    """Keeps the newest row of a key and one event-time timer, at which the row is forgotten and a tombstone sent.

    A row that is already older than `ttl_micros` when it comes is not taken up.
    """

    def __init__(self, ttl_micros: int) -> None:
        self.ttl = ttl_micros

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.newest = handle.getValueState(STATE, _VALUES)

    def _expiry(self, micros: int) -> int:
        """In milliseconds, never before the time to live is over."""
        return -(-(micros + self.ttl) // 1000)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        best = None
        for frame in rows:
            row = frame.loc[frame["micros"].idxmax()]
            if best is None or row["micros"] > best[0]:
                best = tuple(row[c] for c in ("micros", "ctr_avg", "bounce_rate_avg", "event_count"))
        held = self.newest.get()
        if best is None or (held is not None and held[0] >= best[0]):
            return
        if self._expiry(int(best[0])) <= timerValues.getCurrentWatermarkInMs():
            return
        if held is not None:
            self.handle.deleteTimer(self._expiry(held[0]))
        row = (int(best[0]), float(best[1]), float(best[2]), int(best[3]))
        self.newest.update(row)
        self.handle.registerTimer(self._expiry(row[0]))
        yield self._output(key, row, False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held = self.newest.get()
        if held is None:
            return
        self.newest.clear()
        # newer than the row it takes away, older than any row to come
        yield self._output(key, (held[0] + 1, *held[1:]), True)

    @staticmethod
    def _output(key, row: tuple, gone: bool) -> pd.DataFrame:
        return pd.DataFrame([(*key, *row, gone)], columns=[c.split()[0] for c in _UPSERT.split(", ")])

    def close(self) -> None:
        pass


def newest_until_expired(features: DataFrame, ttl_seconds: int, delay: str) -> DataFrame:
    """Online rows and tombstones (`gone`) from feature rows, as they change."""
    features.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    online = online_rows(features).withWatermark("event_timestamp", delay)
    rows = online.withColumn("micros", F.unix_micros("event_timestamp"))
    changed = rows.groupBy(*KEYS).transformWithStateInPandas(NewestUntilExpired(ttl_seconds * 1_000_000), _UPSERT, "Update", "EventTime")
    return changed.withColumn("event_timestamp", F.timestamp_micros("micros")).drop("micros")


def expiring_writer(raw: DataFrame, root: str, ttl_seconds: int = C.ONLINE_TTL_SECONDS, delay: str = C.WATERMARK_DELAY) -> DataStreamWriter:
    """Upserts newest rows and takes expired keys out of the online table."""
    timed = parsed_features(raw, strict=False).withColumn("window_end", parse_utc(F.col("window_end")))
    changed = newest_until_expired(timed.filter(F.col("window_end").isNotNull()), ttl_seconds, delay)
    return changed.writeStream.outputMode("update").foreachBatch(
        lambda batch, batch_id: online_store.upsert(batch, batch_id, root)
    )
