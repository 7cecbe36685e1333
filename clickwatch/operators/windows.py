"""Event-time window features per geography and platform."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickwatch import constants as C
from clickwatch.functions.scalars import half_up_mean, to_units
from clickwatch.functions.timefmt import iso_utc

KEYS = ("geo", "platform")


def _seconds(duration: str) -> int:
    number, unit = duration.split()
    return int(number) * {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.rstrip("s")]


# Doubles are summed in units of 10^-9, decimals in units of their own last digit.
_DOUBLE_DIGITS = 9
_RATIOS = {"ctr": C.CTR_DIGITS, "bounce_rate": C.BOUNCE_DIGITS}


def _input_digits(df: DataFrame, column: str) -> int:
    kind = df.schema[column].dataType
    if isinstance(kind, T.DecimalType):
        return max(kind.scale, _RATIOS[column])
    return _DOUBLE_DIGITS


def _sums(df: DataFrame) -> list[Column]:
    ctr, bounce = (to_units(F.col(c), _input_digits(df, c)) for c in _RATIOS)
    return [F.sum(ctr).alias("c"), F.sum(bounce).alias("b"), F.count(F.lit(1)).alias("n")]


def _means(df: DataFrame) -> list[Column]:
    n = F.col("n")
    ctr_digits, bounce_digits = (_input_digits(df, c) for c in _RATIOS)
    return [
        half_up_mean(F.col("c"), n, ctr_digits, C.CTR_DIGITS).alias("ctr_avg"),
        half_up_mean(F.col("b"), n, bounce_digits, C.BOUNCE_DIGITS).alias("bounce_rate_avg"),
        n.alias("event_count"),
    ]


def window_features(
    events: DataFrame,
    size: str = C.WINDOW_SIZE,
    slide: str | None = None,
    keys: Sequence[str] = KEYS,
) -> DataFrame:
    """Windows straight from Spark's `window`; the form streams use.

    `slide=None` gives tumbling windows.
    """
    window = F.window("ts", size, slide) if slide else F.window("ts", size)
    sums = events.groupBy(window.alias("w"), *keys).agg(*_sums(events))
    return sums.select(
        F.col("w.start").alias("window_start"),
        F.col("w.end").alias("window_end"),
        *keys,
        *_means(events),
    )


def sliding_features(
    events: DataFrame,
    size: str = C.WINDOW_SIZE,
    slide: str = C.WINDOW_SLIDE,
    keys: Sequence[str] = KEYS,
) -> DataFrame:
    """Sliding windows for bounded input, built from panes.

    Every event is aggregated once into its pane (one slide long) and only the
    panes, a few per key and minute however many events there are, are copied
    into the windows covering them. The event-sized data is neither multiplied
    by size/slide nor shuffled: partial sums per (pane, keys) are.
    """
    size_s, slide_s = _seconds(size), _seconds(slide)
    if size_s % slide_s:
        return window_features(events, size, slide, keys)
    second = F.unix_seconds("ts")
    panes = events.groupBy((second - F.pmod(second, F.lit(slide_s))).alias("pane"), *keys).agg(*_sums(events))
    starts = F.array(*[F.col("pane") - F.lit(o) for o in range(0, size_s, slide_s)])
    sums = (
        panes.select(F.explode(starts).alias("start"), *keys, "c", "b", "n")
        .groupBy("start", *keys)
        .agg(F.sum("c").alias("c"), F.sum("b").alias("b"), F.sum("n").alias("n"))
    )
    return sums.select(
        F.timestamp_seconds("start").alias("window_start"),
        F.timestamp_seconds(F.col("start") + F.lit(size_s)).alias("window_end"),
        *keys,
        *_means(events),
    )


def tumbling_features(events: DataFrame, size: str = C.WINDOW_SIZE, keys: Sequence[str] = KEYS) -> DataFrame:
    return window_features(events, size, None, keys)


def as_messages(features: DataFrame) -> DataFrame:
    """Window bounds as ISO text, the feature message's fields in order."""
    return features.select(
        iso_utc(F.col("window_start")).alias("window_start"),
        iso_utc(F.col("window_end")).alias("window_end"),
        "geo",
        "platform",
        "ctr_avg",
        "bounce_rate_avg",
        "event_count",
    )
