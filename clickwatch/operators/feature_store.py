"""Offline table, latest values per key and time-correct lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clickwatch import constants as C
from clickwatch.operators.windows import KEYS

VALUES = ("ctr_avg", "bounce_rate_avg", "event_count")


def by_window_end(features: DataFrame, days_back: int | None = None, as_of: Column | None = None) -> DataFrame:
    """The feature table in time order, optionally only its last days."""
    if days_back is not None:
        since = (as_of if as_of is not None else F.current_timestamp()) - F.make_dt_interval(days=F.lit(days_back))
        features = features.filter(F.col("window_end") >= since)
    return features.orderBy("window_end", *KEYS)


def offline_rows(features: DataFrame) -> DataFrame:
    """Offline names and types, plus the date the partitions go by."""
    return features.select(
        F.col("window_start").cast("timestamp").alias("window_start"),
        F.col("window_end").cast("timestamp").alias("window_end"),
        *KEYS,
        F.col("ctr_avg").cast("double").alias("avg_ctr"),
        F.col("bounce_rate_avg").cast("double").alias("avg_bounce_rate"),
        F.col("event_count").cast("bigint").alias("event_count"),
        F.to_date("window_end").alias("ingest_date"),
    )


def from_offline(offline: DataFrame) -> DataFrame:
    """Back to the canonical feature names."""
    return offline.withColumnsRenamed({"avg_ctr": "ctr_avg", "avg_bounce_rate": "bounce_rate_avg"})


def latest_per_key(features: DataFrame, time: str = "window_end", keys: Sequence[str] = KEYS) -> DataFrame:
    """Newest row of each key.

    One `max_by` per column, which hash aggregation takes: one candidate per key and
    task before the shuffle and no sort, so a key holding most rows costs no more
    than any other. Rows of a key at one time are deliveries of the same row.
    """
    rest = [c for c in features.columns if c not in keys]
    newest = [F.max(time).alias(c) if c == time else F.max_by(c, time).alias(c) for c in rest]
    return features.groupBy(*keys).agg(*newest)


def online_rows(features: DataFrame) -> DataFrame:
    return features.select(
        *KEYS,
        F.col("window_end").cast("timestamp").alias("event_timestamp"),
        F.col("ctr_avg").cast("float").alias("ctr_avg"),
        F.col("bounce_rate_avg").cast("float").alias("bounce_rate_avg"),
        F.col("event_count").cast("bigint").alias("event_count"),
    )


def latest_online(features: DataFrame) -> DataFrame:
    return latest_per_key(online_rows(features), "event_timestamp")


def materialize_incremental(online: DataFrame, features: DataFrame, since: Column, as_of: Column) -> DataFrame:
    """Online rows after taking in the feature rows with `since < window_end <= as_of`."""
    fresh = features.filter((F.col("window_end") > since) & (F.col("window_end") <= as_of))
    return latest_per_key(online.unionByName(online_rows(fresh)), "event_timestamp")


def _ttl(ttl: str) -> Column:
    return F.expr(f"INTERVAL {ttl}")


def online_lookup(entities: DataFrame, online: DataFrame, as_of: Column, ttl: str = C.ONLINE_TTL) -> DataFrame:
    """Latest values for each entity row, NULL when unknown or older than the ttl.

    `online` has one row per (two-letter geo, platform); a table of such size is
    broadcast by its statistics.
    """
    fresh = F.col("event_timestamp") >= as_of - _ttl(ttl)
    joined = entities.join(online, list(KEYS), "left")
    return joined.select(
        *entities.columns, *[F.when(fresh, F.col(v)).alias(v) for v in ("event_timestamp", *VALUES)]
    )


def _delivered(features: DataFrame) -> DataFrame:
    """One row per (key, window end): of rows delivered for one end the greatest (count, ratios) stands."""
    ratios = [v for v in VALUES if v != "event_count"]
    one = features.filter(F.col("window_end").isNotNull()).groupBy(*KEYS, "window_end")
    return one.agg(F.max(F.struct("event_count", *ratios)).alias("_row")).select(*KEYS, "window_end", "_row.*")


def asof_features(
    rows: DataFrame,
    features: DataFrame,
    time: str = "ts",
    ttl: str = C.ONLINE_TTL,
    grain: str = "hour",
) -> DataFrame:
    """For each row the newest feature window that had ended by its time.

    An ordered merge: rows and features are dealt by key and grain of time, and within each
    such range the last feature met in time order is carried along. What a range begins
    with is the last feature of the key's ranges before it, a running value over one
    row per key and range, joined on the partitioning the merge already has. So every row and every
    feature moves once, whatever the ttl and however sparse a key, and a busy key is
    spread over its ranges. Window ends may lie anywhere and be delivered repeatedly. Rows without key
    or time have no feature.
    """
    age, marks = _ttl(ttl), [f"_{k}" for k in KEYS]
    complete = F.col(time).isNotNull()
    for key in KEYS:
        complete = complete & F.col(key).isNotNull()
    whole = F.struct(*[F.col(f"`{c}`") for c in rows.columns])
    asked = rows.filter(complete).select(
        *[F.col(k).alias(f"_{k}") for k in KEYS], F.col(time).alias("_at"), F.lit(1).alias("_side"), whole.alias("_row")
    )
    ended = F.struct("window_end", *VALUES).alias("_feature")
    one = _delivered(features).select(
        *[F.col(k).alias(f"_{k}") for k in KEYS], F.col("window_end").alias("_at"), F.lit(0).alias("_side"), ended
    )
    span = F.date_trunc(grain, "_at").alias("_span")
    # what each range of a key begins with: one row per key and range
    lasts = one.groupBy(*marks, span).agg(F.max("_feature").alias("_last"))
    ranges = lasts.unionByName(asked.select(*marks, span).distinct(), allowMissingColumns=True)
    ranges = ranges.groupBy(*marks, "_span").agg(F.max("_last").alias("_last"))
    earlier = Window.partitionBy(*marks).orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    begins = ranges.select(*marks, "_span", F.last("_last", ignorenulls=True).over(earlier).alias("_before"))
    # the merge
    both = asked.unionByName(one, allowMissingColumns=True).select("*", span)
    so_far = Window.partitionBy(*marks, "_span").orderBy("_at", "_side").rowsBetween(Window.unboundedPreceding, 0)
    merged = both.withColumn("_last", F.last("_feature", ignorenulls=True).over(so_far)).filter("_side = 1").drop("_feature")
    newest = F.coalesce("_last", "_before")
    found = merged.join(begins, [*marks, "_span"], "left").select(
        "_row.*", F.when(newest["window_end"] >= F.col("_at") - age, newest).alias("_found")
    )
    names = ("window_end", *VALUES)
    matched = found.select(*[F.col(f"`{c}`") for c in rows.columns], *[F.col(f"_found.{v}") for v in names])
    kinds = dict(matched.dtypes[-len(names) :])
    lone = rows.filter(~complete).select("*", *[F.lit(None).cast(kinds[v]).alias(v) for v in names])
    return matched.union(lone)
