"""Counters, rates, distributions and lag."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clickwatch import constants as C


def cumulative_histogram(df: DataFrame, column: str, bounds: Sequence[float]) -> DataFrame:
    """Rows at or below each bound and in total (`+Inf`), counted in one pass."""
    value = F.col(column)
    counts = df.agg(
        *[F.count_if(value <= b).alias(f"b{i}") for i, b in enumerate(bounds)], F.count(column).alias("all")
    )
    entries = [F.struct(F.lit(str(float(b))).alias("le"), F.col(f"b{i}").alias("rows")) for i, b in enumerate(bounds)]
    entries.append(F.struct(F.lit("+Inf").alias("le"), F.col("all").alias("rows")))
    return counts.select(F.inline(F.array(*entries)))


def score_histogram(scores: DataFrame) -> DataFrame:
    return cumulative_histogram(scores, "anomaly_score", C.SCORE_BUCKETS)


def scoring_counters(checked: DataFrame, scored_ok: Column, is_anomaly: Column) -> DataFrame:
    """Rows per outcome: scored, failed, flagged."""
    counts = checked.agg(
        F.count_if(scored_ok).alias("ok"), F.count_if(~scored_ok).alias("error"), F.count_if(is_anomaly).alias("alerts")
    )
    return counts.select(
        F.inline(
            F.array(*[F.struct(F.lit(n).alias("counter"), F.col(n).alias("total")) for n in ("ok", "error", "alerts")])
        )
    )


def rate_per_second(df: DataFrame, time: str) -> DataFrame:
    """Rows per second over consecutive 5-minute windows."""
    return (
        df.groupBy(F.window(time, C.RATE_WINDOW).alias("w"))
        .agg((F.count(F.lit(1)) / F.lit(float(C.RATE_WINDOW_SECONDS))).alias("per_second"))
        .select(F.col("w.start").alias("window_start"), "per_second")
    )


def histogram_quantile(
    df: DataFrame, time: str, seconds: Column, p: float = 0.95, bounds: Sequence[float] = C.LATENCY_BUCKETS
) -> DataFrame:
    """Estimated `p` quantile per 5-minute window from bucket counts.

    Linear inside the bucket where the rank falls; beyond the last bound the last
    bound is the answer. One aggregation, fixed-size state per window.
    """
    counted = (
        df.groupBy(F.window(time, C.RATE_WINDOW).alias("w"))
        .agg(
            *[F.count_if(seconds <= b).alias(f"b{i}") for i, b in enumerate(bounds)],
            F.count(seconds).alias("all"),
        )
        .withColumn("rank", F.col("all") * F.lit(p))
    )
    estimate = F.lit(float(bounds[-1]))
    for i in reversed(range(len(bounds))):
        low = float(bounds[i - 1]) if i else 0.0
        below = F.col(f"b{i - 1}") if i else F.lit(0)
        inside = F.lit(low) + F.lit(float(bounds[i]) - low) * F.try_divide(
            F.col("rank") - below, (F.col(f"b{i}") - below).cast("double")
        )
        estimate = F.when(F.col(f"b{i}") >= F.col("rank"), inside).otherwise(estimate)
    return counted.select(F.col("w.start").alias("window_start"), F.col("all").alias("observations"), estimate.alias("quantile"))


def counter_increases(samples: DataFrame, series: Sequence[str], time: str = "at", value: str = "value") -> DataFrame:
    """Adds `increase`, what a growing counter has gained since the sample before it.

    A sample below the one before it means that the counter was restarted from zero, so all of it is gain. The
    first sample of a series gains nothing: when it was counted is not known.
    """
    before = F.lag(value).over(Window.partitionBy(*series).orderBy(time))
    gained = F.when(before.isNull(), F.lit(0)).when(F.col(value) < before, F.col(value)).otherwise(F.col(value) - before)
    return samples.withColumn("increase", gained.cast("bigint"))


def counter_rate(samples: DataFrame, series: Sequence[str], labels: Sequence[str], time: str = "at", value: str = "value") -> DataFrame:
    """Gain per second of sampled counters over consecutive 5-minute windows, per `labels`."""
    gained = counter_increases(samples, series, time, value)
    return (
        gained.groupBy(F.window(time, C.RATE_WINDOW).alias("w"), *labels)
        .agg((F.sum("increase") / F.lit(float(C.RATE_WINDOW_SECONDS))).alias("per_second"))
        .select(F.col("w.start").alias("window_start"), *labels, "per_second")
    )


def bucket_quantile(
    samples: DataFrame, series: Sequence[str], p: float = 0.95, le: str = "le", time: str = "at", value: str = "value"
) -> DataFrame:
    """Estimated `p` quantile per 5-minute window from sampled cumulative bucket counters of all series together.

    `le` is the upper bound of a bucket as a number, infinity for the last one. Linear inside the bucket where the rank
    falls; in the last bucket the bound before it is the answer. Windows without gain are left out.
    """
    gained = counter_increases(samples, [*series, le], time, value)
    counts = gained.groupBy(F.window(time, C.RATE_WINDOW).alias("w"), le).agg(F.sum("increase").alias("upto"))
    order = Window.partitionBy("w").orderBy(le)  # a row per bound
    ranked = counts.select(
        "w", le, "upto",
        F.coalesce(F.lag(le).over(order), F.lit(0.0)).alias("low"),
        F.coalesce(F.lag("upto").over(order), F.lit(0)).alias("below"),
        F.max("upto").over(Window.partitionBy("w")).alias("observations"),
    )
    rank = F.col("observations") * F.lit(p)
    inside = F.col("low") + (F.col(le) - F.col("low")) * F.try_divide(rank - F.col("below"), (F.col("upto") - F.col("below")).cast("double"))
    estimate = F.when(F.col(le) == float("inf"), F.col("low")).otherwise(inside)
    hit = ranked.filter((F.col("observations") > 0) & (F.col("upto") >= rank)).select("w", "observations", le, estimate.alias("estimate"))
    found = hit.groupBy("w").agg(F.max("observations").alias("observations"), F.min_by("estimate", le).alias("quantile"))
    return found.select(F.col("w.start").alias("window_start"), "observations", "quantile")


def partition_lag(highwater: DataFrame, committed: DataFrame) -> DataFrame:
    """Unread messages per partition known to both sides; (topic, partition, offset) each."""
    joined = highwater.withColumnRenamed("offset", "highwater").join(
        committed.withColumnRenamed("offset", "committed"), ["topic", "partition"]
    )
    return joined.withColumn("lag", F.greatest(F.lit(0), F.col("highwater") - F.col("committed")))
