"""Scores with metadata, decisions and alerts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickwatch import constants as C
from clickwatch.functions import rules
from clickwatch.functions.timefmt import iso_utc
from clickwatch.operators.dataset import MODEL_COLUMNS, SERVING, Preprocessing, serving_inputs
from clickwatch.operators.forest import Scorer, with_scores
from clickwatch.operators.ordering import exact_quantile


def score_requests(messages: DataFrame) -> DataFrame:
    """Feature messages as score requests; the window end is the time."""
    return messages.select(
        "ctr_avg", "bounce_rate_avg", "event_count", "geo", "platform", F.col("window_end").alias("timestamp")
    )


def scorable(rows: DataFrame) -> DataFrame:
    return rules.keep_valid(rows, rules.score_input_rules())


def scored(rows: DataFrame, scorer: Scorer, params: Preprocessing = SERVING, in_jvm: bool = False) -> DataFrame:
    """Scorable rows with `anomaly_score`; their columns stay."""
    return with_scores(serving_inputs(scorable(rows), params), scorer, in_jvm).drop(*MODEL_COLUMNS)


def flagged(scores: DataFrame, threshold: float) -> DataFrame:
    return scores.withColumns(
        {"is_anomaly": F.col("anomaly_score") >= F.lit(threshold), "threshold": F.lit(threshold)}
    )


def _meta(*names: str) -> Column:
    """Map of the given columns without NULL or empty ones, NULL if none is left."""
    pairs = F.create_map(*[part for n in names for part in (F.lit(n), F.col(n))])
    kept = F.map_filter(pairs, lambda _, v: v.isNotNull() & (v != ""))
    return F.when(F.size(kept) > 0, kept)


def score_batch(
    requests: DataFrame, scorer: Scorer, threshold: float, params: Preprocessing = SERVING, keys: tuple[str, ...] = ()
) -> DataFrame:
    """One response per request, with the request's `keys`; one that cannot be scored names its faults in `error`."""
    checked = rules.check(requests, rules.score_input_rules())
    ok = F.size("failed_rules") == 0
    scores = with_scores(serving_inputs(checked, params), scorer)
    score = F.when(ok, F.col("anomaly_score"))
    return scores.select(
        *keys,
        score.alias("anomaly_score"),
        (score >= F.lit(threshold)).alias("is_anomaly"),
        F.lit(threshold).alias("threshold"),
        F.array(*map(F.lit, C.FEATURES_USED)).alias("features_used"),
        _meta("geo", "platform", "timestamp").alias("meta"),
        F.when(~ok, F.concat(F.lit("invalid: "), F.array_join("failed_rules", ","))).alias("error"),
    )


def alerts(flagged_features: DataFrame) -> DataFrame:
    """Alert messages for the flagged windows."""
    return flagged_features.filter("is_anomaly").select(
        F.col("window_end").alias("ts"),
        "geo",
        "platform",
        "ctr_avg",
        "bounce_rate_avg",
        "event_count",
        "anomaly_score",
        "threshold",
        F.struct(F.col("window_start").alias("start"), F.col("window_end").alias("end")).alias("source_window"),
    )


def anomaly_results(flagged_features: DataFrame) -> DataFrame:
    """All scored windows in the results table's columns and types."""
    details = F.to_json(
        F.struct("ctr_avg", "bounce_rate_avg", "event_count", "threshold", iso_utc(F.col("window_start")).alias("window_start"))
    )
    return flagged_features.select(
        F.col("window_end").alias("timestamp"),
        "geo",
        "platform",
        F.col("anomaly_score").cast("decimal(10,6)").alias("anomaly_score"),
        F.when(F.col("is_anomaly"), "isolation_forest").alias("anomaly_type"),
        "is_anomaly",
        details.alias("details"),
    )


def alert_threshold(scores: DataFrame, quantile: float = C.ALERT_QUANTILE) -> float | None:
    return exact_quantile(scores, "anomaly_score", quantile)


def contamination_offset(train_scores: DataFrame, contamination: float = C.CONTAMINATION) -> float | None:
    """The `contamination` quantile of normality (= -score) on the training rows."""
    return exact_quantile(train_scores.select((-F.col("anomaly_score")).alias("s")), "s", contamination)


def contamination_flags(scores: DataFrame, offset: float) -> DataFrame:
    decision = -F.col("anomaly_score") - F.lit(offset)
    return scores.withColumns({"decision": decision, "is_outlier": decision < 0})
