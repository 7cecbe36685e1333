"""Registered queries: name -> function(spark, folder of the input tables).

Time comes out as ISO text or microseconds, decimals as doubles, and computed
doubles rounded to 9 digits, so that results compare across engines.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clickwatch import constants as C
from clickwatch.functions import rules
from clickwatch.functions.scalars import pseudonymous_id
from clickwatch.functions.timefmt import iso_utc
from clickwatch.operators import dataset, evaluation, feature_store, forest, monitoring, ordering, reports, scoring, sketches
from clickwatch.operators.dataset import MODEL_COLUMNS, SERVING, Dataset
from clickwatch.operators.forest import Scorer
from clickwatch.operators.training import flag_with_model, train_model
from clickwatch.operators.windows import KEYS, as_messages, sliding_features, tumbling_features
from clickwatch.plans.fixed_forest import node_rows
from clickwatch.schemas import CLICKSTREAM_TABLE, FEATURE_MESSAGE, LENIENT_FEATURE_MESSAGE, struct
from clickwatch.session import new_path, stage
from clickwatch.sinks import online_store
from clickwatch.sinks.files import LAKE_PARTITIONS, lake_rows, write_lake, write_offline
from clickwatch.sinks.tables import append_batch, read_batches
from clickwatch.sinks.topics import as_json, file_topic_writer
from clickwatch.sources import clickstream
from clickwatch.sources.tables import read_offline
from clickwatch.streaming import expiry, flushing, jobs, metrics
from clickwatch.streaming.sources import file_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    """Register under the function's name; one trailing underscore is for names in use here."""
    QUERIES[fn.__name__.removesuffix("_")] = fn
    return fn


# --- shared inputs ------------------------------------------------------------------


def _at(text: str) -> Column:
    return F.lit(text).cast("timestamp")


def _features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sliding_features(clickstream.clicks(spark, sf_dir))


def _feature_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature windows written once, for queries that pass over them repeatedly."""
    return stage(_features(spark, sf_dir), "features")


def _dataset(spark: SparkSession, sf_dir: str) -> Dataset:
    return dataset.build_dataset(_feature_table(spark, sf_dir))


def _parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clickstream.parse_events(clickstream.raw_events(spark, sf_dir))


def _raw_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clickstream.to_raw_features(_features(spark, sf_dir))


def _table_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid = rules.keep_valid(_parsed(spark, sf_dir), rules.click_event_rules())
    return clickstream.to_table_rows(valid)


def _fixed_scorer(spark: SparkSession) -> Scorer:
    return forest.load_scorer(forest.forest_table(spark, node_rows()))


def _fixed_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every feature window scored by the fixed forest with the serving parameters; staged."""
    return stage(scoring.scored(_features(spark, sf_dir), _fixed_scorer(spark)), "fixed-scores")


def _fixed_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = _fixed_scores(spark, sf_dir)
    return scoring.flagged(scores, scoring.alert_threshold(scores))


def _labelled_scores(spark: SparkSession, sf_dir: str, stratified: bool = False) -> DataFrame:
    """Validation windows with injected anomalies, prepared and scored by the fixed forest; staged."""
    ds = _dataset(spark, sf_dir)
    injected = evaluation.inject(ds.bounded.filter(~ds.is_train), ds.params.count_cap, stratified=stratified)
    inputs = dataset.model_inputs(injected, ds.params.count_cap, "label", "kind")
    return stage(forest.with_scores(dataset.standardized(inputs, ds.params), _fixed_scorer(spark)), "labelled")


def _iso(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: iso_utc(F.col(n)) for n in names})


def _doubles(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("double") for n in names})


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(F.col(n).cast("double"), 9) for n in names})


def _micros(df: DataFrame, name: str) -> DataFrame:
    return df.withColumn(name, F.unix_micros(name))


# --- windows ----------------------------------------------------------------------------


@query
def sliding_features_(spark, sf_dir):
    return as_messages(_features(spark, sf_dir))


@query
def tumbling_features_(spark, sf_dir):
    return as_messages(tumbling_features(clickstream.clicks(spark, sf_dir)))


# --- parsing and rules ---------------------------------------------------------------------


@query
def parse_events(spark, sf_dir):
    return _parsed(spark, sf_dir).withColumn("readable", F.col(rules.CORRUPT).isNull()).drop(rules.CORRUPT)


@query
def valid_events(spark, sf_dir):
    return rules.keep_valid(_parsed(spark, sf_dir), rules.click_event_rules()).drop(rules.CORRUPT)


@query
def invalid_events(spark, sf_dir):
    rejected = rules.keep_invalid(_parsed(spark, sf_dir), rules.click_event_rules())
    return rejected.select("event_id", F.array_join("failed_rules", ",").alias("failed_rules"))


@query
def rule_failure_counts(spark, sf_dir):
    return rules.failure_counts(_parsed(spark, sf_dir), rules.click_event_rules())


@query
def stream_subset_events(spark, sf_dir):
    return _micros(clickstream.window_input(clickstream.raw_events(spark, sf_dir)), "ts")


@query
def valid_features(spark, sf_dir):
    return jobs.parsed_features(_raw_features(spark, sf_dir), strict=True)


@query
def lenient_features(spark, sf_dir):
    return jobs.parsed_features(_raw_features(spark, sf_dir), strict=False)


@query
def lenient_features_tail(spark, sf_dir):
    parsed = rules.parse_json(_raw_features(spark, sf_dir), LENIENT_FEATURE_MESSAGE)
    return rules.keep_valid(parsed, rules.lenient_feature_rules(require_z=True)).drop(rules.CORRUPT)


@query
def scorable_features(spark, sf_dir):
    parsed = rules.parse_json(_raw_features(spark, sf_dir), LENIENT_FEATURE_MESSAGE)
    return scoring.scorable(parsed).drop(rules.CORRUPT)


@query
def ingest_quality(spark, sf_dir):
    counts = _parsed(spark, sf_dir).agg(*rules.quality_metrics(rules.click_event_rules()))
    return counts.withColumn("valid_rate", F.round(F.try_divide("valid", "processed"), 9))


@query
def clickstream_events(spark, sf_dir):
    return _doubles(_micros(_table_rows(spark, sf_dir), "timestamp"), "cpc", "ctr", "bounce_rate")


@query
def score_requests(spark, sf_dir):
    return scoring.score_requests(jobs.parsed_features(_raw_features(spark, sf_dir), strict=True))


@query
def pseudonymous_users(spark, sf_dir):
    users = clickstream.events(spark, sf_dir).groupBy("user_id").agg(F.count(F.lit(1)).alias("events"))
    return users.select("user_id", pseudonymous_id(F.col("user_id"), clickstream.SALT).alias("user_id_hash"), "events")


@query
def events_as_json(spark, sf_dir):
    valid = rules.keep_valid(_parsed(spark, sf_dir), rules.click_event_rules())
    line = as_json(
        valid,
        "timestamp", "user_id_hash", "ad_id", "campaign_id", "geo", "platform", "user_agent",
        F.col("CPC").try_cast("decimal(10,3)").alias("CPC"),
        F.col("CTR").try_cast("decimal(10,4)").alias("CTR"),
        F.col("conversion").try_cast("int").alias("conversion"),
        F.col("bounce_rate").try_cast("decimal(10,3)").alias("bounce_rate"),
    )
    return line


# --- tables, reports ----------------------------------------------------------------------------


@query
def lake_hour_counts(spark, sf_dir):
    path = new_path(spark, "lake")
    write_lake(_table_rows(spark, sf_dir).drop("event_id"), path)
    lake = spark.read.schema("ad_id STRING, y STRING, m STRING, d STRING, h STRING").json(path)
    return lake.groupBy(*LAKE_PARTITIONS).agg(F.count(F.lit(1)).alias("events"))


@query
def total_events(spark, sf_dir):
    return reports.total_events(clickstream.clicks(spark, sf_dir))


@query
def daily_stats(spark, sf_dir):
    stats = reports.daily_stats(clickstream.clicks(spark, sf_dir))
    return _rounded(stats.withColumn("date", F.date_format("date", "yyyy-MM-dd")), "avg_ctr", "avg_bounce_rate", "avg_cpc")


@query
def daily_stats_top10(spark, sf_dir):
    stats = reports.latest_daily_stats(clickstream.clicks(spark, sf_dir))
    return _rounded(stats.withColumn("date", F.date_format("date", "yyyy-MM-dd")), "avg_ctr", "avg_bounce_rate", "avg_cpc")


@query
def geo_stats(spark, sf_dir):
    return _rounded(reports.geo_stats(clickstream.clicks(spark, sf_dir)), "avg_ctr", "avg_bounce_rate", "avg_cpc")


@query
def top_recent_events(spark, sf_dir):
    top = reports.top_recent_events(clickstream.clicks(spark, sf_dir))
    return _doubles(_micros(top, "ts"), "cpc", "ctr", "bounce_rate")


@query
def recent_events(spark, sf_dir):
    recent = reports.recent_events(clickstream.clicks(spark, sf_dir), _at("2024-01-02 03:00:00"))
    return _doubles(_micros(recent, "ts"), "cpc", "ctr", "bounce_rate")


@query
def report(spark, sf_dir):
    found = reports.report(clickstream.clicks(spark, sf_dir)).withColumn("date", F.date_format("date", "yyyy-MM-dd"))
    return _rounded(_micros(found, "ts"), "avg_ctr", "avg_bounce_rate", "avg_cpc")


# --- feature store ---------------------------------------------------------------------------------


@query
def features_by_window_end(spark, sf_dir):
    return as_messages(
        feature_store.by_window_end(_features(spark, sf_dir), days_back=7, as_of=_at("2024-01-08 03:00:00"))
    )


def _offline(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "offline")
    write_offline(_features(spark, sf_dir), path)
    return read_offline(spark, path)


@query
def offline_backfill(spark, sf_dir):
    rows = _offline(spark, sf_dir).groupBy(F.date_format("ingest_date", "yyyy-MM-dd").alias("ingest_date"))
    return _iso(
        rows.agg(
            F.count(F.lit(1)).alias("rows"),
            F.sum("event_count").alias("events"),
            F.min("window_end").alias("first_end"),
            F.max("window_end").alias("last_end"),
        ),
        "first_end", "last_end",
    )


@query
def offline_scan(spark, sf_dir):
    rows = _offline(spark, sf_dir).withColumn("ingest_date", F.date_format("ingest_date", "yyyy-MM-dd"))
    return _iso(rows, "window_start", "window_end")


@query
def online_latest(spark, sf_dir):
    latest = feature_store.latest_online(_features(spark, sf_dir))
    return _doubles(_iso(latest, "event_timestamp"), "ctr_avg", "bounce_rate_avg")


@query
def online_lookup(spark, sf_dir):
    online = stage(feature_store.latest_online(_features(spark, sf_dir)), "online")
    raw = clickstream.raw_events(spark, sf_dir)
    entities = rules.parse_json(raw, struct("geo STRING, platform STRING")).drop(rules.CORRUPT)
    found = feature_store.online_lookup(entities, online, _at("2024-01-04 06:04:00"))
    return _doubles(_iso(found, "event_timestamp"), "ctr_avg", "bounce_rate_avg")


def _asof(spark: SparkSession, sf_dir: str, ttl: str) -> DataFrame:
    cl = clickstream.clicks(spark, sf_dir)
    found = feature_store.asof_features(cl.select("event_id", "ts", *KEYS), sliding_features(cl), ttl=ttl)
    return _micros(_iso(found, "window_end"), "ts")


def _altered_features(features: DataFrame) -> DataFrame:
    """Features as a careless producer delivers them: off-grid ends, repeated rows and conflicting rows."""
    shift = F.make_dt_interval(secs=F.pmod(F.col("event_count") * 17, F.lit(60)))
    moved = features.withColumn("window_end", F.col("window_end") + shift)
    again = moved.filter(F.col("event_count") % 2 == 0)
    conflict = again.withColumn("event_count", F.col("event_count") + 1)
    return moved.unionByName(again).unionByName(conflict)


@query
def asof_features_altered(spark, sf_dir):
    cl = clickstream.clicks(spark, sf_dir)
    features = _altered_features(sliding_features(cl))
    found = feature_store.asof_features(cl.select("event_id", "ts", *KEYS), features, ttl="2 minutes")
    return _micros(_iso(found, "window_end"), "ts")


@query
def asof_features(spark, sf_dir):
    return _asof(spark, sf_dir, C.ONLINE_TTL)


@query
def asof_features_short_ttl(spark, sf_dir):
    return _asof(spark, sf_dir, "30 seconds")


@query
def materialize_incremental(spark, sf_dir):
    features = _feature_table(spark, sf_dir)
    since, as_of = _at("2024-01-01 02:00:00"), _at("2024-01-01 04:30:00")
    old = feature_store.latest_online(features.filter(F.col("window_end") <= since))
    new = feature_store.materialize_incremental(old, features, since, as_of)
    return _doubles(_iso(new, "event_timestamp"), "ctr_avg", "bounce_rate_avg")


@query
def materialize_since_last_run(spark, sf_dir):
    """Three runs, one of them twice; each starts where the one before it is known to have ended."""
    features, path = _feature_table(spark, sf_dir), new_path(spark, "materialized")
    first = 1_704_067_200_000_000  # 2024-01-01, microseconds
    for minutes in (120, 195, 195, 270):
        online_store.materialize_next(features, path, first + minutes * 60_000_000)
    return _doubles(_iso(online_store.read_online(spark, path), "event_timestamp"), "ctr_avg", "bounce_rate_avg")


@query
def sketched_quantiles(spark, sf_dir):
    """Quantiles of a value over all days from stored daily sketches, and whether their true ranks are near enough."""
    clicks, path = clickstream.clicks(spark, sf_dir), new_path(spark, "sketches")
    values = clicks.select(F.to_date("ts").alias("ingest_date"), "cpc")
    sketches.write_sketches(sketches.daily_sketches(values, "cpc"), path)
    found = sketches.merged_quantiles(sketches.read_sketches(spark, path), (0.02, 0.25, 0.5, 0.98))
    told = sketches.with_rank_gap(found, values, "cpc")
    return told.select("p", "days", "rows", (F.col("rank_gap") <= 2 * sketches.rank_error()).alias("near"))


# --- dataset -------------------------------------------------------------------------------------------


@query
def count_cap(spark, sf_dir):
    quantile, cap = dataset.count_cap(_feature_table(spark, sf_dir))
    return spark.range(1).select(F.round(F.lit(quantile).cast("double"), 9).alias("quantile"), F.round(F.lit(cap), 9).alias("cap"))


@query
def prepared_features(spark, sf_dir):
    features = _feature_table(spark, sf_dir)
    cap = dataset.count_cap(features)[1]
    return _rounded(_iso(dataset.prepared(features, cap), "window_end"), *MODEL_COLUMNS)


@query
def time_split(spark, sf_dir):
    rows = _feature_table(spark, sf_dir).select("window_end", *KEYS)
    is_train, _, _ = dataset.split_at(rows)
    return _iso(rows.withColumn("split", dataset.split_name(is_train)), "window_end")


@query
def time_split_null_keys(spark, sf_dir):
    """Every row is in one split, those without time or keys too."""
    fault = F.pmod(F.col("event_count") + F.unix_seconds("window_end"), F.lit(7))
    rows = _feature_table(spark, sf_dir).select(
        F.when(fault != 1, F.col("window_end")).alias("window_end"),
        F.when(fault != 2, F.col("geo")).alias("geo"),
        F.when(fault != 3, F.col("platform")).alias("platform"),
    )
    is_train, _, _ = dataset.split_at(stage(rows, "null-keys"))
    return _iso(rows.withColumn("split", dataset.split_name(is_train)), "window_end").groupBy("window_end", *KEYS, "split").agg(F.count(F.lit(1)).alias("rows"))


@query
def split_sizes(spark, sf_dir):
    rows = _feature_table(spark, sf_dir)
    is_train, _, _ = dataset.split_at(rows)
    return dataset.split_sizes(rows, is_train)


@query
def scaler_fit(spark, sf_dir):
    params = _dataset(spark, sf_dir).params
    rows = [(c, m, s) for c, m, s in zip(MODEL_COLUMNS, params.mean, params.scale)]
    return _rounded(spark.createDataFrame(rows, "feature STRING, mean DOUBLE, scale DOUBLE"), "mean", "scale")


@query
def standardized_features(spark, sf_dir):
    ds = _dataset(spark, sf_dir)
    rows = ds.scaled.withColumn("split", dataset.split_name(ds.is_train))
    return _rounded(_iso(rows, "window_end"), *MODEL_COLUMNS)


@query
def split_summary(spark, sf_dir):
    ds = _dataset(spark, sf_dir)
    summary = dataset.split_summary(ds.scaled, ds.is_train)
    return _rounded(summary, *[c for c in summary.columns if c != "split"])


@query
def serving_features(spark, sf_dir):
    rows = dataset.serving_inputs(scoring.scorable(_features(spark, sf_dir))).select("window_end", *KEYS, *MODEL_COLUMNS)
    return _rounded(_iso(rows, "window_end"), *MODEL_COLUMNS)


@query
def inverse_features(spark, sf_dir):
    ds = _dataset(spark, sf_dir)
    return _rounded(_iso(dataset.inverse(ds.scaled, ds.params), "window_end"), "ctr", "bounce", "count")


# --- forest and scores ---------------------------------------------------------------------------------------


@query
def forest_nodes(spark, sf_dir):
    return forest.fit_forest(_dataset(spark, sf_dir).train)


#: a forest small enough to be grown again in SQL
SMALL = {"trees": 3, "max_samples": 16}


@query
def small_forest_nodes(spark, sf_dir):
    nodes = forest.fit_forest(_dataset(spark, sf_dir).train, **SMALL)
    split = F.col("feature") >= 0
    return nodes.select(
        "tree_id", "node_id", "feature", F.round(F.when(split, F.col("threshold")), 9).alias("threshold"), "size",
        F.round(F.when(~split, F.col("path_length")), 9).alias("path_length"),
    )


@query
def small_forest_scores(spark, sf_dir):
    ds = _dataset(spark, sf_dir)
    scores = forest.with_scores(ds.validation, forest.load_scorer(forest.fit_forest(ds.train, **SMALL)))
    return _rounded(_iso(scores.select("window_end", *KEYS, "anomaly_score"), "window_end"), "anomaly_score")


def _fitted(ds: Dataset) -> Scorer:
    return forest.load_scorer(forest.fit_forest(ds.train))


@query
def anomaly_scores(spark, sf_dir):
    ds = _dataset(spark, sf_dir)
    scores = forest.with_scores(ds.validation, _fitted(ds))
    return _iso(scores.select("window_end", *KEYS, "anomaly_score"), "window_end")


@query
def fixed_forest_scores(spark, sf_dir):
    scores = scoring.scored(_features(spark, sf_dir), _fixed_scorer(spark))
    return _rounded(_iso(scores.select("window_end", *KEYS, "anomaly_score"), "window_end"), "anomaly_score")


@query
def fixed_forest_scores_jvm(spark, sf_dir):
    """The same scores without a Python worker."""
    scores = scoring.scored(_features(spark, sf_dir), _fixed_scorer(spark), in_jvm=True)
    return _rounded(_iso(scores.select("window_end", *KEYS, "anomaly_score"), "window_end"), "anomaly_score")


@query
def contamination_flags(spark, sf_dir):
    scores = _fixed_scores(spark, sf_dir)
    is_train, _, _ = dataset.split_at(scores)
    offset = scoring.contamination_offset(scores.filter(is_train))
    flags = scoring.contamination_flags(scores, offset)
    return _rounded(_iso(flags.select("window_end", *KEYS, "decision", "is_outlier"), "window_end"), "decision")


@query
def threshold(spark, sf_dir):
    tau = scoring.alert_threshold(_fixed_scores(spark, sf_dir))
    return spark.range(1).select(F.round(F.lit(tau), 9).alias("threshold"))


@query
def flagged_windows(spark, sf_dir):
    flags = _fixed_flags(spark, sf_dir).select("window_end", *KEYS, "anomaly_score", "threshold", "is_anomaly")
    return _rounded(_iso(flags, "window_end"), "anomaly_score", "threshold")


@query
def anomaly_results(spark, sf_dir):
    results = scoring.anomaly_results(_fixed_flags(spark, sf_dir))
    count = F.get_json_object("details", "$.event_count").cast("bigint")
    return _doubles(_iso(results.withColumn("event_count", count).drop("details"), "timestamp"), "anomaly_score")


@query
def score_batch(spark, sf_dir):
    """Responses to all feature messages, unreadable and invalid ones included."""
    parsed = rules.parse_json(_raw_features(spark, sf_dir), LENIENT_FEATURE_MESSAGE)
    responses = scoring.score_batch(scoring.score_requests(parsed), _fixed_scorer(spark), C.SERVING_THRESHOLD)
    meta = F.col("meta")
    return _rounded(
        responses.select(
            "anomaly_score", "is_anomaly", "threshold",
            F.array_join("features_used", ",").alias("features_used"),
            meta["geo"].alias("geo"), meta["platform"].alias("platform"), meta["timestamp"].alias("timestamp"), "error",
        ),
        "anomaly_score", "threshold",
    )


@query
def fitted_alerts(spark, sf_dir):
    """Alerts of a model that was fitted, stored and read back."""
    features = _feature_table(spark, sf_dir)
    path = new_path(spark, "model")
    train_model(features, path)
    messages = scoring.alerts(_iso(flag_with_model(features, path), "window_start", "window_end"))
    return messages.select("ts", "geo", "platform", "event_count", "anomaly_score", "threshold")


@query
def alerts(spark, sf_dir):
    messages = scoring.alerts(_iso(_fixed_flags(spark, sf_dir), "window_start", "window_end"))
    flat = messages.select("*", F.col("source_window.start").alias("source_start"), F.col("source_window.end").alias("source_end"))
    return _rounded(flat.drop("source_window"), "anomaly_score", "threshold")


# --- evaluation ---------------------------------------------------------------------------------------------------


def _injected(spark: SparkSession, sf_dir: str, stratified: bool) -> DataFrame:
    ds = _dataset(spark, sf_dir)
    injected = evaluation.inject(ds.bounded.filter(~ds.is_train), ds.params.count_cap, stratified=stratified)
    return _rounded(_iso(injected, "window_end"), "ctr", "bounce", "count")


@query
def inject_uniform(spark, sf_dir):
    return _injected(spark, sf_dir, stratified=False)


@query
def inject_stratified(spark, sf_dir):
    return _injected(spark, sf_dir, stratified=True)


@query
def confusion_metrics(spark, sf_dir):
    labelled = _labelled_scores(spark, sf_dir)
    tau = scoring.alert_threshold(labelled)
    cells = evaluation.confusion_metrics(labelled, F.col("anomaly_score") >= F.lit(tau))
    return _rounded(cells, "precision", "recall", "f1")


@query
def roc_auc(spark, sf_dir):
    return _rounded(evaluation.roc_auc(evaluation.threshold_counts(_labelled_scores(spark, sf_dir))), "roc_auc")


@query
def roc_curve(spark, sf_dir):
    points = evaluation.roc_curve(evaluation.threshold_counts(_labelled_scores(spark, sf_dir)))
    return _rounded(points, "fpr", "tpr", "threshold")


@query
def roc_curve_corners(spark, sf_dir):
    counts = evaluation.threshold_counts(_labelled_scores(spark, sf_dir))
    return _rounded(evaluation.roc_curve(counts, drop_intermediate=True), "fpr", "tpr", "threshold")


@query
def value_quantiles(spark, sf_dir):
    """Exact quantiles of a column with a different value in nearly every row."""
    values = stage(clickstream.events(spark, sf_dir).select((F.col("value") + F.col("event_id") / 1e7).alias("x")), "values")
    ps = (0.0, 0.02, 0.5, 0.98, 0.999, 1.0)
    rows = list(zip(ps, ordering.exact_quantiles(values, "x", ps)))
    return _rounded(spark.createDataFrame(rows, "p DOUBLE, quantile DOUBLE"), "quantile")


@query
def value_auc(spark, sf_dir):
    """AUC of a continuous score over many ranges; events without a value take the last place."""
    ev = clickstream.events(spark, sf_dir)
    score = F.when(F.col("event_id") % 11 != 0, F.col("value") + F.col("event_id") / 1e7)
    labelled = ev.select(score.alias("anomaly_score"), (F.col("event_type") == "purchase").cast("int").alias("label"))
    return _rounded(evaluation.roc_auc(evaluation.threshold_counts(labelled)), "roc_auc")


@query
def random_label_auc(spark, sf_dir):
    labelled = evaluation.random_labels(_fixed_scores(spark, sf_dir))
    area = evaluation.roc_auc(evaluation.threshold_counts(labelled))
    return _rounded(area, "roc_auc").withColumn("plausible", F.col("roc_auc") <= C.RANDOM_LABEL_MAX_AUC)


@query
def forest_evaluation(spark, sf_dir):
    """The whole offline path with a fitted forest: fit, inject, score, threshold, metrics.

    One row per flagging rule: the score quantile of the evaluated rows, and the
    contamination offset of the training rows.
    """
    ds = _dataset(spark, sf_dir)
    scorer = _fitted(ds)
    injected = evaluation.inject(ds.bounded.filter(~ds.is_train), ds.params.count_cap)
    inputs = dataset.model_inputs(injected, ds.params.count_cap, "label")
    labelled = stage(forest.with_scores(dataset.standardized(inputs, ds.params), scorer), "labelled")
    auc = evaluation.roc_auc(evaluation.threshold_counts(labelled)).first()["roc_auc"]
    tau = scoring.alert_threshold(labelled)
    offset = scoring.contamination_offset(forest.with_scores(ds.train, scorer))
    score = F.col("anomaly_score")
    rules_of = {"quantile": (tau, score >= F.lit(tau)), "contamination": (-offset, score > F.lit(-offset))}
    parts = [
        evaluation.confusion_metrics(labelled, flag).withColumns(
            {"rule": F.lit(name), "threshold": F.lit(limit), "roc_auc": F.lit(auc)}
        )
        for name, (limit, flag) in rules_of.items()
    ]
    return parts[0].unionByName(parts[1])


# --- monitoring ------------------------------------------------------------------------------------------------------


@query
def score_histogram(spark, sf_dir):
    return monitoring.score_histogram(scoring.scored(_features(spark, sf_dir), _fixed_scorer(spark)))


@query
def scoring_counters(spark, sf_dir):
    raw = stage(_raw_features(spark, sf_dir), "messages")
    scored = scoring.flagged(
        scoring.scored(jobs.parsed_features(raw, strict=True), _fixed_scorer(spark)), C.SERVING_THRESHOLD
    ).select(F.lit(True).alias("ok"), "is_anomaly")
    failed = rules.keep_invalid(rules.parse_json(raw, FEATURE_MESSAGE), rules.strict_feature_rules()).select(
        F.lit(False).alias("ok"), F.lit(False).alias("is_anomaly")
    )
    return monitoring.scoring_counters(scored.unionByName(failed), F.col("ok"), F.col("is_anomaly"))


@query
def scored_rate(spark, sf_dir):
    rate = monitoring.rate_per_second(_features(spark, sf_dir), "window_end")
    return _rounded(_iso(rate, "window_start"), "per_second")


@query
def alert_rate(spark, sf_dir):
    flags = _fixed_flags(spark, sf_dir).filter("is_anomaly")
    return _rounded(_iso(monitoring.rate_per_second(flags, "window_end"), "window_start"), "per_second")


@query
def latency_p95(spark, sf_dir):
    ev = clickstream.events(spark, sf_dir).select(clickstream.squeezed_time().alias("ts"), (F.col("value") / 100).alias("seconds"))
    return _rounded(_iso(monitoring.histogram_quantile(ev, "ts", F.col("seconds")), "window_start"), "quantile")


def _counter_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latency bucket counters of three instances, read every minute; all restart at the full hour."""
    ev = clickstream.events(spark, sf_dir).select(
        (F.col("user_id") % 3).cast("int").alias("instance"),
        F.date_trunc("minute", clickstream.squeezed_time()).alias("minute"),
        (F.col("value") / 100).alias("seconds"),
    )
    bounds = [*C.LATENCY_BUCKETS, float("inf")]
    counts = [F.count_if(F.col("seconds") <= b).alias(f"b{i}") for i, b in enumerate(bounds)]
    life = Window.partitionBy("instance", F.date_trunc("hour", "minute")).orderBy("minute")
    held = [F.struct(F.lit(b).alias("le"), F.sum(f"b{i}").over(life).alias("value")) for i, b in enumerate(bounds)]
    read = ev.groupBy("instance", "minute").agg(*counts).select(
        "instance", (F.col("minute") + F.expr("INTERVAL 1 minute")).alias("at"), F.array(*held).alias("held")
    )
    return read.select("instance", "at", F.inline("held"))


@query
def counter_served_rate(spark, sf_dir):
    """Gain per second of sampled counters that restart, per instance."""
    totals = _counter_samples(spark, sf_dir).filter(F.col("le") == float("inf"))
    rate = monitoring.counter_rate(totals, ["instance"], ["instance"])
    return _rounded(_iso(rate, "window_start"), "per_second")


@query
def counter_latency_p95(spark, sf_dir):
    """95th percentile from the bucket counters of all instances."""
    found = monitoring.bucket_quantile(_counter_samples(spark, sf_dir), ["instance"])
    return _rounded(_iso(found, "window_start"), "quantile")


@query
def partition_lag(spark, sf_dir):
    ev = clickstream.events(spark, sf_dir).select(
        F.lit(C.TOPIC_EVENTS).alias("topic"),
        (F.col("user_id") % 3).cast("int").alias("partition"),
        clickstream.squeezed_time().alias("ts"),
    )
    size = F.count(F.lit(1)).alias("offset")
    highwater = ev.groupBy("topic", "partition").agg(size)
    committed = ev.filter(F.col("ts") <= _at("2024-01-01 05:00:00")).groupBy("topic", "partition").agg(size)
    return monitoring.partition_lag(highwater, committed)


# --- streaming, run to the end of what is there -----------------------------------------------------------------------


def _run(spark: SparkSession, writer) -> None:
    jobs.run(writer, new_path(spark, "checkpoint"), available_now=True).awaitTermination()


def _raw_event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clickstream.to_raw(clickstream.to_clicks(clickstream.events_stream(spark, sf_dir))).select("value")


def _raw_feature_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "feature-topic")
    _raw_features(spark, sf_dir).write.text(path)
    return spark.readStream.format("text").load(path)


@query
def stream_sliding_features(spark, sf_dir):
    path = new_path(spark, "features")
    _run(spark, file_topic_writer(as_json(jobs.feature_stream(_raw_event_stream(spark, sf_dir))), path))
    return jobs.parsed_features(spark.read.schema("value STRING").text(path), strict=True)


def _late_runs(spark: SparkSession, sf_dir: str, runs: int) -> tuple[str, str]:
    """(features, checkpoint) after so many runs of the window job; the third brings rows whose windows have closed."""
    topic, path, checkpoint = (new_path(spark, x) for x in ("late-topic", "late-features", "late-checkpoint"))
    cl = clickstream.clicks(spark, sf_dir)
    late = (F.col("event_id") % 7 == 0) & (F.col("ts") < _at("2024-01-01 01:00:00"))
    part = F.when(late, 3).when(F.col("ts") < _at("2024-01-01 02:00:00"), 1).when(F.col("ts") < _at("2024-01-01 04:00:00"), 2).otherwise(3)
    raw = stage(clickstream.to_raw(cl).join(cl.select("event_id", part.alias("part")), "event_id"), "late-rows")
    for run in range(1, runs + 1):
        raw.filter(F.col("part") == run).select("value").write.mode("append").text(topic)
        features = as_json(jobs.feature_stream(file_stream(spark, topic)))
        jobs.run(file_topic_writer(features, path), checkpoint, available_now=True).awaitTermination()
    return path, checkpoint


@query
def stream_late_events(spark, sf_dir):
    """Three runs of the window job on one checkpoint."""
    path, _ = _late_runs(spark, sf_dir, 3)
    return jobs.parsed_features(spark.read.schema("value STRING").text(path), strict=True)


@query
def stream_open_windows(spark, sf_dir):
    """Windows still open after the second run, read from the state the third run starts from."""
    _, checkpoint = _late_runs(spark, sf_dir, 2)
    state = jobs.window_state(spark, checkpoint)
    return _iso(state, "window_end")


@query
def stream_online_expiry(spark, sf_dir):
    """Two runs of the expiring store; web stops in the first, so its keys are gone from the table after the second."""
    topic, path, checkpoint = (new_path(spark, x) for x in ("expiry-topic", "expiry-online", "expiry-checkpoint"))
    features = stage(_features(spark, sf_dir), "expiry-features")
    early = F.col("window_end") <= _at("2024-01-01 02:00:00")
    for part in (features.filter(early), features.filter(~early & (F.col("platform") != "web"))):
        clickstream.to_raw_features(part).write.mode("append").text(topic)
        writer = expiry.expiring_writer(file_stream(spark, topic), path, ttl_seconds=3600)
        jobs.run(writer, checkpoint, available_now=True).awaitTermination()
    return _doubles(_iso(online_store.read_online(spark, path), "event_timestamp"), "ctr_avg", "bounce_rate_avg")


def _ingested(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """(table, quarantine) after one run of the ingest job."""
    table, bad = new_path(spark, "event-table"), new_path(spark, "quarantine")
    checked = jobs.checked_events(_raw_event_stream(spark, sf_dir))
    _run(spark, jobs.ingest_writer(checked, lambda rows, n: append_batch(rows, n, table), lambda rows, n: append_batch(rows, n, bad)))
    return table, bad


@query
def stream_table_ingest(spark, sf_dir):
    table = read_batches(spark, _ingested(spark, sf_dir)[0], CLICKSTREAM_TABLE)
    return _doubles(_micros(table, "timestamp"), "cpc", "ctr", "bounce_rate")


@query
def stream_quarantine(spark, sf_dir):
    bad = read_batches(spark, _ingested(spark, sf_dir)[1], "value STRING, failed_rules ARRAY<STRING>")
    return bad.select("value", F.array_join("failed_rules", ",").alias("failed_rules"))


@query
def stream_observed_counts(spark, sf_dir):
    """Quality counts of the ingest job as its micro-batches reported them."""
    root, table, bad = (new_path(spark, x) for x in ("observed", "event-table", "quarantine"))
    topic = new_path(spark, "event-topic")
    raw = stage(clickstream.raw_events(spark, sf_dir).select("value"), "raw-lines")
    raw.write.text(topic)
    listener = metrics.ObservedMetrics(spark, root)
    spark.streams.addListener(listener)
    try:
        checked = jobs.checked_events(file_stream(spark, topic, files_per_batch=1), "ingest")
        writer = jobs.ingest_writer(checked, lambda rows, n: append_batch(rows, n, table), lambda rows, n: append_batch(rows, n, bad))
        run = jobs.run(writer, new_path(spark, "checkpoint"), available_now=True)
        run.awaitTermination()
        listener.wait(run)
    finally:
        spark.streams.removeListener(listener)
    counts = metrics.observed_totals(metrics.read_observed(spark, root), "ingest").groupBy().pivot("metric", ["processed", "valid", "invalid"])
    return counts.agg(F.first("total"))


@query
def stream_lake_flushes(spark, sf_dir):
    """Lines of every hour after two runs of the buffered lake: nothing lost or doubled, no file above its size.

    Between the runs what is left waits its time; the second run brings one line of another year.
    """
    topic, path, checkpoint = (new_path(spark, x) for x in ("flush-topic", "flush-lake", "flush-checkpoint"))
    valid = rules.keep_valid(clickstream.parse_events(clickstream.raw_events(spark, sf_dir), keep_text=True), rules.click_event_rules())
    lines = stage(valid.select("value"), "flush-lines")
    later = lines.limit(1).select(F.regexp_replace("value", '"timestamp":"2024', '"timestamp":"2023').alias("value"))
    for part in (lines, later):
        part.write.mode("append").text(topic)
        checked = jobs.checked_events(file_stream(spark, topic))
        timed = lake_rows(clickstream.to_table_rows(checked.filter(F.size("failed_rules") == 0)))
        flushing.run_once(spark, flushing.flush_writer(timed, path, wait_seconds=1), checkpoint)
        time.sleep(1.5)
    files = flushing.read_flushes(spark, path).filter(F.col("y") == "2024").groupBy(*LAKE_PARTITIONS, "lane", "flush", "cause")
    files = files.agg(F.count(F.lit(1)).alias("n"))
    fits = F.when(F.col("cause") == "size", F.col("n") == C.LAKE_BATCH_ROWS).otherwise(F.col("n") < C.LAKE_BATCH_ROWS)
    return files.groupBy(*LAKE_PARTITIONS).agg(F.sum("n").alias("events"), F.bool_and(fits).alias("sizes_fit"))


@query
def stream_online_latest(spark, sf_dir):
    path = new_path(spark, "online")
    _run(spark, jobs.online_writer(_raw_feature_stream(spark, sf_dir), path))
    latest = online_store.read_online(spark, path)
    return _doubles(_iso(latest, "event_timestamp"), "ctr_avg", "bounce_rate_avg")


@query
def stream_alerts(spark, sf_dir):
    path = new_path(spark, "alerts")
    stream = jobs.alert_stream(_raw_feature_stream(spark, sf_dir), _fixed_scorer(spark), C.SERVING_THRESHOLD)
    _run(spark, file_topic_writer(as_json(stream), path))
    found = spark.read.schema("value STRING").text(path).select(
        F.from_json("value", "ts STRING, geo STRING, platform STRING, event_count BIGINT, anomaly_score DOUBLE").alias("a")
    )
    return _rounded(found.select("a.*"), "anomaly_score")
