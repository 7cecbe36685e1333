"""One job from a feature table to a stored model: split, fit, evaluate, threshold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickwatch.operators import evaluation, forest, scoring
from clickwatch.operators.dataset import build_dataset, model_inputs, standardized
from clickwatch.schemas import METRICS_DOCUMENT
from clickwatch.session import stage
from clickwatch.sinks.files import write_document, write_model
from clickwatch.sources.tables import read_model


def train_model(features: DataFrame, path: str, **forest_options: int) -> None:
    """Fit on the train split and write node table, parameters, threshold, split sizes and metrics below `path`.

    The threshold is the alert quantile of the validation rows, a known share of
    them altered; the metrics tell how many of those it finds. `features` is a staged table.
    """
    spark = features.sparkSession
    ds = build_dataset(features)
    nodes = stage(forest.fit_forest(ds.train, **forest_options), "forest")
    injected = evaluation.inject(ds.bounded.filter(~ds.is_train), ds.params.count_cap)
    inputs = standardized(model_inputs(injected, ds.params.count_cap, "label"), ds.params)
    labelled = stage(forest.with_scores(inputs, forest.load_scorer(nodes)), "labelled")
    threshold = scoring.alert_threshold(labelled)
    metrics = evaluation.confusion_metrics(labelled, F.col("anomaly_score") >= F.lit(threshold)).first()
    area = evaluation.roc_auc(evaluation.threshold_counts(labelled)).first()["roc_auc"]
    write_model(nodes, path, ds.params, threshold, train_size=ds.train_size, total_size=ds.total_size)
    write_document(
        spark, f"{path}/metrics", METRICS_DOCUMENT,
        precision=metrics["precision"], recall=metrics["recall"], f1=metrics["f1"], roc_auc=area,
    )


def flag_with_model(features: DataFrame, path: str) -> DataFrame:
    """Scorable feature rows scored and flagged by the stored model."""
    nodes, params, threshold = read_model(features.sparkSession, path)
    return scoring.flagged(scoring.scored(features, forest.load_scorer(nodes), params), threshold)
