import numpy as np
import pytest
from pyspark.sql import functions as F

from clickwatch.constants import SERVING_THRESHOLD
from clickwatch.operators import forest, scoring
from clickwatch.operators.dataset import serving_inputs
from clickwatch.plans.fixed_forest import node_rows
from clickwatch.sinks.files import write_model
from clickwatch.sources.tables import read_model
from clickwatch.operators.dataset import SERVING

REQUEST = "ctr_avg DOUBLE, bounce_rate_avg DOUBLE, event_count BIGINT, geo STRING, platform STRING, timestamp STRING"
FULL = (0.017, 0.58, 73, "FR", "android", "2023-06-02T08:05:00Z")


@pytest.fixture(scope="module")
def scorer(spark):
    return forest.load_scorer(forest.forest_table(spark, node_rows()))


def _batch(spark, scorer, rows):
    return scoring.score_batch(spark.createDataFrame(rows, REQUEST), scorer, SERVING_THRESHOLD)


def test_response_shape_and_flag(spark, scorer):
    row = _batch(spark, scorer, [FULL]).first()
    assert list(row.asDict()) == ["anomaly_score", "is_anomaly", "threshold", "features_used", "meta", "error"]
    assert row.is_anomaly == (row.anomaly_score >= row.threshold)
    assert row.features_used == ["ctr_avg", "bounce_rate_avg", "event_count"]
    assert row.meta == {"geo": "FR", "platform": "android", "timestamp": "2023-06-02T08:05:00Z"}


def test_minimal_row_has_no_meta(spark, scorer):
    rows = _batch(spark, scorer, [(0.02, 0.35, 100, None, None, None), (0.02, 0.35, 100, "DE", "", None)]).collect()
    assert [r.meta for r in rows] == [None, {"geo": "DE"}]


def test_batches_of_any_size(spark, scorer):
    assert _batch(spark, scorer, []).count() == 0
    assert _batch(spark, scorer, [FULL] * 3).count() == 3
    rows = _batch(spark, scorer, [FULL] * 1001).collect()
    assert len(rows) == 1001 and np.isfinite([r.anomaly_score for r in rows]).all()


@pytest.mark.parametrize("change", [(1.5, 0.5, 10), (-0.1, 0.5, 10), (0.5, 1.1, 10), (0.5, 0.5, 0), (0.5, 0.5, None), (None, 0.5, 10)])
def test_unscorable_rows_are_answered_with_their_faults(spark, scorer, change):
    rows = _batch(spark, scorer, [(*change, None, None, "bad"), FULL]).collect()
    bad = next(r for r in rows if r.meta.get("timestamp") == "bad")
    good = next(r for r in rows if r.meta.get("timestamp") != "bad")
    assert bad.anomaly_score is None and bad.is_anomaly is None and bad.error.startswith("invalid: ")
    assert good.error is None and good.anomaly_score is not None


def test_responses_carry_the_request_key(spark, scorer):
    requests = spark.createDataFrame([(7, *FULL), (8, 9.0, *FULL[1:])], "id INT, " + REQUEST)
    rows = scoring.score_batch(requests, scorer, SERVING_THRESHOLD, keys=("id",)).collect()
    assert {r.id: r.error for r in rows} == {7: None, 8: "invalid: ctr_avg"}


def test_serving_preparation(spark):
    df = spark.createDataFrame([(0.1, 0.5, 10), (0.1, 0.5, 5000)], "ctr_avg DOUBLE, bounce_rate_avg DOUBLE, event_count BIGINT")
    rows = serving_inputs(df).collect()
    for row, count in zip(rows, (10, 1000)):
        raw = np.array([0.1, 0.5, np.log1p(count)])
        assert np.allclose([row.ctr, row.bounce, row.log_count], (raw - SERVING.mean) / SERVING.scale)


FEATURE = "window_start STRING, window_end STRING, geo STRING, platform STRING, ctr_avg DOUBLE, bounce_rate_avg DOUBLE, event_count BIGINT, anomaly_score DOUBLE"


def test_alert_fields_and_filter(spark):
    rows = [("s1", "e1", "US", "web", 0.013, 0.62, 42, 1.2), ("s2", "e2", "DE", "ios", 0.02, 0.4, 10, 0.61), ("s3", "e3", "JP", "web", 0.02, 0.4, 10, 0.5)]
    found = scoring.alerts(scoring.flagged(spark.createDataFrame(rows, FEATURE), 0.61)).collect()
    assert [a.ts for a in found] == ["e1", "e2"]  # a score equal to the threshold counts
    assert found[0].asDict(True) == {
        "ts": "e1", "geo": "US", "platform": "web", "ctr_avg": 0.013, "bounce_rate_avg": 0.62, "event_count": 42,
        "anomaly_score": 1.2, "threshold": 0.61, "source_window": {"start": "s1", "end": "e1"},
    }


def test_contamination_share(spark):
    train = spark.range(1000).select((F.col("id") / 1000.0).alias("anomaly_score"))
    offset = scoring.contamination_offset(train)
    flags = scoring.contamination_flags(train, offset)
    assert flags.filter("is_outlier").count() == 20
    assert flags.filter("is_outlier").agg(F.min("anomaly_score")).first()[0] == pytest.approx(0.98)


def test_model_round_trip(spark, tmp_path, scorer):
    path = str(tmp_path / "model")
    write_model(forest.forest_table(spark, node_rows()), path, SERVING, 0.5, train_size=8, total_size=10)
    nodes, params, threshold = read_model(spark, path)
    assert params == SERVING and threshold == 0.5
    x = np.array([[0.1, -0.2, 3.0], [5.0, 1.0, -1.0]])
    assert (forest.load_scorer(nodes).score(x) == scorer.score(x)).all()


def test_anomaly_result_types(spark):
    from clickwatch.schemas import ANOMALY_RESULT

    rows = spark.createDataFrame([("s", "e", "US", "web", 0.013, 0.62, 42, 0.7)], FEATURE)
    rows = rows.withColumns({c: F.lit("2024-01-15 10:30:00").cast("timestamp") for c in ("window_start", "window_end")})
    results = scoring.anomaly_results(scoring.flagged(rows, 0.6))
    assert [(f.name, f.dataType) for f in results.schema] == [(f.name, f.dataType) for f in ANOMALY_RESULT]
    assert '"event_count":42' in results.first().details
