import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from clickwatch.operators import evaluation
from clickwatch.session import stage

BASE = dt.datetime(2024, 1, 15, tzinfo=dt.timezone.utc)
SCHEMA = "window_end TIMESTAMP, geo STRING, platform STRING, ctr DOUBLE, bounce DOUBLE, count DOUBLE"


def _table(spark, sizes, seed=1):
    rng = random.Random(seed)
    rows = [
        (BASE + dt.timedelta(minutes=i), geo, "web", rng.random() * 0.05, rng.random(), float(rng.randrange(1, 900)))
        for geo, n in sizes.items() for i in range(n)
    ]
    return stage(spark.createDataFrame(rows, SCHEMA), "rows"), len(rows)


@pytest.mark.parametrize("sizes,rate,stratified", [
    ({"US": 900, "DE": 100}, 0.02, False),
    ({"US": 900, "DE": 100}, 0.02, True),
    ({"US": 500, "DE": 3, "JP": 1}, 0.1, True),  # small strata: topped up
    ({g + h: 4 for g in "ABCDE" for h in "FGHIJ"}, 0.02, True),  # more strata than picks: cut
    ({"US": 7}, 0.0001, False),  # at least one
])
def test_injected_rows(spark, sizes, rate, stratified):
    rows, n = _table(spark, sizes)
    injected = stage(evaluation.inject(rows, 1000.0, rate, stratified=stratified), "injected")
    k = max(1, round(rate * n))
    assert injected.count() == n and injected.select("window_end", "geo").distinct().count() == n
    marked = injected.filter("label = 1")
    assert marked.count() == k
    assert injected.filter("ctr < 0 or ctr > 1 or bounce < 0 or bounce > 1 or count > 1000").count() == 0
    same = injected.filter("label = 0").drop("label", "kind")
    assert same.exceptAll(rows).count() == 0


def test_strata_get_equal_shares(spark):
    rows, _ = _table(spark, {"US": 900, "DE": 300, "JP": 300})
    picks = evaluation.pick_stratified(rows, 0.02).filter("picked").groupBy("geo").count().collect()
    assert {r["geo"]: r["count"] for r in picks} == {"US": 10, "DE": 10, "JP": 10}


@pytest.mark.parametrize("stratified", [False, True])
def test_repeated_rows_stay_as_many(spark, stratified):
    rows, n = _table(spark, {"US": 3, "DE": 3})
    again = stage(rows.unionByName(rows), "repeated")
    assert evaluation.inject(again, 1000.0, 0.3, stratified=stratified).count() == 2 * n


def test_stratified_picks_do_not_move_the_table(spark):
    rows, _ = _table(spark, {"US": 500, "DE": 100})
    plan = evaluation.pick_stratified(rows, 0.1)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan


def test_changes_stay_in_their_ranges(spark):
    rows, _ = _table(spark, {"US": 3000})
    injected = evaluation.inject(rows, 1000.0, rate=0.5).filter("label = 1")
    before = rows.withColumnsRenamed({c: f"{c}_before" for c in ("ctr", "bounce", "count")})
    both = stage(injected.join(before, ["window_end", "geo", "platform"]), "both")
    shares = {r["kind"]: r["count"] for r in both.groupBy("kind").count().collect()}
    assert set(shares) == {"ctr_spike", "bounce_spike", "volume_spike", "mixed"} and min(shares.values()) > 300
    ratio = F.col("count") / F.col("count_before")
    volume = both.filter("kind = 'volume_spike' and count < 1000").agg(F.min(ratio), F.max(ratio)).first()
    assert 1.1 <= volume[0] and volume[1] <= 1.3
    shift = F.col("bounce") - F.col("bounce_before")
    bounce = both.filter("kind = 'bounce_spike' and bounce < 1").agg(F.min(shift), F.max(shift)).first()
    assert 0.02 - 0.006 <= bounce[0] and bounce[1] <= 0.05 + 0.006
    assert both.filter("kind in ('ctr_spike', 'bounce_spike') and count <> count_before").count() == 0


def test_other_seed_other_rows(spark):
    rows, _ = _table(spark, {"US": 1000})
    a, b = (evaluation.pick_uniform(rows, 0.05, seed).filter("picked").select("window_end") for seed in (1, 2))
    assert a.exceptAll(b).count() > 0
    assert a.exceptAll(evaluation.pick_uniform(rows.repartition(3), 0.05, 1).filter("picked").select("window_end")).count() == 0


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(4)
    data = [(rng.randrange(30) / 10 + (0.5 if rng.random() < 0.1 else 0), int(rng.random() < 0.2)) for _ in range(500)]
    return data, spark.createDataFrame(data, "anomaly_score DOUBLE, label INT")


def test_auc_counts_pairs(spark, labelled):
    data, df = labelled
    pos = [s for s, y in data if y]
    neg = [s for s, y in data if not y]
    want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / len(pos) / len(neg)
    counts = evaluation.threshold_counts(df)
    assert evaluation.roc_auc(counts).first()[0] == pytest.approx(want)


def test_roc_points(spark, labelled):
    data, df = labelled
    p, n = sum(y for _, y in data), sum(1 - y for _, y in data)
    got = evaluation.roc_curve(evaluation.threshold_counts(df)).collect()
    want = {(None, 0.0, 0.0)} | {
        (t, sum(1 - y for s, y in data if s >= t) / n, sum(y for s, y in data if s >= t) / p) for t in {s for s, _ in data}
    }
    assert {(r.threshold, r.fpr, r.tpr) for r in got} == want


def test_dropped_points_lie_on_the_line(spark, labelled):
    _, df = labelled
    counts = evaluation.threshold_counts(df)
    full = sorted((r.fpr, r.tpr) for r in evaluation.roc_curve(counts).collect())
    kept = sorted((r.fpr, r.tpr) for r in evaluation.roc_curve(counts, drop_intermediate=True).collect())
    assert set(kept) < set(full) and kept[0] == full[0] and kept[-1] == full[-1]
    for x, y in set(full) - set(kept):
        left = max(p for p in kept if p <= (x, y))
        right = min(p for p in kept if p >= (x, y))
        assert (y - left[1]) * (right[0] - left[0]) == pytest.approx((x - left[0]) * (right[1] - left[1]))


def test_single_class(spark):
    df = spark.createDataFrame([(0.1, 0), (0.2, 0)], "anomaly_score DOUBLE, label INT")
    assert evaluation.roc_auc(evaluation.threshold_counts(df)).first()[0] is None
    row = evaluation.confusion_metrics(df, F.lit(False)).first()
    assert (row.precision, row.recall, row.f1, row.tn) == (0.0, 0.0, 0.0, 2)


def test_confusion(spark):
    df = spark.createDataFrame([(0.9, 1), (0.8, 0), (0.2, 1), (0.1, 0)], "anomaly_score DOUBLE, label INT")
    row = evaluation.confusion_metrics(df, F.col("anomaly_score") >= 0.5).first()
    assert row.asDict() == {"tp": 1, "fp": 1, "fn": 1, "tn": 1, "precision": 0.5, "recall": 0.5, "f1": 0.5}
