import datetime as dt
import random
from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from clickwatch.operators.windows import as_messages, sliding_features, tumbling_features, window_features

BASE = dt.datetime(2024, 1, 15, 10, 0, tzinfo=dt.timezone.utc)
SCHEMA = "ts TIMESTAMP, geo STRING, platform STRING, ctr {0}, bounce_rate {1}"


def _events(n=400, seed=1):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        ts = BASE + dt.timedelta(milliseconds=rng.randrange(20 * 60 * 1000))
        geo = "US" if rng.random() < 0.6 else "DE"
        rows.append((ts, geo, "web", Decimal(rng.randrange(500)).scaleb(-4), Decimal(rng.randrange(1001)).scaleb(-3)))
    return rows


def _brute(rows, size, slide):
    groups = defaultdict(list)
    for ts, geo, platform, ctr, bounce in rows:
        second = int(ts.timestamp())
        start = second - second % slide
        while start > second - size:
            groups[start, geo, platform].append((ctr, bounce))
            start -= slide

    def mean(values, digits):
        return float((sum(values) / len(values)).quantize(Decimal(1).scaleb(-digits), ROUND_HALF_UP))

    return {k: (mean([c for c, _ in v], 4), mean([b for _, b in v], 3), len(v)) for k, v in groups.items()}


def _result(df):
    return {
        (int(r.window_start.timestamp()), r.geo, r.platform): (r.ctr_avg, r.bounce_rate_avg, r.event_count)
        for r in df.withColumns({c: F.col(c) for c in ("window_start",)}).collect()
    }


@pytest.fixture()
def utc(monkeypatch):
    monkeypatch.setenv("TZ", "UTC")


@pytest.mark.parametrize("size,slide", [(300, 60), (300, 300), (120, 30), (300, 120)])
def test_sliding_equals_brute_force(spark, size, slide):
    rows = _events()
    df = spark.createDataFrame(rows, SCHEMA.format("DECIMAL(10,4)", "DECIMAL(10,3)"))
    assert _result(sliding_features(df, f"{size} seconds", f"{slide} seconds")) == _brute(rows, size, slide)


def test_doubles_give_the_same_as_decimals(spark):
    rows = _events(seed=2)
    decimals = spark.createDataFrame(rows, SCHEMA.format("DECIMAL(10,4)", "DECIMAL(10,3)"))
    doubles = decimals.withColumns({c: F.col(c).cast("double") for c in ("ctr", "bounce_rate")})
    want = _result(sliding_features(decimals))
    assert _result(sliding_features(doubles)) == want
    assert _result(window_features(doubles, slide="1 minute")) == want


def test_tumbling(spark):
    rows = _events(seed=3)
    df = spark.createDataFrame(rows, SCHEMA.format("DECIMAL(10,4)", "DECIMAL(10,3)"))
    assert _result(tumbling_features(df)) == _brute(rows, 300, 300)


def test_window_edges_and_message_fields(spark):
    df = spark.createDataFrame(
        [(BASE, "US", "web", 0.1, 0.5), (BASE + dt.timedelta(minutes=5), "US", "web", 0.3, 0.7)],
        SCHEMA.format("DOUBLE", "DOUBLE"),
    )
    rows = {r.window_start: r for r in as_messages(sliding_features(df)).collect()}
    assert len(rows) == 10  # start inclusive, end exclusive: no window holds both
    assert rows["2024-01-15T10:00:00Z"].window_end == "2024-01-15T10:05:00Z"
    assert rows["2024-01-15T10:00:00Z"].ctr_avg == 0.1
    assert list(rows["2024-01-15T10:01:00Z"].asDict()) == [
        "window_start", "window_end", "geo", "platform", "ctr_avg", "bounce_rate_avg", "event_count",
    ]


def test_events_are_shuffled_only_as_partial_sums(spark):
    df = spark.createDataFrame(_events(20), SCHEMA.format("DECIMAL(10,4)", "DECIMAL(10,3)"))
    plan = sliding_features(df)._jdf.queryExecution().executedPlan().toString()
    first_exchange = plan.rindex("Exchange hashpartitioning")
    assert "partial_sum" in plan[first_exchange:]
    assert "Expand" not in plan and "Generate" in plan[:first_exchange]
