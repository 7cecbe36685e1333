import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from clickwatch.functions.scalars import pseudonymous_id
from clickwatch.operators import monitoring, reports
from clickwatch.sources import clickstream

UTC = dt.timezone.utc


def test_overview(spark, sf_dir):
    cl = clickstream.clicks(spark, sf_dir)
    report = reports.overview(cl)
    assert list(report) == ["total", "recent", "daily", "geo"]
    assert report["recent"].count() == 5 and report["daily"].count() == 10
    newest = [r.ts for r in report["recent"].collect()]
    assert newest == sorted(newest, reverse=True)


def test_overview_of_an_empty_table(spark, sf_dir):
    report = reports.overview(clickstream.clicks(spark, sf_dir).limit(0))
    assert list(report) == ["total"] and report["total"].first()[0] == 0


def test_top_n_needs_no_full_sort(spark, sf_dir):
    plan = reports.top_recent_events(clickstream.clicks(spark, sf_dir))._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "Exchange" not in plan


def test_scan_reads_only_needed_columns(spark, sf_dir):
    plan = reports.geo_stats(clickstream.clicks(spark, sf_dir))._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<user_id:bigint,value:double>" in plan


def test_pseudonym_is_stable_and_salted(spark):
    row = spark.range(1).select(pseudonymous_id(F.lit(7), "a"), pseudonymous_id(F.lit(7), "b")).first()
    assert len(row[0]) == 16 and row[0] != row[1]


def test_lag_is_never_negative_and_needs_both_sides(spark):
    schema = "topic STRING, partition INT, offset BIGINT"
    high = spark.createDataFrame([("t", 0, 10), ("t", 1, 3), ("t", 2, 8)], schema)
    done = spark.createDataFrame([("t", 0, 4), ("t", 1, 5)], schema)
    assert {r.partition: r["lag"] for r in monitoring.partition_lag(high, done).collect()} == {0: 6, 1: 0}


def test_histogram_quantile_interpolates(spark):
    base = dt.datetime(2024, 1, 15, tzinfo=UTC)
    rows = [(base, 0.2)] * 10 + [(base, 0.4)] * 10 + [(base + dt.timedelta(minutes=7), 99.0)]
    df = spark.createDataFrame(rows, "ts TIMESTAMP, s DOUBLE")
    found = [r["quantile"] for r in monitoring.histogram_quantile(df, "ts", F.col("s")).orderBy("window_start").collect()]
    assert found == [pytest.approx(0.25 + 0.25 * 0.9), 10.0]


def test_cumulative_histogram(spark):
    df = spark.createDataFrame([(0.05,), (0.1,), (0.7,), (50.0,)], "anomaly_score DOUBLE")
    rows = {r.le: r["rows"] for r in monitoring.score_histogram(df).collect()}
    assert rows["0.0"] == 0 and rows["0.1"] == 2 and rows["1.0"] == 3 and rows["10.0"] == 3 and rows["+Inf"] == 4


def test_counters_that_restart(spark):
    """Gains over samples: a drop is a restart, the first sample gains nothing, series do not mix."""
    samples = spark.createDataFrame(
        [("a", 0, 10), ("a", 60, 15), ("a", 120, 4), ("a", 180, 4), ("a", 300, 10), ("b", 30, 100), ("b", 90, 101)],
        "instance STRING, s INT, value BIGINT",
    ).withColumn("at", F.timestamp_seconds("s"))
    gained = monitoring.counter_increases(samples, ["instance"])
    assert [(r.instance, r.s, r.increase) for r in gained.orderBy("instance", "s").collect()] == [
        ("a", 0, 0), ("a", 60, 5), ("a", 120, 4), ("a", 180, 0), ("a", 300, 6), ("b", 30, 0), ("b", 90, 1)
    ]
    rate = monitoring.counter_rate(samples, ["instance"], ["instance"])
    assert sorted(r.per_second for r in rate.collect()) == [1 / 300, 6 / 300, 9 / 300]
    buckets = [(le, s, v) for s, values in ((0, (0, 0, 0)), (60, (2, 6, 8)), (360, (1, 1, 1)), (420, (1, 1, 1))) for le, v in zip((1.0, 2.0, math.inf), values)]
    frame = spark.createDataFrame(buckets, "le DOUBLE, s INT, value BIGINT").withColumn("at", F.timestamp_seconds("s"))
    found = {r.observations: r.quantile for r in monitoring.bucket_quantile(frame, [], 0.5).collect()}
    assert found == {8: 1.5, 1: 0.5}
    assert {r.observations: r.quantile for r in monitoring.bucket_quantile(frame, [], 0.9).collect()}[8] == 2.0


def test_report_is_one_table(spark, sf_dir):
    """Its parts equal the single reports; total, daily and geo share one scan, the newest events have their own."""
    cl = clickstream.clicks(spark, sf_dir)
    report = reports.report(cl, recent=3, daily=4)
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 2 and "TakeOrderedAndProject" in plan
    rows = report.collect()
    parts = {s: sorted((r for r in rows if r.section == s), key=lambda r: r.position) for s in ("total", "daily", "geo", "recent")}
    assert sum(map(len, parts.values())) == len(rows) and [r.events for r in parts["total"]] == [cl.count()]
    daily = reports.latest_daily_stats(cl, 4).collect()
    assert [(r.date, r.geo, r.platform, r.events, r.avg_ctr) for r in parts["daily"]] == [(r.date, r.geo, r.platform, r.total_events, r.avg_ctr) for r in daily]
    assert [(r.geo, r.events, r.avg_cpc) for r in parts["geo"]] == [(r.geo, r.event_count, r.avg_cpc) for r in reports.geo_stats(cl).collect()]
    assert [r.event_id for r in parts["recent"]] == [r.event_id for r in reports.top_recent_events(cl, 3).collect()]


def test_report_of_an_empty_table(spark, sf_dir):
    rows = reports.report(clickstream.clicks(spark, sf_dir).limit(0)).collect()
    assert [(r.section, r.position, r.events) for r in rows] == [("total", 1, 0)]
