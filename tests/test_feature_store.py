import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from clickwatch.operators import feature_store
from clickwatch.schemas import FEATURE
from clickwatch.session import stage
from clickwatch.sinks import online_store
from clickwatch.sinks.files import write_offline
from clickwatch.sources.tables import read_offline

BASE = dt.datetime(2024, 1, 15, 10, 0, tzinfo=dt.timezone.utc)


def _features(spark, ends):
    """(geo, platform, minute) triples as feature rows."""
    rows = [
        (BASE + dt.timedelta(minutes=m - 5), BASE + dt.timedelta(minutes=m), g, p, 0.001 * m, 0.002 * m, m)
        for g, p, m in ends
    ]
    return spark.createDataFrame(rows, FEATURE)


def _at(minute):
    return F.lit(BASE + dt.timedelta(minutes=minute))


def test_latest_per_key(spark):
    features = _features(spark, [("US", "web", m) for m in (3, 9, 5)] + [("DE", "ios", 2)])
    rows = feature_store.latest_online(features).collect()
    assert {(r.geo, r.platform): r.event_count for r in rows} == {("US", "web"): 9, ("DE", "ios"): 2}
    assert dict(feature_store.latest_online(features).dtypes)["ctr_avg"] == "float"


def test_lookup_of_known_unknown_and_stale_keys(spark):
    online = stage(feature_store.latest_online(_features(spark, [("US", "ios", 10), ("DE", "web", 1)])), "online")
    entities = spark.createDataFrame(
        [(1, "US", "ios"), (2, "DE", "web"), (3, "JP", "android"), (4, None, "web"), (5, "US", "ios")],
        "id INT, geo STRING, platform STRING",
    )
    rows = feature_store.online_lookup(entities, online, _at(11), ttl="5 minutes").collect()
    assert {r.id: r.event_count for r in rows} == {1: 10, 2: None, 3: None, 4: None, 5: 10}
    three_days = feature_store.online_lookup(entities, online, _at(11)).collect()
    assert {r.id: r.event_count for r in three_days}[2] == 1


@pytest.mark.parametrize("ttl,minutes", [("3 days", 4320), ("10 minutes", 10), ("90 seconds", 1.5), ("30 seconds", 0.5)])
def test_asof_equals_brute_force(spark, ttl, minutes):
    rng = random.Random(8)
    keys = [("US", "web")] * 8 + [("DE", "web"), ("JP", "ios")]  # one key has most rows
    ends = sorted({(*rng.choice(keys), rng.randrange(0, 200, rng.choice([1, 7]))) for _ in range(120)})
    events = [(i, BASE + dt.timedelta(seconds=rng.randrange(-600, 15000)), *rng.choice(keys)) for i in range(400)]
    df = spark.createDataFrame(events, "id INT, ts TIMESTAMP, geo STRING, platform STRING")
    got = {r.id: r.event_count for r in feature_store.asof_features(df, _features(spark, ends), ttl=ttl).collect()}
    want = {}
    for i, ts, geo, platform in events:
        age = (ts - BASE).total_seconds() / 60
        ok = [m for g, p, m in ends if (g, p) == (geo, platform) and age - minutes <= m <= age]
        want[i] = max(ok) if ok else None
    assert got == want


def test_incremental_materialisation_is_what_a_full_one_gives(spark):
    rng = random.Random(2)
    features = _features(spark, sorted({(rng.choice(["US", "DE"]), "web", rng.randrange(60)) for _ in range(60)}))
    state = feature_store.latest_online(features.filter(F.col("window_end") <= _at(10)))
    for since, until in ((10, 25), (25, 40)):
        state = feature_store.materialize_incremental(state, features, _at(since), _at(until))
    full = feature_store.latest_online(features.filter(F.col("window_end") <= _at(40)))
    assert sorted(map(tuple, state.collect())) == sorted(map(tuple, full.collect()))


def test_offline_round_trip_and_rerun(spark, tmp_path):
    root = str(tmp_path / "offline")
    features = _features(spark, [("US", "web", m) for m in range(0, 3000, 5)])
    write_offline(features, root)
    write_offline(features.filter(F.col("window_end") >= _at(24 * 60)), root)  # replaces the dates it has
    back = read_offline(spark, root)
    first_day = back.filter("ingest_date = date'2024-01-15'")
    assert first_day.count() == features.filter("to_date(window_end) = date'2024-01-15'").count()
    assert back.columns[3:6] == ["platform", "avg_ctr", "avg_bounce_rate"]
    assert "PartitionFilters: [isnotnull(ingest_date" in first_day._jdf.queryExecution().executedPlan().toString()
    assert feature_store.from_offline(back).columns[4:6] == ["ctr_avg", "bounce_rate_avg"]


def test_days_back(spark):
    features = _features(spark, [("US", "web", m) for m in (0, 1440, 2880)])
    rows = feature_store.by_window_end(features, days_back=1, as_of=_at(2880)).collect()
    assert [r.event_count for r in rows] == [1440, 2880]
    assert feature_store.by_window_end(features).count() == 3


def test_online_log_is_idempotent_and_compacts(spark, tmp_path):
    root = str(tmp_path / "online")
    newer = feature_store.online_rows(_features(spark, [("US", "web", 9), ("US", "web", 7)]))
    older = feature_store.online_rows(_features(spark, [("US", "web", 4), ("DE", "web", 1)]))
    online_store.upsert(newer, 0, root)
    online_store.upsert(older, 1, root)
    online_store.upsert(older, 1, root)  # the batch again after a failure
    want = {("US", 9), ("DE", 1)}
    assert {(r.geo, r.event_count) for r in online_store.read_online(spark, root).collect()} == want
    for _ in range(3):
        online_store.compact(spark, root)
        assert {(r.geo, r.event_count) for r in online_store.read_online(spark, root).collect()} == want
    _, folders = online_store._folders(spark, root)
    assert len(folders) == 2  # the last snapshot and the one it covers


def test_asof_takes_off_grid_and_repeated_features(spark):
    def row(minute, second, count):
        end = BASE + dt.timedelta(minutes=minute, seconds=second)
        return (end - dt.timedelta(minutes=5), end, "US", "web", 0.01, 0.5, count)

    rows = [row(5, 20, 1), row(5, 20, 1), row(5, 40, 2), row(5, 40, 7), row(2000, 30, 3)]
    seconds = {0: None, 310: None, 330: 1, 345: 7, 370: 7, 60 * 2000 + 29: 7, 60 * 2000 + 30: 3, 60 * 9000: None}
    events = [(i, BASE + dt.timedelta(seconds=s), "US", "web") for i, s in enumerate(seconds)] + [(99, None, "US", "web"), (98, BASE, None, "web")]
    df = spark.createDataFrame(events, "id INT, ts TIMESTAMP, geo STRING, platform STRING")
    got = {r.id: r.event_count for r in feature_store.asof_features(df, spark.createDataFrame(rows, FEATURE)).collect()}
    assert got == {**dict(enumerate(seconds.values())), 99: None, 98: None}


def test_latest_values_need_no_sort(spark):
    plan = feature_store.latest_online(_features(spark, [("US", "web", 1)]))._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "Sort" not in plan


def test_asof_of_sparse_keys_and_a_long_ttl(spark):
    """Each row and each feature moves once, whatever the ttl: a feature 29 days old is found, one of 31 is not."""
    features = spark.createDataFrame(
        [("US", "web", "2024-01-01 00:00:00", 0.1, 0.2, 1), ("US", "web", "2024-01-01 00:00:00", 0.1, 0.2, 3),
         ("US", "ios", "2024-02-01 10:00:00", 0.3, 0.4, 7), ("US", "ios", "2024-02-01 10:30:00", 0.5, 0.6, 9)],
        "geo STRING, platform STRING, end STRING, ctr_avg DOUBLE, bounce_rate_avg DOUBLE, event_count BIGINT",
    ).withColumn("window_end", F.col("end").cast("timestamp")).drop("end")
    asked = [
        (1, "US", "web", "2024-01-30 00:00:00", 3), (2, "US", "web", "2024-02-01 00:00:00", None),
        (3, "US", "web", "2023-12-31 23:59:59", None), (4, "US", "ios", "2024-02-01 10:00:00", 7),
        (5, "US", "ios", "2024-02-01 10:29:59", 7), (6, "US", "ios", "2024-02-01 10:30:00", 9), (7, "US", "ios", "2024-02-20 00:00:00", 9),
        (8, None, "ios", "2024-02-20 00:00:00", None), (9, "US", "ios", None, None), (10, "DE", "ios", "2024-02-20 00:00:00", None),
    ]
    rows = spark.createDataFrame([r[:4] for r in asked], "id INT, geo STRING, platform STRING, at STRING")
    rows = rows.withColumn("ts", F.col("at").cast("timestamp"))
    found = feature_store.asof_features(rows, features, ttl="30 days")
    assert {r.id: r.event_count for r in found.collect()} == {r[0]: r[4] for r in asked}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and found.columns == [*rows.columns, "window_end", "ctr_avg", "bounce_rate_avg", "event_count"]


def test_materialisation_remembers_where_it_ended(spark, tmp_path):
    """A repeated run does nothing, a run that was cut off before its commit is made good, and gaps are not left."""
    root = str(tmp_path / "online")
    micros = lambda minute: int((BASE + dt.timedelta(minutes=minute)).timestamp()) * 1_000_000
    features = _features(spark, [("US", "web", m) for m in range(10)] + [("IN", "ios", 2), ("IN", "ios", 7)])

    def newest():
        return {r.geo: r.event_count for r in online_store.read_online(spark, root).collect()}

    assert online_store.materialized_intervals(spark, root).count() == 0
    assert online_store.materialize_next(features, root, micros(3)) and newest() == {"US": 3, "IN": 2}
    assert not online_store.materialize_next(features, root, micros(3))
    assert not online_store.materialize_next(features, root, micros(1)) and newest() == {"US": 3, "IN": 2}
    # rows are there, the commit is not: the same interval is taken in again
    cut = features.filter(F.unix_micros("window_end") == micros(5))
    feature_rows = feature_store.latest_online(cut).withColumn("gone", F.lit(False))
    feature_rows.select("geo", "platform", "event_timestamp", "ctr_avg", "bounce_rate_avg", "event_count", "gone").write.parquet(f"{root}/log/materialized/{micros(6)}")
    assert online_store.materialize_next(features, root, micros(6)) and newest() == {"US": 6, "IN": 2}
    assert online_store.materialize_next(features, root, micros(100)) and newest() == {"US": 9, "IN": 7}
    done = online_store.materialized_intervals(spark, root).orderBy("until").collect()
    assert [tuple(r) for r in done] == [(None, micros(3)), (micros(3), micros(6)), (micros(6), micros(100))]
    online_store.compact(spark, root)
    assert newest() == {"US": 9, "IN": 7} and not online_store.materialize_next(features, root, micros(100))
