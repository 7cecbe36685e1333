import json
import os
import time

import pytest
from pyspark.sql import functions as F

from clickwatch.functions import rules
from clickwatch.operators import forest
from clickwatch.operators.windows import as_messages, sliding_features
from clickwatch.plans.fixed_forest import node_rows
from clickwatch.sinks import online_store
from clickwatch.schemas import CLICKSTREAM_TABLE
from clickwatch.sinks.tables import append_batch, read_batches
from clickwatch.sinks.topics import as_json, file_topic_writer
from clickwatch.sources.clickstream import window_input
from clickwatch.streaming import jobs
from clickwatch.streaming.sources import file_stream

BATCHES = [["10:30:10"], ["10:36:29"], ["10:32:00", "10:31:00"], ["10:50:00"], ["11:30:00"]]


def _event(time, ctr, **change):
    event = {
        "timestamp": f"2024-01-15T{time}Z", "user_id_hash": "0f1e2d3c4b5a6978", "ad_id": "ad_1", "campaign_id": "camp_1",
        "geo": "US", "platform": "web", "user_agent": "x", "CPC": 0.31, "CTR": ctr, "conversion": 0, "bounce_rate": 0.62,
    }
    return json.dumps({**event, **change})


def _put(folder, number, lines):
    path = os.path.join(folder, f"{number:03d}.txt")
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")
    os.utime(path, (1_700_000_000 + number * 10,) * 2)  # read in this order


@pytest.fixture()
def topic(tmp_path):
    folder = str(tmp_path / "topic")
    os.makedirs(folder)
    return folder


def _go(writer, tmp_path, name="checkpoint"):
    query = jobs.run(writer, str(tmp_path / name), available_now=True)
    query.awaitTermination()
    return query


def _windows(spark, path):
    found = jobs.parsed_features(spark.read.schema("value STRING").text(path), strict=True)
    return {r.window_start[11:16]: r.event_count for r in found.collect()}


def test_late_rows_and_open_windows(spark, topic, tmp_path):
    """A row is late when the watermark of the batch before has passed its windows."""
    for i, times in enumerate(BATCHES):
        _put(topic, i, [_event(t, 0.1 * (i + 1)) for t in times])
    out = str(tmp_path / "features")
    _go(file_topic_writer(as_json(jobs.feature_stream(file_stream(spark, topic, 1))), out), tmp_path)
    want = {"10:26": 1, "10:27": 2, "10:28": 3, "10:29": 3, "10:30": 3, "10:31": 2, "10:32": 2}
    want |= {f"10:{m}": 1 for m in (33, 34, 35, 36, 46, 47, 48, 49, 50)}
    assert _windows(spark, out) == want


def test_stream_equals_batch_for_closed_windows(spark, topic, tmp_path):
    lines = [_event(f"10:{m:02d}:{s:02d}", ctr, geo=geo) for m in range(20) for s, ctr, geo in ((5, 0.0213, "US"), (31, 0.5, "DE"), (59, 0.1111, "US"))]
    lines += ["broken", _event("10:05:00", 2.0)]
    _put(topic, 0, lines)
    out = str(tmp_path / "features")
    _go(file_topic_writer(as_json(jobs.feature_stream(file_stream(spark, topic))), out), tmp_path)
    streamed = jobs.parsed_features(spark.read.schema("value STRING").text(out), strict=True)
    batch = as_messages(sliding_features(window_input(spark.read.text(topic)))).filter("window_end <= '2024-01-15T10:19:29Z'")
    assert streamed.count() > 20
    columns = batch.columns
    assert streamed.select(columns).exceptAll(batch).count() == 0 and batch.exceptAll(streamed.select(columns)).count() == 0


def test_restart_continues_from_the_checkpoint(spark, topic, tmp_path):
    out = str(tmp_path / "features")
    for i, times in enumerate(BATCHES):
        _put(topic, i, [_event(t, 0.1) for t in times])
        _go(file_topic_writer(as_json(jobs.feature_stream(file_stream(spark, topic, 1))), out), tmp_path)
    found = jobs.parsed_features(spark.read.schema("value STRING").text(out), strict=True)
    assert found.groupBy("window_start").count().filter("count > 1").count() == 0
    assert _windows(spark, out)["10:28"] >= 1


def test_ingest_table_counts_and_quarantine(spark, topic, tmp_path):
    _put(topic, 0, [_event("10:30:00", 0.1), "broken", _event("10:31:00", 7)])
    _put(topic, 1, [_event("10:32:00", 0.2), _event("10:33:00", 0.2, geo="us")])
    table, bad = str(tmp_path / "table"), str(tmp_path / "bad")
    writer = lambda: jobs.ingest_writer(
        jobs.checked_events(file_stream(spark, topic, 1)),
        lambda rows, n: append_batch(rows, n, table), lambda rows, n: append_batch(rows, n, bad),
    )
    query = _go(writer(), tmp_path)
    seen = [p["observedMetrics"]["ingest"] for p in map(lambda p: json.loads(p.json), query.recentProgress) if p.get("observedMetrics")]
    assert sum(m["processed"] for m in seen) == 5 and sum(m["valid"] for m in seen) == 2
    stored = spark.read.option("recursiveFileLookup", "true").parquet(table)
    assert stored.count() == 2 and "created_at" in stored.columns
    quarantined = read_batches(spark, bad, "value STRING, failed_rules ARRAY<STRING>").collect()
    assert {tuple(r.failed_rules)[0] for r in quarantined if r.value != "broken"} == {"CTR", "geo"}
    assert len(quarantined) == 3
    # a query with another checkpoint starts at batch 0 again and replaces nothing
    _go(writer(), tmp_path, "another")
    assert read_batches(spark, table, CLICKSTREAM_TABLE).count() == 4
    # a batch that is written again replaces itself
    rows = jobs.valid_rows(jobs.checked_events(spark.read.text(topic)))
    for _ in range(2):
        append_batch(rows, 3, str(tmp_path / "once"))
    assert read_batches(spark, str(tmp_path / "once"), CLICKSTREAM_TABLE).count() == 2


def test_lake_files_by_hour_and_size(spark, topic, tmp_path):
    _put(topic, 0, [_event(f"10:{i % 60:02d}:00", 0.1) for i in range(250)] + [_event("11:00:00", 0.1)])
    lake = str(tmp_path / "lake")
    rows = jobs.valid_rows(jobs.checked_events(file_stream(spark, topic)))
    _go(jobs.lake_writer(rows, lake, rows_per_file=100), tmp_path)
    stored = spark.read.json(lake)
    assert {(r["y"], r["m"], r["d"], r["h"]): r["count"] for r in stored.groupBy("y", "m", "d", "h").count().collect()} == {
        (2024, 1, 15, 10): 250, (2024, 1, 15, 11): 1,
    }
    hour = os.path.join(lake, "y=2024", "m=01", "d=15", "h=10")
    assert len([f for f in os.listdir(hour) if f.endswith(".json")]) == 3  # 100 rows per file


def _feature(end, count, **change):
    message = {
        "window_start": f"2024-01-15T10:{end - 5:02d}:00Z", "window_end": f"2024-01-15T10:{end:02d}:00Z", "geo": "US",
        "platform": "web", "ctr_avg": 0.013, "bounce_rate_avg": 0.62, "event_count": count,
    }
    return json.dumps({**message, **change})


def test_latest_values_ignore_older_rows(spark, topic, tmp_path):
    root = str(tmp_path / "online")
    _put(topic, 0, [_feature(20, 5), _feature(10, 4), _feature(12, 9, geo="DE")])
    _go(jobs.online_writer(file_stream(spark, topic), root), tmp_path)
    _put(topic, 1, [_feature(15, 7), _feature(25, -1), "broken"])
    _go(jobs.online_writer(file_stream(spark, topic), root), tmp_path)
    rows = online_store.read_online(spark, root).collect()
    assert {r.geo: r.event_count for r in rows} == {"US": 5, "DE": 9}


def test_alerts_only_for_flagged_valid_features(spark, topic, tmp_path):
    scorer = forest.load_scorer(forest.forest_table(spark, node_rows()))
    lines = [_feature(20, 5), _feature(21, 5, ctr_avg=0.9, bounce_rate_avg=0.99), _feature(22, 5, ctr_avg=9), "broken"]
    _put(topic, 0, lines)
    features = jobs.parsed_features(spark.read.text(topic), strict=True)
    from clickwatch.operators.scoring import scored

    scores = {r.window_end: r.anomaly_score for r in scored(features, scorer).collect()}
    assert len(scores) == 2
    limit = max(scores.values())
    out = str(tmp_path / "alerts")
    _go(file_topic_writer(as_json(jobs.alert_stream(file_stream(spark, topic), scorer, limit)), out), tmp_path)
    found = [json.loads(r.value) for r in spark.read.text(out).collect()]
    assert {a["ts"] for a in found} == {e for e, s in scores.items() if s >= limit}
    assert found[0]["source_window"]["end"] == found[0]["ts"]


def test_progress_offsets(spark):
    class Query:
        lastProgress = {"sources": [{"endOffset": {"clickstream": {"0": 5, "1": 9}}, "latestOffset": '{"clickstream": {"0": 8, "1": 9}}'}]}

    from clickwatch.operators.monitoring import partition_lag

    lag = partition_lag(*jobs.progress_offsets(spark, Query()))
    assert {r.partition: r["lag"] for r in lag.collect()} == {0: 3, 1: 0}


def test_lag_listener(spark):
    class Event:
        class progress:  # noqa: N801
            json = json.dumps({
                "name": "ingest",
                "sources": [{"endOffset": {"t": {"0": 5, "1": 9}}, "latestOffset": {"t": {"0": 8, "1": 9, "2": 1}}}, {"endOffset": {"logOffset": 3}, "latestOffset": None}],
            })

    seen = []
    jobs.LagListener(seen.extend).onQueryProgress(Event)
    assert seen == [("ingest", "t", 0, 8, 5, 3), ("ingest", "t", 1, 9, 9, 0)]


def test_expired_keys_leave_state_and_table(spark, tmp_path):
    """Of two keys one goes on; once the watermark is past the other's time to live it is in neither."""
    from clickwatch.streaming import expiry

    topic, root, checkpoint = (str(tmp_path / n) for n in ("topic", "online", "checkpoint"))
    line = (
        '{"window_start": "2024-01-01T%s:00Z", "window_end": "2024-01-01T%s:00Z", "geo": "US", "platform": "%s", '
        '"ctr_avg": 0.1, "bounce_rate_avg": 0.2, "event_count": %d}'
    )

    def run(*rows):
        spark.createDataFrame([(line % r,) for r in rows], "value STRING").write.mode("append").text(topic)
        writer = expiry.expiring_writer(file_stream(spark, topic), root, ttl_seconds=600)
        jobs.run(writer, checkpoint, available_now=True).awaitTermination()
        state = spark.read.format("statestore").option("stateVarName", expiry.STATE).load(checkpoint)
        held = {r.platform for r in state.select("key.platform").collect()}
        table = {r.platform: r.event_count for r in online_store.read_online(spark, root).collect()}
        assert held == set(table)
        return table

    assert run(("00:00", "00:05", "web", 1), ("00:00", "00:05", "ios", 2), ("00:01", "00:06", "ios", 3)) == {"web": 1, "ios": 3}
    assert run(("00:05", "00:10", "ios", 4)) == {"web": 1, "ios": 4}
    assert run(("00:15", "00:20", "ios", 5)) == {"ios": 5}
    online_store.compact(spark, root)
    online_store.compact(spark, root)
    assert run(("00:15", "00:20", "web", 6)) == {"web": 6, "ios": 5}
    # older than the time to live when it comes
    assert run(("00:35", "00:40", "ios", 7), ("00:10", "00:15", "android", 8)) == {"ios": 7}


def test_observed_counts_of_every_batch(spark, tmp_path):
    """A row per batch and metric; batches of a second run are added, none is counted twice."""
    from clickwatch.streaming import metrics

    topic, root, checkpoint, table, bad = (str(tmp_path / n) for n in ("topic", "observed", "checkpoint", "table", "bad"))
    listener = metrics.ObservedMetrics(spark, root)
    spark.streams.addListener(listener)
    try:
        for times in (["10:30:10", "10:31:00"], ["10:32:00"]):
            lines = [(_event(t, 0.02),) for t in times] + [("{broken",)]
            spark.createDataFrame(lines, "value STRING").coalesce(1).write.mode("append").text(topic)
            checked = jobs.checked_events(file_stream(spark, topic))
            writer = jobs.ingest_writer(checked, lambda r, n: append_batch(r, n, table), lambda r, n: append_batch(r, n, bad))
            query = jobs.run(writer, checkpoint, available_now=True)
            query.awaitTermination()
            listener.wait(query)
    finally:
        spark.streams.removeListener(listener)
    observed = metrics.read_observed(spark, root)
    assert observed.select("batch_id").distinct().count() == 2
    totals = {r.metric: r.total for r in metrics.observed_totals(observed, "ingest").collect()}
    assert totals == {"processed": 5, "valid": 3, "invalid": 2}


def test_lines_are_flushed_by_size_and_by_time(spark, tmp_path):
    """Five lines make two files of two at once; the fifth waits in the state over a restart until its time is over."""
    from clickwatch.sinks.files import lake_rows
    from clickwatch.streaming import flushing

    topic, root, checkpoint = (str(tmp_path / n) for n in ("topic", "lake", "checkpoint"))

    def run(*times):
        spark.createDataFrame([(t,) for t in times], "value STRING").write.mode("append").text(topic)
        lines = lake_rows(file_stream(spark, topic).withColumn("timestamp", F.col("value").cast("timestamp")))
        flushing.run_once(spark, flushing.flush_writer(lines, root, rows=2, wait_seconds=0.5), checkpoint)
        found = flushing.read_flushes(spark, root).groupBy("h", "flush", "cause").agg(F.sort_array(F.collect_list("value")).alias("v"))
        held = spark.read.format("statestore").option("stateVarName", flushing.PROGRESS).load(checkpoint)
        waiting = {r.h: r.waiting for r in held.select("key.h", "value.waiting").collect()}
        return {(r.h, r.flush, r.cause): r.v for r in found.collect()}, waiting

    at = [f"2024-01-01 10:00:0{i}" for i in range(5)]
    files, waiting = run(*at)
    assert {k: len(v) for k, v in files.items()} == {("10", 0, "size"): 2, ("10", 1, "size"): 2} and waiting == {"10": 1}
    time.sleep(1)
    files, waiting = run("2024-01-01 11:00:00")
    assert {k: len(v) for k, v in files.items()} == {("10", 0, "size"): 2, ("10", 1, "size"): 2, ("10", 2, "time"): 1}
    assert sorted(sum(files.values(), [])) == at and waiting == {"10": 0, "11": 1}
    # the waiting line is the first of a file that is full before its time
    files, waiting = run("2024-01-01 11:00:01", "2024-01-01 11:00:02", "2024-01-01 11:00:03")
    lines = sorted(v for k, values in files.items() for v in values if k[0] == "11")
    assert files["11", 0, "size"] and lines == [f"2024-01-01 11:00:0{i}" for i in range(4)] and waiting == {"10": 0, "11": 0}


def test_a_flush_is_a_file_and_not_a_folder(spark, tmp_path):
    """A backlog of many flushes: a file of so many lines each, a folder for all of a buffer."""
    import glob
    import os

    from clickwatch.sinks.files import lake_rows
    from clickwatch.streaming import flushing

    topic, root = str(tmp_path / "topic"), str(tmp_path / "lake")
    lines = [(f"2024-01-01 1{i % 2}:{i // 60:02d}:{i % 60:02d}",) for i in range(2000)]
    spark.createDataFrame(lines, "value STRING").write.text(topic)
    stream = lake_rows(file_stream(spark, topic).withColumn("timestamp", F.col("value").cast("timestamp")))
    flushing.run_once(spark, flushing.flush_writer(stream, root, rows=10, wait_seconds=60), str(tmp_path / "checkpoint"))
    files = glob.glob(f"{root}/**/*.json", recursive=True)
    assert len(files) == 200 and len({os.path.dirname(f) for f in files}) == 2
    found = flushing.read_flushes(spark, root).withColumn("file", F.input_file_name())
    assert sorted(r.value for r in found.collect()) == sorted(v for v, in lines)
    per = found.groupBy("file", "h", "flush", "cause").count().collect()
    assert len(per) == 200 and {(r["count"], r.cause) for r in per} == {(10, "size")}
    assert {(r.h, r.flush) for r in per} == {(h, n) for h in ("10", "11") for n in range(100)}
