import json

import pytest
from pyspark.sql import functions as F

from clickwatch.functions import rules
from clickwatch.functions.timefmt import iso_utc, parse_utc
from clickwatch.schemas import FEATURE_MESSAGE, LENIENT_FEATURE_MESSAGE, MissingColumnsError, require_columns
from clickwatch.sources.clickstream import parse_events, to_table_rows, window_input

EVENT = {
    "timestamp": "2024-01-15T10:30:00.000Z",
    "user_id_hash": "0f1e2d3c4b5a6978",
    "ad_id": "ad_77",
    "campaign_id": "camp_31",
    "geo": "US",
    "platform": "web",
    "user_agent": "reader/2 (desk)",
    "CPC": 0.31,
    "CTR": 0.013,
    "conversion": 0,
    "bounce_rate": 0.62,
}
FEATURE = {
    "window_start": "2024-01-15T10:30:00Z",
    "window_end": "2024-01-15T10:35:00Z",
    "geo": "US",
    "platform": "web",
    "ctr_avg": 0.013,
    "bounce_rate_avg": 0.62,
    "event_count": 42,
}

# fault -> (changed field, its value, expected failed rules)
EVENT_FAULTS = {
    "none": ({}, []),
    "no zone": ({"timestamp": "2024-01-15T10:30:00.000"}, ["timestamp"]),
    "no date": ({"timestamp": "10:30Z"}, ["timestamp"]),
    "month 13": ({"timestamp": "2024-13-15T10:30:00Z"}, ["timestamp"]),
    "compact time": ({"timestamp": "20240115T103000Z"}, []),
    "blank instead of T": ({"timestamp": "2024-01-15 10:30Z"}, []),
    "lower-case geo": ({"geo": "us"}, ["geo"]),
    "long geo": ({"geo": "USA"}, ["geo"]),
    "geo with digit": ({"geo": "U1"}, ["geo"]),
    "CTR high": ({"CTR": 1.5}, ["CTR"]),
    "CTR negative": ({"CTR": -0.1}, ["CTR"]),
    "CTR boolean": ({"CTR": True}, ["CTR"]),
    "CTR at bounds": ({"CTR": 1, "bounce_rate": 0}, []),
    "CPC negative": ({"CPC": -0.5}, ["CPC"]),
    "CPC beyond the table": ({"CPC": 12345678.5}, ["CPC_range"]),
    "CPC at the table's end": ({"CPC": 9999999.999}, []),
    "conversion": ({"conversion": 2}, ["conversion"]),
    "conversion as 1.0": ({"conversion": 1.0}, []),
    "ad id": ({"ad_id": "adv_77"}, ["ad_id"]),
    "other digits": ({"ad_id": "ad_١٢"}, []),
    "campaign id": ({"campaign_id": "campaign-31"}, ["campaign_id"]),
    "hash": ({"user_id_hash": "invalid_hash"}, ["user_id_hash"]),
    "short hash": ({"user_id_hash": "0f1e2d3c4b5a697"}, ["user_id_hash"]),
    "long hash": ({"user_id_hash": "a" * 65}, ["user_id_hash"]),
    "agent empty": ({"user_agent": ""}, ["user_agent"]),
    "agent blank": ({"user_agent": " \t "}, ["user_agent"]),
    "agent of no-break spaces": ({"user_agent": "\u00a0\u2003"}, ["user_agent"]),
    "platform": ({"platform": "desktop"}, ["platform"]),
    "missing": ({"bounce_rate": None}, ["bounce_rate"]),
    "unknown field": ({"extra": {"a": 1}}, []),
    "two faults": ({"geo": "xx", "CTR": 7}, ["geo", "CTR"]),
}


def _texts(spark, named):
    return spark.createDataFrame(list(named.items()), "name STRING, value STRING")


def test_click_event_faults(spark):
    named = {n: json.dumps({k: v for k, v in {**EVENT, **change}.items() if v is not None}) for n, (change, _) in EVENT_FAULTS.items()}
    named["wrong key case"] = json.dumps({("ctr" if k == "CTR" else k): v for k, v in EVENT.items()})
    parsed = parse_events(_texts(spark, named))
    checked = rules.check(parsed, rules.click_event_rules()).collect()
    want = {n: failed for n, (_, failed) in EVENT_FAULTS.items()} | {"wrong key case": ["CTR"]}
    assert {r["name"]: r["failed_rules"] for r in checked} == want
    valid = {r["name"] for r in rules.keep_valid(parsed, rules.click_event_rules()).collect()}
    assert valid == {n for n, failed in want.items() if not failed}


@pytest.mark.parametrize("text", ["invalid json", "", '{"timestamp": "2024', "[1, 2]", "null"])
def test_unreadable_text_fails_every_rule_and_nothing_else_breaks(spark, text):
    parsed = parse_events(_texts(spark, {"bad": text, "good": json.dumps(EVENT)}), keep_text=True)
    rejected = rules.keep_invalid(parsed, rules.click_event_rules()).collect()
    assert [(r["name"], r["value"]) for r in rejected] == [("bad", text)]
    assert len(rejected[0]["failed_rules"]) == 11


def test_quality_counts(spark):
    named = {"a": json.dumps(EVENT), "b": "broken", "c": json.dumps({**EVENT, "geo": "x"})}
    counts = parse_events(_texts(spark, named)).agg(*rules.quality_metrics(rules.click_event_rules())).first()
    assert counts.asDict() == {"processed": 3, "valid": 1, "invalid": 2}


def test_bulk_rows_in_another_format_are_all_rejected(spark):
    other = {k.lower(): v for k, v in EVENT.items() if k != "conversion"}
    failures = rules.failure_counts(parse_events(_texts(spark, {"a": json.dumps(other)})), rules.click_event_rules())
    assert {r["rule"]: r["failures"] for r in failures.collect()} == {"CPC": 1, "CTR": 1, "conversion": 1}


def test_stream_subset_accepts_what_only_the_full_rules_reject(spark):
    named = {
        "good": EVENT,
        "bad ids": {**EVENT, "ad_id": "?", "user_id_hash": "?", "CPC": -1},
        "odd geo": {**EVENT, "geo": "U1"},
        "low geo": {**EVENT, "geo": "us"},
        "text number": {**EVENT, "CTR": "0.5"},
    }
    kept = window_input(_texts(spark, {n: json.dumps(e) for n, e in named.items()})).collect()
    assert {r["name"] for r in kept} == {"good", "bad ids", "odd geo"}
    assert set(kept[0].asDict()) == {"name", "ts", "geo", "platform", "ctr", "bounce_rate"}


def test_table_rows_have_declared_types(spark):
    rows = to_table_rows(parse_events(_texts(spark, {"a": json.dumps(EVENT)})))
    assert dict(rows.dtypes)["cpc"] == "decimal(10,3)" and dict(rows.dtypes)["ctr"] == "decimal(10,4)"
    assert str(rows.first()["bounce_rate"]) == "0.620"


FEATURE_CASES = {
    # change: (strict, lenient, lenient tail)
    "none": ({}, True, True, True),
    "lower geo": ({"geo": "us"}, False, True, True),
    "long geo": ({"geo": "usa"}, False, False, False),
    "platform": ({"platform": "desktop"}, False, False, False),
    "ratio above 1": ({"ctr_avg": 1.5}, False, True, True),
    "negative": ({"bounce_rate_avg": -0.1}, False, False, False),
    "zero count": ({"event_count": 0}, False, True, True),
    "fraction count": ({"event_count": 1.5}, False, False, False),
    "no Z": ({"window_end": "2024-01-15T10:35:00"}, False, True, False),
    "not a time": ({"window_start": "soonZ"}, False, True, True),
    "missing": ({"geo": None}, False, False, False),
}


def test_feature_rules_differ_as_intended(spark):
    named = {n: json.dumps({k: v for k, v in {**FEATURE, **c[0]}.items() if v is not None}) for n, c in FEATURE_CASES.items()}
    texts = _texts(spark, named)
    strict = rules.keep_valid(rules.parse_json(texts, FEATURE_MESSAGE), rules.strict_feature_rules())
    parsed = rules.parse_json(texts, LENIENT_FEATURE_MESSAGE)
    lenient = rules.keep_valid(parsed, rules.lenient_feature_rules())
    tail = rules.keep_valid(parsed, rules.lenient_feature_rules(require_z=True))
    for df, index in ((strict, 1), (lenient, 2), (tail, 3)):
        assert {r["name"] for r in df.collect()} == {n for n, c in FEATURE_CASES.items() if c[index]}


def test_time_text_round_trip(spark):
    df = spark.createDataFrame([("2024-01-15T10:30:00Z",)], "t STRING")
    assert df.select(iso_utc(parse_utc(F.col("t")))).first()[0] == "2024-01-15T10:30:00Z"


def test_required_columns(spark):
    with pytest.raises(MissingColumnsError, match="b"):
        require_columns(spark.range(1).withColumnRenamed("id", "a"), "a", "b")
