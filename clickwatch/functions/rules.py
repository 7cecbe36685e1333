"""Row rules as named column predicates.

Each rule set is a dict `rule name -> Column`. `check` adds `failed_rules`, so
filtering, quarantine and counting all come from one pass over the rows.
The sets accept different rows on purpose and stay separate.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickwatch import constants as C
from clickwatch.functions.timefmt import parse_utc

Rules = Mapping[str, Column]
CORRUPT = "_corrupt"


def parse_json(df: DataFrame, schema: T.StructType, column: str = "value", keep_text: bool = False) -> DataFrame:
    """Tolerant parse: bad JSON gives NULL fields and its text in `_corrupt`.

    `inline` makes the parse a step of its own. As a plain column it would be
    copied into every later filter and run once per rule.
    """
    with_corrupt = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    kept = [c for c in df.columns if c not in schema.fieldNames() and (keep_text or c != column)]
    return df.select(*kept, F.inline(F.array(F.from_json(column, with_corrupt, options))))


def _upper_pair(geo: Column) -> Column:
    return (F.length(geo) == 2) & (F.upper(geo) == geo) & (F.lower(geo) != geo)


def click_event_rules() -> dict[str, Column]:
    """All eleven fields of a click event, strictly."""
    c = F.col
    return {
        "timestamp": parse_utc(c("timestamp")).isNotNull(),
        "user_id_hash": c("user_id_hash").rlike(C.USER_ID_HASH_PATTERN),
        "ad_id": c("ad_id").rlike(C.AD_ID_PATTERN),
        "campaign_id": c("campaign_id").rlike(C.CAMPAIGN_ID_PATTERN),
        "geo": c("geo").rlike(C.GEO_PATTERN),
        "platform": c("platform").isin(*C.PLATFORMS),
        "user_agent": c("user_agent").rlike(r"(?U)\S"),  # Unicode white space is blank too
        "CPC": (c("CPC") >= 0) & ~F.isnan("CPC"),
        "CTR": c("CTR").between(0, 1),
        "conversion": c("conversion").isin(0.0, 1.0),
        "bounce_rate": c("bounce_rate").between(0, 1),
        # what the event table's DECIMAL(10,3) cannot hold is rejected by name, not by a failed cast
        "CPC_range": c("CPC").isNull() | (c("CPC") < C.CPC_LIMIT),
    }


def stream_subset_rules() -> dict[str, Column]:
    """The five fields the window job reads."""
    c = F.col
    return {
        "timestamp": parse_utc(c("timestamp")).isNotNull(),
        "geo": _upper_pair(c("geo")),
        "platform": c("platform").isin(*C.PLATFORMS),
        "CTR": c("CTR").between(0, 1),
        "bounce_rate": c("bounce_rate").between(0, 1),
    }


def strict_feature_rules() -> dict[str, Column]:
    c = F.col
    return {
        "window_start": parse_utc(c("window_start")).isNotNull(),
        "window_end": parse_utc(c("window_end")).isNotNull(),
        "geo": _upper_pair(c("geo")),
        "platform": c("platform").isin(*C.PLATFORMS),
        "ctr_avg": c("ctr_avg").between(0, 1),
        "bounce_rate_avg": c("bounce_rate_avg").between(0, 1),
        "event_count": (c("event_count") >= 1) & (c("event_count") == F.floor("event_count")),
    }


def lenient_feature_rules(require_z: bool = False) -> dict[str, Column]:
    """No upper bound on the ratios, any case in geo, zero counts allowed."""
    c = F.col
    rules = {
        "window_start": c("window_start").isNotNull(),
        "window_end": c("window_end").isNotNull(),
        "geo": F.length("geo") == 2,
        "platform": c("platform").isin(*C.PLATFORMS),
        "ctr_avg": c("ctr_avg") >= 0,
        "bounce_rate_avg": c("bounce_rate_avg") >= 0,
        "event_count": c("event_count") >= 0,
    }
    if require_z:
        rules["window_start"] = c("window_start").endswith("Z")
        rules["window_end"] = c("window_end").endswith("Z")
    return rules


def score_input_rules() -> dict[str, Column]:
    """What a row needs to be scored; keys and time are optional."""
    c = F.col
    return {
        "ctr_avg": c("ctr_avg").between(0, 1),
        "bounce_rate_avg": c("bounce_rate_avg").between(0, 1),
        "event_count": c("event_count") >= 1,
    }


def check(df: DataFrame, rules: Rules) -> DataFrame:
    """Add `failed_rules`; a NULL verdict (missing field) is a failure."""
    failures = [F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items()]
    return df.withColumn("failed_rules", F.array_compact(F.array(*failures)))


def _all_hold(rules: Rules) -> Column:
    verdict = F.lit(True)
    for ok in rules.values():
        verdict = verdict & F.coalesce(ok, F.lit(False))
    return verdict


def keep_valid(df: DataFrame, rules: Rules) -> DataFrame:
    return df.filter(_all_hold(rules))


def keep_invalid(df: DataFrame, rules: Rules) -> DataFrame:
    return check(df.filter(~_all_hold(rules)), rules)


def failure_counts(df: DataFrame, rules: Rules) -> DataFrame:
    """Rows failing each rule, rules without failures left out; one aggregate row is shuffled.

    Only rows with some failure reach the rule-by-rule count.
    """
    counts = df.filter(~_all_hold(rules)).agg(*[F.count_if(~F.coalesce(ok, F.lit(False))).alias(name) for name, ok in rules.items()])
    entries = [F.struct(F.lit(name).alias("rule"), F.col(name).alias("failures")) for name in rules]
    return counts.select(F.inline(F.array(*entries))).filter("failures > 0")


def quality_metrics(rules: Rules) -> list[Column]:
    """Aggregates for `df.observe` or `df.agg`: rows seen, kept and skipped."""
    ok = _all_hold(rules)
    return [
        F.count(F.lit(1)).alias("processed"),
        F.count_if(ok).alias("valid"),
        (F.count(F.lit(1)) - F.count_if(ok)).alias("invalid"),
    ]
