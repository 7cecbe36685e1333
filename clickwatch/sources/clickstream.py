"""Click events derived from the `events` table.

The table has no geography, platform or ratios, so they are computed from its
own columns; 30 days are squeezed into 6 hours so that 5-minute windows hold
several events. `raw_events` renders the same events as JSON text, a known share
of it faulty, the way they would arrive on a topic.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickwatch.functions import rules
from clickwatch.functions.scalars import pseudonymous_id, to_units
from clickwatch.functions.timefmt import iso_utc, parse_utc
from clickwatch.schemas import CLICK_EVENT, WINDOW_EVENT, struct
from clickwatch.session import use_all_cores, use_utc

EVENTS_SCHEMA = struct(
    "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
)

# --- fixed values of the derivation --------------------------------------------
EPOCH_START_MICROS = 1_704_067_200_000_000  # 2024-01-01T00:00:00Z
TIME_SQUEEZE = 120
GEOS = ("US", "IN", "BR", "DE", "FR", "UK", "CA", "JP", "IT", "AU")
SALT = "salt"


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return use_utc(spark).read.schema(EVENTS_SCHEMA).parquet(f"{sf_dir}/events.parquet")


def events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same table as a file stream; the pattern fits a single file and a folder of files."""
    limited = use_utc(spark).readStream.schema(EVENTS_SCHEMA).option("maxFilesPerTrigger", 1_000)
    return limited.parquet(f"{sf_dir}/events.parque[t]")


def squeezed_time() -> Column:
    shifted = F.unix_micros(F.col("ts").cast("timestamp")) - F.lit(EPOCH_START_MICROS)
    return F.timestamp_micros(F.lit(EPOCH_START_MICROS) + F.call_function("div", shifted, F.lit(TIME_SQUEEZE)))


def _decimal(units: Column, digits: int) -> Column:
    """Whole units of 10^-digits as a decimal."""
    return (units.cast("decimal(6,0)") * F.lit(Decimal(1).scaleb(-digits))).cast(f"decimal(10,{digits})")


def to_clicks(ev: DataFrame) -> DataFrame:
    cents = to_units(F.col("value"), 2)
    share = F.pmod(F.col("event_id"), F.lit(20))
    return ev.select(
        "event_id",
        squeezed_time().alias("ts"),
        pseudonymous_id(F.col("user_id"), SALT).alias("user_id_hash"),
        F.concat(F.lit("ad_"), (F.lit(1000) + F.col("event_id") % 9000).cast("string")).alias("ad_id"),
        F.concat(F.lit("camp_"), (F.lit(100) + F.col("user_id") % 900).cast("string")).alias("campaign_id"),
        F.element_at(F.array(*map(F.lit, GEOS)), (F.col("user_id") % 10).cast("int") + 1).alias("geo"),
        F.when(share < 9, "web").when(share < 15, "android").otherwise("ios").alias("platform"),
        F.concat(F.lit("agent/"), F.col("event_type")).alias("user_agent"),
        _decimal(F.lit(100) + cents % 1100, 3).alias("cpc"),
        _decimal(cents % 500, 4).alias("ctr"),
        F.when(F.col("event_type") == "purchase", 1).otherwise(0).alias("conversion"),
        _decimal(F.lit(200) + (cents * 7) % 700, 3).alias("bounce_rate"),
    )


def clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_clicks(events(spark, sf_dir))


def _json_field(name: str, text: Column) -> Column:
    return F.concat(F.lit(f'"{name}":"'), text, F.lit('"'))


def _json_number(name: str, number: Column) -> Column:
    return F.concat(F.lit(f'"{name}":'), number.cast("string"))


def to_raw(cl: DataFrame) -> DataFrame:
    """One JSON text per event; the event number decides which fault it carries."""
    fault = F.pmod(F.col("event_id"), F.lit(50))

    def faulty(code: int, wrong: str, right: Column) -> Column:
        return F.when(fault == code, F.lit(wrong)).otherwise(right)

    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    body = F.concat_ws(
        ",",
        _json_field("timestamp", F.concat(stamp, F.when(fault == 1, "").otherwise("Z"))),
        _json_field("user_id_hash", faulty(2, "xyz", F.col("user_id_hash"))),
        _json_field("ad_id", faulty(3, "advertisement_1", F.col("ad_id"))),
        _json_field("campaign_id", F.col("campaign_id")),
        _json_field("geo", F.when(fault == 4, F.lower("geo")).when(fault == 6, F.lit("USA")).otherwise(F.col("geo"))),
        _json_field("platform", faulty(7, "desktop", F.col("platform"))),
        _json_field("user_agent", faulty(8, "  ", F.col("user_agent"))),
        _json_number("CPC", F.when(fault == 13, "12345678.5").otherwise(faulty(9, "-0.5", F.col("cpc").cast("string")))),
        _json_number("CTR", faulty(10, "1.5", F.col("ctr").cast("string"))),
        _json_number("conversion", faulty(11, "2", F.col("conversion").cast("string"))),
        F.when(fault != 12, _json_number("bounce_rate", F.col("bounce_rate"))),
    )
    text = F.concat(F.lit("{"), body, F.lit("}"))
    return cl.select("event_id", F.when(fault == 5, F.substring(text, 1, 40)).otherwise(text).alias("value"))


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ("event_id", "ts", "user_id", "event_type", "value")
    return to_raw(to_clicks(use_all_cores(events(spark, sf_dir).select(*columns))))


def to_raw_features(features: DataFrame) -> DataFrame:
    """Feature windows as JSON text; window time and count decide which fault a row carries."""
    fault = F.pmod(F.call_function("div", F.unix_seconds("window_start"), F.lit(60)) + F.col("event_count"), F.lit(20))
    geo = F.when(fault == 1, F.lower("geo")).otherwise(F.col("geo"))
    count = F.col("event_count").cast("string")
    body = F.concat_ws(
        ",",
        _json_field("window_start", iso_utc(F.col("window_start"))),
        _json_field("window_end", F.when(fault == 5, F.rtrim(iso_utc(F.col("window_end")), F.lit("Z"))).otherwise(iso_utc(F.col("window_end")))),
        F.when(fault != 8, _json_field("geo", geo)),
        _json_field("platform", F.when(fault == 2, "desktop").otherwise(F.col("platform"))),
        _json_number("ctr_avg", F.when(fault == 3, "1.5").otherwise(F.col("ctr_avg").cast("decimal(10,4)").cast("string"))),
        _json_number("bounce_rate_avg", F.when(fault == 7, "-0.1").otherwise(F.col("bounce_rate_avg").cast("decimal(10,3)").cast("string"))),
        _json_number("event_count", F.when(fault == 4, "0").when(fault == 9, F.concat(count, F.lit(".0"))).otherwise(count)),
    )
    text = F.concat(F.lit("{"), body, F.lit("}"))
    return features.select(F.when(fault == 6, F.substring(text, 1, 40)).otherwise(text).alias("value"))


def parse_events(raw: DataFrame, column: str = "value", keep_text: bool = False) -> DataFrame:
    """JSON text to the eleven event fields, NULL where unreadable."""
    return rules.parse_json(raw, CLICK_EVENT, column, keep_text)


def to_table_rows(parsed: DataFrame) -> DataFrame:
    """Valid wire events to the event table's names and types."""
    kept = [c for c in parsed.columns if c not in {*CLICK_EVENT.fieldNames(), rules.CORRUPT, "failed_rules"}]
    return parsed.select(
        *kept,
        parse_utc(F.col("timestamp")).alias("timestamp"),
        "user_id_hash",
        "ad_id",
        "campaign_id",
        "geo",
        "platform",
        "user_agent",
        F.col("CPC").try_cast("decimal(10,3)").alias("cpc"),
        F.col("CTR").try_cast("decimal(10,4)").alias("ctr"),
        F.col("conversion").try_cast("int").alias("conversion"),
        F.col("bounce_rate").try_cast("decimal(10,3)").alias("bounce_rate"),
    )


def window_input(raw: DataFrame, column: str = "value") -> DataFrame:
    """Event text cut to the five fields windows need, rows failing the subset rules dropped."""
    parsed = rules.parse_json(raw, WINDOW_EVENT, column)
    kept = [c for c in raw.columns if c != column]
    return rules.keep_valid(parsed, rules.stream_subset_rules()).select(
        *kept,
        parse_utc(F.col("timestamp")).alias("ts"),
        "geo",
        "platform",
        F.col("CTR").alias("ctr"),
        "bounce_rate",
    )
