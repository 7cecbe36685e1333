"""Reports over the event table (columns as in `clicks`: ts, geo, platform, cpc, ctr, ...)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clickwatch.functions.scalars import to_units

RECENT_COLUMNS = (
    "ts", "user_id_hash", "ad_id", "campaign_id", "geo", "platform", "cpc", "ctr", "conversion", "bounce_rate",
)


def _mean(column: str, digits: int) -> Column:
    """Mean of a decimal column from its exact whole-number sum."""
    return F.sum(to_units(F.col(column), digits)) / F.lit(float(10**digits)) / F.count(column)


def total_events(events: DataFrame) -> DataFrame:
    return events.agg(F.count(F.lit(1)).alias("total_events"))


def daily_stats(events: DataFrame) -> DataFrame:
    return events.groupBy(F.to_date("ts").alias("date"), "geo", "platform").agg(
        F.count(F.lit(1)).alias("total_events"),
        _mean("ctr", 4).alias("avg_ctr"),
        _mean("bounce_rate", 3).alias("avg_bounce_rate"),
        _mean("cpc", 3).alias("avg_cpc"),
        F.sum("conversion").alias("total_conversions"),
        F.count_if(F.col("conversion") == 1).alias("conversion_count"),
    )


def latest_daily_stats(events: DataFrame, limit: int = 10) -> DataFrame:
    """Top rows by newest date; geo and platform break ties."""
    return daily_stats(events).orderBy(F.desc("date"), "geo", "platform").limit(limit)


def geo_stats(events: DataFrame) -> DataFrame:
    return (
        events.groupBy("geo")
        .agg(
            F.count(F.lit(1)).alias("event_count"),
            _mean("ctr", 4).alias("avg_ctr"),
            _mean("bounce_rate", 3).alias("avg_bounce_rate"),
            _mean("cpc", 3).alias("avg_cpc"),
        )
        .orderBy(F.desc("event_count"), "geo")
    )


def top_recent_events(events: DataFrame, limit: int = 10) -> DataFrame:
    """Newest events; the event number makes the order total."""
    return events.orderBy(F.desc("ts"), F.desc("event_id")).limit(limit).select("event_id", *RECENT_COLUMNS)


def recent_events(events: DataFrame, as_of: Column, hours: int = 24, newest_first: bool = True) -> DataFrame:
    """Events of the last `hours` before `as_of`, an explicit instant."""
    recent = events.filter(F.col("ts") >= as_of - F.make_dt_interval(hours=F.lit(hours)))
    return recent.orderBy(F.desc("ts")) if newest_first else recent


def report(events: DataFrame, recent: int = 5, daily: int = 10) -> DataFrame:
    """The whole report as one table: section, position in it, and the columns the section has.

    Sections `total`, `daily` (newest dates first) and `geo` (busiest first) come from one scan with grouping sets;
    `recent` takes a bounded heap per task from a scan of its own columns. An empty table has only its zero total.
    """
    one = events.select(
        F.to_date("ts").alias("date"), "geo", "platform", "ctr", "bounce_rate", "cpc", "conversion", F.lit(1).alias("one")
    )
    # grouping sets of no rows have no total; this row counts nothing and makes one
    nothing = events.sparkSession.range(1).select(F.lit(0).alias("one"))
    level = F.grouping_id("date", "geo", "platform")
    sums = (
        one.unionByName(nothing, allowMissingColumns=True)
        .groupingSets([["date", "geo", "platform"], ["geo"], []], "date", "geo", "platform")
        .agg(
            level.alias("level"),
            F.sum("one").alias("events"),
            _mean("ctr", 4).alias("avg_ctr"),
            _mean("bounce_rate", 3).alias("avg_bounce_rate"),
            _mean("cpc", 3).alias("avg_cpc"),
            F.sum("conversion").alias("total_conversions"),
        )
    )
    section = F.when(F.col("level") == 0, "daily").when(F.col("level") == 7, "total").otherwise("geo")
    kept = sums.filter((F.col("events") > 0) | (F.col("level") == 7)).withColumn("section", section)
    busiest = F.when(F.col("section") == "geo", -F.col("events"))
    order = Window.partitionBy("section").orderBy(F.desc("date"), busiest, "geo", "platform")
    ranked = kept.withColumn("position", F.row_number().over(order))
    sections = ranked.filter((F.col("section") != "daily") | (F.col("position") <= daily)).drop("level")
    newest = Window.orderBy(F.desc("ts"), F.desc("event_id"))
    latest = events.select("event_id", "ts", "geo", "platform").orderBy(F.desc("ts"), F.desc("event_id")).limit(recent)
    latest = latest.select(F.lit("recent").alias("section"), F.row_number().over(newest).alias("position"), "*")
    return sections.unionByName(latest, allowMissingColumns=True)


def overview(events: DataFrame) -> dict[str, DataFrame]:
    """The whole report; an empty table has only its zero count."""
    total = total_events(events)
    if events.isEmpty():
        return {"total": total}
    return {
        "total": total,
        "recent": top_recent_events(events, 5),
        "daily": latest_daily_stats(events),
        "geo": geo_stats(events),
    }
