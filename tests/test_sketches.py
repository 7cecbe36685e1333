"""Daily sketches: merged quantiles against exact ranks, days replaced, missing values, no days."""

import datetime as dt

from pyspark.sql import functions as F

from clickwatch.operators import sketches


def test_merged_days_are_within_the_rank_error(spark, tmp_path):
    root, days = str(tmp_path / "sketches"), 5
    # skewed, with many ties, and one day that holds a third of all rows
    day = F.when(F.col("id") % 3 == 0, 0).otherwise(1 + F.col("id") % (days - 1))
    value = F.when(F.col("id") % 10 == 0, 1.0).otherwise(F.exp(F.rand(5) * 20))
    rows = spark.range(120_000).select(F.date_add(F.lit(dt.date(2024, 1, 1)), day.cast("int")).alias("ingest_date"), value.alias("v"))
    sketches.write_sketches(sketches.daily_sketches(rows, "v"), root)
    stored = sketches.read_sketches(spark, root)
    assert stored.count() == days and stored.select(F.max(F.length("sketch"))).first()[0] < 64_000
    found = sketches.with_rank_gap(sketches.merged_quantiles(stored, (0.0, 0.02, 0.5, 0.98, 1.0)), rows, "v").collect()
    assert len(found) == 5 and all((r.days, r.rows) == (days, 120_000) for r in found)
    assert all(r.rank_gap <= 2 * sketches.rank_error() for r in found)
    # a day written again replaces itself and no other
    first = rows.filter(F.col("ingest_date") == dt.date(2024, 1, 1)).limit(7)
    sketches.write_sketches(sketches.daily_sketches(first, "v"), root)
    counts = {r.ingest_date.day: r.rows for r in sketches.read_sketches(spark, root).collect()}
    assert counts[1] == 7 and len(counts) == days


def test_missing_values_and_no_days(spark):
    day = dt.date(2024, 1, 1)
    rows = spark.createDataFrame([(day, 1.0), (day, None), (day, float("nan")), (dt.date(2024, 1, 2), None)], "ingest_date DATE, v DOUBLE")
    made = sketches.daily_sketches(rows, "v")
    assert [(r.ingest_date, r.rows) for r in made.collect()] == [(day, 1)]
    found = sketches.merged_quantiles(made, (0.5,))
    assert [tuple(r) for r in found.collect()] == [(0.5, 1, 1, 1.0)]
    assert sketches.merged_quantiles(made.limit(0), (0.5,)).count() == 0
