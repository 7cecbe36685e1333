"""Quantiles of many days from one small sketch per day, without reading the rows again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: accuracy of a sketch: values kept per level
SKETCH_K = 1024


def rank_error(k: int = SKETCH_K) -> float:
    """Share of all rows by which the rank of an estimate may be off, 99 times in 100; merging adds nothing."""
    return 2.296 / k**0.9021


def daily_sketches(rows: DataFrame, column: str, day: str = "ingest_date", k: int = SKETCH_K) -> DataFrame:
    """day, rows with a value, and a mergeable KLL sketch of the values; NULL and NaN are left out."""
    value = F.col(column).cast("double")
    known = rows.filter(value.isNotNull() & ~F.isnan(value))
    return known.groupBy(day).agg(F.count(F.lit(1)).alias("rows"), F.kll_sketch_agg_double(value, k).alias("sketch"))


def write_sketches(sketches: DataFrame, root: str, day: str = "ingest_date") -> None:
    """Sketches by day; a day that is written again is replaced, other days stay."""
    writer = sketches.repartition(day).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(day).parquet(root)


def read_sketches(spark: SparkSession, root: str, day: str = "ingest_date") -> DataFrame:
    return spark.read.schema(f"rows BIGINT, sketch BINARY, `{day}` DATE").parquet(root)


def merged_quantiles(sketches: DataFrame, probabilities: Sequence[float], k: int = SKETCH_K) -> DataFrame:
    """p, days, rows and quantile over all given days; no days, no rows."""
    merged = sketches.agg(
        F.count(F.lit(1)).alias("days"), F.sum("rows").alias("rows"), F.kll_merge_agg_double("sketch", k).alias("sketch")
    ).filter("days > 0")
    found = [
        F.struct(F.lit(float(p)).alias("p"), F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))).alias("quantile"))
        for p in probabilities
    ]
    return merged.select("days", "rows", F.inline(F.array(*found))).select("p", "days", "rows", "quantile")


def with_rank_gap(quantiles: DataFrame, rows: DataFrame, column: str) -> DataFrame:
    """`quantiles` with the distance of p from the ranks that `quantile` really has among `rows`, from one scan."""
    estimates = quantiles.select("p", "quantile").collect()  # one row per probability asked for
    value = F.col(column).cast("double")
    known = rows.filter(value.isNotNull() & ~F.isnan(value))
    counts = [F.struct(F.lit(e.p).alias("p"), F.count_if(value < e.quantile).alias("below"), F.count_if(value <= e.quantile).alias("upto"), F.count(F.lit(1)).alias("total")) for e in estimates]
    if not counts:
        return quantiles.withColumn("rank_gap", F.lit(None).cast("double"))
    ranks = known.agg(F.array(*counts).alias("ranks")).select(F.inline("ranks"))
    gap = F.greatest(F.lit(0.0), F.col("below") / F.col("total") - F.col("p"), F.col("p") - F.col("upto") / F.col("total"))
    return quantiles.join(ranks.select("p", gap.alias("rank_gap")), "p")
