"""Training set: bounded features, time-ordered split, train-only scaling."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickwatch import constants as C
from clickwatch.functions.scalars import clip
from clickwatch.operators.ordering import exact_quantile, kth_key, up_to_key
from clickwatch.operators.windows import KEYS
from clickwatch.schemas import require_columns

ORDER = ("window_end", *KEYS)
MODEL_COLUMNS = ("ctr", "bounce", "log_count")


@dataclass(frozen=True)
class Preprocessing:
    """What serving needs to repeat the training preparation."""

    mean: tuple[float, float, float]
    scale: tuple[float, float, float]
    count_cap: float


SERVING = Preprocessing(C.SERVING_MEAN, C.SERVING_SCALE, C.SERVING_COUNT_CAP)


def complete_rows(features: DataFrame) -> DataFrame:
    require_columns(features, *ORDER, *C.FEATURES_USED)
    return features.na.drop(subset=list(C.FEATURES_USED))


def floored_count() -> Column:
    return F.greatest(F.col("event_count").cast("double"), F.lit(1.0))


def count_cap(features: DataFrame) -> tuple[float | None, float]:
    """(99.9 % quantile of the floored counts, cap in use); without rows no quantile and the least cap."""
    quantile = exact_quantile(
        complete_rows(features).select(floored_count().alias("n")), "n", C.COUNT_CAP_QUANTILE
    )
    return quantile, C.COUNT_CAP_FLOOR if quantile is None else max(quantile, C.COUNT_CAP_FLOOR)


def bounded(features: DataFrame, cap: float) -> DataFrame:
    """Ratios in [0,1], counts in [1, cap]; still in natural units, keys kept."""
    return complete_rows(features).select(
        *ORDER,
        clip(F.col("ctr_avg"), 0.0, 1.0).alias("ctr"),
        clip(F.col("bounce_rate_avg"), 0.0, 1.0).alias("bounce"),
        F.least(floored_count(), F.lit(float(cap))).alias("count"),
    )


def model_inputs(rows: DataFrame, cap: float, *extra: str) -> DataFrame:
    """Bounded rows to the three model columns; the one path train and serve share."""
    return rows.select(
        *[c for c in (*ORDER, *extra) if c in rows.columns],
        clip(F.col("ctr"), 0.0, 1.0).alias("ctr"),
        clip(F.col("bounce"), 0.0, 1.0).alias("bounce"),
        F.log1p(F.least(F.col("count"), F.lit(float(cap)))).alias("log_count"),
    )


def prepared(features: DataFrame, cap: float) -> DataFrame:
    return model_inputs(bounded(features, cap), cap)


def split_at(rows: DataFrame, ratio: float = C.TRAIN_RATIO) -> tuple[Column, int, int]:
    """(is-train predicate, train size, total) for the first `ratio` of rows in time order.

    The predicate compares a row with the one row at the boundary, so splitting
    the table is a filter: nothing is sorted or shuffled, and parquet can skip.
    A NULL in time or keys comes last in its place, so every row is in one split.
    """
    total = rows.count()
    train = int(total * ratio)
    if train == 0:
        return F.lit(False), 0, total
    boundary = kth_key(rows, train, [F.to_date("window_end"), F.col("window_end")], ORDER)
    return up_to_key(boundary), train, total


def fit_scaler(train: DataFrame, cap: float) -> Preprocessing:
    """Population mean and deviation of the train rows; a constant column scales by 1."""
    stats = train.agg(
        *[F.avg(c).alias(f"mean_{c}") for c in MODEL_COLUMNS],
        # equal bounds, not a zero deviation: rounding can leave a speck of deviation
        *[F.when(F.min(c) < F.max(c), F.stddev_pop(c)).otherwise(1.0).alias(f"scale_{c}") for c in MODEL_COLUMNS],
    ).first()
    return Preprocessing(
        tuple(stats[f"mean_{c}"] for c in MODEL_COLUMNS),
        tuple(stats[f"scale_{c}"] for c in MODEL_COLUMNS),
        cap,
    )


def standardized(inputs: DataFrame, params: Preprocessing) -> DataFrame:
    scaled = {
        c: (F.col(c) - F.lit(m)) / F.lit(s) for c, m, s in zip(MODEL_COLUMNS, params.mean, params.scale)
    }
    return inputs.withColumns(scaled)


def serving_inputs(features: DataFrame, params: Preprocessing = SERVING) -> DataFrame:
    """Standardised model columns from scorable rows with stored parameters.

    Other columns stay. The count needs no floor here: scorable rows have one.
    """
    rest = [c for c in features.columns if c not in MODEL_COLUMNS]
    raw = features.select(
        *rest,
        clip(F.col("ctr_avg"), 0.0, 1.0).alias("ctr"),
        clip(F.col("bounce_rate_avg"), 0.0, 1.0).alias("bounce"),
        F.log1p(F.least(F.col("event_count").cast("double"), F.lit(params.count_cap))).alias("log_count"),
    )
    return standardized(raw, params)


def inverse(scaled: DataFrame, params: Preprocessing) -> DataFrame:
    """Standardised columns back to natural units, counts at least 1."""
    raw = {c: F.col(c) * F.lit(s) + F.lit(m) for c, m, s in zip(MODEL_COLUMNS, params.mean, params.scale)}
    return scaled.select(
        *ORDER,
        raw["ctr"].alias("ctr"),
        raw["bounce"].alias("bounce"),
        F.greatest(F.expm1(raw["log_count"]), F.lit(1.0)).alias("count"),
    )


def split_sizes(rows: DataFrame, is_train: Column) -> DataFrame:
    return rows.agg(
        F.count_if(is_train).alias("train_size"),
        F.count_if(~is_train).alias("val_size"),
        F.count(F.lit(1)).alias("total_size"),
    )


def split_name(is_train: Column) -> Column:
    return F.when(is_train, "train").otherwise("val")


def split_summary(scaled: DataFrame, is_train: Column) -> DataFrame:
    """Minimum, maximum and mean of each standardised column per split."""
    return scaled.groupBy(split_name(is_train).alias("split")).agg(
        *[f(c).alias(f"{label}_{c}") for c in MODEL_COLUMNS for label, f in (("min", F.min), ("max", F.max), ("mean", F.avg))]
    )


@dataclass(frozen=True)
class Dataset:
    """Handles on one prepared training set; the frames read one staged table."""

    bounded: DataFrame
    inputs: DataFrame
    scaled: DataFrame
    is_train: Column
    train_size: int
    total_size: int
    params: Preprocessing

    @property
    def train(self) -> DataFrame:
        return self.scaled.filter(self.is_train)

    @property
    def validation(self) -> DataFrame:
        return self.scaled.filter(~self.is_train)


def build_dataset(features: DataFrame) -> Dataset:
    """Everything from an offline feature table to scaled splits.

    Give a table (`stage`d or written): it is passed over for the cap, for the
    boundary row and for the train statistics, each time a small aggregate.
    """
    cap = count_cap(features)[1]
    rows = bounded(features, cap)
    inputs = model_inputs(rows, cap)
    is_train, train_size, total = split_at(rows)
    params = fit_scaler(inputs.filter(is_train), cap)
    return Dataset(rows, inputs, standardized(inputs, params), is_train, train_size, total, params)
