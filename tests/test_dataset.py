import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickwatch.operators import dataset
from clickwatch.operators.dataset import MODEL_COLUMNS
from clickwatch.schemas import FEATURE, MissingColumnsError
from clickwatch.session import stage

BASE = dt.datetime(2024, 1, 15, 23, 40, tzinfo=dt.timezone.utc)


def _rows(n_windows=40, seed=1):
    rng = random.Random(seed)
    rows = []
    for w in range(n_windows):
        end = BASE + dt.timedelta(minutes=w)
        for geo in ("US", "DE", "JP"):
            for platform in ("web", "ios"):
                if rng.random() < 0.8:
                    rows.append((end - dt.timedelta(minutes=5), end, geo, platform, rng.random() * 1.2, rng.random(), rng.randrange(0, 3000)))
    return rows


@pytest.fixture(scope="module")
def rows():
    return _rows()


@pytest.fixture(scope="module")
def features(spark, rows):
    return stage(spark.createDataFrame(rows, FEATURE), "features")


def test_split_is_the_first_rows_in_time_order(spark, features, rows):
    is_train, train, total = dataset.split_at(features)
    order = sorted((r[1], r[2], r[3]) for r in rows)
    assert (train, total) == (int(0.8 * len(rows)), len(rows))
    got = {(r.window_end.timestamp(), r.geo, r.platform) for r in features.filter(is_train).collect()}
    assert got == {(e.timestamp(), g, p) for e, g, p in order[:train]}


@pytest.mark.parametrize("ratio", [0.0, 0.003, 0.5, 1.0])
def test_split_sizes_at_other_ratios(features, ratio):
    is_train, train, total = dataset.split_at(features, ratio)
    row = dataset.split_sizes(features, is_train).first()
    assert (row.train_size, row.val_size) == (int(total * ratio), total - int(total * ratio))


def test_preparation_equals_numpy(features, rows):
    ds = dataset.build_dataset(features)
    count = np.maximum([r[6] for r in rows], 1).astype(float)
    cap = max(np.quantile(count, 0.999), 1000)
    assert ds.params.count_cap == pytest.approx(cap) and cap > 1000
    order = sorted(range(len(rows)), key=lambda i: (rows[i][1], rows[i][2], rows[i][3]))
    x = np.column_stack([
        np.clip([r[4] for r in rows], 0, 1), np.clip([r[5] for r in rows], 0, 1), np.log1p(np.minimum(count, cap)),
    ])[order]
    train = x[: ds.train_size]
    assert np.allclose(ds.params.mean, train.mean(axis=0)) and np.allclose(ds.params.scale, train.std(axis=0))
    got = [[r[c] for c in MODEL_COLUMNS] for r in ds.scaled.orderBy("window_end", "geo", "platform").collect()]
    assert np.allclose(got, (x - train.mean(axis=0)) / train.std(axis=0))


def test_cap_is_the_floor_for_small_counts_only(spark, features, rows):
    small = stage(features.withColumn("event_count", F.least("event_count", F.lit(1000))), "small")
    assert dataset.count_cap(small)[1] == 1000.0
    assert dataset.count_cap(features.limit(0)) == (None, 1000.0)


def test_rows_without_time_or_keys_are_in_one_split(spark, rows):
    holes = [(r[0], None if i % 5 == 0 else r[1], None if i % 7 == 0 else r[2], r[3], *r[4:]) for i, r in enumerate(rows)]
    df = stage(spark.createDataFrame(holes, FEATURE), "holes")
    is_train, train, total = dataset.split_at(df)
    sizes = dataset.split_sizes(df, is_train).first()
    assert sizes.train_size + sizes.val_size == total == len(rows)
    assert sizes.train_size >= train


def test_train_and_serve_prepare_alike(features):
    ds = dataset.build_dataset(features)
    served = dataset.serving_inputs(features.filter("event_count >= 1"), ds.params).select("window_end", "geo", "platform", *MODEL_COLUMNS)
    trained = ds.scaled.join(served.select("window_end", "geo", "platform"), ["window_end", "geo", "platform"])
    assert served.exceptAll(trained.select(served.columns)).count() == 0


def test_inverse_returns_natural_units(features):
    ds = dataset.build_dataset(features)
    back = dataset.inverse(ds.scaled, ds.params).alias("i").join(ds.bounded.alias("b"), ["window_end", "geo", "platform"])
    worst = back.agg(*[F.max(F.abs(F.col(f"i.{c}") - F.col(f"b.{c}"))) for c in ("ctr", "bounce", "count")]).first()
    assert max(worst) < 1e-6


def test_rows_with_missing_features_are_dropped(spark, rows):
    holes = [(*rows[0][:4], None, 0.5, 3), (*rows[1][:4], 0.5, None, 3), (*rows[2][:4], 0.5, 0.5, None), rows[3]]
    assert dataset.complete_rows(spark.createDataFrame(holes, FEATURE)).count() == 1


def test_constant_column_scales_by_one(spark, rows):
    flat = spark.createDataFrame([(*r[:4], 0.5, r[5], r[6]) for r in rows], FEATURE)
    assert dataset.build_dataset(stage(flat, "flat")).params.scale[0] == 1.0


def test_missing_columns(features):
    with pytest.raises(MissingColumnsError, match="event_count"):
        dataset.complete_rows(features.drop("event_count"))
