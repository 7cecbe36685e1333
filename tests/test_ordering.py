import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickwatch.operators.ordering import exact_quantile, exact_quantiles, group_cutoffs, kth_key, order_statistics, running_totals, up_to_key


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    # group "a" holds most rows
    return [("a" if rng.random() < 0.8 else rng.choice("bc"), rng.randrange(1000), i) for i in range(1200)]


@pytest.mark.parametrize("k", [1, 2, 599, 1199, 1200])
def test_kth_key(spark, rows, k):
    df = spark.createDataFrame(rows, "g STRING, v INT, id INT")
    levels = [F.floor(F.col("v") / 100), F.col("v")]
    cutoff = kth_key(df, k, levels, ["v", "id"])
    want = sorted((v, i) for _, v, i in rows)[k - 1]
    assert tuple(cutoff) == want
    assert df.filter(up_to_key(cutoff)).count() == k


@pytest.mark.parametrize("k", [1, 3, 5, 6, 7])
def test_nulls_come_last(spark, k):
    data = [(1, "b"), (1, None), (None, "a"), (None, None), (2, "a"), (2, "a"), (0, "z")]
    df = spark.createDataFrame(data, "v INT, s STRING")
    cutoff = kth_key(df, k, [F.col("v")], ["v", "s"])
    ordered = sorted(data, key=lambda r: (r[0] is None, r[0] or 0, r[1] is None, r[1] or ""))
    assert tuple(cutoff) == ordered[k - 1]
    assert df.filter(up_to_key(cutoff)).count() == max(i + 1 for i, r in enumerate(ordered) if r == ordered[k - 1])
    assert df.filter(~up_to_key(cutoff)).count() + df.filter(up_to_key(cutoff)).count() == len(data)


def test_kth_key_beyond_the_table(spark, rows):
    df = spark.createDataFrame(rows, "g STRING, v INT, id INT")
    with pytest.raises(ValueError):
        kth_key(df, len(rows) + 1, [F.col("v")], ["v", "id"])


@pytest.mark.parametrize("k", [1, 7, 150, 5000])
def test_group_cutoffs(spark, rows, k):
    df = spark.createDataFrame([*rows, (None, 3, -1)], "g STRING, v INT, id INT")
    found = group_cutoffs(df, k, ["g"], [F.floor(F.col("v") / 50)], ["v", "id"]).collect()
    assert len(found) == 4
    for r in found:
        own = sorted((v, i) for g, v, i in [*rows, (None, 3, -1)] if g == r.g)
        assert tuple(r["_cutoff"]) == own[min(k, len(own)) - 1]


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("ranges", [1, 2, 9])
def test_running_totals_are_the_same_over_any_ranges(spark, descending, ranges):
    rng = random.Random(9)
    values = sorted({rng.randrange(10**6) for _ in range(700)}, reverse=descending)
    data = [(v, rng.randrange(5), rng.randrange(3)) for v in values] + [(None, 2, 1)]
    counts = spark.createDataFrame(data, "value BIGINT, pos BIGINT, neg BIGINT").repartition(5)
    got = running_totals(counts, "value", ["pos", "neg"], descending, with_next=True, ranges=ranges)
    assert dict(got.dtypes)["value"] == "bigint"
    pos, neg = np.cumsum([p for _, p, _ in data]), np.cumsum([n for _, _, n in data])
    following = [p for _, p, _ in data[1:]] + [None]
    assert {r.value: (r.cum_pos, r.cum_neg, r.next_pos) for r in got.collect()} == {
        v: (p, n, q) for (v, _, _), p, n, q in zip(data, pos, neg, following)
    }


@pytest.mark.parametrize("ranges", [1, 4])
def test_running_totals_put_nan_above_numbers(spark, ranges):
    counts = spark.createDataFrame([(1.0, 1), (math.nan, 2), (math.inf, 4), (None, 8), (-1.0, 16)], "value DOUBLE, n BIGINT")
    got = running_totals(counts, "value", ["n"], ranges=ranges).collect()
    assert {str(r.value): r.cum_n for r in got} == {"-1.0": 16, "1.0": 17, "inf": 21, "nan": 23, "None": 31}


@pytest.mark.parametrize("p", [0.0, 0.02, 0.5, 0.98, 0.999, 1.0])
def test_exact_quantile(spark, p):
    rng = random.Random(3)
    values = [rng.gauss(0, 1) for _ in range(500)] + [0.25] * 300 + [1e300, -1e300]
    df = spark.createDataFrame([(v,) for v in [*values, None, math.nan]], "x DOUBLE")
    assert exact_quantile(df, "x", p) == pytest.approx(float(np.quantile(values, p)), rel=1e-12, abs=1e-12)


def test_exact_quantile_of_nothing_and_infinity(spark):
    assert exact_quantile(spark.createDataFrame([(None,), (math.nan,)], "x DOUBLE"), "x", 0.5) is None
    assert exact_quantile(spark.createDataFrame([], "x DOUBLE"), "x", 0.5) is None
    df = spark.createDataFrame([(-math.inf,), (1.0,), (2.0,), (math.inf,)], "x DOUBLE")
    assert exact_quantile(df, "x", 1 / 3) == 1.0 and exact_quantile(df, "x", 1.0) == math.inf


def test_order_statistics_of_any_doubles_in_six_passes(spark):
    """Subnormals, infinities, signed zeros and neighbours; all ranks in one descent of at most six jobs."""
    rng = random.Random(3)
    values = [5e-324, -5e-324, 1e-300, 1e300, math.inf, -math.inf, 0.0, -0.0, 1.0, math.nextafter(1.0, 2), -1e-310, 2.0, 2.0]
    values += [rng.uniform(-1, 1) * 10 ** rng.randint(-300, 300) for _ in range(500)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,), (math.nan,)], "x DOUBLE").repartition(4).cache()
    df.count()
    ordered = sorted(v + 0.0 for v in values)
    ranks = [1, 2, 250, 251, 252, 253, 254, 255, 256, 257, 258, len(values) - 1, len(values)]
    spark.sparkContext.setJobGroup("order", "")
    found = order_statistics(df, "x", lambda total: ranks)
    stages = spark.sparkContext.statusTracker().getJobIdsForGroup("order")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert found == {k: ordered[k - 1] for k in ranks}
    # adaptive execution runs a pass as two jobs, its shuffle and its result
    assert len(stages) <= 12
    with pytest.raises(ValueError):
        order_statistics(df, "x", lambda total: [total + 1])


def test_several_quantiles_at_once(spark):
    rng = random.Random(4)
    values = [rng.choice([rng.gauss(0, 1), 3.0, -1e-9]) for _ in range(700)]
    df = spark.createDataFrame([(v,) for v in values], "x DOUBLE")
    ps = [0.0, 0.1, 0.5, 0.98, 0.999, 1.0]
    assert exact_quantiles(df, "x", ps) == pytest.approx([float(np.quantile(values, p)) for p in ps], rel=1e-12, abs=1e-12)
    assert exact_quantiles(df.limit(0), "x", ps) == [None] * 6
