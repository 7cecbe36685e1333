import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickwatch.operators import forest
from clickwatch.plans.fixed_forest import node_rows
from clickwatch.session import stage

BASE = dt.datetime(2024, 1, 15, tzinfo=dt.timezone.utc)


@pytest.fixture(scope="module")
def train(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(600, 3))
    rows = [(BASE + dt.timedelta(minutes=i), "US", "web", *map(float, r)) for i, r in enumerate(x)]
    schema = "window_end TIMESTAMP, geo STRING, platform STRING, ctr DOUBLE, bounce DOUBLE, log_count DOUBLE"
    return stage(spark.createDataFrame(rows, schema), "train")


@pytest.fixture(scope="module")
def nodes(train):
    return forest.fit_forest(train, trees=50, max_samples=64).toPandas()


def test_tree_shape(nodes):
    assert nodes["tree_id"].nunique() == 50
    for _, tree in nodes.groupby("tree_id"):
        by_id = tree.set_index("node_id")
        assert by_id.loc[0, "size"] == 64
        inner = by_id[by_id["feature"] >= 0]
        assert (by_id.loc[inner["left"], "size"].to_numpy() + by_id.loc[inner["right"], "size"].to_numpy() == inner["size"]).all()
        assert tree["node_id"].max() < 2 ** (math.ceil(math.log2(64)) + 1) - 1
        leaves = by_id[by_id["feature"] < 0]
        depth = np.floor(np.log2(leaves.index + 1))
        assert np.allclose(leaves["path_length"], depth + leaves["size"].map(forest.average_path))


def test_same_seed_same_forest_whatever_the_partitioning(train, nodes):
    again = forest.fit_forest(train.repartition(7), trees=50, max_samples=64).toPandas()
    key = ["tree_id", "node_id"]
    a, b = (n.sort_values(key).reset_index(drop=True) for n in (nodes, again))
    assert a.equals(b)
    other = forest.fit_forest(train, trees=50, max_samples=64, seed=7).toPandas()
    assert not a.equals(other.sort_values(key).reset_index(drop=True))


def _walk(nodes, x):
    by_id = {(t, n): row for t, n, *row in nodes[["tree_id", "node_id", "feature", "threshold", "left", "right", "size", "path_length"]].itertuples(index=False)}
    total = 0.0
    trees = sorted({t for t, _ in by_id})
    for t in trees:
        n = 0
        while by_id[t, n][0] >= 0:
            feature, threshold, left, right, *_ = by_id[t, n]
            n = left if x[int(feature)] <= threshold else right
        total += by_id[t, n][5]
    size = by_id[trees[0], 0][4]
    return 2 ** (-total / len(trees) / forest.average_path(size))


def test_scores_equal_a_walk_down_each_tree(nodes):
    x = np.random.default_rng(2).normal(size=(40, 3)) * 2
    got = forest.Scorer(nodes).score(x)
    assert np.allclose(got, [_walk(nodes, row) for row in x], atol=1e-12)


def test_fixed_forest_scores_equal_a_walk(spark):
    fixed = forest.forest_table(spark, node_rows()).toPandas()
    x = np.random.default_rng(3).normal(size=(40, 3)) * 2
    assert np.allclose(forest.Scorer(fixed).score(x), [_walk(fixed, row) for row in x], atol=1e-12)


def test_outliers_score_above_inliers(spark, train, nodes):
    scorer = forest.Scorer(nodes)
    far = spark.createDataFrame([(8.0, -8.0, 8.0), (-9.0, 9.0, 9.0)], "ctr DOUBLE, bounce DOUBLE, log_count DOUBLE")
    inliers = forest.with_scores(train, scorer).agg(F.percentile("anomaly_score", F.lit(0.5)), F.min("anomaly_score"), F.max("anomaly_score")).first()
    outliers = forest.with_scores(far, scorer).agg(F.min("anomaly_score")).first()[0]
    assert 0 < inliers[1] <= inliers[2] < 1
    assert outliers > inliers[0] and outliers > 0.6


@pytest.mark.parametrize("n", [1, 2, 5])
def test_tiny_training_sets(train, n):
    nodes = forest.fit_forest(train.orderBy("window_end").limit(n), trees=3).toPandas()
    score = forest.Scorer(nodes).score(np.zeros((4, 3)))
    assert np.isfinite(score).all()


def test_constant_rows_give_single_leaves(train):
    nodes = forest.fit_forest(train.withColumns({c: F.lit(1.0) for c in ("ctr", "bounce", "log_count")}), trees=2).toPandas()
    assert (nodes["feature"] == -1).all() and len(nodes) == 2


def test_nothing_to_fit(train):
    with pytest.raises(ValueError):
        forest.fit_forest(train.limit(0))


def test_draws_are_rows_of_the_whole_table(train):
    """Every tree has different rows, and all trees together reach most of the table."""
    drawn, size = forest._drawn_rows(train, trees=40, max_samples=100, seed=3)
    rows = drawn.select("tree_id", "window_end", "geo", "platform").toPandas()
    n = train.count()
    assert size == min(100, n) and len(rows) == 40 * size
    assert rows.drop_duplicates().groupby("tree_id").size().eq(size).all()
    reached = len(rows.drop(columns="tree_id").drop_duplicates())
    assert reached > 0.9 * n * (1 - (1 - size / n) ** 40)


@pytest.mark.parametrize("trees", [50, 1])
def test_scores_inside_the_jvm(spark, train, nodes, trees):
    """Equal to the vectorised descents, without a Python worker; single leaves and infinite thresholds too."""
    scorer = forest.Scorer(nodes[nodes["tree_id"] < trees])
    scored = forest.with_scores(train, scorer, in_jvm=True)
    assert "Python" not in scored._jdf.queryExecution().executedPlan().toString()
    got = scored.toPandas()
    assert np.allclose(got["anomaly_score"], scorer.score(got[["ctr", "bounce", "log_count"]].to_numpy()), atol=1e-12)
    leaf = forest.Scorer(nodes.head(1).assign(feature=-1, threshold=np.nan, size=5, path_length=2.0, node_id=0, tree_id=0))
    flat = forest.with_scores(train.limit(3), leaf, in_jvm=True).toPandas()["anomaly_score"]
    assert np.allclose(flat, leaf.score(np.zeros((3, 3))), atol=1e-12)
