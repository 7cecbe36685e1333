"""Isolation forest (Liu, Ting & Zhou, ICDM 2008) fitted and applied as Spark jobs.

A forest is a node table (`schemas.FOREST_NODE`). Nodes are numbered like a
binary heap: the children of `i` are `2i+1` (value <= threshold) and `2i+2`.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from clickwatch import constants as C
from clickwatch.functions.scalars import hash_uniforms
from clickwatch.operators.dataset import MODEL_COLUMNS, ORDER
from clickwatch.schemas import FOREST_NODE

INDEX_PREFIXES = 1 << 20


def average_path(size: int) -> float:
    """Mean path length of an unsuccessful search among `size` rows."""
    if size <= 1:
        return 0.0
    if size == 2:
        return 1.0
    return 2.0 * (math.log(size - 1) + C.EULER_GAMMA) - 2.0 * (size - 1) / size


def row_key_text(seed: int) -> Column:
    """Text naming a feature row, the input of every hash-based draw."""
    return F.concat_ws("|", F.unix_seconds("window_end").cast("string"), "geo", "platform", F.lit(str(seed)))


def _digest(*parts: object) -> str:
    return hashlib.md5("|".join(map(str, parts)).encode()).hexdigest()


def _uniform(*parts: object) -> float:
    """In [0, 1), from the names given: the same in any engine with md5."""
    return int(_digest(*parts)[:8], 16) / 2**32


def draw_positions(total: int, size: int, tree_id: int, seed: int) -> list[int]:
    """`size` different positions below `total`, in the order of their hashed draws."""
    found: dict[int, None] = {}
    draw = 0
    while len(found) < size:
        found.setdefault(int(_digest(seed, tree_id, draw)[:15], 16) % total)
        draw += 1
    return list(found)


def _grow(sample: pd.DataFrame, tree_id: int, depth_limit: int, seed: int) -> pd.DataFrame:
    """One tree over at most a few hundred rows; feature and threshold of a node are drawn from its name."""
    x = sample[list(MODEL_COLUMNS)].to_numpy()
    nodes = []
    open_nodes = [(0, 0, np.arange(len(x)))]
    while open_nodes:
        node, depth, members = open_nodes.pop()
        low, high = x[members].min(axis=0), x[members].max(axis=0)
        splittable = np.flatnonzero(high > low)
        if depth == depth_limit or splittable.size == 0:
            nodes.append((tree_id, node, -1, np.nan, -1, -1, members.size, depth + average_path(members.size)))
            continue
        feature = int(splittable[int(_uniform(seed, tree_id, node, "feature") * splittable.size)])
        threshold = float(low[feature] + _uniform(seed, tree_id, node, "threshold") * (high[feature] - low[feature]))
        goes_left = x[members, feature] <= threshold
        nodes.append((tree_id, node, feature, threshold, 2 * node + 1, 2 * node + 2, members.size, np.nan))
        open_nodes.append((2 * node + 1, depth + 1, members[goes_left]))
        open_nodes.append((2 * node + 2, depth + 1, members[~goes_left]))
    return pd.DataFrame(nodes, columns=FOREST_NODE.fieldNames())


def _drawn_rows(train: DataFrame, trees: int, max_samples: int, seed: int) -> tuple[DataFrame, int]:
    """(rows with `tree_id`, rows per tree): `max_samples` of all rows for every tree, without replacement.

    Rows are thought of in the order of a hash of their key. The driver draws
    positions in that order, for every tree independently. Counts per hash prefix (at
    most INDEX_PREFIXES rows) turn a position into a prefix and a rank within it, so only
    rows of the prefixes hit are ranked, a few per prefix, and joined with the draws.
    """
    spark = train.sparkSession
    (u,) = hash_uniforms(row_key_text(seed), 1)
    prefix = F.floor(u * INDEX_PREFIXES).cast("int")
    rows = train.select(*ORDER, *MODEL_COLUMNS, u.alias("_u"), prefix.alias("prefix"))
    counts = rows.groupBy("prefix").agg(F.count(F.lit(1)).alias("rows")).toPandas().sort_values("prefix")
    total = int(counts["rows"].sum())
    if total == 0:
        raise ValueError("cannot fit a forest on no rows")
    size = min(max_samples, total)
    position = np.array([p for tree_id in range(trees) for p in draw_positions(total, size, tree_id, seed)])
    ends = counts["rows"].cumsum().to_numpy()
    at = np.searchsorted(ends, position, "right")
    draws = pd.DataFrame(
        {
            "tree_id": np.repeat(np.arange(trees, dtype=np.int32), size),
            "prefix": counts["prefix"].to_numpy()[at].astype(np.int32),
            "rank": (position - ends[at] + counts["rows"].to_numpy()[at] + 1).astype(np.int32),
        }
    )
    # trees x max_samples rows, a fixed size
    drawn = F.broadcast(spark.createDataFrame(draws, "tree_id INT, prefix INT, rank INT"))
    hit = rows.join(F.broadcast(drawn.select("prefix").distinct()), "prefix", "left_semi")
    rank = F.row_number().over(Window.partitionBy("prefix").orderBy("_u", *ORDER, *MODEL_COLUMNS))
    return hit.withColumn("rank", rank).join(drawn, ["prefix", "rank"]), size


def fit_forest(
    train: DataFrame,
    trees: int = C.FOREST_TREES,
    max_samples: int = C.FOREST_MAX_SAMPLES,
    seed: int = C.FOREST_SEED,
) -> DataFrame:
    """Node table of `trees` trees, each grown on its own random rows of `train`."""
    spark = train.sparkSession
    drawn, size = _drawn_rows(train, trees, max_samples, seed)
    depth_limit = math.ceil(math.log2(max(size, 2)))

    def grow(key: tuple, sample: pd.DataFrame) -> pd.DataFrame:
        return _grow(sample.sort_values(["prefix", "rank"]), int(key[0]), depth_limit, seed)

    # the draws are few bytes but much work: spread the trees over the cores instead of by size
    tasks = min(trees, max(8, spark.sparkContext.defaultParallelism))
    return drawn.repartition(tasks, "tree_id").groupBy("tree_id").applyInPandas(grow, FOREST_NODE)


def forest_table(spark: SparkSession, nodes: Iterable[tuple]) -> DataFrame:
    """A node table from literal rows."""
    return spark.createDataFrame(list(nodes), FOREST_NODE)


class Scorer:
    """A forest packed into arrays for vectorised descents.

    Every tree is completed to full depth: a leaf above the bottom passes rows on
    to its left until the bottom, where its path length waits. All rows then take
    the same number of steps, with no branch.
    """

    def __init__(self, nodes: pd.DataFrame):
        tree_ids = np.sort(nodes["tree_id"].unique())
        depth = int(math.floor(math.log2(nodes["node_id"].max() + 1)))
        inner = 2**depth - 1
        self.feature = np.zeros((tree_ids.size, inner), dtype=np.int32)
        self.threshold = np.full((tree_ids.size, inner), np.inf)
        self.length = np.zeros((tree_ids.size, inner + 1))
        row = np.searchsorted(tree_ids, nodes["tree_id"])
        node = nodes["node_id"].to_numpy()
        feature = nodes["feature"].to_numpy()
        split = feature >= 0
        self.feature[row[split], node[split]] = feature[split]
        self.threshold[row[split], node[split]] = nodes["threshold"].to_numpy()[split]
        level = np.floor(np.log2(node + 1)).astype(int)
        bottom = (node + 1) * 2 ** (depth - level) - 1 - inner
        self.length[row[~split], bottom[~split]] = nodes["path_length"].to_numpy()[~split]
        root_size = int(nodes.loc[nodes["node_id"] == 0, "size"].max())
        self.normal = average_path(root_size) or 1.0

    def arrays(self) -> tuple:
        """Plain data, what is broadcast."""
        return self.feature, self.threshold, self.length, self.normal

    def score(self, x: np.ndarray) -> np.ndarray:
        return score_rows(self.arrays(), x)


def score_rows(forest: tuple, x: np.ndarray) -> np.ndarray:
    """2^(-mean path / expected path) per row of `x`; higher is more anomalous."""
    features, thresholds, lengths, normal = forest
    inner = features.shape[1]
    rows = np.arange(x.shape[0])
    total = np.zeros(x.shape[0])
    for feature, threshold, length in zip(features, thresholds, lengths):
        node = np.zeros(x.shape[0], dtype=np.int32)
        for _ in range(inner.bit_length()):
            node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
        total += length[node - inner]
    return np.exp2(-total / len(features) / normal)


def load_scorer(nodes: DataFrame) -> Scorer:
    """Collect a node table; its size is set by trees and max_samples."""
    return Scorer(nodes.toPandas())


def score_column(spark: SparkSession, scorer: Scorer) -> Column:
    """`anomaly_score` over the standardised model columns."""
    shared = spark.sparkContext.broadcast(scorer.arrays())

    @F.pandas_udf(T.DoubleType())
    def anomaly_score(ctr: pd.Series, bounce: pd.Series, log_count: pd.Series) -> pd.Series:
        x = np.column_stack([ctr.to_numpy(), bounce.to_numpy(), log_count.to_numpy()]).astype(np.float64)
        return pd.Series(score_rows(shared.value, x))

    return anomaly_score(*MODEL_COLUMNS)


def _packed(values: np.ndarray, kind: str) -> Column:
    """An array literal; the text is parsed once, when the plan's constants are folded."""
    text = ",".join(map(repr, values.ravel().tolist()))
    return F.split(F.lit(text), ",").cast(f"array<{kind}>") if text else F.array().cast(f"array<{kind}>")


def descent_column(scorer: Scorer) -> Column:
    """`anomaly_score` by the same descents over array literals, inside the JVM.

    No Python worker and no batching, which is what small micro-batches want; a large batch is scored faster by
    `score_column`, whose steps are vectorised over rows.
    """
    features, thresholds, lengths, normal = scorer.arrays()
    trees, inner = features.shape
    feature, threshold, length = _packed(features, "int"), _packed(thresholds, "double"), _packed(lengths, "double")
    x = F.array(*MODEL_COLUMNS)

    def leaf(tree: Column) -> Column:
        def step(node: Column, _: Column) -> Column:
            at = tree * F.lit(inner) + node
            right = F.get(x, F.get(feature, at)) > F.get(threshold, at)
            return (node * 2 + 1 + F.when(right, 1).otherwise(0)).cast("int")

        return F.aggregate(F.array_repeat(F.lit(0), inner.bit_length()), F.lit(0), step)

    def add(total: Column, tree: Column) -> Column:
        return total + F.get(length, tree * F.lit(inner + 1) + leaf(tree) - F.lit(inner))

    total = F.aggregate(F.sequence(F.lit(0), F.lit(trees - 1)), F.lit(0.0), add)
    return F.pow(F.lit(2.0), -total / F.lit(float(trees)) / F.lit(float(normal)))


def with_scores(scaled: DataFrame, scorer: Scorer, in_jvm: bool = False) -> DataFrame:
    score = descent_column(scorer) if in_jvm else score_column(scaled.sparkSession, scorer)
    return scaled.withColumn("anomaly_score", score)
