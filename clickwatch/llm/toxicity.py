"""Toxicity: logistic regression by FTRL-proximal over hashed word n-grams and skip-grams.

Features are presences of single words, neighbouring words and words one and two
places apart, hashed into 2**20 buckets. Every coordinate has its own learning
rate, from the squares of its gradients, and the L1 term keeps coordinates without steady
evidence at exactly zero, so the model is a short list of (bucket, weight).

Training reads a bounded sample of labelled rows (`rows`, those of least id
hash): features are made where the rows are, and one task runs the passes over their bucket
numbers. Scoring is a map over all texts with the weights in the task.

Defined cases: a repeated id is learnt from once, from its least text, and is
toxic if any label says so; null labels, ids and texts are not learnt from; null and empty texts are
scored by the bias alone; without labelled rows every score is 0; repeated rows stay
repeated rows and other columns are passed over.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickwatch.session import stage

BITS = 20
_WORDS = re.compile(r"[^\W_]+")
#: odd multipliers of the parts of a feature: one word, neighbours, gaps of one and two
_KINDS = ((0x9E3779B97F4A7C15, 0), (0xC2B2AE3D27D4EB4F, 1), (0x165667B19E3779F9, 2), (0xD6E8FEB86659FD93, 3))
_SECOND, _FINAL = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_MEMO_WORDS = 300_000


@dataclass(frozen=True)
class Ftrl:
    alpha: float = 0.3
    beta: float = 1.0
    l1: float = 4.0
    l2: float = 0.5
    passes: int = 3
    #: bound of the labelled sample
    rows: int = 12_000


class _WordHashes(dict):
    """Word to hash; emptied when full."""

    def __missing__(self, word: str) -> int:
        if len(self) >= _MEMO_WORDS:
            self.clear()
        self[word] = value = zlib.crc32(word.encode("utf-8", "replace"))
        return value


_hashes = _WordHashes()


def buckets(text: str | None) -> np.ndarray:
    """Bucket numbers of the features of a text, repeats included."""
    words = _WORDS.findall((text or "").lower())
    h = np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))
    parts = []
    for factor, gap in _KINDS:
        if len(h) > gap:
            x = h * np.uint64(factor) if not gap else h[:-gap] * np.uint64(factor) + h[gap:] * _SECOND
            parts.append(((x ^ (x >> np.uint64(32))) * _FINAL) >> np.uint64(64 - BITS))
    return np.concatenate(parts).astype(np.int32) if parts else np.empty(0, np.int32)


@dataclass(frozen=True)
class Model:
    bias: float
    index: np.ndarray
    weight: np.ndarray

    @property
    def fitted(self) -> bool:
        return np.isfinite(self.bias)


def fit_ftrl(examples: list[tuple[np.ndarray, int]], how: Ftrl) -> Model:
    """FTRL-proximal in the order given; each example is (different buckets, label). The bias is not penalised."""
    if not examples:
        return Model(-np.inf, np.empty(0, np.int32), np.empty(0, np.float32))
    z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)
    bias_z = bias_n = 0.0

    def weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
        shrunk = np.sign(z) * np.maximum(np.abs(z) - how.l1, 0.0)
        return -shrunk / ((how.beta + np.sqrt(n)) / how.alpha + how.l2)

    for _ in range(how.passes):
        for at, label in examples:
            zs, ns = z[at], n[at]
            w = weights(zs, ns)
            bias = -bias_z * how.alpha / (how.beta + bias_n**0.5)
            g = 1.0 / (1.0 + np.exp(-np.clip(bias + w.sum(), -35, 35))) - label
            rate = (np.sqrt(ns + g * g) - np.sqrt(ns)) / how.alpha
            z[at], n[at] = zs + g - rate * w, ns + g * g
            bias_z += g - ((bias_n + g * g) ** 0.5 - bias_n**0.5) / how.alpha * bias
            bias_n += g * g
    w = weights(z, n)
    index = np.flatnonzero(w).astype(np.int32)
    return Model(float(-bias_z * how.alpha / (how.beta + bias_n**0.5)), index, w[index].astype(np.float32))


def score(text: str | None, model: Model, dense: np.ndarray) -> float:
    at = buckets(text)
    hit = np.unique(at[dense[at] != 0])
    return float(1.0 / (1.0 + np.exp(-np.clip(model.bias + dense[hit].sum(dtype=np.float64), -35, 35))))


def labelled_sample(docs: DataFrame, labels: DataFrame, how: Ftrl, doc_id: str, text: str, label: str) -> DataFrame:
    """(doc_id, label, text) of at most `how.rows` ids, those of least hash."""
    ids = (
        labels.select(F.col(doc_id).alias("doc_id"), F.col(label).cast("int").alias("label"))
        .dropna()
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
        .join(docs.select(F.col(doc_id).alias("doc_id")).distinct(), "doc_id", "left_semi")
    )
    chosen = stage(ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(how.rows), "toxic-sample")
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).filter(F.col(text).isNotNull())
    # at most `rows` narrow rows: the bound proves the broadcast
    return texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    how: Ftrl = Ftrl(),
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
) -> Model:
    """The model of the labelled rows of `docs`; give only rows that may be learnt from."""

    def featurise(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = [np.unique(buckets(t)).tobytes() for t in frame["text"]]
            yield pd.DataFrame({"place": frame["place"], "label": frame["label"], "found": found})

    def train(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = sorted((r for f in frames for r in zip(f["place"], f["label"], f["found"])), key=lambda r: (r[0], r[2]))
        model = fit_ftrl([(np.frombuffer(found, np.int32), int(y)) for _, y, found in rows], how)
        yield pd.DataFrame({"bias": [model.bias], "index": [model.index.tobytes()], "weight": [model.weight.tobytes()]})

    sample = labelled_sample(docs, labels, how, doc_id, text, label).withColumn("place", F.xxhash64("doc_id"))
    features = stage(sample.mapInPandas(featurise, "place long, label int, found binary"), "toxic-features")
    row = features.repartition(1).mapInPandas(train, "bias double, index binary, weight binary").first()
    if row is None:  # a plan known to be empty runs no task
        return fit_ftrl([], how)
    return Model(row.bias, np.frombuffer(row["index"], np.int32), np.frombuffer(row.weight, np.float32))


def scored(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: id and score, the probability of the label 1."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dense = np.zeros(1 << BITS, np.float32)
        dense[model.index] = model.weight
        for batch in batches:
            scores = [score(t.as_py(), model, dense) if model.fitted else 0.0 for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=["key", "score"])

    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.col(doc_id).alias("key"), F.col(text).alias("text"))
    return rows.mapInArrow(apply, f"key {kind}, score double").withColumnRenamed("key", doc_id)
