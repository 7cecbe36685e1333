"""Language identification: averaged hashed subword embeddings under a linear softmax.

A text is its words, lower-cased, with a boundary on either side, and its features
are all runs of two to four characters of a word, boundaries included, hashed into
2**17 buckets with an embedding each. Embeddings are averaged over the
whole text and a linear layer scores the languages. Both are trained by stochastic gradient descent in
numpy, in one task, on a bounded sample (at most `rows_per_language` rows of least id hash of every
language; a fifth of it is kept for calibration). As the layers are linear, a text is
scored from one table, embeddings times weights.

Calibration fits a temperature on the kept rows, so that the score is the probability
of the predicted language, and sets the rejection bound: the score below which less than the
share `lost` of the rightly named kept rows lie, never above `most_bound`. Where that share
is less than a row, only texts without a language are rejected.

Defined cases: a null text, or one without a letter, is `und` with score 0 and is
rejected; rows without language are not learnt from; of rows repeating an id one is
learnt from (least text, then language); with nothing to learn from all texts are `und`; repeated rows
stay repeated rows; other columns pass through.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clickwatch.session import stage

BITS, LENGTHS = 17, (2, 3, 4)
UNKNOWN = "und"
_FACTOR, _FINAL = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC4CEB9FE1A85EC53)
_BLOCK = 1 << 20  # characters whose features are looked up at once


@dataclass(frozen=True)
class Training:
    rows_per_language: int = 1_500
    dimension: int = 16
    #: rows seen by gradient descent, in passes over the sample
    steps: int = 20_000
    rate: float = 0.5
    lost: float = 0.002
    most_bound: float = 0.5
    seed: int = 7


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    table: np.ndarray  # buckets x languages
    temperature: float
    bound: float


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def features(text: str | None) -> np.ndarray:
    """Bucket numbers of the subwords of a text, repeats included; empty without a letter."""
    code = np.frombuffer((text or "").lower().encode("utf-32-le", "replace"), np.uint32)
    letter = _letters()[code]
    if not letter.any():
        return np.empty(0, np.int32)
    code = np.where(letter, code, np.uint32(32))
    inner = np.flatnonzero(letter)
    code = np.concatenate(([np.uint32(32)], code[inner[0] : inner[-1] + 1], [np.uint32(32)]))
    edge = code == 32
    keep = np.ones(len(code), bool)
    keep[1:] = ~(edge[1:] & edge[:-1])  # one boundary between words
    code, edge = code[keep].astype(np.uint64), edge[keep]
    parts = []
    for n in LENGTHS:
        m = len(code) - n + 1
        if m <= 0:
            continue
        x = np.full(m, n, np.uint64)
        for i in range(n):
            x = x * _FACTOR + code[i : i + m]
        x = ((x ^ (x >> np.uint64(31))) * _FINAL) >> np.uint64(64 - BITS)
        # runs across a boundary say nothing about words
        across = np.zeros(m, bool)
        for i in range(1, n - 1):
            across |= edge[i : i + m]
        if n == 2:
            across = edge[:m] & edge[1 : m + 1]
        parts.append(x[~across].astype(np.int32))
    return np.concatenate(parts)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit_softmax(texts: list[str], named: list[str], how: Training) -> Model:
    """Train on four fifths, calibrate on every fifth row, in the order given."""
    languages = tuple(sorted(set(named)))
    if not languages:
        return Model((), np.zeros((1 << BITS, 0), np.float32), 1.0, 0.0)
    rng = np.random.default_rng(how.seed)
    embedding = rng.uniform(-1 / how.dimension, 1 / how.dimension, (1 << BITS, how.dimension)).astype(np.float32)
    weight = np.zeros((how.dimension, len(languages)), np.float32)
    rows = []
    for text, name in zip(texts, named):
        at, count = np.unique(features(text), return_counts=True)
        if len(at):
            rows.append((at, (count / count.sum()).astype(np.float32), languages.index(name)))
    kept = rows[::5] if len(rows) >= 50 else rows
    taught = [r for i, r in enumerate(rows) if i % 5] if len(rows) >= 50 else rows
    step = 0
    while taught and step < how.steps:
        for i in rng.permutation(len(taught))[: how.steps - step]:
            at, share, y = taught[i]
            rate = how.rate * (1 - step / how.steps)
            own = embedding[at]
            mean = share @ own
            error = _softmax(mean @ weight)
            error[y] -= 1
            back = weight @ error
            weight -= rate * np.outer(mean, error)
            embedding[at] = own - rate * how.dimension * share[:, None] * back
            step += 1
    table = embedding @ weight
    if not kept:
        return Model(languages, table, 1.0, 0.0)
    logits = np.array([share @ table[at] for at, share, _ in kept])
    truth = np.array([y for _, _, y in kept])
    temperature = min(
        np.geomspace(0.05, 20, 60),
        key=lambda t: -np.log(_softmax(logits / t)[np.arange(len(truth)), truth] + 1e-12).mean(),
    )
    sure = _softmax(logits / temperature)
    right = np.sort(sure.max(axis=1)[sure.argmax(axis=1) == truth])
    allowed = int(how.lost * len(right))
    bound = min(how.most_bound, float(right[allowed - 1])) if allowed else 0.0
    return Model(languages, table.astype(np.float32), float(temperature), bound)


def predict(text: str | None, model: Model) -> tuple[str, float]:
    at = features(text)
    if not len(at) or not model.languages:
        return UNKNOWN, 0.0
    total = np.zeros(len(model.languages))
    for i in range(0, len(at), _BLOCK):
        total += model.table[at[i : i + _BLOCK]].sum(axis=0, dtype=np.float64)
    sure = _softmax(total / len(at) / model.temperature)
    best = int(sure.argmax())
    return model.languages[best], float(sure[best])


def fit(
    docs: DataFrame, how: Training = Training(), doc_id: str = "doc_id", text: str = "text", lang: str = "lang"
) -> Model:
    """The model of the rows of `docs` with a language; give only rows that may be learnt from."""

    def train(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = sorted(r for f in frames for r in zip(f["place"], f["text"], f["lang"]))
        model = fit_softmax([r[1] for r in rows], [r[2] for r in rows], how)
        yield pd.DataFrame(
            {
                "languages": [json.dumps(model.languages)],
                "table": [model.table.tobytes()],
                "temperature": [model.temperature],
                "bound": [model.bound],
            }
        )

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    rows = rows.filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull())
    # about thrice the rows wanted of every language pass by their hash, whatever its size, before any are ranked
    counts = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("rows"))
    hashed = rows.select("doc_id", "lang", (F.pmod(F.xxhash64("doc_id"), F.lit(1 << 52)) / (1 << 52)).alias("u"))
    # one row per language, as many as the model has columns
    few = hashed.join(F.broadcast(counts), "lang").filter(F.col("u") * F.col("rows") < 3 * how.rows_per_language)
    place = F.row_number().over(Window.partitionBy("lang").orderBy("u", "doc_id"))
    ids = few.withColumn("nth", place).filter(F.col("nth") <= how.rows_per_language)
    chosen = stage(ids.select("doc_id").distinct(), "language-sample")
    # at most `rows_per_language` ids of every language: the bound proves the broadcast
    sample = (
        rows.filter(F.col("text").isNotNull())
        .join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id")
        .agg(F.min(F.struct("text", "lang")).alias("row"))
        .select(F.xxhash64("doc_id").alias("place"), "row.*")
    )
    schema = "languages string, table binary, temperature double, bound double"
    row = sample.repartition(1).mapInPandas(train, schema).first()
    if row is None:  # a plan known to be empty runs no task
        return fit_softmax([], [], how)
    languages = tuple(json.loads(row.languages))
    table = np.frombuffer(row["table"], np.float32).reshape(1 << BITS, len(languages))
    return Model(languages, table, row.temperature, row.bound)


def identified(text: Column, model: Model, docs: DataFrame) -> Column:
    """struct(lang_pred, score, rejected) of a text column of `docs`."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most 2**17 rows of a float per language

    @F.pandas_udf("lang_pred string, score double, rejected boolean")
    def named(texts: pd.Series) -> pd.DataFrame:
        model = shared.value
        found = [predict(t, model) for t in texts]
        return pd.DataFrame(
            {
                "lang_pred": [name for name, _ in found],
                "score": [sure for _, sure in found],
                "rejected": [name == UNKNOWN or sure < model.bound for name, sure in found],
            }
        )

    return named(text)
