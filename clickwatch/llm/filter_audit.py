"""What every filter of a cleaning chain removes in every order the chain may run in.

Each document gets a mask of the filters it fails; documents are counted per part (language)
and mask, at most 32 cells a part, and all that follows works on cells. A Gray code walks the
32 subsets of filters, toggling one filter a step: every cell has a counter of active
filters that it fails, and when that counter leaves or reaches zero the cell leaves or rejoins the
running survivors. The survivors of all 32 states are stored, and a step of any order is
the difference of two of them.

Filters, in the letters of the report: A few words, B repeated words, C capitals,
D symbols, E copies of the text of a smaller id. Texts are read once, in the tasks that scan
them; what is shuffled is a row of id, part, mask and SHA-256 of the text, and rows equal
in all but the id are summed before they meet, so no group of copies is ever in one task.

Defined cases: a null text is empty; a null part is the empty string; a null id is
smaller than all others (so is never a copy) and has no labels; rows repeating the
smallest id of a text are not copies; a document with several label rows is good or toxic if any of them says so; an
empty table has no parts and gives no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

#: fixed values of the report
FILTERS = "ABCDE"
MIN_WORDS, MIN_DISTINCT_PERCENT, MAX_CAPITALS_PERCENT = 200, 50, 3
SYMBOLS = "#$%&*|"

_BIT = {letter: 1 << i for i, letter in enumerate(FILTERS)}
_STATES = 1 << len(FILTERS)
_NO_ID = -(1 << 63)
_CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
_HAS_SYMBOL = re.compile(b"[" + re.escape(SYMBOLS.encode()) + b"]")
MEASURES = ("n", "good", "toxic")

REPORT = T.StructType(
    [T.StructField("part", T.StringType()), T.StructField("filter_order", T.StringType()), T.StructField("step", T.IntegerType())]
    + [
        T.StructField(name, T.LongType())
        for name in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    ]
)


def failing(text: bytes, code_points: int) -> int:
    """Mask of the filters A to D that a text fails; white space is ASCII white space, as `bytes.split` has it."""
    words = text.split()
    mask = 0
    if len(words) < MIN_WORDS:
        mask |= _BIT["A"]
    if 100 * len(set(words)) < MIN_DISTINCT_PERCENT * len(words):
        mask |= _BIT["B"]
    capitals = len(text) - len(text.translate(None, _CAPITALS))
    if 100 * capitals > MAX_CAPITALS_PERCENT * code_points:
        mask |= _BIT["C"]
    if _HAS_SYMBOL.search(text):
        mask |= _BIT["D"]
    return mask


def _marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        text = pc.fill_null(batch.column(2), "")
        lengths = pc.utf8_length(text).to_pylist()
        raw = [value.as_buffer().to_pybytes() for value in text]
        masks = pa.array([failing(t, n) for t, n in zip(raw, lengths)], pa.int32())
        digests = pa.array([hashlib.sha256(t).digest() for t in raw], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), masks, digests], names=["id", "part", "mask", "digest"])


def cells(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """Documents per part and mask of failing filters: part, mask, n, good, toxic."""
    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("id"),
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.col("text").cast("string").alias("text"),
    ).mapInArrow(_marked, "id long, part string, mask int, digest binary")
    marks = labels.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("id"))
    marks = marks.agg(
        F.max((F.coalesce("quality", F.lit(0)) == 1).cast("int")).alias("good"),
        F.max((F.coalesce("toxic", F.lit(0)) == 1).cast("int")).alias("toxic"),
    )
    rows = rows.join(marks, "id", "left").na.fill(0, ["good", "toxic"])
    kind = ["digest", "part", "mask", "good", "toxic"]
    # repeated rows first, so that the number of rows at a group's smallest id is known
    once = rows.groupBy("id", *kind).agg(F.count(F.lit(1)).alias("n"))
    groups = once.groupBy(*kind).agg(
        F.sum("n").alias("n"), F.min("id").alias("first"), F.min_by("n", "id").alias("at_first")
    )
    smallest = F.min("first").over(Window.partitionBy("digest"))
    own = F.when(F.col("first") == smallest, F.col("at_first")).otherwise(0)
    split = groups.withColumn("own", own).select(
        "part", "good", "toxic",
        F.inline(
            F.array(
                F.struct(F.col("mask").alias("mask"), F.col("own").alias("n")),
                F.struct((F.col("mask") + _BIT["E"]).alias("mask"), (F.col("n") - F.col("own")).alias("n")),
            )
        ),
    )
    return split.groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("good"), F.sum(F.col("n") * F.col("toxic")).alias("toxic")
    )


def survivors(counts: np.ndarray) -> np.ndarray:
    """What is left by every subset of filters, given `counts` per mask (one row each)."""
    masks = np.arange(_STATES)
    active = np.zeros(_STATES, np.int64)  # of every cell: filters on that it fails
    running = counts.sum(axis=0)
    left = np.empty_like(counts)
    left[0] = running
    state = 0
    for step in range(1, _STATES):
        bit = step & -step
        state ^= bit
        hit = (masks & bit) != 0
        if state & bit:
            active[hit] += 1
            running = running - counts[hit & (active == 1)].sum(axis=0)
        else:
            active[hit] -= 1
            running = running + counts[hit & (active == 0)].sum(axis=0)
        left[state] = running
    return left


_ORDERS = list(permutations(FILTERS))
_STEP_BIT = np.array([[_BIT[f] for f in order] for order in _ORDERS])
_AFTER = np.bitwise_or.accumulate(_STEP_BIT, axis=1)
_BEFORE = _AFTER - _STEP_BIT
_INDEX = np.log2(_STEP_BIT).astype(np.int64)


def _report(frame: pd.DataFrame) -> pd.DataFrame:
    counts = np.zeros((_STATES, len(MEASURES)), np.int64)
    counts[frame["mask"]] = frame[list(MEASURES)].to_numpy()
    left = survivors(counts)
    lost = left[_BEFORE] - left[_AFTER]
    removed = lost[..., 0]
    masks = np.arange(_STATES)
    fails = np.array([counts[(masks & bit) != 0, 0].sum() for bit in _BIT.values()])
    shapley = np.array([removed[_INDEX == i].sum() for i in range(len(FILTERS))])
    columns = {
        "kept": left[_AFTER, 0],
        "removed": removed,
        "redundant": fails[_INDEX] - removed,
        "unique_fails": counts[_STEP_BIT, 0],
        "good_lost": lost[..., 1],
        "toxic_lost": lost[..., 2],
        "shapley": shapley[_INDEX],
    }
    steps = len(FILTERS)
    return pd.DataFrame(
        {
            "part": frame["part"].iloc[0],
            "filter_order": np.repeat(["".join(order) for order in _ORDERS], steps),
            "step": np.tile(np.arange(1, steps + 1, dtype=np.int32), len(_ORDERS)),
            **{name: values.ravel() for name, values in columns.items()},
        }
    )


def audit(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """Effect of every filter at every step of every order, per part (600 rows each)."""
    return cells(docs, labels, part).groupBy("part").applyInPandas(_report, REPORT)


def audit_sql() -> str:
    letters = ", ".join(f"('{letter}', {bit})" for letter, bit in _BIT.items())
    return rf"""
WITH filters(letter, bit) AS (VALUES {letters}),
texts AS (
  SELECT coalesce(lang, '') AS part, coalesce(text, '') AS text, coalesce(doc_id, {_NO_ID}) AS id FROM documents
),
counted AS (
  SELECT part, id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
    length(regexp_replace(text, '[^A-Z]', '', 'g')) AS capitals,
    min(id) OVER (PARTITION BY text) AS first_id
  FROM texts
),
masked AS (
  SELECT part, id,
    CASE WHEN len(words) < {MIN_WORDS} THEN {_BIT["A"]} ELSE 0 END
    + CASE WHEN 100 * len(list_distinct(words)) < {MIN_DISTINCT_PERCENT} * len(words) THEN {_BIT["B"]} ELSE 0 END
    + CASE WHEN 100 * capitals > {MAX_CAPITALS_PERCENT} * length(text) THEN {_BIT["C"]} ELSE 0 END
    + CASE WHEN regexp_matches(text, '[{SYMBOLS}]') THEN {_BIT["D"]} ELSE 0 END
    + CASE WHEN id > first_id THEN {_BIT["E"]} ELSE 0 END AS mask
  FROM counted
),
marks AS (
  SELECT doc_id AS id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
),
cells AS (
  SELECT part, mask, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic
  FROM masked LEFT JOIN marks USING (id) GROUP BY part, mask
),
orders AS (
  SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order,
    [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM filters a, filters b, filters c, filters d, filters e
  WHERE a.bit + b.bit + c.bit + d.bit + e.bit = {_STATES - 1}
    AND len(list_distinct([a.bit, b.bit, c.bit, d.bit, e.bit])) = {len(FILTERS)}
),
steps AS (
  SELECT filter_order, unnest(range(1, {len(FILTERS) + 1})) AS step, bits FROM orders
),
state AS (
  SELECT filter_order, step, bits[step] AS bit, list_sum(bits[1:step])::BIGINT AS after_mask FROM steps
),
report AS (
  SELECT part, filter_order, step, bit,
    sum(CASE WHEN mask & after_mask = 0 THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN mask & after_mask = bit THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN mask & bit = bit AND mask & (after_mask - bit) > 0 THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN mask & after_mask = bit THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN mask & after_mask = bit THEN toxic ELSE 0 END) AS toxic_lost
  FROM cells, state GROUP BY part, filter_order, step, bit
)
SELECT part, filter_order, step::INTEGER AS step, kept::BIGINT AS kept, removed::BIGINT AS removed,
  redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost,
  toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM report
"""
