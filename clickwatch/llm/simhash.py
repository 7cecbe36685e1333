"""SimHash near-duplicates by an inverted index over the bytes of the fingerprint.

Fingerprints that differ in at most `max_bits` bits agree in at least
`8 - max_bits` of their eight bytes. The index lists fingerprints under their
positional bytes; as a single byte's list holds 1/256 of everything, lists are kept for sets
of byte positions, chosen so that any two fingerprints agreeing in that minimum of
positions meet in a list. Of pairs that meet, the shared positional bytes are
tallied, pairs below the minimum are dropped, and the rest is verified bit by bit.

Only distinct fingerprints are indexed, so exact copies cost nothing. A list of
more than `list_limit` fingerprints (near copies agree in most bytes) emits no pairs: its members
name all values within `max_bits / 2` flips of the bytes outside the list's
positions. Two members are within `max_bits` exactly if they name a common value, so linking
each to the smallest member naming it gives the same components, one row per member and value.

Defined cases: a text of fewer words than a shingle is one shingle; null, empty
and blank texts have fingerprint zero and are linked like any other; a component
of null ids only has a null id; repeated rows stay repeated rows; an empty table gives an
empty result.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clickwatch.llm.common import free_name, text_key
from clickwatch.llm.components import connected_components
from clickwatch.session import stage

#: fixed by the contract
SHINGLE_WORDS, HASH_SEED, MAX_BITS = 3, 42, 2
BYTES = 8
_BLOCK = 1 << 16  # shingles whose bits are counted at once


def fingerprint(text: str | None, width: int = SHINGLE_WORDS) -> int:
    """The 64-bit SimHash of a text: bits set in over half the shingle hashes."""
    words = (text or "").encode("utf-8", "replace").lower().split()  # bytes: ASCII letters and white space only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    span = min(width, len(words))
    cuts = zip(starts[: len(words) - span + 1].tolist(), ends[span - 1 :].tolist())
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], HASH_SEED) for a, b in cuts], dtype=">u8")
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _BLOCK):
        block = hashes[at : at + _BLOCK].view(np.uint8).reshape(-1, BYTES)
        counts += np.unpackbits(block, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(hashes)).tobytes(), "big")


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def fingerprint_column(text: Column, width: int = SHINGLE_WORDS) -> Column:
    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([_signed(fingerprint(t, width)) for t in texts], dtype="int64")

    return of(text)


def hex_digits(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def index_positions(max_bits: int, key_bytes: int) -> list[tuple[int, ...]]:
    """Sets of `key_bytes` byte positions, one of which escapes any `max_bits` spoilt positions."""
    spoilt = set(combinations(range(BYTES), max_bits))
    sets = list(combinations(range(BYTES), key_bytes))
    chosen = []
    while spoilt:
        best = max(sets, key=lambda s: sum(not set(s) & set(x) for x in spoilt))
        chosen.append(best)
        spoilt = {x for x in spoilt if set(best) & set(x)}
    return chosen


def _mask(positions: tuple[int, ...]) -> int:
    return _signed(sum(0xFF << (8 * p) for p in positions))


def _flips(mask: int, most: int) -> list[int]:
    """All ways to flip up to `most` bits outside the mask."""
    free = [1 << b for b in range(64) if not (mask >> b) & 1]
    return [_signed(sum(c)) for n in range(most + 1) for c in combinations(free, n)]


def links(fingerprints: DataFrame, max_bits: int = MAX_BITS, list_limit: int = 64, key_bytes: int = 4) -> DataFrame:
    """Links (a, b), a < b, among distinct longs `fp` that give the components of "differs in at most max_bits bits".

    Every link returned holds; of lists above `list_limit` enough links are returned to connect all that belong together.
    """
    if max_bits % 2 or not 0 < max_bits <= BYTES - key_bytes:
        raise ValueError("max_bits must be even, and leave key_bytes of the bytes untouched")
    masks = [_mask(p) for p in index_positions(max_bits, key_bytes)]
    entries = F.explode(
        F.array(*[F.struct(F.lit(i).alias("list"), F.col("fp").bitwiseAND(F.lit(m)).alias("bytes")) for i, m in enumerate(masks)])
    )
    index = stage(fingerprints.select("fp", entries.alias("k")).select("k.list", "k.bytes", "fp"), "simhash-index")
    sizes = index.groupBy("list", "bytes").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    met = stage(index.join(sizes, ["list", "bytes"]), "simhash-met")

    short = met.filter(F.col("members") <= list_limit)
    left, right = short.withColumnRenamed("fp", "a"), short.select("list", "bytes", F.col("fp").alias("b"))
    differ = F.col("a").bitwiseXOR(F.col("b"))
    shared = reduce(
        lambda x, y: x + y, [(differ.bitwiseAND(F.lit(_mask((p,)))) == 0).cast("int") for p in range(BYTES)]
    )
    first_list = F.coalesce(*[F.when(differ.bitwiseAND(F.lit(m)) == 0, F.lit(i)) for i, m in enumerate(masks)])
    pairs = (
        left.join(right, ["list", "bytes"])
        .filter("a < b")
        .filter(shared >= BYTES - max_bits)
        .filter(F.bit_count(differ) <= max_bits)
        .filter(F.col("list") == first_list)  # a pair meets in several lists and is kept once
        .select("a", "b")
    )

    by_list = F.element_at(F.array(*[F.array(*[F.lit(x) for x in _flips(m, max_bits // 2)]) for m in masks]), F.col("list") + 1)
    named = (
        met.filter(F.col("members") > list_limit)
        .select("fp", F.explode(by_list).alias("flip"))
        .select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("value"))
        .distinct()
    )
    least = named.groupBy("value").agg(F.min("fp").alias("a"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    stars = named.join(least, "value").filter("fp != a").select("a", F.col("fp").alias("b"))
    return pairs.unionByName(stars)


def _group_ids(tagged: DataFrame, max_bits: int) -> DataFrame:
    """(fp, root, first_id, component_id) of every distinct fingerprint of `tagged` (doc_id, fp)."""
    distinct = stage(tagged.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-distinct")
    roots = stage(connected_components(links(distinct.select("fp"), max_bits)), "simhash-roots")
    linked = roots.join(distinct, roots.node == distinct.fp).select("fp", "root", "first_id")
    ids = linked.groupBy("root").agg(F.min("first_id").alias("component_id"))
    linked = linked.join(ids, "root").select("fp", "root", "component_id")
    alone = F.col("root").isNull()
    return distinct.join(linked, "fp", "left").select(
        "fp",
        F.coalesce("root", "fp").alias("root"),
        "first_id",
        F.when(alone, F.col("first_id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = SHINGLE_WORDS, max_bits: int = MAX_BITS
) -> DataFrame:
    """Per row of `docs`: id, fp (long) and component_id, the smallest id reachable by links."""
    tagged = stage(
        docs.select(F.col(doc_id).alias("doc_id"), fingerprint_column(F.col(text), width).alias("fp")), "simhash-docs"
    )
    groups = stage(_group_ids(tagged, max_bits), "simhash-groups")
    return tagged.join(groups.select("fp", "component_id"), "fp").select(F.col("doc_id").alias(doc_id), "fp", "component_id")


def one_of_each(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = SHINGLE_WORDS, max_bits: int = MAX_BITS
) -> DataFrame:
    """The rows of `docs`, all columns, that stand for their group: the smallest id (null last), one row of it."""
    fp = free_name(docs, "fp")
    wide = stage(docs.withColumn(fp, fingerprint_column(F.col(text), width)), "simhash-wide")
    tagged = wide.select(F.col(doc_id).alias("doc_id"), F.col(fp).alias("fp"))
    groups = stage(_group_ids(tagged, max_bits), "simhash-groups")
    # of the fingerprints in a group that have its smallest id, the smallest one
    first = F.row_number().over(Window.partitionBy("root").orderBy("fp"))
    heads = (
        groups.filter(F.col("first_id").eqNullSafe(F.col("component_id")))
        .withColumn("nth", first)
        .filter("nth = 1")
        .select(F.col("fp").alias("_fp"), F.col("first_id").alias("_id"))
    )
    kept = wide.join(heads, (wide[fp] == heads["_fp"]) & wide[doc_id].eqNullSafe(heads["_id"]))
    nth = F.row_number().over(Window.partitionBy(wide[fp], wide[doc_id]).orderBy(text_key(wide[text])))
    mark = free_name(docs, "nth")
    return kept.select(*[wide[c] for c in docs.columns], nth.alias(mark)).filter(F.col(mark) == 1).drop(mark)
