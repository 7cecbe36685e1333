"""Benchmark decontamination: which test items lie inside which documents.

An item is contained in a document if at least `threshold` of its distinct word
shingles occur there. Items are partitioned by size (powers of two of their
shingle count). Each partition has its own MinHash sketch length: the `s`
shingles of least hash, `s` being one more than the shingles an item of that size may miss. A
document that contains an item therefore has at least one shingle of its sketch,
however long it is, and the search loses nothing. Documents smaller than
`threshold` of an item are left out. Candidates are then verified by counting the item's
shingles in the document, compared as text.

Document shingles stream past the sketches in one pass; only those that hit are
shuffled. Sketches are broadcast after their rows are counted against
`broadcast_rows`, and joined by shuffle beyond it.

Words are runs of letters and digits, lower-cased. Defined cases: a text of fewer
words than a shingle is a single shingle; null and blank texts have none and
neither contain nor are contained; a repeated item id is one item with the shingles of all its rows;
rows equal in id and text are reported once; empty tables give empty results.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clickwatch.llm.common import free_name
from clickwatch.session import stage

WORD_SEPARATOR = r"[^\p{L}\p{N}]+"


@dataclass(frozen=True)
class Search:
    words: int = 5
    threshold: float = 0.8
    #: sketches of up to so many rows (16 bytes each, or a shingle's text) are broadcast
    broadcast_rows: int = 1_000_000


def _exploded(rows: DataFrame, text: Column, width: int) -> DataFrame:
    """Every shingle of every row as columns w0 .. w<width-1>, beside the columns of `rows`, with their count `n_all`.

    The outer form of `inline` keeps the optimizer from repeating the split in a filter of its own.
    """
    split = rows.withColumn("_words", F.split(F.lower(F.coalesce(text, F.lit(""))), WORD_SEPARATOR))
    # separators at the ends leave an empty first or last word
    first = (F.get("_words", F.lit(0)) == "").cast("int")
    count = F.size("_words") - first - (F.element_at("_words", -1) == "").cast("int")
    n = F.when(count > 0, F.greatest(count - (width - 1), F.lit(1))).otherwise(0)
    # a text shorter than a shingle leaves its last words null
    words = [F.slice("_words", first + (i + 1), F.greatest(F.least(n, count - i), F.lit(0))).alias(f"w{i}") for i in range(width)]
    zipped = split.select(*rows.columns, n.alias("n_all"), F.arrays_zip(*words).alias("_zip"))
    every = zipped.select(*rows.columns, "n_all", F.inline_outer("_zip").alias(*[f"w{i}" for i in range(width)]))
    return every.filter(F.col("w0").isNotNull())


def _hash(width: int) -> Column:
    return F.xxhash64(*[F.col(f"w{i}") for i in range(width)])


def _shingle(width: int) -> Column:
    return F.concat_ws(" ", *[F.col(f"w{i}") for i in range(width)])


def _small(df: DataFrame, rows: int) -> DataFrame:
    """`df`, a staged table, hinted for broadcast if a count proves it small."""
    return F.broadcast(df) if df.count() <= rows else df


def item_shingles(items: DataFrame, item_id: str, text: str, search: Search) -> DataFrame:
    """(item_id, n, shingle, hash) of the distinct shingles; n: how many the item has."""
    rows = items.select(F.col(item_id).alias("item_id"), F.col(text).alias("_text")).filter(F.col("item_id").isNotNull())
    every = _exploded(rows, F.col("_text"), search.words)
    distinct = every.select("item_id", _shingle(search.words).alias("shingle"), _hash(search.words).alias("hash")).distinct()
    n = F.count(F.lit(1)).over(Window.partitionBy("item_id"))
    return distinct.select("item_id", n.alias("n"), "shingle", "hash")


def sketches(shingles: DataFrame, search: Search) -> DataFrame:
    """(item_id, n, hash): of every item the shingles of least hash, as many as its size partition asks for."""
    largest = F.pow(F.lit(2), F.floor(F.log2("n")) + 1) - 1  # of the partition n falls in
    length = F.floor(largest * (1 - search.threshold) + F.lit(1e-9)) + 1
    place = F.row_number().over(Window.partitionBy("item_id").orderBy(F.xxhash64("hash"), "hash", "shingle"))
    return shingles.withColumn("place", place).filter(F.col("place") <= length).select("item_id", "n", "hash").distinct()


def contained_items(
    docs: DataFrame,
    items: DataFrame,
    search: Search = Search(),
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """(doc_id, text_hash, item_id, shared, item_shingles, containment) of every contained item."""
    width = search.words
    shingles = stage(item_shingles(items, item_id, item_text, search), "leak-items")
    sketch = _small(stage(sketches(shingles, search), "leak-sketches"), search.broadcast_rows)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(F.col(text)).alias("text_hash"), F.col(text).alias("_text"))
    # a text has at least as many shingles as distinct ones, so n_all may only keep too much
    hits = (
        _exploded(rows, F.col("_text"), width).withColumn("hash", _hash(width)).select("doc_id", "text_hash", "n_all", "hash")
        .join(sketch, "hash")
        .filter(F.col("n_all") >= F.col("n") * search.threshold - 1e-9)
    )
    candidates = stage(hits.select("doc_id", "text_hash").distinct(), "leak-candidates")
    suspects = rows.join(
        candidates.alias("c"),
        rows["doc_id"].eqNullSafe(F.col("c.doc_id")) & (rows["text_hash"] == F.col("c.text_hash")),
        "left_semi",
    )
    found = _exploded(suspects, F.col("_text"), width).select(
        "doc_id", "text_hash", _hash(width).alias("hash"), _shingle(width).alias("shingle")
    )
    shared = (
        found.join(_small(shingles, search.broadcast_rows), ["hash", "shingle"])
        .groupBy("doc_id", "text_hash", "item_id", "n")
        .agg(F.countDistinct("shingle").alias("shared"))
    )
    return shared.filter(F.col("shared") >= F.col("n") * search.threshold - 1e-9).select(
        F.col("doc_id").alias(doc_id),
        "text_hash",
        F.col("item_id").alias(item_id),
        "shared",
        F.col("n").alias("item_shingles"),
        (F.col("shared") / F.col("n")).alias("containment"),
    )


def without_leaks(
    docs: DataFrame, items: DataFrame, search: Search = Search(), doc_id: str = "doc_id", text: str = "text", item_text: str = "text"
) -> DataFrame:
    """The rows of `docs`, all columns, that contain no item."""
    found = contained_items(docs, items, search, doc_id, text, item_text=item_text)
    leaks = stage(found.select(F.col(doc_id).alias("_id"), F.col("text_hash").alias("_hash")).distinct(), "leak-documents")
    key = free_name(docs, "text_hash")
    keyed = docs.withColumn(key, F.xxhash64(F.col(text)))
    same = keyed[doc_id].eqNullSafe(leaks["_id"]) & (keyed[key] == leaks["_hash"])
    return keyed.join(leaks, same, "left_anti").drop(key)


def contained_items_sql(search: Search = Search()) -> str:
    """Exact containment of every item of `benchmark` in `documents`, by shingle counts alone, as DuckDB SQL."""
    width, step = search.words, search.words - 1

    def shingles(source: str, key: str) -> str:
        words = f"list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> '')"
        return f"""
            SELECT DISTINCT {key}, array_to_string(w[i:i + {step}], ' ') AS shingle
            FROM (SELECT {key}, w, unnest(range(1, greatest(len(w) - {step}, 1) + 1)) AS i
                  FROM (SELECT {key}, {words} AS w FROM {source}) WHERE len(w) > 0)"""

    return f"""
        WITH item AS ({shingles('benchmark', 'item_id')}),
        sized AS (SELECT item_id, count(*) AS n FROM item GROUP BY item_id),
        doc AS ({shingles('(SELECT doc_id, text, md5(text) AS text_key FROM documents)', 'doc_id, text_key')}),
        shared AS (SELECT doc_id, text_key, item_id, count(*) AS shared FROM doc JOIN item USING (shingle) GROUP BY ALL)
        SELECT doc_id, item_id, shared, n AS item_shingles, shared / n AS containment
        FROM shared JOIN sized USING (item_id) WHERE item_id IS NOT NULL AND shared >= n * {search.threshold} - 1e-9"""
