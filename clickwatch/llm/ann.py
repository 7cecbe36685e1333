"""Nearest neighbours by inner product over an inverted multi-index.

Both halves of a vector are quantised by codebooks of their own; a pair of centroids
is a cell, and a vector belongs to one cell. A query walks the pairs in
order of summed distance (centroids' inner products with the query's halves, negated)
with a heap over the two sorted lists, until the cells seen hold `entries` rows or `share`
of all rows, whichever is more. The rows of those cells are ranked by their exact inner product.
The default share is set for vectors without any clusters, where an index helps least;
clustered vectors reach the same recall with far less.

Codebooks are fitted on at most `sample` rows (those of least id hash) in one task; every row is
indexed. Cells are packed into blocks of about `block_rows`; a larger cell
takes several. A query goes only to the blocks of its cells, and the queries of a busy block
are dealt out in chunks, so a task meets one block and one chunk.

Of rows with equal vectors only the `k + 1` smallest ids can be among the k nearest of
anything (ties go to the smaller id, the query itself apart), so only they are indexed: exact, and a vector that
a third of all rows share fills no cell.

As cells are seen in order of distance, a query's cells are told by the distance of the last one.

Defined cases: vectors that are null, zero, hold null or non-finite components, or whose length is not
the commonest one (the smaller on a tie) take no part, nor do null ids; of rows
repeating an id the least vector counts; other columns are passed over; fewer than k
candidates give fewer rows; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clickwatch.session import stage

_RESULT = "query_id long, vec_id long, score double"
_SLACK = 1e-9
_QUERIES_AT_ONCE = 256


@dataclass(frozen=True)
class MultiIndex:
    k: int = 20
    #: rows a query looks at: at least so many, and at least this share of all
    entries: int = 4_000
    share: float = 0.5
    #: rows the codebooks are fitted on, and most centroids of each half
    sample: int = 16_384
    most_centroids: int = 1_024
    rows_per_cell: int = 4
    rounds: int = 8
    block_rows: int = 4_096
    chunk_queries: int = 4_096
    seed: int = 11


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(vec_id, v) of the rows that take part, one per id, v as doubles."""
    v = F.transform(F.col(vector), lambda x: x.cast("double"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col(key).cast("long").alias("vec_id"), v.alias("v")).filter(
        F.col("vec_id").isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists("v", lambda x: x != 0)
    )
    lengths = rows.groupBy(F.size("v").alias("n")).agg(F.count(F.lit(1)).alias("rows"))
    common = lengths.orderBy(F.desc("rows"), "n").first()  # one row per length
    rows = rows.filter(F.size("v") == (common["n"] if common else 0))
    return rows.groupBy("vec_id").agg(F.min("v").alias("v"))


def fit_codebook(rows: np.ndarray, centroids: int, rounds: int, seed: int) -> np.ndarray:
    """Lloyd's k-means; the first centroids are rows drawn at random, a centroid without rows stays."""
    rng = np.random.default_rng(seed)
    book = rows[rng.choice(len(rows), min(centroids, len(rows)), replace=False)].copy()
    for _ in range(rounds):
        own = nearest(rows, book)
        counts = np.bincount(own, minlength=len(book))
        sums = np.zeros_like(book)
        np.add.at(sums, own, rows)
        book = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], book)
    return book


def nearest(rows: np.ndarray, book: np.ndarray) -> np.ndarray:
    return np.concatenate(
        [(((book**2).sum(1) - 2 * rows[i : i + 8192] @ book.T)).argmin(1) for i in range(0, len(rows), 8192)]
        or [np.empty(0, np.int64)]
    )


def walk(first: np.ndarray, second: np.ndarray, sizes: np.ndarray, entries: int) -> float:
    """Summed distance of the last cell, in that order, until cells hold `entries` rows; cell (i, j) is i * len(second) + j."""
    rank1, rank2 = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    near1, near2 = first[rank1].tolist(), second[rank2].tolist()
    held = sizes.reshape(len(near1), len(near2))[np.ix_(rank1, rank2)].tolist()
    # one entry per row of the grid: its next column; a row opens when the row above has given its first
    heap, seen, distance, width, height = [(near1[0] + near2[0], 0, 0)], 0, -np.inf, len(near2), len(near1)
    while heap and seen < entries:
        distance, i, j = heap[0]
        seen += held[i][j]
        if j + 1 < width:
            heapq.heapreplace(heap, (near1[i] + near2[j + 1], i, j + 1))
        else:
            heapq.heappop(heap)
        if j == 0 and i + 1 < height:
            heapq.heappush(heap, (near1[i + 1] + near2[0], i + 1, 0))
    return distance


def _books(index: DataFrame, rows: int, how: MultiIndex) -> tuple[np.ndarray, np.ndarray]:
    """The codebooks of both halves; about `rows_per_cell` rows fall in a cell."""
    centroids = int(min(how.most_centroids, max(2, round((rows / how.rows_per_cell) ** 0.5))))

    def fit(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sample = pd.concat(list(frames)).sort_values("vec_id")
        x = np.array(sample["v"].tolist())
        half = x.shape[1] // 2
        books = [fit_codebook(part, centroids, how.rounds, how.seed) for part in (x[:, :half], x[:, half:])]
        yield pd.DataFrame({"part": [0, 1], "rows": [len(b) for b in books], "book": [b.tobytes() for b in books]})

    sample = index.orderBy(F.xxhash64("vec_id"), "vec_id").limit(how.sample)
    found = sample.repartition(1).mapInPandas(fit, "part int, rows int, book binary").orderBy("part").collect()
    return tuple(np.frombuffer(r["book"]).reshape(r["rows"], -1) for r in found)


def _pack(sizes: np.ndarray, block_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """(first block, blocks) of every cell: neighbours share a block, a large cell has several of its own."""
    first, count, block, filled = np.zeros(len(sizes), np.int64), np.ones(len(sizes), np.int64), 0, 0
    for cell, size in enumerate(sizes.tolist()):
        if filled and filled + size > block_rows:
            block, filled = block + 1, 0
        first[cell], count[cell] = block, max(1, -(-size // block_rows))
        block, filled = block + count[cell] - 1, filled + size if count[cell] == 1 else block_rows
    return first, count


def _best(query: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best of every query: highest score, then smaller id."""
    if not len(query):
        return np.empty(0, np.int64)
    order = np.lexsort((ids, -scores, query))
    ranked = query[order]
    start = np.concatenate(([True], ranked[1:] != ranked[:-1]))
    nth = np.arange(len(ranked)) - np.maximum.accumulate(np.where(start, np.arange(len(ranked)), 0))
    return order[nth < k]


def search(
    vectors: DataFrame, every: int, how: MultiIndex = MultiIndex(), key: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """(query_id, rank, vec_id, score): the nearest found of every row whose id is divisible by `every`."""
    spark = vectors.sparkSession
    rows = stage(usable(vectors, key, vector), "ann-rows")
    nth = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    index = stage(rows.withColumn("nth", nth).filter(F.col("nth") <= how.k + 1).drop("nth"), "ann-index")
    total = index.count()
    if not total:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    first_book, second_book = _books(index, total, how)
    half, width = first_book.shape[1], len(second_book)

    @F.pandas_udf("int")
    def cell_of(v: pd.Series) -> pd.Series:
        x = np.array(v.tolist()).reshape(len(v), -1)
        return pd.Series(nearest(x[:, :half], first_book) * width + nearest(x[:, half:], second_book), dtype="int32")

    placed = stage(index.withColumn("cell", cell_of("v")), "ann-cells")
    # at most most_centroids ** 2 cells
    sizes = np.zeros(len(first_book) * width, np.int64)
    for r in placed.groupBy("cell").agg(F.count(F.lit(1)).alias("rows")).collect():
        sizes[r["cell"]] = r["rows"]
    first_block, blocks = _pack(sizes, how.block_rows)
    wanted = max(how.entries, int(how.share * total))
    shared = spark.sparkContext.broadcast((first_book, second_book, sizes, first_block, blocks))

    @F.pandas_udf("int")
    def block_of(cell: pd.Series, spread: pd.Series) -> pd.Series:
        *_, first_block, blocks = shared.value
        return pd.Series(first_block[cell] + spread.to_numpy() % blocks[cell], dtype="int32")

    def visit(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        first_book, second_book, sizes, first_block, blocks = shared.value
        filled = np.flatnonzero(sizes)
        for frame in frames:
            out = []
            for query, v in zip(frame["vec_id"], frame["v"]):
                near1, near2 = -first_book @ v[:half], -second_book @ v[half:]
                reach = walk(near1, near2, sizes, wanted) + _SLACK
                cells = filled[near1[filled // width] + near2[filled % width] <= reach]
                parts = [first_block[cells], *[np.arange(first_block[c], first_block[c] + blocks[c]) for c in cells[blocks[cells] > 1]]]
                out += [(query, v, reach, int(b)) for b in np.unique(np.concatenate(parts))]
            yield pd.DataFrame(out, columns=["query_id", "v", "reach", "block"])

    queries = rows.filter(F.col("vec_id") % every == 0)
    schema = "query_id long, v array<double>, reach double, block int"
    visits = stage(queries.repartition("vec_id").mapInPandas(visit, schema), "ann-visits")
    chunks = visits.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / how.chunk_queries).cast("int").alias("chunks"))
    chunks = stage(chunks, "ann-chunks")
    dealt = visits.join(chunks, "block").withColumn("chunk", F.pmod(F.xxhash64("query_id"), F.col("chunks")).cast("int"))
    spread = F.pmod(F.xxhash64("vec_id"), F.lit(1 << 20)).cast("int")
    entries = placed.withColumn("block", block_of("cell", spread)).join(chunks, "block")
    entries = entries.select("vec_id", "v", "cell", "block", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"))
    k = how.k

    def rank(asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        if not len(asked) or not len(held):
            return none
        first_book, second_book, *_ = shared.value
        ids, x, cell = held["vec_id"].to_numpy(), np.array(held["v"].tolist()), held["cell"].to_numpy()
        longest, found = np.sqrt((x**2).sum(1).max()), []
        for at in range(0, len(asked), _QUERIES_AT_ONCE):
            part = asked.iloc[at : at + _QUERIES_AT_ONCE]
            q, of = np.array(part["v"].tolist()), part["query_id"].to_numpy()
            near1, near2 = -q[:, :half] @ first_book.T, -q[:, half:] @ second_book.T
            inside = near1[:, cell // width] + near2[:, cell % width] <= part["reach"].to_numpy()[:, None]
            scores = np.where(inside & (of[:, None] != ids[None]), q @ x.T, -np.inf)
            # the k-th best of this block, less what rounding may move
            least = np.partition(scores, -k, axis=1)[:, -k] if len(ids) > k else np.full(len(of), -np.inf)
            slack = _SLACK * (1 + longest * np.sqrt((q**2).sum(1)))
            a, b = np.nonzero((scores >= (least - slack)[:, None]) & (scores > -np.inf))
            # one fixed order of summation for every pair: equal vectors get equal scores
            exact = np.einsum("nd,nd->n", q[a], x[b])
            top = _best(a, ids[b], exact, k)
            found.append(pd.DataFrame({"query_id": of[a[top]], "vec_id": ids[b[top]], "score": exact[top]}))
        return pd.concat(found) if found else none

    near = dealt.groupBy("block", "chunk").cogroup(entries.groupBy("block", "chunk")).applyInPandas(rank, _RESULT)
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return near.withColumn("rank", place).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
