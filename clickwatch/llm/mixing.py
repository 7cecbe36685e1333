"""Mixing sources to target weights by weighted sampling without replacement.

Each source gets a word budget: its share of `budget` times all words, by weight,
never above `most` times its own words; what is above goes to the other sources
by weight. A source's budget is filled by whole epochs over all its documents
first. The fraction left is filled by Efraimidis-Spirakis sampling: a document
of quality q draws the exponential key -ln(u) / q from a hash of its id and text,
and documents are taken in order of key until the words taken come nearest to the budget.

No source is ever sorted. Keys are cut into slices whose words are summed before
the shuffle; running sums over slices name the one slice where the budget
falls, and only that slice is ranked. What is taken then is a comparison of each
row with its source's boundary, so texts are never moved.

Defined cases: a null text has size 0; a null source is a source of its own, last
in code-point order; a null id is an id like any other. Rows equal in id, source
and text share a key; at the boundary as many of them are taken as come nearest.
An empty table gives an empty result; other columns pass through untouched.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clickwatch.llm.common import WORD, text_key
from clickwatch.session import stage

#: fixed by the contract: weights by rank of the source, repeating
WEIGHTS = (5, 2, 1)
#: slices of key order in each source; running sums need one row per source and slice
SLICES = 65_536
#: documents of a non-letter text keep this much of the full quality
LEAST_QUALITY = 0.1
_HASH_DIGITS = 13  # hex digits, exact in a double


@dataclass(frozen=True)
class Mix:
    weights: Sequence[int] = WEIGHTS
    budget: float = 1.5
    most: float = 2.0
    seed: str = "mix"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def quality(text: Column) -> Column:
    """Share of letters among the characters, from LEAST_QUALITY to 1."""
    text = F.coalesce(text, F.lit(""))
    letters = F.length(F.regexp_replace(text, r"[^\p{L}]+", ""))
    return LEAST_QUALITY + (1 - LEAST_QUALITY) * F.coalesce(F.try_divide(letters, F.length(text)), F.lit(0.0))


def sampling_key(doc_id: Column, text: Column, seed: str) -> Column:
    """-ln(u) / quality, u in (0, 1] from a hash of seed, id and text: small keys are taken first."""
    drawn = F.md5(F.concat_ws(":", F.lit(seed), doc_id.cast("string"), F.coalesce(text_key(text), F.lit(""))).cast("binary"))
    whole = F.conv(F.substring(drawn, 1, _HASH_DIGITS), 16, 10).cast("long")
    u = (whole + 1) / F.lit(float(16**_HASH_DIGITS))
    return -F.log(u) / quality(text)


def _marks(doc_id: str, source: str, text: str, mix: Mix) -> dict[str, Column]:
    """What a row is judged by; `place` orders the rows of a source."""
    key = sampling_key(F.col(doc_id), F.col(text), mix.seed)
    return {
        "_source": F.col(source),
        "_size": word_count(F.col(text)),
        "_place": F.struct(key.alias("key"), F.col(doc_id).alias("doc_id"), text_key(F.col(text)).alias("text_key")),
    }


def _slice_of(key: Column) -> Column:
    """Rises with the key, from 0 to SLICES - 1."""
    return F.floor(key / (key + 1) * SLICES).cast("int")


def source_targets(sizes: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """Word budgets from one row per source (source, source_size).

    Sources reach their limit in order of limit per weight, so one running sum
    in that order tells which ones stop there and what the others share. One row
    per source is sorted here, never documents.
    """
    last = F.col("source").isNull()
    place = F.row_number().over(Window.orderBy(last, "source")) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in mix.weights]), (place % len(mix.weights) + 1).cast("int"))
    rows = sizes.withColumn("weight", weight).withColumn("limit", F.col("source_size") * mix.most)
    order = Window.orderBy(F.col("limit") / F.col("weight"), last, "source")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    rows = rows.select(
        "*",
        (F.sum("source_size").over(everything) * mix.budget - F.coalesce(F.sum("limit").over(before), F.lit(0.0))).alias("left"),
        (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))).alias("weight_left"),
        F.row_number().over(order).alias("at"),
    )
    share = F.col("left") / F.col("weight_left")
    stops = F.col("limit") <= share * F.col("weight")
    # past the first source below its limit, all share what was left there
    level = F.min(F.when(~stops, F.struct("at", share.alias("share")))).over(everything)["share"]
    target = F.when(stops, F.col("limit")).otherwise(level * F.col("weight"))
    return rows.select("source", "source_size", target.alias("target"))


def _budgets(marks: DataFrame, mix: Mix) -> DataFrame:
    """One staged row per source: sizes, target, whole epochs and where the fraction ends.

    Rows up to `edge` are taken once more, of the rows equal to it `edge_taken` of `edge_rows`.
    """
    by_source = lambda a, b: F.col(f"{a}._source").eqNullSafe(F.col(f"{b}._source"))
    sizes = marks.groupBy(F.col("_source").alias("source")).agg(F.sum("_size").alias("source_size"))
    targets = source_targets(sizes, mix).withColumnRenamed("source", "_source")
    epochs = F.coalesce(F.floor(F.try_divide("target", "source_size")), F.lit(0)).cast("long")
    targets = targets.withColumn("epochs", epochs)
    targets = stage(targets.withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size")), "mix-targets")

    sliced = marks.withColumn("slice", _slice_of(F.col("_place.key")))
    words = sliced.groupBy("_source", "slice").agg(F.sum("_size").alias("words"))
    upto = F.sum("words").over(Window.partitionBy("_source").orderBy("slice"))
    running = words.withColumn("below", upto - F.col("words")).alias("w").join(targets.alias("t"), by_source("w", "t"))
    # the first slice that reaches the fraction; none where the fraction is empty
    reached = (F.col("rest") > 0) & (F.col("below") + F.col("words") >= F.col("rest"))
    first = F.min(F.when(reached, F.struct("slice", "below", "rest"))).alias("at")
    crossing = stage(running.groupBy(F.col("w._source").alias("_source")).agg(first).select("_source", "at.*"), "mix-slices")

    inside = sliced.alias("m").join(
        crossing.alias("c"), by_source("m", "c") & (F.col("m.slice") == F.col("c.slice"))
    )
    groups = inside.groupBy("m._source", "_place", "_size", "below", "rest").agg(F.count(F.lit(1)).alias("rows"))
    before = Window.partitionBy("_source").orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
    room = F.col("rest") - F.col("below") - F.coalesce(F.sum(F.col("_size") * F.col("rows")).over(before), F.lit(0))
    # one more row is taken if the words then come nearer to the budget
    nearest = F.floor(F.coalesce(F.try_divide(room, "_size"), F.when(room >= 0, F.col("rows")).otherwise(0)) + 0.5)
    counted = groups.withColumn("taken", F.least(F.col("rows"), F.greatest(F.lit(0), nearest)).cast("long"))
    last = F.max(F.when(F.col("taken") > 0, F.struct(F.col("_place").alias("edge"), F.col("taken").alias("edge_taken"), F.col("rows").alias("edge_rows"))))
    edges = counted.groupBy("_source").agg(last.alias("at")).select("_source", "at.*")
    joined = targets.alias("t").join(crossing.alias("c"), by_source("t", "c"), "left").join(edges.alias("e"), by_source("t", "e"), "left")
    return stage(
        joined.select("t._source", "source_size", "target", "epochs", F.col("c.slice").alias("edge_slice"), "edge", "edge_taken", "edge_rows"),
        "mix-budgets",
    )


def _decide(rows: DataFrame, budgets: DataFrame) -> DataFrame:
    """Add the budget's columns and `_copies`, the times a row is taken."""
    renamed = budgets.select(*[F.col(c).alias(f"_b_{c}") for c in budgets.columns])
    joined = rows.join(renamed, F.col("_source").eqNullSafe(F.col("_b__source")))
    at = _slice_of(F.col("_place.key"))
    equal = F.col("_place").eqNullSafe(F.col("_b_edge"))
    below = (at < F.col("_b_edge_slice")) | ((at == F.col("_b_edge_slice")) & (F.col("_place") <= F.col("_b_edge")))
    once_more = F.coalesce(below, F.lit(False)).cast("long")
    if budgets.filter("edge_taken < edge_rows").isEmpty():
        return joined.withColumn("_copies", F.col("_b_epochs") + once_more)
    # rows equal to an edge of which some are taken: numbered, the others are judged alone
    shared = equal & (F.col("_b_edge_taken") < F.col("_b_edge_rows"))
    nth = F.row_number().over(Window.partitionBy("_source").orderBy("_place"))
    some = joined.filter(shared).withColumn("_copies", F.col("_b_epochs") + (nth <= F.col("_b_edge_taken")).cast("long"))
    return joined.filter(~shared | shared.isNull()).withColumn("_copies", F.col("_b_epochs") + once_more).unionByName(some)


def mix_report(
    docs: DataFrame, mix: Mix = Mix(), doc_id: str = "doc_id", source: str = "source", text: str = "text"
) -> DataFrame:
    """Per row of `docs`: id, source, size, source_size, target, copies and taken (words, repeats counted)."""
    marks = stage(docs.select(*[c.alias(n) for n, c in _marks(doc_id, source, text, mix).items()]), "mix-marks")
    rows = _decide(marks, _budgets(marks, mix))
    return rows.select(
        F.col("_place.doc_id").alias(doc_id),
        F.col("_source").alias(source),
        F.col("_size").alias("size"),
        F.col("_b_source_size").alias("source_size"),
        F.col("_b_target").alias("target"),
        F.col("_copies").alias("copies"),
        (F.col("_copies") * F.col("_size")).alias("taken"),
    )


def mix_documents(
    docs: DataFrame, mix: Mix = Mix(), doc_id: str = "doc_id", source: str = "source", text: str = "text"
) -> DataFrame:
    """The rows of the mix: every row of `docs`, all its columns, as often as it is taken."""
    marks = stage(docs.select(*[c.alias(n) for n, c in _marks(doc_id, source, text, mix).items()]), "mix-marks")
    nested = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    inner = lambda c: f"_row.`{c}`"
    rows = nested.withColumns(_marks(inner(doc_id), inner(source), inner(text), mix))
    taken = _decide(rows, _budgets(marks, mix)).filter(F.col("_copies") > 0)
    return taken.select("_row", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int")))).select("_row.*")


def mix_sql(docs: str = "documents", mix: Mix = Mix(), columns: str | None = None) -> str:
    """`mix_report` (or, with `columns`, the rows of `mix_documents`) as DuckDB SQL over the relation `docs`."""
    weights = ", ".join(str(float(w)) for w in mix.weights)
    letters = r"length(regexp_replace(coalesce(text, ''), '[^\p{L}]+', '', 'g'))"
    result = (
        "SELECT doc_id, size, source_size::BIGINT AS source_size, target, (size * copies)::BIGINT AS taken FROM counted"
        if columns is None
        else f"SELECT {columns} FROM counted, unnest(range(copies))"
    )
    return f"""
        WITH sized AS (
            SELECT *, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS size,
                   coalesce(md5(text), '') AS text_key,
                   {LEAST_QUALITY} + {1 - LEAST_QUALITY} * coalesce({letters} / nullif(length(text), 0), 0)::DOUBLE AS quality
            FROM {docs}),
        keyed AS (
            SELECT *, -ln((('0x' || substr(md5(concat_ws(':', '{mix.seed}', doc_id::VARCHAR, text_key)), 1, {_HASH_DIGITS}))::BIGINT + 1)
                          / {float(16**_HASH_DIGITS)}::DOUBLE) / quality AS key FROM sized),
        sources AS (SELECT source, sum(size)::DOUBLE AS source_size FROM keyed GROUP BY source),
        weighted AS (
            SELECT *, {mix.most} * source_size AS most,
                   ([{weights}])[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(mix.weights)} + 1]::DOUBLE AS weight
            FROM sources),
        ordered AS (
            SELECT *, row_number() OVER w AS pos,
                   {mix.budget} * sum(source_size) OVER () - coalesce(sum(most) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS unspent,
                   sum(weight) OVER () - coalesce(sum(weight) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS weight_left
            FROM weighted WINDOW w AS (ORDER BY most / weight, source NULLS LAST)),
        targets AS (
            SELECT source, source_size,
                   CASE WHEN most <= unspent / weight_left * weight THEN most
                        ELSE weight * (SELECT arg_min(unspent / weight_left, pos) FROM ordered WHERE most > unspent / weight_left * weight) END AS target
            FROM ordered),
        epochs AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs FROM targets),
        placed AS (
            SELECT k.*, e.source_size, e.target, e.epochs, e.target - e.epochs * e.source_size AS rest,
                   coalesce(sum(size) OVER (PARTITION BY k.source ORDER BY key, doc_id NULLS FIRST, text_key
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
            FROM keyed k JOIN epochs e ON k.source IS NOT DISTINCT FROM e.source),
        counted AS (SELECT *, (epochs + (rest > 0 AND 2 * before + size <= 2 * rest)::INT)::BIGINT AS copies FROM placed)
        {result}"""
