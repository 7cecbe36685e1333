"""Order statistics without ever sorting a large table in one task.

One order holds throughout: NULL last, NaN above every number. There is one path
for tables of any size.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clickwatch.session import stage

#: bits of an ordered double that each pass looks at, from the top: six passes reach every bit
DIGIT_SHIFTS = (55, 44, 33, 22, 11, 0)


def kth_key(df: DataFrame, k: int, levels: Sequence[Column], order_by: Sequence[str]) -> Row:
    """The `k`-th smallest row (from 1) by `order_by`, cut to those columns.

    Each level is an expression that rises with the order. Rows are counted per
    level value, the one value holding position `k` becomes a filter, and the
    next level continues inside it. What is left after the last level is counted
    per distinct key, so repeated rows cost one. No pass moves rows, only counts.
    """

    def hit(counts: DataFrame, names: Sequence[str]) -> Row:
        upto = F.sum("_rows").over(Window.orderBy(*[F.col(n).asc_nulls_last() for n in names]))
        row = counts.withColumn("_upto", upto).filter(F.col("_upto") >= k).orderBy("_upto").first()
        if row is None:
            raise ValueError(f"position {k} is beyond the table")
        return row

    rows = F.count(F.lit(1)).alias("_rows")
    for level in levels:
        at = hit(df.groupBy(level.alias("_level")).agg(rows), ["_level"])
        df = df.filter(level.eqNullSafe(F.lit(at["_level"])))
        k -= at["_upto"] - at["_rows"]
    found = hit(df.groupBy(*order_by).agg(rows), order_by)
    return Row(*order_by)(*[found[n] for n in order_by])


def up_to_key(cutoff: Row) -> Column:
    """True for rows whose columns, compared in order, are not above `cutoff`; never NULL."""
    names = cutoff.__fields__
    verdict = F.lit(True)
    for name in reversed(names):
        value = cutoff[name]
        below = F.col(name).isNotNull() if value is None else F.coalesce(F.col(name) < F.lit(value), F.lit(False))
        verdict = below | (F.col(name).eqNullSafe(F.lit(value)) & verdict)
    return verdict


def group_cutoffs(df: DataFrame, k: int, groups: Sequence[str], buckets: Sequence[Column], order_by: Sequence[str]) -> DataFrame:
    """One row per group: `_cutoff`, the struct of `order_by` of its `k`-th smallest row (of its last, if it has fewer).

    As `kth_key`, for all groups at once: rows are counted per group and bucket,
    and only the bucket where `k` falls goes on to the next, finer one.
    """
    sought = None
    rows = F.count(F.lit(1)).alias("_rows")
    same = lambda a, b: [F.col(f"{a}.{g}").eqNullSafe(F.col(f"{b}.{g}")) for g in groups]
    keys = [*buckets, F.struct(*order_by)]
    for i, key in enumerate(keys):
        counted = df.withColumn("_bucket", key)
        if sought is not None:
            inside = [*same("d", "s"), keys[i - 1].eqNullSafe(F.col("s._cutoff"))]
            counted = counted.alias("d").join(F.broadcast(sought.alias("s")), inside).select("d.*", "_k")
        else:
            counted = counted.withColumn("_k", F.lit(k).cast("bigint"))
        counts = counted.groupBy(*groups, "_bucket", "_k").agg(rows)
        order = Window.partitionBy(*groups).orderBy("_bucket")
        total = F.sum("_rows").over(Window.partitionBy(*groups))
        ranked = counts.select("*", F.sum("_rows").over(order).alias("_upto"), F.least("_k", total).alias("_want"))
        first = F.min(F.struct(F.col("_bucket").alias("_cutoff"), (F.col("_want") - F.col("_upto") + F.col("_rows")).alias("_k")))
        # one row per group
        sought = stage(
            ranked.filter(F.col("_upto") >= F.col("_want")).groupBy(*groups).agg(first.alias("_f")).select(*groups, "_f.*"), "cutoffs"
        )
    return sought.drop("_k")


def running_totals(
    counts: DataFrame, value: str, measures: Sequence[str], descending: bool = False, with_next: bool = False, ranges: int | None = None
) -> DataFrame:
    """Add `cum_<measure>`: inclusive running sums in order of `value`.
    `with_next` also adds `next_<measure>`, that of the following value.

    `counts` has one row per distinct value. It is written once in ranges of the
    value (as many as the session's partitions, or `ranges`); each range is summed
    on its own and lifted by the total of the ranges before it. NULL comes last
    and NaN above all numbers; types stay as they are.
    """
    direction = F.desc_nulls_last if descending else F.asc_nulls_last
    dealt = counts.repartitionByRange(*([ranges] if ranges else []), direction(value))
    ranged = stage(dealt.withColumn("_range", F.spark_partition_id()), "ranges")
    order = [direction(value)]
    within = Window.partitionBy("_range").orderBy(*order)
    firsts = ranged.withColumn("_nth", F.row_number().over(within)).filter("_nth = 1")
    totals = ranged.groupBy("_range").agg(*[F.sum(m).alias(f"_all_{m}") for m in measures])
    totals = totals.join(firsts.select("_range", *[F.col(m).alias(f"_first_{m}") for m in measures]), "_range")
    across = Window.orderBy("_range")
    lifts = totals.select(
        "_range",
        *[(F.sum(f"_all_{m}").over(across) - F.col(f"_all_{m}")).alias(f"_lift_{m}") for m in measures],
        *[F.lead(f"_first_{m}").over(across).alias(f"_after_{m}") for m in measures],
    )
    nexts = [
        F.coalesce(F.lead(m).over(within), F.col(f"_after_{m}")).alias(f"next_{m}") for m in measures if with_next
    ]
    # one row per range, at most as many as the session has partitions
    return ranged.join(F.broadcast(lifts), "_range").select(
        *counts.columns,
        *[(F.sum(m).over(within) + F.col(f"_lift_{m}")).alias(f"cum_{m}") for m in measures],
        *nexts,
    )


def ordered_bits(value: Column) -> Column:
    """The bits of a double as a long that has the doubles' order; -0.0 counts as 0.0."""
    bits = F.java_method(F.lit("java.lang.Double"), F.lit("doubleToRawLongBits"), value + F.lit(0.0)).cast("bigint")
    return F.when(bits < 0, bits.bitwiseXOR(F.lit((1 << 63) - 1))).otherwise(bits)


def _double_of(key: int) -> float:
    bits = key if key >= 0 else key ^ ((1 << 63) - 1)
    return struct.unpack(">d", struct.pack(">q", bits))[0]


def order_statistics(df: DataFrame, column: str, ranks_of: Callable[[int], Sequence[int]]) -> dict[int, float]:
    """Numbers at several ranks (from 1) of a column; NULL and NaN are left out.

    `ranks_of` gives the ranks sought among so many numbers. Values are counted by the digits of
    their ordered bits: a pass counts the next digit below the prefixes in which a sought rank
    falls, for all ranks together, and a prefix that holds one value only needs no further pass. So
    six passes find any ranks of any doubles; a pass moves at most a row per rank and digit.
    """
    v = F.col(column).cast("double")
    keys = df.filter(v.isNotNull() & ~F.isnan(v)).select(ordered_bits(v).alias("key"))
    found: dict[int, float] = {}
    open_ranks: dict[int | None, list[tuple[int, int]]] = {}  # prefix: (rank, rank below the prefix)
    for level, shift in enumerate(DIGIT_SHIFTS):
        prefix = F.shiftright("key", shift)
        parent = F.shiftright("key", DIGIT_SHIFTS[level - 1]) if level else F.lit(None).cast("bigint")
        inside = keys.filter(parent.isin(list(open_ranks))) if level else keys
        counts = inside.groupBy(parent.alias("parent"), prefix.alias("prefix")).agg(
            F.count(F.lit(1)).alias("rows"), F.min("key").alias("low"), F.max("key").alias("high")
        )
        parts: dict[int | None, list] = {}
        for row in sorted(counts.collect(), key=lambda r: r["prefix"]):
            parts.setdefault(row["parent"], []).append(row)
        if not level:
            total = sum(row["rows"] for row in parts.get(None, []))
            open_ranks = {None: [(rank, rank) for rank in ranks_of(total)]} if total else {}
        below: dict[int | None, list[tuple[int, int]]] = {}
        for above, sought in open_ranks.items():
            for rank, left in sought:
                for row in parts[above]:
                    if left <= row["rows"]:
                        break
                    left -= row["rows"]
                else:
                    raise ValueError(f"rank {rank} is beyond the table")
                if row["low"] == row["high"]:
                    found[rank] = _double_of(row["low"])
                else:
                    below.setdefault(row["prefix"], []).append((rank, left))
        open_ranks = below
        if not open_ranks:
            break
    return found


def exact_quantiles(df: DataFrame, column: str, ps: Sequence[float]) -> list[float | None]:
    """Quantiles with linear interpolation between neighbours, all in one descent.

    NULL and NaN are left out; without a number every quantile is None.
    """
    size = 0

    def ranks_of(total: int) -> list[int]:
        nonlocal size
        size = total
        positions = [(total - 1) * p for p in ps]
        return sorted({math.floor(x) + 1 for x in positions} | {math.ceil(x) + 1 for x in positions})

    at = order_statistics(df, column, ranks_of)
    if not size:
        return [None] * len(ps)
    quantiles = []
    for p in ps:
        position = (size - 1) * p
        low, high = at[math.floor(position) + 1], at[math.ceil(position) + 1]
        quantiles.append(low if low == high else low + (high - low) * (position - math.floor(position)))
    return quantiles


def exact_quantile(df: DataFrame, column: str, p: float) -> float | None:
    return exact_quantiles(df, column, [p])[0]
