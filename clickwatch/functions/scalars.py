"""Column expressions shared by several operators."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def clip(x: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(x, F.lit(low)), F.lit(high))


def pseudonymous_id(user_id: Column, salt: str) -> Column:
    """First 16 hex digits of sha256(`id:salt`)."""
    return F.substring(F.sha2(F.concat(user_id.cast("string"), F.lit(f":{salt}")), 256), 1, 16)


def to_units(x: Column, digits: int) -> Column:
    """A number as the nearest whole multiple of 10^-digits, so that sums are exact in any order.

    Through a double on purpose: exact for up to 15 digits and far cheaper than
    decimal arithmetic or `round`.
    """
    return F.floor(x.cast("double") * F.lit(float(10**digits)) + F.lit(0.5))


def half_up_mean(units: Column, count: Column, in_digits: int, out_digits: int) -> Column:
    """Mean of units of 10^-in_digits, rounded half-up to `out_digits` by whole-number division."""
    step = F.lit(10 ** (in_digits - out_digits)).cast("bigint") * count
    return F.call_function("div", 2 * units + step, 2 * step) / F.lit(float(10**out_digits))


def hash_uniforms(text: Column, count: int) -> list[Column]:
    """`count` independent uniforms in [0,1) read off md5 digests of `text`.

    Reproducible whatever the partitioning, unlike `rand(seed)`.
    """
    out = []
    for i in range(count):
        digest = F.md5(F.concat(text, F.lit(f"#{i // 4}")))
        digits = F.substring(digest, 1 + 8 * (i % 4), 8)
        out.append(F.conv(digits, 16, 10).cast("bigint") / F.lit(float(2**32)))
    return out


def between_uniform(u: Column, bounds: tuple[float, float]) -> Column:
    low, high = bounds
    return F.lit(low) + u * F.lit(high - low)


def standard_normal(u1: Column, u2: Column) -> Column:
    """Box-Muller; `1 - u1` keeps the logarithm finite."""
    return F.sqrt(F.lit(-2.0) * F.log(F.lit(1.0) - u1)) * F.cos(F.lit(2 * math.pi) * u2)
