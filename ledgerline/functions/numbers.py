"""Numbers as texts and keys."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import once

#: Multiplying by it splits a double into two halves of 26 bits.
_SPLIT = float((1 << 27) + 1)


def rounded(x: Column, digits: int) -> Column:
    """A double rounded to `digits` (at most 6) decimals by its exact binary value, ties to even: 2.0005, which is a little more than it
    says, gives 2.001, and 0.0625 gives 0.062.

    The value times 10^digits is held exactly as the sum of two doubles, whose distance from the half has the right sign. Null, NaN, infinities and
    values of 2^53 / 10^digits and more stay as they are; the sign of zero is kept."""
    scale = float(10**digits)

    def nearest(a: Column) -> Column:
        wide = a * F.lit(_SPLIT)
        high = wide - (wide - a)
        p, q = high * F.lit(scale), (a - high) * F.lit(scale)
        return once(F.struct(p.alias("p"), q.alias("q"), F.floor(p + q).cast("double").alias("f")), by_rest)

    def by_rest(s: Column) -> Column:
        over = (s["p"] - s["f"] - F.lit(0.5)) + s["q"]
        up = (over > 0) | ((over == 0) & (s["f"] % 2 == 1))
        return (s["f"] + F.when(up, 1.0).otherwise(0.0)) / F.lit(scale)

    small = once(F.abs(x), nearest)
    # a zero's sign shows only in its text
    signed = F.when(F.startswith(x.cast("string"), F.lit("-")), -small).otherwise(small)
    return F.when(F.abs(x) < F.lit(2.0**53 / scale), signed).otherwise(x)
