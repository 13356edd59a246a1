"""Percentages from integer counts, rounded half up to one decimal, NULL on an empty base."""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column
from pyspark.sql import functions as F


def _whole_div(num: Column, den: Column) -> Column:
    return F.call_function("div", num, den)


def tenths(num: Column, den: Column) -> Column:
    """100 * num / den in tenths of a percent, as BIGINT; counts are never negative."""
    base = F.nullif(den.cast("bigint"), F.lit(0).cast("bigint"))
    return _whole_div(num.cast("bigint") * F.lit(2000) + base, base * F.lit(2))


def pct(num: Column, den: Column) -> Column:
    return tenths(num, den) / F.lit(10.0)


def change_pct(now: Column, before: Column) -> Column:
    """Relative change in percent; rounds half away from zero on both sides."""
    diff = now.cast("bigint") - before.cast("bigint")
    sign = F.signum(diff.cast("double")).cast("bigint")
    return sign * tenths(F.abs(diff), before) / F.lit(10.0)


def below(num: Column, den: Column, threshold: float) -> Column:
    """num / den < threshold, compared in whole numbers."""
    t = Fraction(str(threshold))
    return num * F.lit(t.denominator) < den * F.lit(t.numerator)


def above(num: Column, den: Column, threshold: float) -> Column:
    t = Fraction(str(threshold))
    return num * F.lit(t.denominator) > den * F.lit(t.numerator)
