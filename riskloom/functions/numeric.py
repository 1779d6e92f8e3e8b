"""Column helpers for arithmetic, rounding, missing values and number texts."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def ratio(top: Column, bottom: Column) -> Column:
    """``top / bottom``; NULL, not an error, when the bottom is 0."""
    return F.try_divide(top, bottom)


def ratio_or_zero(top: Column, bottom: Column) -> Column:
    return F.coalesce(F.try_divide(top, bottom), F.lit(0.0))


def clip(x: Column, low: float, high: float) -> Column:
    """``x`` held within [low, high]; a missing ``x`` stays missing."""
    return F.when(x.isNotNull(), F.greatest(F.lit(float(low)), F.least(F.lit(float(high)), x)))


def half_even(x: Column, digits: int) -> Column:
    return F.bround(x, digits)


def finite(x: Column) -> Column:
    """NaN and infinities become NULL; aggregates then skip them."""
    bad = F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    return F.when(~bad, x)


def count_where(condition: Column) -> Column:
    """Rows for which ``condition`` holds; 0, not NULL, on no rows at all."""
    return F.count(F.when(condition, F.lit(1)))


def f1_score(precision: Column, recall: Column) -> Column:
    return ratio_or_zero(F.lit(2.0) * precision * recall, precision + recall)


def money_text(x: Column, digits: int = 2) -> Column:
    return F.concat(F.lit("$"), F.format_number(x, digits))


def percent_text(x: Column, digits: int = 2) -> Column:
    return F.concat(F.format_number(100 * x, digits), F.lit("%"))


def loan_label(key: Column) -> Column:
    return F.concat(F.lit("L-"), key.cast("string"))


def even_grid(low: float, high: float, points: int) -> Column:
    """An array of ``points`` evenly spaced values from ``low`` to ``high``."""
    step = (high - low) / (points - 1)
    return F.transform(
        F.sequence(F.lit(0), F.lit(points - 1)),
        lambda i: F.when(i == points - 1, F.lit(float(high))).otherwise(low + i * F.lit(step)),
    )
